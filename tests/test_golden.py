"""Scores and summaries of small rows with values computed by hand."""

import pytest
from pyspark.sql import functions as F

from holecard.operators import scoring, summary
from holecard.sources import stage_tables

# label, completion, n-gram match
PAIRS = [
    ("same", "int total = count + 1 ;", "int total = count + 1 ;", 1.0),
    # 4/5 of the words, 3/4, 2/3 and 1/2 of the longer runs: (0.2) ** (1 / 4)
    ("last_word", "alpha beta gamma delta omega", "alpha beta gamma delta sigma", 0.2 ** 0.25),
    ("nothing", "alpha beta", "gamma delta", 0.0),
    ("open_literal", 'String s = "a";', 'String s = "a;', None),
]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame(PAIRS, "prompt_id string, label string, completion string, want double")
    return scoring.ngram_match_scores(df)


def test_ngram_match(scored):
    for r in scored.collect():
        if r["want"] is None:
            assert r["ngram_match_score"] is None and not r["lex_ok"]
        else:
            assert r["ngram_match_score"] == pytest.approx(r["want"], abs=1e-6), r["prompt_id"]


def test_composite_is_a_quarter_of_each(scored):
    out = scored.select("prompt_id", scoring.composite_score(
        F.lit(0.4), F.lit(0.8), F.lit(0.2), F.lit(0.6)).alias("c")).collect()
    assert all(r["c"] == pytest.approx(0.5) for r in out)


def test_summary_of_two_results(spark):
    rows = [("run_lines_df", 0.25, 0.5, 0.5, 1.0, 0.5, "a b", "a"), ("run_lines_df", 0.75, 0.5, 0.5, 0.0, 1.0, "a", "a b c"),
            ("run_tokens_df", None, None, None, None, None, "a", "b")]
    df = spark.createDataFrame(rows, "result_name string, codebleu double, ngram_match_score double, "
                               "weighted_ngram_match_score double, syntax_match_score double, "
                               "dataflow_match_score double, label string, completion string")
    got = {r["result_name"]: r for r in summary.summary_table(df).collect()}
    lines = got["run_lines_df"]
    assert lines["average_code_bleu"] == 0.5 and lines["average_code_bleu_moe"] == pytest.approx(0.125 ** 0.5)
    assert lines["average_label_token_count"] == 1.5 and lines["average_completion_token_count"] == 2.0
    assert lines["prompt_type"] == "lines" and got["run_tokens_df"]["average_code_bleu"] is None


def test_csv_cells_keep_line_breaks_and_quotes(spark, tmp_path):
    rows = [("a", 'x = "1";\n\n// two, lines\n'), ("b", "plain")]
    df = spark.createDataFrame(rows, "prompt_id string, prompt string")
    stage_tables.write_stage_csv(df, f"{tmp_path}/t")
    assert sorted((r["prompt_id"], r["prompt"]) for r in stage_tables.read_stage_csv(spark, f"{tmp_path}/t").collect()) == rows
