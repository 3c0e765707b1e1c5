"""Sources and sinks, the end-to-end run, and the streaming stages."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from holecard.operators import scoring
from holecard.plans import scorecard
from holecard.sources import corpus, stage_tables
from holecard.streaming import scoring_stream


def _write(root, rel, text):
    p = os.path.join(root, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", newline="") as f:
        f.write(text)


def test_corpus_scan(spark, tmp_out):
    _write(tmp_out, "core/src/Main.java", "class Main {\n  void run() {\n    go();\n  }\n}\n")
    _write(tmp_out, "core/src/MainTest.java", "class MainTest {}\n")
    _write(tmp_out, "web/App.java", "class App {}")
    _write(tmp_out, "web/notes.txt", "not java")
    src = {r["path"]: r for r in corpus.scan_source_files(spark, tmp_out).collect()}
    assert set(src) == {"core/src/Main.java", "web/App.java"}
    assert src["core/src/Main.java"]["module"] == "core"
    assert src["web/App.java"]["text"] == "class App {}"
    tests = [r["path"] for r in corpus.scan_unit_test_files(spark, tmp_out).collect()]
    assert tests == ["core/src/MainTest.java"]


def test_csv_round_trip_keeps_multiline_cells(spark, tmp_out):
    df = spark.createDataFrame([("p1", 'say "hi"\nnext line', 1)], "prompt_id string, label string, n int")
    path = os.path.join(tmp_out, "t")
    stage_tables.write_stage_csv(df, path)
    back = stage_tables.read_stage_csv(spark, path, "prompt_id string, label string, n int").collect()
    assert back[0]["label"] == 'say "hi"\nnext line' and back[0]["n"] == 1


def test_module_results_json(spark, tmp_out):
    doc = {"core": {"pass": True, "failure_count": 0, "failed_tests": [], "error_count": 0},
           "web": {"pass": False, "failure_count": 2, "failed_tests": ["A.b", "C.d"], "error_count": 1}}
    src = os.path.join(tmp_out, "base_module_build_results_abc.json")
    with open(src, "w") as f:
        json.dump(doc, f, indent=4)
    rows = {r["module"]: r for r in stage_tables.read_module_results(spark, src).collect()}
    assert rows["web"]["failed_tests"] == ["A.b", "C.d"] and rows["core"]["built"]
    out = os.path.join(tmp_out, "modules")
    stage_tables.write_module_results(stage_tables.read_module_results(spark, src), out)
    again = {r["module"]: r for r in stage_tables.read_module_results_lines(spark, out).collect()}
    assert again["web"]["error_count"] == 1 and not again["web"]["built"]


def test_result_name_parse(spark):
    df = spark.createDataFrame([("20231212-142722_tokens_df_codellama-7b_output",)], "n string")
    r = df.select(*[c.alias(k) for k, c in stage_tables.parse_result_name(F.col("n")).items()]).collect()[0]
    assert (r["run_stamp"], r["prompt_kind"], r["model"]) == ("20231212-142722", "tokens", "codellama-7b")


def test_scorecard_with_completion_table_and_sidecars(spark, tmp_out):
    _write(tmp_out, "src/core/A.java", "class A {\n" + "".join(
        f"  int m{i}() {{\n    int v = {i};\n    return v + {i};\n  }}\n" for i in range(30)) + "}\n")
    _write(tmp_out, "src/core/B.java", "class B {\n  int b() {\n    return 1;\n  }\n}\n")
    files = corpus.scan_source_files(spark, os.path.join(tmp_out, "src"))
    cfg = scorecard.RunConfig(run_ts="t0", train_ratio=0.5, lines_prompts_count=3,
                              tokens_prompts_count=3, methods_prompts_count=3)
    res = scorecard.run_scorecard(files, cfg)
    prompts = res["prompts"].collect()
    assert {p["kind"] for p in prompts} <= {"lines", "tokens", "methods"}
    assert all(p["path_in_code_repo"] in ("core/A.java", "core/B.java") for p in prompts)
    # the same run with completions from a table: a label scores 1 against
    # itself, except that orders longer than the text get the 0.1 smoothing
    perfect = res["prompts"].select("prompt_id", F.lit(0).alias("sample_idx"),
                                    F.col("label").alias("completion"))
    res2 = scorecard.run_scorecard(files, cfg, completions=perfect)
    toks = scoring.score_tokens("label")[0]
    for r in res2["evaluated"].select("ngram_match_score", F.size(toks).alias("n")).collect():
        assert r["ngram_match_score"] == pytest.approx(0.1 ** (max(0, 4 - r["n"]) / 4))
    assert res2["summary"].count() == len({p["kind"] for p in prompts})
    stage_tables.write_sidecar(spark, res["config"], os.path.join(tmp_out, "config"))
    stage_tables.write_run_table(res["evaluated"].drop("params").withColumn("run_ts", F.lit("t0")),
                                 os.path.join(tmp_out, "evaluated"), ["run_ts"])
    assert spark.read.parquet(os.path.join(tmp_out, "evaluated")).count() == len(prompts)


def test_streaming_scores_equal_batch(spark, tmp_out):
    src = os.path.join(tmp_out, "incoming")
    rows = pd.DataFrame({"prompt_id": ["a", "b", "c"], "result_name": ["r1", "r1", "r2"],
                         "label": ["x = 1 ;", "return y ;", "f ( a )"],
                         "completion": ["x = 1 ;\n <EOT>", "return z ;", "f ( b )"]})
    spark.createDataFrame(rows).write.parquet(os.path.join(src, "batch0"))
    sink = os.path.join(tmp_out, "scored")
    q = scoring_stream.start_scoring(spark, os.path.join(src, "batch0"), sink, name="t_scoring")
    q.awaitTermination(120)
    got = {r["prompt_id"]: r["codebleu"] for r in spark.read.parquet(sink).collect()}
    batch = scoring.code_bleu(spark.createDataFrame(rows).withColumn(
        "completion", scoring.strip_eot("completion")))
    want = {r["prompt_id"]: r["codebleu"] for r in batch.collect()}
    assert got == pytest.approx(want)
    s = scoring_stream.start_summary(spark, os.path.join(src, "batch0"), "t_summary")
    s.awaitTermination(120)
    summ = {r["result_name"]: r["n_responses"] for r in spark.sql("SELECT * FROM t_summary").collect()}
    assert summ == {"r1": 2, "r2": 1}


def test_scorecard_by_module_with_outcomes(spark, tmp_out):
    for mod in ("core", "web", "cli"):
        _write(tmp_out, f"src/{mod}/A{mod}.java", "class A {\n" + "".join(
            f"  int m{i}() {{\n    int v = {i};\n    return v * {i};\n  }}\n" for i in range(5)) + "}\n")
        _write(tmp_out, f"src/{mod}/B{mod}.java", "class B {\n  int b() {\n    int q = 2;\n    return q;\n  }\n}\n")
    files = corpus.scan_source_files(spark, os.path.join(tmp_out, "src"))
    cfg = scorecard.RunConfig(run_ts="t1", split_strategy="by_module", lines_prompts_count=4,
                              tokens_prompts_count=4, methods_prompts_count=4,
                              evaluation_metrics=("CodeBLEU", "pass@k"))
    res = scorecard.run_scorecard(files, cfg)
    tests = res["mapping"].where(F.col("split") == "test").collect()
    assert len(tests) == 3 and {t["old_path"].split("/")[0] for t in tests} == {"core", "web", "cli"}
    outcomes = res["responses"].select("prompt_id", "sample_idx", F.lit(True).alias("built"),
                                       F.lit(0).alias("error_count"), F.lit(0).alias("failure_count"))
    res2 = scorecard.run_scorecard(files, cfg, outcomes=outcomes)
    for r in res2["summary"].collect():
        assert r["successful_build_rate"] == 1.0 and r["pass_at_1_rate"] == 1.0
        assert r["successful_build_rate_moe"] == 0.0


def test_command_line_run(tmp_out):
    import subprocess
    import sys
    _write(tmp_out, "cb/core/A.java", "class A {\n" + "".join(
        f"  int m{i}() {{\n    int v = {i};\n    return v + {i};\n  }}\n" for i in range(12)) + "}\n")
    _write(tmp_out, "cb/web/W.java", "class W {\n" + "".join(
        f"  void w{i}() {{\n    call({i});\n    done();\n  }}\n" for i in range(12)) + "}\n")
    out = os.path.join(tmp_out, "runs")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    proc = subprocess.run([sys.executable, "-m", "holecard", "--code-base", os.path.join(tmp_out, "cb"),
                           "--out", out, "--master", "local[2]", "--train-ratio", "0.5",
                           "--format", "csv"], cwd=root, capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    run_dir = proc.stdout.strip().splitlines()[-1]
    assert sorted(os.listdir(run_dir)) == sorted(list(scorecard.STAGE_TABLES) + ["config"])


def test_resume_from_analysis(spark, tmp_out):
    _write(tmp_out, "src/core/A.java", "class A {\n" + "".join(
        f"  int m{i}() {{\n    int v = {i};\n    return v + {i};\n  }}\n" for i in range(20)) + "}\n")
    _write(tmp_out, "src/web/B.java", "class B {\n" + "".join(
        f"  int b{i}() {{\n    int w = {i};\n    return w;\n  }}\n" for i in range(20)) + "}\n")
    files = corpus.scan_source_files(spark, os.path.join(tmp_out, "src"))
    cfg = scorecard.RunConfig(run_ts="r9", train_ratio=0.5, lines_prompts_count=5,
                              tokens_prompts_count=5, methods_prompts_count=5)
    res = scorecard.run_scorecard(files, cfg)
    run_dir = scorecard.write_run(spark, res, os.path.join(tmp_out, "runs"))
    staged = scorecard.run_staged(spark, files, cfg, os.path.join(tmp_out, "staged"))
    for name in ("mapping", "prompts", "summary"):
        want = sorted(map(tuple, res[name].collect()), key=repr)
        assert sorted(map(tuple, spark.read.parquet(f"{staged}/{name}").collect()), key=repr) == want
    as_csv = scorecard.run_staged(spark, files, cfg, os.path.join(tmp_out, "csv"), fmt="csv")
    prompts = stage_tables.read_stage_csv(spark, f"{as_csv}/prompts")
    assert sorted(r["prompt_id"] for r in prompts.collect()) == sorted(r["prompt_id"] for r in res["prompts"].collect())
    again = scorecard.resume_scorecard(spark, run_dir, None, cfg, "analyze")
    assert sorted(map(tuple, again["summary"].collect()), key=repr) == \
        sorted(map(tuple, res["summary"].collect()), key=repr)
    redo = scorecard.resume_scorecard(spark, run_dir, files, cfg, "completions")
    assert redo["summary"].count() == res["summary"].count()
