"""Token places, constructors, lookups, result files, run history and stored baselines."""

import os
from fractions import Fraction
from math import comb

import pytest
from pyspark.sql import functions as F

from holecard.functions.arrays import running_sums
from holecard.operators import candidates as cand
from holecard.operators import outcomes as outc
from holecard.operators import scoring, splits
from holecard.plans import scorecard as sc
from holecard.sources import stage_tables
from holecard.sources.tables import spread

CLASS = """package a.b;
import static x.Y.*;
class Outer<T> extends Base {
    Outer made = new Outer(1);
    @Inject public Outer(int a) {
        super(a);
        run(a);
    }
    <X> Outer(X a, int b) {
        this(b);
        go();
    }
    Outer copy() {
        return new Outer(2);
    }
    enum Inner {
        ;
        Inner() {
            Outer(3);
            x();
        }
        Outer(int wrong) {
            y();
            z();
        }
    }
    Object o = new Object() {
        void shown() {
            w();
        }
    };
}
"""


def _files(spark, *texts):
    return spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "path string, text string")


def test_constructors_are_methods_named_as_their_type(spark):
    names = lambda flag: sorted(
        (r.method, r.body_start_line) for r in cand.method_bodies(_files(spark, CLASS), flag)[0].collect())
    plain = names(False)
    assert ("copy", 13) in plain and ("shown", 28) in plain and ("Inner", 18) not in plain
    both = names(True)
    # `<X> Outer(` has a type before its name, as the rule of methods goes
    assert [m for m in both if m not in plain] == [("Inner", 18), ("Outer", 5)]


def test_token_places_count_from_the_text_with_lf(spark):
    text = "int a;\r\n/* x\r\n y */ b = \"q\";\rc\n"
    got = [(r.token, r.line, r.column, r.offset) for r in
           cand.token_places(_files(spark, text)).orderBy("token_idx").collect()]
    flat = text.replace("\r\n", "\n").replace("\r", "\n")
    want = []
    for token, at in (("int", 0), ("a", 4), (";", 5), ("b", flat.index("b =")), ("=", flat.index("=")),
                      ('"q"', flat.index('"')), (";", flat.index(";", 8)), ("c", flat.rindex("c"))):
        line = flat[:at].count("\n") + 1
        want.append((token, line, at - (flat[:at].rfind("\n") + 1) + 1, at))
    assert got == want
    assert cand.token_places(_files(spark, "'open", "", None)).count() == 0


def test_running_sums_of_long_arrays(spark):
    for n in (0, 1, 31, 32, 33, 2000):
        sizes = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: (i % 7).cast("long")) if n \
            else F.array().cast("array<long>")
        got = spark.range(1).select(running_sums(sizes).alias("s")).first()["s"]
        assert got == [sum(i % 7 for i in range(1, k)) for k in range(1, n + 1)]


def test_import_statements_hold_no_candidates(spark):
    text = "package a.b; import c.d; class E { int f; } import g"
    kept = lambda flag: [r.token for r in cand.token_candidates(
        _files(spark, text), 0, 0, 1, skip_import_lines=flag).orderBy("token_idx").collect()]
    assert kept(True) == ["class", "E", "{", "int", "f", ";"]
    assert kept(False)[:4] == ["a", ".", "b", ";"]


def test_one_lexing_gives_the_candidates_of_every_kind(spark):
    files = _files(spark, CLASS, "class A { 'open\n}\n", CLASS.replace("\n", "\r\n"), "")
    both = cand.prompt_candidates(files, 2, 2).cache()
    of = lambda kind: both.where(F.col("kind") == kind)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(of("lines").select("path", "idx")) == rows(cand.line_candidates(files, 2))
    assert rows(of("tokens").select("path", "idx")) == rows(cand.token_candidates(files, 2).select("path", "token_idx"))
    bodies, skips = cand.bodies_of_marks(of("marks").select("path", "mark", "method"))
    want, want_skips = cand.method_bodies(files)
    assert rows(bodies) == rows(want) and rows(skips) == rows(want_skips)
    assert rows(sc.skipped_files(both)) == rows(cand.token_lex_failures(files).unionByName(want_skips))


def test_sample_reads_its_candidates_once(spark):
    df = spark.range(1000).withColumn("path", F.lit("p"))
    plan = splits.sample_k(df, 10, 0, "x", ["path", "id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "TakeOrderedAndProject" in plan


def _runs(spark):
    text = "class A {\n" + "".join(f"  int m{i}() {{\n    int v = {i};\n    return v;\n  }}\n" for i in range(12)) + "}\n"
    return spark.createDataFrame([(f"{m}/{n}{i}.java", f"{n}{i}.java", m, text.replace("A", f"{n}{i}"))
                                  for i, (m, n) in enumerate([("core", "A"), ("web", "B"), ("cli", "C")] * 3)],
                                 "path string, file_name string, module string, text string")


CFG = dict(train_ratio=0.4, lines_prompts_count=5, tokens_prompts_count=5, methods_prompts_count=5)


def test_prompts_without_a_mapping_are_skipped_with_a_reason(spark):
    files, cfg = _runs(spark), sc.RunConfig(run_ts="r", **CFG)
    mapping = sc.split_stage(files, cfg)
    tests = sc.test_files(files, mapping, cfg.seed)
    known = mapping.where("split = 'test'").orderBy("old_path").limit(2)
    prompts, skipped = sc.prompt_stage(tests, known, cfg)
    kept, lost = prompts.collect(), skipped.collect()
    paths = {r.old_path for r in known.collect()}
    assert len(kept) + len(lost) == 15 and kept and lost
    assert {r.path_in_code_repo for r in kept} <= paths and not {r.old_path for r in lost} & paths
    assert {r.reason for r in lost} <= {"line_removal_prompts", "token_removal_prompts", "method_removal_prompts"}
    assert len({r.prompt_id for r in kept}) == len(kept)


def test_csv_run_resumes_and_history_is_pruned(spark, tmp_out):
    files, cfg = _runs(spark), sc.RunConfig(run_ts="r1", **CFG)
    run_dir = sc.run_staged(spark, files, cfg, tmp_out, fmt="csv")
    assert sorted(os.listdir(run_dir)) == sorted(list(sc.STAGE_TABLES) + ["config"])
    want = sorted(map(tuple, spark.read.parquet(f"{sc.stages_dir(run_dir, 'csv')}/summary").collect()), key=repr)
    for step in ("analyze", "evaluate", "completions"):
        again = sc.resume_scorecard(spark, run_dir, files, cfg, step, fmt="csv")
        assert sorted(map(tuple, again["summary"].collect()), key=repr) == want
    first = sc.read_history(spark, tmp_out).count()
    sc.run_staged(spark, files, cfg, tmp_out)  # the same run again replaces its rows
    assert sc.read_history(spark, tmp_out).count() == first
    other = sc.RunConfig(run_ts="r2", **CFG)
    written = sc.write_run(spark, sc.run_scorecard(files, other), tmp_out, fmt="csv")
    assert sc.resume_scorecard(spark, written, None, other, "analyze", fmt="csv")["summary"].count() == 3
    lines = sc.read_history(spark, tmp_out, run_stamp="r2", prompt_kind="lines")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_stamp" in plan and "prompt_kind" in plan
    assert {(r.run_stamp, r.kind) for r in lines.collect()} == {("r2", "lines")}
    assert sc.read_history(spark, tmp_out).count() == 2 * first


def test_result_and_prompt_files_of_a_folder(spark, tmp_out):
    def put(name, text):
        with open(os.path.join(tmp_out, name), "w", newline="") as f:
            f.write(text)
    put("20231212-142816_lines_df_codellama-7b_output.csv",
        'prompt_id,label\n1,"two\nlines, ""quoted"""\n2,\n3,""\n')
    put("notes.csv", "a,b\n1,2\n")
    rows = spark.createDataFrame([("9", " x \n", "20231212-142722_tokens_df_m_output"), ("8", None, "20240101-000000_methods_df_m_output")],
                                 "prompt_id string, label string, result_name string")
    stage_tables.write_result_files(rows, os.path.join(tmp_out, "more"))
    stage_tables.write_result_files(rows.limit(1), os.path.join(tmp_out, "more"))  # replaces only its own
    got = {(r.prompt_id, r.label, r.run_stamp, r.prompt_kind, r.model) for r in
           stage_tables.read_result_files(spark, tmp_out, "prompt_id string, label string").collect()}
    assert got == {("1", 'two\nlines, "quoted"', "20231212-142816", "lines", "codellama-7b"),
                   ("2", None, "20231212-142816", "lines", "codellama-7b"),
                   ("3", None, "20231212-142816", "lines", "codellama-7b"),  # as in pandas
                   ("9", " x \n", "20231212-142722", "tokens", "m"), ("8", None, "20240101-000000", "methods", "m")}
    folder = os.path.join(tmp_out, "prompts")
    os.makedirs(folder)
    for name in ("lines_df.csv", "skipped_files.csv"):
        put(f"prompts/{name}", "path,label\np,l\n")
    assert [r.source_file for r in stage_tables.read_prompt_tables(spark, folder).collect()] == ["lines_df.csv"]


def test_baselines_are_made_once_a_version(spark, tmp_out):
    path, asked = os.path.join(tmp_out, "baselines"), []
    known = spark.createDataFrame([("a", True, 0, 1, ["t"]), ("b", False, 2, 0, [])],
                                  "module string, built boolean, failure_count int, error_count int, "
                                  "failed_tests array<string>")

    def made(missing):
        asked.append(sorted(r.module for r in missing.collect()))
        return known.join(missing, "module", "left_semi")

    catalogue = spark.createDataFrame([("a",), ("b",), ("c",), ("a",)], "module string")
    outc.extend_baselines(spark, path, catalogue.where("module = 'a'"), made, "v1")
    outc.extend_baselines(spark, path, catalogue, made, "v1")
    found = outc.extend_baselines(spark, path, catalogue, made, "v1")
    outc.extend_baselines(spark, path, catalogue, made, "v2")
    assert asked == [["a"], ["b", "c"], [], ["a", "b", "c"]]
    assert sorted((r.module, r.built) for r in found.collect()) == [("a", True), ("b", False), ("c", False)]
    assert outc.read_baselines(spark, path).count() == 6
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(code_version" in plan


def test_equal_edits_share_a_build(spark):
    rows = spark.createDataFrame(
        [(1, "m/A.java", "a\nb\nc\n", "b\n", "x\n", 2), (2, "m/A.java", "a\nb\nc\n", "b\n", "x\n", 2),
         (3, "m/A.java", "a\nb\nc\n", "b\n", "y\n", 2), (4, "n/A.java", "a\nb\nc\n", "b\n", "x\n", 2),
         (5, "m/A.java", "a\nb\nc\n", "b\nc\n", "x\nc\n", 2)],
        "prompt_id int, path_in_code_repo string, text string, label string, completion string, offset int")
    responses, builds = outc.edited_builds(rows)
    keys = {r.prompt_id: (r.module, r.build_key) for r in responses.collect()}
    assert keys[1] == keys[2] == keys[5] and len({k for _, k in keys.values()}) == 3
    assert sorted((r.module, r.path, r.edited) for r in builds.collect()) == [
        ("m", "m/A.java", "a\nx\nc\n"), ("m", "m/A.java", "a\ny\nc\n"), ("n", "n/A.java", "a\nx\nc\n")]


def test_pass_at_large_k_equals_exact_fractions(spark):
    rows = [(g, i < c) for g, (n, c) in enumerate([(100, 0), (100, 1), (150, 7), (99, 5), (120, 120), (300, 20)])
            for i in range(n)]
    df = spark.createDataFrame(rows, "g int, built boolean")
    got = {r.g: (r.pass_at_3, r.pass_at_100) for r in outc.pass_at_k(df, ["g"], [3, 100]).collect()}
    for g, (n, c) in enumerate([(100, 0), (100, 1), (150, 7), (99, 5), (120, 120), (300, 20)]):
        for k, found in zip((3, 100), got[g]):
            want = None if n < k else float(1 - Fraction(comb(n - c, k), comb(n, k)))
            assert found is None if want is None else found == pytest.approx(want, abs=1e-12)


def test_weighted_score_against_the_whole_reference(spark):
    pairs = spark.createDataFrame([("a = b + c ;", "a = b")], "label string, completion string")
    plain = scoring.ngram_match_scores(pairs).first()["weighted_ngram_match_score"]
    whole = scoring.ngram_match_scores(pairs, whole_reference=True).first()["weighted_ngram_match_score"]
    assert whole == pytest.approx(plain * 2.718281828459045 ** (1 - 6 / 3))


def test_spread_gives_small_tables_a_task_per_core(spark):
    df = spark.range(100).coalesce(1)
    assert spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(100).repartition(64)
    assert spread(wide) is wide


def test_spread_refills_splits_that_may_be_empty(spark):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(100).repartition(cores + 1)
    assert spread(df, waves=4).rdd.getNumPartitions() == 4 * cores
    assert spread(df.coalesce(1), waves=4).rdd.getNumPartitions() == cores


def test_clipped_counts_of_long_pairs_match_plain_loops(spark):
    words = ["if", "x", "=", "y", ";", "return", "\"a b\""]
    label = [words[i * i % 7] for i in range(60_000)]
    completion = [words[i * i * i % 7] for i in range(50_000)]
    ok, hl, rl, *m, wm1, wr1 = scoring.pair_counts(" ".join(label), " // c\n".join(completion))
    assert (ok, hl, rl) == (True, 50_000, 60_000)
    for n in range(1, 5):
        r, h = ({} for _ in range(2))
        for counts, toks in ((r, label), (h, completion)):
            for i in range(len(toks) - n + 1):
                gram = tuple(toks[i:i + n])
                counts[gram] = counts.get(gram, 0) + 1
        assert m[n - 1] == sum(min(c, h.get(g, 0)) for g, c in r.items())
        if n == 1:
            weight = lambda t: 1.0 if t in ("if", "return") else 0.2
            assert wm1 == pytest.approx(sum(min(c, h.get((t,), 0)) * weight(t) for (t,), c in r.items()))
            assert wr1 == pytest.approx(sum(c * weight(t) for (t,), c in r.items()))


def test_scores_scan_every_pair_once(spark):
    pairs = spark.createDataFrame([("a = b + c ;", "a = b", 0.5, 0.5)], "label string, completion string, s double, d double")
    plan = scoring.code_bleu(pairs, syntax="s", dataflow="d")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "array_sort" not in plan


def test_rows_of_tokens_carry_no_arrays(spark):
    text = "class A { int f = g ( 1 ) ; }\n// c\n" * 3000
    files = _files(spark, text, None, "'open", "")
    plan = cand.token_candidates(files, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("MapInArrow") == 1
    toks = text.replace("// c", "").split()
    got = [(r.token_idx, r.token) for r in cand.token_candidates(files, 2).orderBy("token_idx").collect()]
    assert got == list(enumerate(toks))[1:-3]
    places = cand.token_places(files).orderBy("offset").collect()
    assert [r.token for r in places] == toks
    assert (places[-1].line, places[-1].column, places[-1].offset) == (5999, 29, len(text) - 7)


def test_marks_are_spread_by_number(spark):
    bodies, skips = cand.method_bodies(_files(spark, CLASS, None, "'open"), True)
    cores = spark.sparkContext.defaultParallelism
    plan = bodies._jdf.queryExecution().executedPlan().toString()
    assert f"{cand.MARK_PARTITIONS * cores}), REPARTITION_BY_NUM" in plan
    assert plan.count("hashpartitioning") == plan.count("REPARTITION_BY_NUM")
    assert skips.where("reason = 'all_relevant_method_bodies'").count() >= 2
