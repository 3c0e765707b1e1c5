"""Registered queries: each operator family on the stand-in tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names and types equal those of the SQL of the same name in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holecard.functions.text import normalize_newlines, split_lines
from holecard.operators import candidates as cand
from holecard.operators import completions as comp
from holecard.operators import graph as gr
from holecard.operators import masking
from holecard.operators import matching as mt
from holecard.operators import outcomes as outc
from holecard.operators import scoring, splits
from holecard.operators import summary as summ
from holecard.plans import scorecard as sc
from holecard.plans import standins as si
from holecard.plans.standins import code_files, completion_pairs, table
from holecard.session import scratch_path, write_table
from holecard.sources import stage_tables

SEED = 0
# Prompt counts of the registered queries (sampling is the feature being run).
LINES_K = 200
TOKENS_K = 200
METHODS_K = 200
NUM_LABEL_LINES = 2
NUM_LABEL_TOKENS = 2
SPAN_LINES = 3
OUT_DIR = "data/run"


def corpus_scan_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Application files (name without 'test') and unit-test files, with
    their length as the scan reads them (line ends as ``\\n``)."""
    files = code_files(spark, sf_dir)
    is_java = F.col("file_name").endswith(".java")
    is_test = F.lower("file_name").contains("test")
    return files.where(is_java).select(
        "path", "file_name",
        F.when(is_test, F.lit("test")).otherwise(F.lit("app")).alias("role"),
        F.length(normalize_newlines("text")).cast("long").alias("n_chars"))


def module_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """module = first path component; files per module."""
    files = code_files(spark, sf_dir)
    return files.groupBy(splits.module_of("path").alias("module")) \
        .agg(F.count(F.lit(1)).alias("n_files"))


def line_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = code_files(spark, sf_dir)
    return cand.line_candidates(files, NUM_LABEL_LINES).select(
        "path", F.col("line_idx").cast("int").alias("line_idx"))


def _line_prompts(spark: SparkSession, sf_dir: str, infill: bool) -> DataFrame:
    files = code_files(spark, sf_dir).select("path", "text")
    cands = cand.line_candidates(files, NUM_LABEL_LINES)
    chosen = splits.sample_k(cands, LINES_K, SEED, "lines", ["path", "line_idx"])
    rows = splits.join_back(chosen, files, ["path"])
    out = masking.mask_lines(rows, "line_idx", NUM_LABEL_LINES, infill=infill)
    return out.select(
        F.concat_ws(":", F.lit("lines"), "path", F.col("line_idx").cast("string")).alias("prompt_id"),
        "path", F.col("path").alias("path_in_code_repo"), "prompt", "label",
        "start_line", "end_line")


def line_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1+T2 -> P6 -> M1/M2: infill prompts masking two lines."""
    return _line_prompts(spark, sf_dir, infill=True)


def prefix_only_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same without infill: the prompt is the prefix, the label the rest."""
    return _line_prompts(spark, sf_dir, infill=False)


def one_candidate_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One random maskable line of every file."""
    cands = cand.line_candidates(code_files(spark, sf_dir).select("path", "text"), NUM_LABEL_LINES)
    return splits.one_per_file(cands, SEED, "line", "line_idx").select(
        "path", F.col("line_idx").cast("int").alias("line_idx"))


def token_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 + T3: maskable code tokens of files that lex."""
    files = code_files(spark, sf_dir)
    return cand.token_candidates(files, NUM_LABEL_TOKENS).select(
        "path", F.col("token_idx").cast("int").alias("token_idx"), "token")


def token_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 -> P6 -> M3: infill prompts masking two tokens."""
    files = code_files(spark, sf_dir).select("path", "text")
    cands = cand.token_candidates(files, NUM_LABEL_TOKENS).select("path", "token_idx")
    chosen = splits.sample_k(cands, TOKENS_K, SEED, "tokens", ["path", "token_idx"])
    rows = splits.join_back(chosen, files, ["path"])
    out = masking.mask_tokens(rows, "token_idx", NUM_LABEL_TOKENS)
    return out.select(
        F.concat_ws(":", F.lit("tokens"), "path", F.col("token_idx").cast("string")).alias("prompt_id"),
        "path", F.col("path").alias("path_in_code_repo"), "prompt", "label",
        "start_line", "end_line")


def token_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line, column and offset of every code token (CRLF files included)."""
    files = code_files(spark, sf_dir).select("path", "text")
    return cand.token_places(files).select("path", F.col("token_idx").cast("int").alias("token_idx"), "token",
                                           "line", "column", "offset")


def tokens_without_imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with ``skip_import_lines``: no token of an import or package statement."""
    files = code_files(spark, sf_dir)
    return cand.token_candidates(files, NUM_LABEL_TOKENS, skip_import_lines=True).select(
        "path", F.col("token_idx").cast("int").alias("token_idx"), "token")


def span_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: prompts that mask a span of lines given by its ends."""
    files = code_files(spark, sf_dir).select("path", "text")
    chosen = splits.sample_k(cand.line_candidates(files, SPAN_LINES), LINES_K, SEED, "lines", ["path", "line_idx"])
    rows = splits.join_back(chosen, files, ["path"]).withColumn("end_idx", F.col("line_idx") + SPAN_LINES)
    return masking.mask_span(rows, "line_idx", "end_idx").select(
        F.concat_ws(":", F.lit("lines"), "path", F.col("line_idx").cast("string")).alias("prompt_id"),
        "path", F.col("path").alias("path_in_code_repo"), "prompt", "label", "start_line", "end_line")


def lex_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 (token kind): files the lexer rejects."""
    return cand.token_lex_failures(code_files(spark, sf_dir))


def split_random_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 80/20 split in seeded random order."""
    files = code_files(spark, sf_dir).select("path", "file_name")
    return splits.split_random_exact(files, 0.8, SEED).select(
        "path", "split", F.col("split_id").cast("long").alias("split_id"))


def split_holdout_per_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One random test file per module."""
    files = code_files(spark, sf_dir).select("path", "module")
    return splits.split_holdout_per_module(files, SEED).select("path", "module", "split")


def file_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: old path -> flat new path ``out/<split>/<id>_<name>``."""
    files = code_files(spark, sf_dir).select("path", "file_name")
    return splits.file_mapping(splits.split_random_exact(files, 0.8, SEED), OUT_DIR)


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = completion_pairs(spark, sf_dir)
    pairs = pairs.withColumn("completion", scoring.strip_eot("completion"))
    return scoring.code_bleu(si.with_matches(pairs), syntax="syntax_match", dataflow="dataflow_match")


def ngram_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 (+C4): BLEU-4 n-gram match of every pair."""
    pairs = completion_pairs(spark, sf_dir)
    return scoring.ngram_match_scores(pairs).select("prompt_id", _r6("ngram_match_score"))


def weighted_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 (+C4): keyword-weighted n-gram match of every pair."""
    pairs = completion_pairs(spark, sf_dir)
    return scoring.ngram_match_scores(pairs).select(
        "prompt_id", _r6("weighted_ngram_match_score"))


def weighted_ngram_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 with the brevity penalty against the whole reference (flag of Q10)."""
    pairs = completion_pairs(spark, sf_dir)
    return scoring.ngram_match_scores(pairs, whole_reference=True).select(
        "prompt_id", _r6("weighted_ngram_match_score"))


def composite_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 (+C4): composite with syntax and data-flow matches as inputs."""
    return _scored(spark, sf_dir).select(
        "prompt_id", "kind", _r6("ngram_match_score"), _r6("weighted_ngram_match_score"),
        _r6("syntax_match_score"), _r6("dataflow_match_score"), _r6("codebleu"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separator-split token counts (published form) and lexed counts."""
    pairs = completion_pairs(spark, sf_dir)
    return pairs.select(
        "prompt_id",
        scoring.token_count("label").cast("long").alias("label_token_count"),
        scoring.token_count("completion").cast("long").alias("completion_token_count"),
        scoring.token_count_lexed("label").cast("long").alias("label_code_tokens"))


def perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 per user: events' values as token probabilities ``1 / (1 + value)``.

    Long form with plain aggregates (``exp(-(sum ln p - ln p_first) / n)``):
    no per-user list is ever built, so a hot user is reduced map-side.
    """
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    probs = ev.select("user_id", F.struct("ts", "event_id").alias("_o"),
                      (1.0 / (1.0 + F.col("value"))).alias("p"))
    out = scoring.perplexity_by_group(probs, "user_id", "_o", "p")
    return out.select("user_id", F.col("n_tokens").cast("long").alias("n_tokens"), _r6("perplexity"))


def strip_eot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4 on every pair: completions with the end-of-text marker removed."""
    pairs = completion_pairs(spark, sf_dir)
    return pairs.select("prompt_id", scoring.strip_eot(
        F.concat("completion", F.lit(scoring.EOT_SUFFIX))).alias("completion"))


def stop_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw output that ran past the stop sequence (completion, stop,
    label) is cut back at the first stop sequence."""
    pairs = completion_pairs(spark, sf_dir)
    raw = F.concat("completion", F.lit(comp.STOP_SEQUENCE), "label")
    return pairs.select("prompt_id", comp.stop_cut(raw).alias("completion"))


def samples_expand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three samples of every sampled line prompt."""
    prompts = line_prompts(spark, sf_dir).select("prompt_id")
    return comp.expand_samples(prompts, 3).select("prompt_id", F.col("sample_idx").cast("int"))


def batch_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + G2: a batch callable (stand-in model) completes the sampled prompts."""
    prompts = line_prompts(spark, sf_dir).select("prompt_id", "prompt")
    done = comp.complete_with(prompts, comp.previous_line_completer)
    return done.select("prompt_id", "completion", comp.params_struct()["model"].alias("model"))


def build_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: failure/error counts, number and first of the failed tests per build."""
    parsed = outc.parse_build_logs(si.build_logs(spark, sf_dir))
    return parsed.select(
        "build_id", F.col("failure_count").cast("long").alias("failure_count"),
        F.col("error_count").cast("long").alias("error_count"),
        F.col("n_failed_tests").cast("long").alias("n_failed_tests"), "first_failed_test")


def failed_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 (long form): every failed-test line of every build log."""
    return outc.failed_test_lines(si.build_logs(spark, sf_dir))


def build_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2: outcome row per build with defaults for clean logs."""
    parsed = outc.parse_build_logs(si.build_logs(spark, sf_dir))
    out = outc.build_outcomes(si.builds(spark, sf_dir), parsed)
    return out.select("build_id", "built", F.col("failure_count").cast("long").alias("failure_count"),
                      F.col("error_count").cast("long").alias("error_count"),
                      F.col("n_failed_tests").cast("long").alias("n_failed_tests"))


# --- fixed values: stand-in module block in pages ---
PAGE_BLOCK = r"(?s)<ul>(.*?)</ul>"
PAGE_ITEM = r'<li><a href="[^"]*">([^<]*)</a></li>'


def module_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the first list block of every page, in order."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return pages.select("page_id", F.posexplode(outc.first_block_items("html", PAGE_BLOCK, PAGE_ITEM))
                        .alias("module_idx", "module")) \
        .select("page_id", F.col("module_idx").cast("int"), "module")


def build_file_modules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B4 with its own patterns: modules that build files list."""
    return outc.module_catalogue(si.build_files(spark, sf_dir)).select(
        "project", F.col("module_idx").cast("int").alias("module_idx"), "module")


def baseline_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 + B7: each response against its module's baseline."""
    out = outc.baseline_delta(si.response_outcomes(spark, sf_dir), si.module_baselines(spark, sf_dir))
    return out.select("doc_id", "module",
                      F.col("additional_failure_count").cast("long").alias("additional_failure_count"),
                      F.col("additional_error_count").cast("long").alias("additional_error_count"),
                      F.array_join("additional_failed_tests", ",").alias("additional_failed_tests"),
                      "additional_pass")


def missing_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modules of the corpus without a baseline of the current version."""
    catalogue = table(spark, sf_dir, "documents").select(F.col("source").alias("module")).distinct()
    have = si.module_baselines(spark, sf_dir).withColumn(
        "code_version", F.when(F.col("failure_count") + F.col("error_count") == 0, "v1").otherwise("v0"))
    return outc.missing_baselines(catalogue, have, "v1")


def baselines_extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored baselines after runs over some modules, all, all again, and
    all of another code version; a module's baseline is made once a version."""
    path = scratch_path(spark, "baselines")
    modules = table(spark, sf_dir, "documents").select(F.col("source").alias("module")).distinct()
    known = si.module_baselines(spark, sf_dir)
    made = lambda missing: known.join(missing, "module", "left_semi")
    for catalogue, version in ((modules.where("module < 'src2'"), "v1"), (modules, "v1"), (modules, "v1"),
                               (modules, "v2")):
        outc.extend_baselines(spark, path, catalogue, made, version)
    return outc.read_baselines(spark, path).groupBy("code_version", "module").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("built").alias("built"),
        F.max("failure_count").cast("long").alias("failure_count"))


def pass_at_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B9 for large k, per language."""
    out = outc.pass_at_k(si.response_outcomes(spark, sf_dir), ["lang"], [10, 100])
    return out.select("lang", F.col("n_samples").cast("long"), F.col("n_passed").cast("long"),
                      _r6("pass_at_10"), _r6("pass_at_100"))


def pass_at_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unbiased pass@1 and pass@5 per (module, lang) sample group."""
    out = outc.pass_at_k(si.response_outcomes(spark, sf_dir), ["module", "lang"], [1, 5])
    return out.select(
        "module", "lang", F.col("n_samples").cast("long"), F.col("n_passed").cast("long"),
        _r6("pass_at_1"), _r6("pass_at_5"))


def _summary_out(df: DataFrame) -> DataFrame:
    return df.select("result_name", *[_r6(c) for c in summ.SUMMARY_COLUMNS[1:-1]], "prompt_type")


def summary_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CodeBLEU summary per result file (pair kind)."""
    scored = _scored(spark, sf_dir).withColumn(
        "result_name", F.concat(F.lit("standin_"), F.col("kind"), F.lit("_df_output")))
    return _summary_out(summ.summary_table(scored, metrics=("CodeBLEU",)))


def rates_with_moe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Build, no-error and pass@1 rates with margins of error per language."""
    out = si.response_outcomes(spark, sf_dir).withColumn("result_name", F.col("lang"))
    return _summary_out(summ.summarize(out, metrics=("pass@k",)))


def summary_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 -> S10 -> A8: result files written as CSV, read back by folder, summarised."""
    path = scratch_path(spark, "results")
    kept = ["prompt_id", "label", "completion", *summ.AVERAGED[:4], "codebleu"]
    scored = _scored(spark, sf_dir).withColumn("result_name", F.concat(
        F.lit("20240101-000000_"), "kind", F.lit("_df_standin_output")))
    stage_tables.write_result_files(scored.select("result_name", *kept), path)
    schema = ", ".join(f"{c} {'string' if i < 3 else 'double'}" for i, c in enumerate(kept))
    return _summary_out(summ.summary_table(stage_tables.read_result_files(spark, path, schema)))


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of every language in two runs of one history table, of which
    the first was run twice."""
    path = scratch_path(spark, "runs")
    rows = si.response_outcomes(spark, sf_dir).withColumn("kind", F.col("lang"))
    for stamp, part in (("r1", rows), ("r2", rows.where("error_count = 0")), ("r1", rows)):
        sc.write_history(part, sc.RunConfig(run_ts=stamp, inference_model=SCORECARD_MODEL), path)
    return _summary_out(summ.summarize(sc.read_history(spark, path), metrics=("pass@k",)))


def baseline_summary_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The baseline row of the unaltered modules."""
    return _summary_out(summ.baseline_summary(si.module_baselines(spark, sf_dir),
                                              metrics=("CodeBLEU", "pass@k")))


def method_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: method bodies (lines strictly between the braces) of every file."""
    bodies, _ = cand.method_bodies(code_files(spark, sf_dir).select("path", "text"))
    return bodies.select("path", "method", F.col("pos").cast("int").alias("name_pos"),
                         (F.col("body_start_line") + 1).alias("start_line"),
                         (F.col("body_start_line") + F.col("body_line_count")).alias("end_line"))


def constructor_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 with ``include_constructors``: bodies of methods and constructors."""
    bodies, _ = cand.method_bodies(code_files(spark, sf_dir).select("path", "text"), include_constructors=True)
    return bodies.select("path", "method", F.col("pos").cast("int").alias("name_pos"),
                         (F.col("body_start_line") + 1).alias("start_line"),
                         (F.col("body_start_line") + F.col("body_line_count")).alias("end_line"))


def method_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 -> P6 -> M4: infill prompts masking whole method bodies."""
    files = code_files(spark, sf_dir).select("path", "text")
    bodies, _ = cand.method_bodies(files)
    chosen = splits.sample_k(bodies, METHODS_K, SEED, "methods", ["path", "pos"])
    rows = splits.join_back(chosen, files, ["path"])
    out = masking.mask_lines(rows, "body_start_line", "body_line_count")
    return out.select(
        F.concat_ws(":", F.lit("methods"), "path", F.col("pos").cast("string")).alias("prompt_id"),
        "path", F.col("path").alias("path_in_code_repo"), "method", "prompt", "label",
        "start_line", "end_line")


def split_by_module(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + P5: one file of every module held out, numbered and mapped."""
    files = code_files(spark, sf_dir).select("path", "module", "file_name")
    held = splits.split_holdout_per_module(files, SEED)
    return splits.file_mapping(splits.number_within_split(held, SEED), OUT_DIR)


def catalogue_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An outcome for every catalogued module; those without one are not built."""
    catalogue = table(spark, sf_dir, "documents").select(F.col("source").alias("module")).distinct()
    known = si.module_baselines(spark, sf_dir).where("built")
    return outc.module_baseline(catalogue, known).select(
        "module", "built", F.col("failure_count").cast("long"), F.col("error_count").cast("long"))


def prompt_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B5 + B6: the module and build outcome of every sampled prompt, by key."""
    prompts = line_prompts(spark, sf_dir).select("prompt_id", "path_in_code_repo")
    builds = si.response_outcomes(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("doc"), "built", F.col("failure_count").cast("long"))
    prompts = prompts.withColumn("doc", F.element_at(F.split("path_in_code_repo", "/"), 3))
    return outc.response_outcomes(prompts, builds, build_key=["doc"]).select(
        "prompt_id", "module", "built", "failure_count")


def summary_with_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome rates of every language and of the unaltered modules in one table."""
    out = si.response_outcomes(spark, sf_dir).withColumn("result_name", F.col("lang"))
    return _summary_out(summ.summary_table(out, si.module_baselines(spark, sf_dir), metrics=("pass@k",)))


# --- fixed values: files that the stand-in mapping has lost ---
UNMAPPED = "/[0-9]*[37]/[^/]*$"


def _prompts_and_skipped(spark: SparkSession, sf_dir: str):
    """Prompts of the test files and the skipped table; the mapping lacks some files."""
    files = code_files(spark, sf_dir).select("path", "file_name", "text")
    cfg = sc.RunConfig(seed=SEED, output_directory=OUT_DIR, lines_prompts_count=LINES_K, tokens_prompts_count=TOKENS_K,
                       methods_prompts_count=METHODS_K, num_label_lines=NUM_LABEL_LINES,
                       num_label_tokens=NUM_LABEL_TOKENS)
    mapping = write_table(sc.split_stage(files, cfg), "mapping")
    tests = sc.test_files(files, mapping, SEED)
    return sc.prompt_stage(tests, mapping.where(~F.col("old_path").rlike(UNMAPPED)), cfg)


def _skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prompts_and_skipped(spark, sf_dir)[1]


def skipped_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5 + J1: skipped files of every kind and prompts whose file the mapping
    lacks, under their original paths."""
    return _skipped(spark, sf_dir)


def placed_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of every kind under the new paths of their files."""
    return _prompts_and_skipped(spark, sf_dir)[0].select(
        "prompt_id", "kind", "path", "path_in_code_repo", F.md5("prompt").alias("prompt_md5"), "label")


def skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skipped records per reason."""
    return summ.skip_counts(_skipped(spark, sf_dir)).select(
        "reason", F.col("n_skipped").cast("long").alias("n_skipped"))


def _apps_and_tests(spark: SparkSession, sf_dir: str):
    files = code_files(spark, sf_dir).select("file_name")
    apps = files.where(~mt.is_test_name("file_name"))
    tests = files.where(mt.is_test_name("file_name"))
    return mt.match_tests(apps, tests)


def test_match_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(application file, unit-test file) pairs by name."""
    return _apps_and_tests(spark, sf_dir)[1]


def apps_without_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Application file names no test file maps to."""
    return _apps_and_tests(spark, sf_dir)[0]


def tests_without_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit-test file names without an application file."""
    return _apps_and_tests(spark, sf_dir)[2]


GRAPH_SELECTED = "s0"


def neighbourhood_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: self / 1-hop / 2-hop / rest tiers around one supplier."""
    nodes, edges = si.graph(spark, sf_dir)
    return gr.neighbourhood_tiers(nodes, edges, GRAPH_SELECTED).select(
        "id", F.col("hop").cast("int").alias("hop"), "tier")


def node_property_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: nodes whose size is one of the listed values (0 never matches)."""
    nodes, _ = si.graph(spark, sf_dir)
    return gr.nodes_with_property(nodes, "size", ["0", "5", "10", "20"])


def edge_property_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H4: endpoints of the edges carrying 2 or 3 line items."""
    _, edges = si.graph(spark, sf_dir)
    return gr.edge_endpoints_with_property(edges, "n_lines", ["2", "3"])


def visible_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: visibility of every node after selecting the endpoints of 4-line edges."""
    nodes, edges = si.graph(spark, sf_dir)
    return gr.visible_flag(nodes, gr.edge_endpoints_with_property(edges, "n_lines", ["4"]))


def splice_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: completions put back into their files, positionally and (legacy)
    by replacing every occurrence of the label."""
    files = code_files(spark, sf_dir).select("path", "text")
    prompts = line_prompts(spark, sf_dir).select("prompt_id", "path", "prompt", "label", "start_line")
    done = comp.complete_with(prompts, comp.previous_line_completer)
    rows = splits.join_back(done, files, ["path"])
    offset = F.length(F.array_join(F.slice(split_lines("text"), 1, F.col("start_line") - 1), ""))
    edited = masking.splice("text", "label", "completion", offset)
    legacy = masking.splice("text", "label", "completion")
    return rows.select("prompt_id", F.md5(edited).alias("edited_md5"),
                       F.length(edited).cast("long").alias("edited_chars"),
                       F.md5(legacy).alias("legacy_md5"))


def edited_builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three samples of every prompt, two of them alike, to builds of their
    edited files, and the builds' outcomes back to the samples."""
    files = code_files(spark, sf_dir).select("path", "text")
    prompts = line_prompts(spark, sf_dir).select("prompt_id", "path", "path_in_code_repo", "prompt", "label",
                                                 "start_line")
    done = comp.expand_samples(comp.complete_with(prompts, comp.previous_line_completer), 3)
    done = done.withColumn("completion", F.when(F.col("sample_idx") == 2, F.col("label")).otherwise(F.col("completion")))
    before = F.array_join(F.slice(split_lines("text"), 1, F.col("start_line") - 1), "")
    rows = splits.join_back(done, files, ["path"]).withColumn("offset", F.length(before))
    responses, builds = outc.edited_builds(rows)
    ran = builds.select("build_key", (F.left("build_key", F.lit(1)) < "8").alias("built"),
                        F.length("edited").cast("long").alias("edited_chars"))
    return outc.response_outcomes(responses, ran, build_key=["build_key"]).select(
        "prompt_id", F.col("sample_idx").cast("int").alias("sample_idx"), "module", "build_key", "built",
        "edited_chars")


SCORECARD_RUN = "standin"
SCORECARD_MODEL = "codellama/7b"


def scorecard_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split -> three prompt kinds -> stand-in completions -> scores -> summary."""
    cfg = sc.RunConfig(run_ts=SCORECARD_RUN, seed=SEED, output_directory=OUT_DIR,
                    lines_prompts_count=LINES_K, tokens_prompts_count=TOKENS_K,
                    methods_prompts_count=METHODS_K, num_label_lines=NUM_LABEL_LINES,
                    num_label_tokens=NUM_LABEL_TOKENS, inference_model=SCORECARD_MODEL)
    res = sc.run_scorecard(code_files(spark, sf_dir), cfg, matches=si.with_matches)
    return _summary_out(res["summary"])


QUERIES = {
    "corpus_scan_filter": corpus_scan_filter,
    "module_extract": module_extract,
    "line_candidates": line_candidates,
    "line_prompts": line_prompts,
    "prefix_only_prompts": prefix_only_prompts,
    "one_candidate_per_file": one_candidate_per_file,
    "token_candidates": token_candidates,
    "token_prompts": token_prompts,
    "lex_failures": lex_failures,
    "split_random_exact": split_random_exact,
    "split_holdout_per_module": split_holdout_per_module,
    "file_mapping": file_mapping,
    "split_by_module": split_by_module,
    "catalogue_baselines": catalogue_baselines,
    "prompt_outcomes": prompt_outcomes,
    "summary_with_baseline": summary_with_baseline,
    "ngram_match": ngram_match,
    "weighted_ngram": weighted_ngram,
    "composite_score": composite_score,
    "token_counts": token_counts,
    "perplexity": perplexity,
    "strip_eot": strip_eot,
    "stop_cut": stop_cut,
    "samples_expand": samples_expand,
    "batch_completion": batch_completion,
    "build_log_parse": build_log_parse,
    "failed_tests": failed_tests,
    "build_outcomes": build_outcomes,
    "module_catalogue": module_catalogue,
    "baseline_delta": baseline_delta,
    "missing_baselines": missing_baselines,
    "pass_at_k": pass_at_k,
    "summary_by_kind": summary_by_kind,
    "rates_with_moe": rates_with_moe,
    "baseline_summary_row": baseline_summary_row,
    "method_bodies": method_bodies,
    "method_prompts": method_prompts,
    "skipped_union": skipped_union,
    "skip_counts": skip_counts,
    "test_match_pairs": test_match_pairs,
    "apps_without_tests": apps_without_tests,
    "tests_without_apps": tests_without_apps,
    "neighbourhood_tiers": neighbourhood_tiers,
    "node_property_filter": node_property_filter,
    "edge_property_filter": edge_property_filter,
    "visible_flag": visible_flag,
    "splice_completion": splice_completion,
    "scorecard_summary": scorecard_summary,
    "token_positions": token_positions,
    "tokens_without_imports": tokens_without_imports,
    "span_prompts": span_prompts,
    "weighted_ngram_whole": weighted_ngram_whole,
    "build_file_modules": build_file_modules,
    "baselines_extended": baselines_extended,
    "pass_at_many": pass_at_many,
    "summary_from_files": summary_from_files,
    "run_history": run_history,
    "constructor_bodies": constructor_bodies,
    "placed_prompts": placed_prompts,
    "edited_builds": edited_builds,
}
