"""Build and test outcomes (B1-B9): data side of pass@k.

Running builds is not part of the library; build logs, exit codes and module
build files enter as tables.  ``logs(build_id, line_no, line)`` holds one row
per log line, so a single build may be arbitrarily long: the in-block state of
B1 is computed as a segmented scan (per-chunk summaries, a scan over chunks,
then a scan inside each bounded chunk), never by sorting one build in one task,
and failed-test names stay a long table instead of a per-build list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holecard.functions.text import col
from holecard.session import checkpoint_stage

# --- fixed values: build-log markers ---
BLOCK_MARKERS = ("[ERROR] Failures: ", "[ERROR] Errors: ")
COUNTS_MARK = "[ERROR] Tests run:"
TEST_MARK = "[ERROR]   "
CHUNK_LINES = 100_000   # log lines per scan segment
#: Bytes up to which module baselines are broadcast, and those of a row or a name besides its text.
BASELINE_BYTES, ROW_BYTES = 32 << 20, 32


def last_before(df: DataFrame, group: list[str], order: str, flags: dict[str, Column],
                chunk: int | None = None) -> DataFrame:
    """For each row, the largest ``order`` value strictly before it (within its
    group) at which each flag held -> columns ``last_<name>`` (null if none).

    ``order`` is a non-negative integer, unique within a group.  Rows are cut
    into chunks of ``chunk`` consecutive order values; a window scans each
    chunk, and what came before the chunk arrives as a carry computed on the
    small per-chunk table.  No group is ever sorted in one task.
    """
    names = list(flags)
    chunk = chunk or CHUNK_LINES
    marked = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)).cast("long"))
    for n, c in flags.items():
        marked = marked.withColumn(f"_at_{n}", F.when(c, F.col(order)))
    per_chunk = marked.groupBy(*group, "_chunk").agg(
        *[F.max(f"_at_{n}").alias(f"_cm_{n}") for n in names])
    wc = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(*group, "_chunk",
                             *[F.max(f"_cm_{n}").over(wc).alias(f"_carry_{n}") for n in names])
    wl = Window.partitionBy(*group, "_chunk").orderBy(order) \
        .rowsBetween(Window.unboundedPreceding, -1)
    inside = marked.select("*", *[F.max(f"_at_{n}").over(wl).alias(f"_in_{n}") for n in names])
    out = inside.join(carry, [*group, "_chunk"], "inner")
    for n in names:
        out = out.withColumn(f"last_{n}", F.greatest(f"_in_{n}", f"_carry_{n}"))
    return out.drop("_chunk", *[f"_{p}_{n}" for n in names for p in ("at", "in", "carry")])


def _log_hits(logs: DataFrame, build: str, line_no: str, line: str, chunk: int | None) -> DataFrame:
    """Counts lines and failed-test lines inside failure blocks."""
    l = F.col(line)
    scanned = last_before(logs.select(build, line_no, line), [build], line_no,
                          {"open": l.isin(*BLOCK_MARKERS), "close": l.contains(COUNTS_MARK)}, chunk)
    in_block = F.coalesce(F.col("last_open"), F.lit(-1)) > F.coalesce(F.col("last_close"), F.lit(-1))
    is_counts = in_block & l.contains(COUNTS_MARK)
    is_test = in_block & ~l.contains(COUNTS_MARK) & l.contains(TEST_MARK)
    return scanned.where(is_counts | is_test).select(
        build, line_no, is_counts.alias("_counts"),
        F.regexp_extract(l, r"Failures: (\d+)", 1).alias("_f"),
        F.regexp_extract(l, r"Errors: (\d+)", 1).alias("_e"),
        F.try_element_at(F.split(l, " "), F.lit(4)).alias("_test"))


def failed_test_lines(logs: DataFrame, build: str = "build_id", line_no: str = "line_no",
                      line: str = "line", chunk: int | None = None) -> DataFrame:
    """B1 (names, long form): ``(build_id, line_no, test)``, one row per
    failed-test line in a failure block (4th space-separated field)."""
    hits = _log_hits(logs, build, line_no, line, chunk)
    return hits.where(~F.col("_counts")).select(build, line_no, F.col("_test").alias("test"))


def parse_build_logs(logs: DataFrame, build: str = "build_id", line_no: str = "line_no",
                     line: str = "line", chunk: int | None = None,
                     with_names: bool = False) -> DataFrame:
    """B1: ``(build_id, failure_count, error_count, n_failed_tests, first_failed_test)``.

    A line equal to a block marker opens a block; inside it a line holding
    ``[ERROR] Tests run:`` gives the counts and closes the block, and a line
    holding ``[ERROR]   `` names a failed test.  The last counts line wins
    (null when there is none).  All outputs are map-side combinable
    aggregates; the names themselves stay a long table
    (:func:`failed_test_lines`).  ``with_names=True`` adds the reference's
    ``failed_tests`` list per build (a ``collect_list``: only for builds
    whose logs are known to be bounded).
    """
    hits = _log_hits(logs, build, line_no, line, chunk)
    counts = F.col("_counts")
    aggs = [
        F.max_by(F.when(counts, F.col("_f").try_cast("int")), F.when(counts, F.col(line_no)))
        .alias("failure_count"),
        F.max_by(F.when(counts, F.col("_e").try_cast("int")), F.when(counts, F.col(line_no)))
        .alias("error_count"),
        F.sum((~counts).cast("int")).alias("n_failed_tests"),
        F.min_by(F.when(~counts, F.col("_test")), F.when(~counts, F.col(line_no))).alias("first_failed_test"),
    ]
    if with_names:
        aggs.append(F.transform(F.array_sort(F.collect_list(
            F.when(~counts, F.struct(F.col(line_no).alias("k"), F.col("_test").alias("t"))))),
            lambda x: x["t"]).alias("failed_tests"))
    return hits.groupBy(build).agg(*aggs)


def build_outcomes(builds: DataFrame, parsed: DataFrame, build: str = "build_id",
                   exit_code: str = "exit_code") -> DataFrame:
    """B2: one outcome row per build: ``built`` (exit code 0) and counts
    (default 0; failed-test lists, when asked for, default to empty)."""
    out = builds.join(parsed, build, "left").select(
        "*",
        (F.col(exit_code) == 0).alias("built"),
    ).withColumn("failure_count", F.coalesce("failure_count", F.lit(0))) \
        .withColumn("error_count", F.coalesce("error_count", F.lit(0))) \
        .withColumn("n_failed_tests", F.coalesce("n_failed_tests", F.lit(0)))
    if "failed_tests" in parsed.columns:
        out = out.withColumn("failed_tests", F.coalesce("failed_tests", F.array().cast("array<string>")))
    return out


# --- fixed values: pattern of a module entry in a build file ---
MODULES_BLOCK = r"(?s)<modules>(.*?)</modules>"
# a whole line but for white space, so a commented-out entry is none
MODULE_ITEM = r"(?m)^[ \t]*<module>([^<]+)</module>[ \t\r]*$"


def first_block_items(text, block_pattern: str = MODULES_BLOCK,
                      item_pattern: str = MODULE_ITEM) -> Column:
    """Items of the first block of a tagged text, in order."""
    block = F.regexp_extract(col(text), block_pattern, 1)
    return F.regexp_extract_all(block, F.lit(item_pattern), 1)


def module_catalogue(build_files: DataFrame, text: str = "text", key: str = "project") -> DataFrame:
    """``(project, module_idx, module)`` from build-file texts."""
    return build_files.select(key, F.posexplode(first_block_items(text)).alias("module_idx", "module"))


def module_baseline(catalogue: DataFrame, outcomes: DataFrame, module: str = "module") -> DataFrame:
    """One outcome row per catalogued module (missing outcome -> not built)."""
    return catalogue.join(outcomes, module, "left") \
        .withColumn("built", F.coalesce("built", F.lit(False)))


def join_outcomes(responses: DataFrame, outcomes: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Responses with their build outcome, by key (never by position)."""
    return responses.join(outcomes, key or ["prompt_id"], "left")


def response_outcomes(responses: DataFrame, builds: DataFrame, root: str = "",
                      build_key: list[str] | None = None) -> DataFrame:
    """Per response, its module (first path component of
    ``path_in_code_repo``) and the outcome of the build of its edited file,
    joined by key (the build table holds one row per response build)."""
    from holecard.operators.splits import module_of
    with_module = responses.withColumn("module", module_of("path_in_code_repo", root))
    return with_module.join(builds, build_key or ["prompt_id"], "left")


def edited_builds(responses: DataFrame, text: str = "text", label: str = "label", completion: str = "completion",
                  offset: str = "offset", path: str = "path_in_code_repo",
                  root: str = "") -> tuple[DataFrame, DataFrame]:
    """Responses to edited files to builds.

    Returns the responses with their ``module`` and ``build_key``, and the
    builds to run: one row ``(build_key, module, path, edited)`` per different
    edit.  The key is a digest of the file's path and edited text, so equal
    completions of one hole share a build, whoever gave them.  Outcomes come
    back by key (:func:`response_outcomes` with ``build_key=["build_key"]``).
    Only the digest is shuffled to find equal edits among the responses; a
    build's text is that of any of its responses.
    """
    from holecard.operators.masking import splice
    from holecard.operators.splits import module_of
    edited = splice(text, label, completion, offset)
    keyed = responses.withColumn("module", module_of(path, root)).withColumn("_edited", edited) \
        .withColumn("build_key", F.sha2(F.concat_ws("\n", F.col(path), F.col("_edited")), 256))
    builds = keyed.groupBy("build_key").agg(
        F.any_value("module").alias("module"), F.any_value(path).alias("path"), F.any_value("_edited").alias("edited"))
    return keyed.drop("_edited", text), builds


def baseline_delta(responses: DataFrame, baseline: DataFrame, module: str = "module",
                   broadcast_bytes: int = BASELINE_BYTES) -> DataFrame:
    """Change of each response's outcome against its module's baseline.

    The baseline (a row per module) is written to the checkpoint folder and
    measured.  Up to ``broadcast_bytes`` of module and test names it is
    broadcast, so no response is shuffled on its module; a larger one is
    joined by the planner's choice, where AQE splits hot modules.
    """
    base = checkpoint_stage(baseline.select(
        module, F.col("built").alias("base_built"),
        F.col("failure_count").alias("base_failure_count"),
        F.col("error_count").alias("base_error_count"),
        F.col("failed_tests").alias("base_failed_tests")))
    names = F.octet_length(F.concat_ws("|", F.col(module).cast("string"), "base_failed_tests"))
    size = base.agg(F.sum(names + F.lit(ROW_BYTES) + F.lit(ROW_BYTES) * F.size(
        F.coalesce("base_failed_tests", F.array().cast("array<string>"))))).first()[0] or 0
    out = responses.join(F.broadcast(base) if size <= broadcast_bytes else base, module, "left")
    return out.select(
        "*",
        (F.col("failure_count") - F.coalesce("base_failure_count", F.lit(0))).alias("additional_failure_count"),
        (F.col("error_count") - F.coalesce("base_error_count", F.lit(0))).alias("additional_error_count"),
        F.array_except("failed_tests", F.coalesce("base_failed_tests", F.array().cast("array<string>")))
        .alias("additional_failed_tests"),
        (F.col("built") & F.coalesce("base_built", F.lit(True))).alias("additional_pass"))


def missing_baselines(catalogue: DataFrame, baselines: DataFrame, version: str,
                      module: str = "module") -> DataFrame:
    """Catalogued modules that have no baseline for ``version`` yet."""
    have = baselines.where(F.col("code_version") == version).select(module)
    return catalogue.join(have, module, "left_anti")


# --- the columns of a stored module baseline ---
BASELINE_SCHEMA = ("module string, built boolean, failure_count int, error_count int, failed_tests array<string>, "
                   "code_version string")


def read_baselines(spark, path: str) -> DataFrame:
    """The stored baselines of all versions; none before the first run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], BASELINE_SCHEMA)
    return spark.read.schema(BASELINE_SCHEMA).parquet(path)


def extend_baselines(spark, path: str, catalogue: DataFrame, baseline_of, version: str) -> DataFrame:
    """The baselines of ``version``, after adding those that are missing.

    The table is partitioned by code version, so only that version's partition
    is read.  ``baseline_of`` gives the outcomes of the modules it is handed:
    only catalogued ones without a baseline.  They are appended by one job
    that commits as a whole, so a rerun adds what is still missing and nothing
    twice (one run at a time).
    """
    missing = missing_baselines(catalogue.select("module").distinct(), read_baselines(spark, path), version)
    fresh = module_baseline(missing, baseline_of(missing)).withColumn("code_version", F.lit(version))
    names = [c.split()[0] for c in BASELINE_SCHEMA.split(", ")]
    fresh.select(*names).write.mode("append").partitionBy("code_version").parquet(path)
    return read_baselines(spark, path).where(F.col("code_version") == version)


def pass_at_k(outcomes: DataFrame, group: list[str], ks, passed: str = "built") -> DataFrame:
    """Unbiased pass@k per group: ``1 - prod_{j<k} (n - c - j) / (n - j)``.

    ``n`` samples, ``c`` passing.  Null where there are fewer than k samples; 1
    where fewer than k of them fail.  A null outcome is a sample that did not
    pass.  One aggregate gives the counts for every k; the product is a
    fold of logarithms over 0..k-1, so the plan doesn't grow with k.
    """
    ks = [ks] if isinstance(ks, int) else list(ks)
    agg = outcomes.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.sum(F.coalesce(F.col(passed), F.lit(False)).cast("int")).alias("n_passed"))
    n, c = F.col("n_samples"), F.col("n_passed")
    for k in ks:
        none = F.exp(F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), F.lit(0.0),
                                 lambda total, j: total + F.log((n - c - j) / (n - j))))
        agg = agg.withColumn(f"pass_at_{k}", F.when(n < k, F.lit(None)).when(n - c < k, 1.0).otherwise(1 - none))
    return agg
