"""End-to-end scorecard run (E1): split -> prompts -> completions -> scores -> summary.

Each stage is a function from DataFrames to DataFrames; ``run_scorecard``
chains them lazily and returns every intermediate table, so a caller can
write any of them (``write_run``) as restart points.  The configuration keys
follow the reference's run configuration.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holecard.operators import candidates as cand
from holecard.operators import completions as comp
from holecard.operators import masking, scoring, splits, summary
from holecard.operators.outcomes import join_outcomes
from holecard.session import checkpoint_stage, write_table


# --- fixed values: names and defaults of the run configuration ---
@dataclass
class RunConfig:
    run_ts: str = field(default_factory=lambda: time.strftime("%Y%m%d_%H%M%S"))
    train_ratio: float = 0.8
    seed: int = 0
    split_strategy: str = "random"          # or "by_module"
    num_label_tokens: int = 2
    tokens_prompts_count: int = 10
    num_label_lines: int = 2
    lines_prompts_count: int = 10
    methods_prompts_count: int = 10
    include_constructors: bool = False
    skip_import_lines: bool = False
    infill: bool = True
    max_lines_above: int = 50
    max_lines_below: int = 50
    inference_model: str = "codellama/7b"
    inference_temperature: float = 0.2
    inference_top_p: float = 0.95
    inference_times: int = 1
    inference_max_tokens: int = 256
    evaluation_metrics: tuple = ("CodeBLEU",)
    output_directory: str = "data/run"

    def params(self) -> dict:
        return {"model": self.inference_model, "temperature": self.inference_temperature,
                "top_p": self.inference_top_p, "times": self.inference_times,
                "max_tokens": self.inference_max_tokens}


PROMPT_COLUMNS = ["prompt_id", "kind", "path", "path_in_code_repo", "method", "prompt", "label",
                  "start_line", "end_line"]


def split_stage(files: DataFrame, cfg: RunConfig) -> DataFrame:
    """Stage 1 (P1-P5): the file mapping ``(old_path, new_path, split)``."""
    if cfg.split_strategy == "by_module":
        held = splits.split_holdout_per_module(files.select("path", "module", "file_name"), cfg.seed)
        return splits.file_mapping(splits.number_within_split(held, cfg.seed), cfg.output_directory)
    ranked = splits.split_random_exact(files.select("path", "file_name"), cfg.train_ratio, cfg.seed)
    return splits.file_mapping(ranked, cfg.output_directory)


def test_files(files: DataFrame, mapping: DataFrame, seed: int, strategy: str = "random") -> DataFrame:
    """Test files ``(path, text)`` under their original paths.

    In a random split the test files are those from a random key on, so they
    are a filter on the scan and no text is shuffled.  One file per module is
    a semi-join with as many rows as there are modules.
    """
    test = mapping.where(F.col("split") == "test")
    if strategy == "random":
        key = splits.random_key(seed, F.col("path"))
        first = test.select(F.min(splits.random_key(seed, F.col("old_path")))).scalar()
        return files.where(key >= first).select("path", "text")
    return files.join(test, files["path"] == test["old_path"], "left_semi").select("path", "text")


def skipped_files(candidates: DataFrame) -> DataFrame:
    """T5: ``(path, reason)`` of files that give no candidates of a kind."""
    _, methods = cand.bodies_of_marks(candidates.where(F.col("kind") == "marks").select("path", "mark", "method"))
    tokens = candidates.where(F.col("kind") == "skipped").select("path", F.col("mark").alias("reason"))
    return tokens.unionByName(methods)


def placed_prompts(prompts: DataFrame, mapping: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Prompts with the new path of their file, and the skipped
    ``(path, reason)`` of those whose file the mapping lacks.

    One outer join, its few rows written once, feeds both.  A prompt's id is
    made of its new path, so none is made without one.
    """
    moved = mapping.select("old_path", F.col("new_path").alias("path"))
    looked = write_table(prompts.join(moved, prompts["path_in_code_repo"] == moved["old_path"], "left")
                         .drop("old_path"), "prompts")
    found = looked.where(F.col("path").isNotNull()).withColumn(
        "prompt_id", F.concat_ws(":", "kind", "path", F.col("_pos").cast("string")))
    missed = looked.where(F.col("path").isNull()).select(
        F.col("path_in_code_repo").alias("path"),
        F.concat(F.regexp_replace("kind", "s$", ""), F.lit("_removal_prompts")).alias("reason"))
    return found, missed


def prompt_stage(tests: DataFrame, mapping: DataFrame, cfg: RunConfig) -> tuple[DataFrame, DataFrame]:
    """Stage 2 (T1-T5, P6, M1-M4, J1, J2): prompts of the three kinds, and skipped files.

    Every text is lexed once; the candidates of all kinds are written by kind
    and each sample reads its own.  They are sampled by original path; only
    the sampled rows meet the text again, and the mapping for their new path.
    """
    src = tests.select("path", "text")
    cands = write_table(cand.prompt_candidates(
        src, cfg.num_label_lines, cfg.num_label_tokens, cfg.include_constructors, cfg.skip_import_lines),
        "candidates", ("kind",))
    of_kind = lambda kind: cands.where(F.col("kind") == kind)
    lines = splits.sample_k(of_kind("lines").select("path", F.col("idx").alias("line_idx")),
                            cfg.lines_prompts_count, cfg.seed, "lines", ["path", "line_idx"])
    lines = masking.mask_lines(splits.join_back(lines, src, ["path"]),
                               "line_idx", cfg.num_label_lines, cfg.infill,
                               cfg.max_lines_above, cfg.max_lines_below) \
        .withColumn("kind", F.lit("lines")).withColumn("method", F.lit(None).cast("string")) \
        .withColumn("_pos", F.col("line_idx"))
    toks = splits.sample_k(of_kind("tokens").select("path", F.col("idx").alias("token_idx")),
                           cfg.tokens_prompts_count, cfg.seed, "tokens", ["path", "token_idx"])
    toks = masking.mask_tokens(splits.join_back(toks, src, ["path"]),
                               "token_idx", cfg.num_label_tokens, cfg.infill,
                               cfg.max_lines_above, cfg.max_lines_below) \
        .withColumn("kind", F.lit("tokens")).withColumn("method", F.lit(None).cast("string")) \
        .withColumn("_pos", F.col("token_idx"))
    bodies, _ = cand.bodies_of_marks(of_kind("marks").select("path", "mark", "method"))
    meth = splits.sample_k(bodies, cfg.methods_prompts_count, cfg.seed, "methods", ["path", "pos"])
    meth = masking.mask_lines(splits.join_back(meth, src, ["path"]),
                              "body_start_line", "body_line_count", cfg.infill,
                              cfg.max_lines_above, cfg.max_lines_below) \
        .withColumn("kind", F.lit("methods")).withColumn("_pos", F.col("pos"))
    cols = ["kind", "path", "method", "prompt", "label", "start_line", "end_line", "_pos"]
    prompts = lines.select(*cols).unionByName(toks.select(*cols)).unionByName(meth.select(*cols)) \
        .withColumnRenamed("path", "path_in_code_repo")
    prompts, missed = placed_prompts(prompts, mapping.where(F.col("split") == "test"))
    skipped = skipped_files(cands).unionByName(missed)
    return prompts.select(*PROMPT_COLUMNS), skipped.select(F.col("path").alias("old_path"), "reason")


def completion_stage(prompts: DataFrame, cfg: RunConfig,
                     completer: Callable[[pd.DataFrame], pd.Series] | None = None,
                     completions: DataFrame | None = None) -> DataFrame:
    """Stage 3 (G1-G4): one completion per prompt and sample."""
    prompts = comp.expand_samples(prompts, cfg.inference_times)
    if completions is not None:
        out = comp.attach_completions(prompts, completions, ["prompt_id", "sample_idx"])
    else:
        completer = completer or comp.previous_line_completer
        out = comp.complete_with(prompts, completer)
        # a model callable need not be deterministic (sampling): unless it says
        # it is, the responses are written to the checkpoint folder once, so a
        # retried downstream task never sees another completion than the one
        # already scored
        if not getattr(completer, "deterministic", False):
            out = checkpoint_stage(out)
    return out.withColumn("params", comp.params_struct(cfg.params()))


def evaluation_stage(responses: DataFrame, cfg: RunConfig, outcomes: DataFrame | None = None) -> DataFrame:
    """Stage 4 (G4, C1-C7, B5): scores (and build outcomes) per response."""
    evaluated = responses.withColumn("completion", scoring.strip_eot("completion"))
    if "CodeBLEU" in cfg.evaluation_metrics:
        given = {k: f"{k}_match" for k in ("syntax", "dataflow") if f"{k}_match" in evaluated.columns}
        evaluated = scoring.code_bleu(evaluated, **given)
    if "pass@k" in cfg.evaluation_metrics and outcomes is not None:
        evaluated = join_outcomes(evaluated, outcomes, ["prompt_id", "sample_idx"])
    return evaluated


def result_name(cfg: RunConfig):
    model = cfg.inference_model.replace("/", "-")
    return F.concat(F.lit(f"{cfg.run_ts}_"), F.col("kind"), F.lit(f"_df_{model}_output"))


def analysis_stage(evaluated: DataFrame, cfg: RunConfig, modules: DataFrame | None = None) -> DataFrame:
    """Stage 5 (A1-A9, O1): one summary row per result file (and baseline)."""
    named = evaluated.withColumn("result_name", result_name(cfg))
    return summary.summary_table(named, modules, cfg.evaluation_metrics)


def run_scorecard(files: DataFrame, cfg: RunConfig | None = None,
                  completer: Callable | None = None, completions: DataFrame | None = None,
                  outcomes: DataFrame | None = None, modules: DataFrame | None = None,
                  matches: Callable[[DataFrame], DataFrame] | None = None) -> dict:
    """All five stages on a corpus ``files(path, file_name, module, text)``.

    ``matches`` adds ``syntax_match`` and ``dataflow_match`` to the responses;
    without them those scores and the composite are null.
    """
    cfg = cfg or RunConfig()
    mapping = split_stage(files, cfg)
    tests = test_files(files, mapping, cfg.seed, cfg.split_strategy)
    prompts, skipped = prompt_stage(tests, mapping, cfg)
    responses = completion_stage(prompts, cfg, completer, completions)
    responses = matches(responses) if matches else responses
    evaluated = evaluation_stage(responses, cfg, outcomes)
    summary_df = analysis_stage(evaluated, cfg, modules)
    return {"config": asdict(cfg), "mapping": mapping, "prompts": prompts, "skipped": skipped,
            "responses": responses, "evaluated": evaluated, "summary": summary_df}


STAGE_TABLES = ("mapping", "prompts", "skipped", "responses", "evaluated", "summary")


#: Partition columns of the history of evaluated responses, beside the runs.
HISTORY, HISTORY_COLUMNS = "history", ["run_stamp", "model", "prompt_kind"]


def write_history(evaluated: DataFrame, cfg: RunConfig, out_dir: str) -> None:
    """Add a run's evaluated responses to ``<out_dir>/history``; a run that
    is repeated replaces its own partitions."""
    from holecard.sources import stage_tables
    rows = evaluated.withColumn("run_stamp", F.lit(cfg.run_ts)).withColumn("prompt_kind", F.col("kind")) \
        .withColumn("model", F.lit(cfg.inference_model.replace("/", "-")))
    stage_tables.write_run_table(rows, f"{out_dir.rstrip('/')}/{HISTORY}", HISTORY_COLUMNS)


def read_history(spark, out_dir: str, **wanted) -> DataFrame:
    """Evaluated responses of all runs, or of the wanted partitions (for
    instance ``run_stamp=..., prompt_kind="lines"``)."""
    from holecard.sources import stage_tables
    rows = stage_tables.read_run_table(spark, f"{out_dir.rstrip('/')}/{HISTORY}", **wanted)
    return rows.withColumn("result_name", F.concat("run_stamp", F.lit("_"), "prompt_kind", F.lit("_df_"), "model",
                                                   F.lit("_output")))


def write_run(spark, result: dict, out_dir: str, fmt: str = "parquet") -> str:
    """Write every stage table of a run under ``<out_dir>/<run_ts>/`` (restart
    points, as the reference hands stages over by folder) and the run
    configuration as a JSON sidecar.  ``fmt`` is ``parquet`` or ``csv``; the
    evaluated responses are also added to the history (:func:`write_history`)."""
    from holecard.sources import stage_tables
    run_dir = f"{out_dir.rstrip('/')}/{result['config']['run_ts']}"
    for name in STAGE_TABLES:
        df = result[name]
        if fmt == "csv":  # what a later run resumes from
            df.write.mode("overwrite").parquet(f"{stages_dir(run_dir, fmt)}/{name}")
            df = spark.read.parquet(f"{stages_dir(run_dir, fmt)}/{name}")
        if "params" in df.columns:  # struct column: flatten for CSV, keep for parquet
            df = df.select("*", "params.*").drop("params") if fmt == "csv" else df
        if fmt == "csv":
            stage_tables.write_stage_csv(df, f"{run_dir}/{name}")
        else:
            df.write.mode("overwrite").parquet(f"{run_dir}/{name}")
    write_history(spark.read.parquet(f"{stages_dir(run_dir, fmt)}/evaluated"), RunConfig(**result["config"]), out_dir)
    stage_tables.write_sidecar(spark, result["config"], f"{run_dir}/config")
    return run_dir


def stages_dir(run_dir: str, fmt: str = "parquet") -> str:
    """Where a run's Parquet stage tables are: beside the folder of a CSV run."""
    parent, _, name = run_dir.rstrip("/").rpartition("/")
    return f"{parent}/_stages/{name}" if fmt == "csv" else run_dir.rstrip("/")


def run_staged(spark, files: DataFrame, cfg: RunConfig, out_dir: str,
               completer: Callable | None = None, completions: DataFrame | None = None,
               outcomes: DataFrame | None = None, modules: DataFrame | None = None,
               matches: Callable[[DataFrame], DataFrame] | None = None,
               fmt: str = "parquet") -> str:
    """The whole run, each stage table written under ``<out_dir>/<run_ts>/`` and
    read back for the next, so no stage computes an earlier one again.

    With ``fmt="csv"`` the tables are CSV, made from Parquet ones in the
    folder that :func:`stages_dir` tells.
    """
    from holecard.sources import stage_tables
    run_dir = f"{out_dir.rstrip('/')}/{cfg.run_ts}"
    stages = stages_dir(run_dir, fmt)

    def kept(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{stages}/{name}")
        df = spark.read.parquet(f"{stages}/{name}")
        if fmt == "csv":
            flat = df.select("*", "params.*").drop("params") if "params" in df.columns else df
            stage_tables.write_stage_csv(flat, f"{run_dir}/{name}")
        return df

    mapping = kept("mapping", split_stage(files, cfg))
    prompts, skipped = prompt_stage(test_files(files, mapping, cfg.seed, cfg.split_strategy), mapping, cfg)
    prompts = kept("prompts", prompts)
    kept("skipped", skipped)
    responses = completion_stage(prompts, cfg, completer, completions)
    responses = kept("responses", matches(responses) if matches else responses)
    evaluated = kept("evaluated", evaluation_stage(responses, cfg, outcomes))
    write_history(evaluated, cfg, out_dir)
    kept("summary", analysis_stage(evaluated, cfg, modules))
    stage_tables.write_sidecar(spark, asdict(cfg), f"{run_dir}/config")
    return run_dir


STEPS = ("split", "prompts", "completions", "evaluate", "analyze")
_STEP_INPUT = {"prompts": "mapping", "completions": "prompts", "evaluate": "responses",
               "analyze": "evaluated"}


def resume_scorecard(spark, run_dir: str, files: DataFrame | None, cfg: RunConfig,
                     from_step: str, completer: Callable | None = None,
                     completions: DataFrame | None = None, outcomes: DataFrame | None = None,
                     modules: DataFrame | None = None, fmt: str = "parquet") -> dict:
    """Run the steps from ``from_step`` on, reading the previous step's table
    from a folder written by :func:`write_run` (parquet) or :func:`run_staged`;
    ``fmt`` is the format that the run was written in."""
    if from_step not in STEPS:
        raise ValueError(f"unknown step {from_step!r}; one of {STEPS}")
    if from_step == "split":
        return run_scorecard(files, cfg, completer, completions, outcomes, modules)
    res = {"config": asdict(cfg)}
    res[_STEP_INPUT[from_step]] = spark.read.parquet(f"{stages_dir(run_dir, fmt)}/{_STEP_INPUT[from_step]}")
    if from_step == "prompts":
        tests = test_files(files, res["mapping"], cfg.seed, cfg.split_strategy)
        res["prompts"], res["skipped"] = prompt_stage(tests, res["mapping"], cfg)
    if from_step in ("prompts", "completions"):
        res["responses"] = completion_stage(res["prompts"], cfg, completer, completions)
    if from_step in ("prompts", "completions", "evaluate"):
        res["evaluated"] = evaluation_stage(res["responses"], cfg, outcomes)
    res["summary"] = analysis_stage(res["evaluated"], cfg, modules)
    return res
