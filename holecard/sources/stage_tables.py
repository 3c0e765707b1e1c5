"""Stage tables on disk (S4-S11): CSV in the reference's layout, JSON
sidecars, the per-module JSON map, and run/result naming.

Parquet is the default format between stages; the CSV readers and writers
exist to exchange tables with the reference's run folders (header row,
quoted multi-line cells with doubled quotes).
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# cells keep their leading and trailing white space (a label may end a line)
CSV_OPTIONS = {"header": True, "multiLine": True, "escape": '"', "quote": '"',
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

# --- fixed values: reference file-name conventions ---
SKIPPED_FILE = "skipped_files.csv"
OUTPUT_SUFFIX = "output.csv"
BASELINE_PREFIX = "base_module_build_results"
# a result file, or the folder of its parts
RESULT_FILE = r"([^/=]+_output)\.csv(?:/[^/]*)?$"
RESULT_NAME = r"^(\d{8}-\d{6})_(.+)_df_(.+)_output$"

OUTCOME_STRUCT = T.StructType([
    T.StructField("pass", T.BooleanType()),
    T.StructField("failure_count", T.IntegerType()),
    T.StructField("failed_tests", T.ArrayType(T.StringType())),
    T.StructField("error_count", T.IntegerType()),
])
MODULE_MAP = T.MapType(T.StringType(), OUTCOME_STRUCT)


def read_stage_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                   glob: str | None = None) -> DataFrame:
    """Stage table(s) from CSV; a directory is read in one scan and
    every row keeps the name of its file (``source_file``)."""
    reader = spark.read.options(**CSV_OPTIONS)
    if schema is not None:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.csv(path)
    return df.withColumn("source_file", F.col("_metadata.file_name"))


def read_prompt_tables(spark: SparkSession, prompts_dir: str) -> DataFrame:
    """Every prompt table of a folder except the skipped-files table."""
    df = read_stage_csv(spark, prompts_dir, glob="*.csv")
    return df.where(F.col("source_file") != SKIPPED_FILE)


def read_result_files(spark: SparkSession, results_dir: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All ``*output.csv`` result files of a folder in one scan;
    ``result_name`` is the name without ``.csv``, parsed into run stamp, prompt
    kind and model.

    A result is one file, or a folder of part files as
    :func:`write_result_files` writes it; other CSV files are left out.  With
    a ``schema`` no file is read twice; without one every column is a string.
    """
    reader = spark.read.options(**CSV_OPTIONS).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    df = (reader.schema(schema) if schema is not None else reader).csv(results_dir)
    name = F.regexp_extract(F.col("_metadata.file_path"), RESULT_FILE, 1)
    return df.withColumn("result_name", name).where(F.col("result_name") != "") \
        .withColumns(parse_result_name(F.col("result_name")))


def write_result_files(df: DataFrame, results_dir: str, name: str = "result_name") -> None:
    """One ``<result_name>.csv`` folder per result file, all by one job;
    a rerun replaces the results it holds and leaves the others."""
    named = df.withColumn("result_file", F.concat(F.col(name), F.lit(".csv"))).drop(name)
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
    named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options) \
        .partitionBy("result_file").csv(results_dir)


def parse_result_name(name) -> dict:
    """``<stamp>_<kind>_df_<model>_output`` -> stamp, kind, model."""
    return {"run_stamp": F.regexp_extract(name, RESULT_NAME, 1),
            "prompt_kind": F.regexp_extract(name, RESULT_NAME, 2),
            "model": F.regexp_extract(name, RESULT_NAME, 3)}


def write_stage_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header row, quoted cells, doubled quotes (readable by S4)."""
    df.write.mode(mode).options(**{k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}).csv(path)


def write_run_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                    mode: str = "overwrite") -> None:
    """Parquet, partitioned by run columns (e.g. run stamp, prompt kind).

    Overwriting a partitioned table replaces the partitions that ``df`` holds
    and leaves the others, so a run that is repeated has its rows once.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def read_run_table(spark: SparkSession, path: str, **wanted) -> DataFrame:
    """Rows of a partitioned table; each of ``wanted`` (column=value) is a
    partition filter, so other runs' files aren't listed into the scan."""
    df = spark.read.parquet(path)
    for name, value in wanted.items():
        df = df.where(F.col(name) == value)
    return df


def write_sidecar(spark: SparkSession, record: dict, path: str) -> None:
    """A one-row JSON document (run configuration, inference metadata)."""
    spark.createDataFrame([(json.dumps(record, default=str),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(path)


def read_module_results(spark: SparkSession, path: str) -> DataFrame:
    """``{module: {pass, failure_count, failed_tests, error_count}}`` ->
    one row per module (no schema inference: it would make one column per
    module)."""
    doc = spark.read.text(path, wholetext=True)
    parsed = doc.select(F.explode(F.from_json("value", MODULE_MAP)).alias("module", "r"))
    return parsed.select("module", F.col("r.pass").alias("built"), "r.failure_count",
                         "r.failed_tests", "r.error_count")


def write_module_results(df: DataFrame, path: str) -> None:
    """Per-module outcomes as JSON lines (one module per line).

    The reference keeps one JSON object for all modules; one object per line
    carries the same content without funnelling every module through one
    task.  :func:`read_module_results_lines` reads it back.
    """
    df.select("module", F.col("built").alias("pass"), "failure_count", "failed_tests",
              "error_count").write.mode("overwrite").json(path)


def read_module_results_lines(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("module", T.StringType())] + OUTCOME_STRUCT.fields)
    return spark.read.schema(schema).json(path).withColumnRenamed("pass", "built")
