"""Corpus scans (S1-S3): source files of a directory tree as a table.

One scan reads every file of the tree as one row (``wholetext``); the glob
filter prunes by suffix at listing time and the name predicate is an ordinary
column filter.  Result: ``(path, file_name, module, text)`` with ``path``
relative to the root and ``text`` with ``\\n`` for every line end, as a
text-mode read gives it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holecard.functions.text import normalize_newlines
from holecard.operators.matching import is_test_name
from holecard.operators.splits import module_of


def _absolute(spark: SparkSession, root: str) -> str:
    """The root's path in its file system, ``.`` and ``..`` resolved."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().getPath().rstrip("/") + "/"


def _scan(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    raw = (spark.read.format("text").option("wholetext", True)
           .option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
           .load(root))
    # the metadata column holds a percent-encoded URI
    uri = F.regexp_replace(F.col("_metadata.file_path"), r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    full = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    base = _absolute(spark, root)
    rel = F.when(F.startswith(full, F.lit(base)), F.substr(full, F.lit(len(base) + 1))).otherwise(full)
    return raw.select(rel.alias("path"), F.col("_metadata.file_name").alias("file_name"),
                      normalize_newlines("value").alias("text")) \
        .withColumn("module", module_of("path")) \
        .select("path", "file_name", "module", "text")


def scan_source_files(spark: SparkSession, root: str, suffix: str = ".java") -> DataFrame:
    """Files with the suffix whose lower-cased name lacks ``test``."""
    return _scan(spark, root, suffix).where(~is_test_name("file_name"))


def scan_unit_test_files(spark: SparkSession, root: str, suffix: str = ".java") -> DataFrame:
    """S3: the complement: files with the suffix whose name mentions ``test``."""
    return _scan(spark, root, suffix).where(is_test_name("file_name"))


def scan_all_files(spark: SparkSession, root: str, suffix: str = ".java") -> DataFrame:
    """Every file with the suffix (the copied test split needs no name filter)."""
    return _scan(spark, root, suffix)
