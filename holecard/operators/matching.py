"""Matching, set and join operators.

Unit-test files are paired with application files by name: the test name
with every ``test``/``Test``/``TEST`` removed must equal an application file
name.  Both sides are reduced to distinct names first (partial aggregation),
so a name shared by many files is one row before any join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: spellings of the word removed from test file names ---
TEST_WORD = r"test|Test|TEST"


def is_test_name(name) -> F.Column:
    """S1/S3 predicate: a file name that mentions 'test' in any case."""
    return F.lower(F.col(name) if isinstance(name, str) else name).contains("test")


def test_key(name) -> F.Column:
    return F.regexp_replace(F.col(name) if isinstance(name, str) else name, TEST_WORD, "")


def match_tests(app_files: DataFrame, test_files: DataFrame, name: str = "file_name"
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(apps without tests, (app, test) pairs, tests without apps)."""
    apps = app_files.select(F.col(name).alias("app")).distinct()
    tests = test_files.select(F.col(name).alias("test"), test_key(name).alias("key")).distinct()
    apps_without = apps.join(tests, apps["app"] == tests["key"], "left_anti")
    pairs = tests.join(apps, tests["key"] == apps["app"], "inner").select("app", "test").distinct()
    tests_without = tests.join(apps, tests["key"] == apps["app"], "left_anti").select("test").distinct()
    return apps_without, pairs, tests_without
