"""Splits and sampling.

Randomness is a seeded md5 of the row key, so every choice is repeatable and
independent of partitioning, executor count and retries (``rand(seed)`` is
not: it depends on the partition a row lands in).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holecard.functions.text import col

# Leading hex digits of the random key that make its bucket: 16 ** 4 buckets,
# a constant, so the table of their row counts stays small at any scale.
BUCKET_DIGITS = 4


def random_key(seed: int, *parts) -> Column:
    """Seeded, partition-independent sort key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[col(p).cast("string") for p in parts]))


def _buckets(keyed: DataFrame) -> DataFrame:
    """``(_b, _off, n_total)``: rows ahead of every bucket of ``_rk``, one row
    per bucket (at most 16 ** BUCKET_DIGITS), from one combinable count."""
    counts = keyed.groupBy(F.substring("_rk", 1, BUCKET_DIGITS).alias("_b")).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy("_b")
    return counts.select(
        "_b", F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("n_total"))


def sample_k(df: DataFrame, k: int, seed: int, kind: str, keys: list[str]) -> DataFrame:
    """``k`` rows drawn without replacement (all rows when there are fewer).

    The first k rows of the seeded order, read in one pass: a task keeps its
    first k in a heap (no sort, nothing else leaves the task), and the heaps
    are merged in another one.
    """
    keyed = df.withColumn("_rk", random_key(seed, F.lit(kind), *keys))
    return keyed.orderBy("_rk", *keys).limit(k).drop("_rk")


def join_back(chosen: DataFrame, big: DataFrame, on: list[str]) -> DataFrame:
    """Join a sampled set back to a large table; the planner knows the sample's
    limit and picks the join."""
    return big.join(chosen, on, "inner")


def one_per_group(df: DataFrame, group: str, seed: int, kind: str, key: str) -> DataFrame:
    """P7/P2 helper: one random row per group -> ``(group, key)``.

    ``min_by`` runs as a partial + final hash aggregate: a hot group (even a
    third of all rows) is reduced map-side before the shuffle, never sorted
    in one task as ``row_number() over (partition by group)`` would be.
    """
    return df.groupBy(group).agg(
        F.min_by(F.col(key), random_key(seed, F.lit(kind), F.col(key))).alias(key))


def one_per_file(cands: DataFrame, seed: int, kind: str, pos: str, path: str = "path") -> DataFrame:
    """One random candidate of every file (no index given)."""
    return cands.groupBy(path).agg(
        F.min_by(F.col(pos), random_key(seed, F.lit(kind), F.col(path), F.col(pos))).alias(pos))


def module_of(path, root: str = "") -> Column:
    """First path component below ``root`` ('' for a file at the root)."""
    rel = col(path)
    if root:
        rel = F.when(F.startswith(rel, F.lit(root)),
                     F.substring(rel, len(root) + 1, 1 << 30)).otherwise(rel)
    rel = F.regexp_replace(rel, r"^/+", "")
    return F.when(F.instr(rel, "/") > 0, F.substring_index(rel, "/", 1)).otherwise(F.lit(""))


def exact_rank(df: DataFrame, seed: int, key: str) -> DataFrame:
    """1-based rank of every row in seeded random order, without one-task sorts.

    A row's bucket is the beginning of its random key, so a rank is the rows in
    earlier buckets plus the place inside its own: a pure function of the keys,
    whatever the partitions.  Adds ``rank`` and ``n_total``.
    """
    keyed = df.withColumn("_rk", random_key(seed, F.col(key))) \
        .withColumn("_b", F.substring("_rk", 1, BUCKET_DIGITS))
    inside = Window.partitionBy("_b").orderBy("_rk", key)
    return keyed.join(F.broadcast(_buckets(keyed.select("_rk"))), "_b") \
        .withColumn("rank", F.col("_off") + F.row_number().over(inside)) \
        .drop("_rk", "_b", "_off")


def split_random_exact(files: DataFrame, train_ratio: float = 0.8, seed: int = 0,
                       key: str = "path") -> DataFrame:
    """Exact split; the first ``floor(ratio * N)`` rows of the seeded order
    are train, the rest test.  Adds ``split`` and ``split_id`` (1-based within
    the split, the id used for the flat file name)."""
    ranked = exact_rank(files, seed, key)
    cut = F.floor(F.lit(train_ratio) * F.col("n_total")).cast("long")
    return ranked.withColumn("split", F.when(F.col("rank") <= cut, "train").otherwise("test")) \
        .withColumn("split_id", F.when(F.col("rank") <= cut, F.col("rank"))
                    .otherwise(F.col("rank") - cut)) \
        .drop("rank", "n_total")


def split_holdout_per_module(files: DataFrame, seed: int = 0, key: str = "path",
                             module: str = "module") -> DataFrame:
    """One random file of every module is test, the others train."""
    chosen = one_per_group(files, module, seed, "holdout", key).select(key).withColumn("_t", F.lit(True))
    return files.join(chosen, key, "left") \
        .withColumn("split", F.when(F.col("_t"), "test").otherwise("train")).drop("_t")


def number_within_split(split_files: DataFrame, seed: int = 0, key: str = "path") -> DataFrame:
    """1-based ``split_id`` in seeded order inside each split (exact, no
    one-task sort: each split is ranked like :func:`exact_rank`)."""
    parts = [exact_rank(split_files.where(F.col("split") == s), seed, key)
             .withColumnRenamed("rank", "split_id").drop("n_total") for s in ("train", "test")]
    return parts[0].unionByName(parts[1])


def file_mapping(split_files: DataFrame, out_dir: str, key: str = "path",
                 name: str = "file_name") -> DataFrame:
    """P5: ``(old_path, new_path, split)``; new path = ``out/split/<id>_<name>``."""
    return split_files.select(
        F.col(key).alias("old_path"),
        F.concat(F.lit(out_dir.rstrip("/") + "/"), F.col("split"), F.lit("/"),
                 F.col("split_id").cast("string"), F.lit("_"), F.col(name)).alias("new_path"),
        "split")

