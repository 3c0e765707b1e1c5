"""Mixing sources to target weights by weighted fair queueing.

Method: every source is a queue of its documents in shuffled order, served over
and over up to ``max_repeats`` times.  Each serving has a virtual start and
finish time: the source's words served up to its begin and end, divided by the
source's target.  The total budget is used up at virtual time 1, where the mix
is truncated: a serving that ends later keeps the words before it.  The servings
are range-sorted by their finish times.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holecard.llm import columnar as C
from holecard.session import write_table

WEIGHTS = (3, 1, 2)
#: The budget as a share of all words, and how often a source may be repeated.
SHARE = 1.5
MAX_REPEATS = 2
SEED = 7
#: Parts of a source's shuffled queue, so that no task holds a whole source.
QUEUE_PARTS = 1024
#: Most sources whose targets are broadcast (about 50 bytes each).
MAX_BROADCAST_SOURCES = 100_000


@F.pandas_udf(T.LongType())
def n_words(text: pd.Series) -> pd.Series:
    """Words of a text given as bytes; ``bytes.split`` splits at the same six."""
    return pd.Series([len(t.split()) if t is not None else 0 for t in text], dtype="int64")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_repeats: float = MAX_REPEATS) -> DataFrame:
    """``(source, queue, source_size, target)`` of each source of ``sizes (source, size)``.

    Sources in code-point order, null last, weigh ``weights`` in turn and share
    ``share`` times all words.  A target stops at ``max_repeats`` times its
    source's size, and the excess is shared anew by weight, until none is
    above: with sources by size per weight, the level is the largest of (budget
    - what the smaller ones take whole) / (weights of the others).  One row per
    source, so the two windows over all of them are small.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    queue = F.row_number().over(by_name) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.col("queue") % len(weights) + 1)
    per = per.withColumn("queue", queue.cast("int")).withColumn("w", w) \
        .withColumn("cap", F.col("source_size") * float(max_repeats))
    rising = Window.orderBy(F.col("cap") / F.col("w"), "queue")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.withColumn("left", share * F.sum("source_size").over(everything)
                         - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        .withColumn("others", F.sum("w").over(rising.rowsBetween(0, Window.unboundedFollowing)))
    level = F.max(F.col("left") / F.col("others")).over(everything)
    return per.select("source", "queue", "source_size",
                      F.least("cap", level * F.col("w")).alias("target"))


def schedule(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS,
             seed: int = SEED, size=None) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken``,
    ``virtual_finish`` and ``servings``, range-sorted by the finish.

    ``size`` counts the text's runs of bytes other than U+0020 and U+0009 to
    U+000D (null: 0), or is the column given.  ``taken`` are the words of the
    document in the mix, repeats counted, at most ``max_repeats`` times its
    size; the words taken of a source are its target, rounded down.
    ``servings`` are structs (turn, start, finish, words) of virtual times and
    the words before virtual time 1; only servings that begin before it, or
    that hold no words and end by it, are there.  ``taken`` sums their words,
    and ``virtual_finish`` is that of the first serving (null for a source
    without words).  The shuffle is a hash of doc_id and ``seed``, so reruns agree;
    ties go by doc_id, size and text.  Null sources are one source; a null
    doc_id is an id like another.  Input columns of the six names are replaced.
    """
    added = ["size", "source_size", "target", "taken", "virtual_finish", "servings"]
    docs = docs.drop(*added)
    text = F.col("text")
    mine = docs.withColumn("size", n_words(text.cast("binary")) if size is None else size) \
        .withColumn("_hc_tie", F.xxhash64(text)) \
        .withColumn("_hc_hash", F.xxhash64(F.col("doc_id"), F.lit(seed))) \
        .withColumn("_hc_part", F.shiftrightunsigned("_hc_hash", 54).cast("int"))
    targets = write_table(source_targets(mine.select("source", "size"), weights, share, max_repeats)
                          .withColumnRenamed("source", "_hc_source").withColumnRenamed("queue", "_hc_queue"), "targets")
    few = targets.count() <= MAX_BROADCAST_SOURCES
    mine = mine.join(F.broadcast(targets) if few else targets, F.col("source").eqNullSafe(F.col("_hc_source"))) \
        .drop("_hc_source")
    parts = mine.groupBy("_hc_queue", "_hc_part").agg(F.sum("size").alias("_hc_words"))
    ahead = Window.partitionBy("_hc_queue").orderBy("_hc_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_hc_queue", "_hc_part", F.coalesce(F.sum("_hc_words").over(ahead), F.lit(0)).alias("_hc_ahead"))
    inside = Window.partitionBy("_hc_queue", "_hc_part").orderBy("_hc_hash", "doc_id", "size", "_hc_tie") \
        .rowsBetween(Window.unboundedPreceding, 0)
    out = mine.join(parts, ["_hc_queue", "_hc_part"]) \
        .withColumn("_hc_end", F.col("_hc_ahead") + F.sum("size").over(inside))
    out = out.withColumn("servings", _servings(int(np.ceil(max_repeats)))) \
        .withColumn("taken", F.aggregate("servings", F.lit(0).cast("long"), lambda n, s: n + s["words"])) \
        .withColumn("virtual_finish", F.when(F.col("target") > 0, F.col("_hc_end") / F.col("target")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *added).orderBy("virtual_finish", "doc_id")


def _servings(turns: int):
    """The servings of a document that fall before virtual time 1, which is when
    a source has been served its target; a target counts whole words."""
    quota = F.floor(F.col("target") + 1e-6)

    def serving(turn):
        ahead = F.col("_hc_end") + turn * F.col("source_size")
        return F.struct(turn.cast("int").alias("turn"), ((ahead - F.col("size")) / F.col("target")).alias("start"),
                        (ahead / F.col("target")).alias("finish"),
                        F.when(ahead <= quota, F.col("size")).otherwise(
                            F.greatest(F.lit(0), quota - ahead + F.col("size"))).cast("long").alias("words"))

    every = F.transform(F.sequence(F.lit(0), F.lit(turns - 1)), serving)
    none = F.array().cast("array<struct<turn: int, start: double, finish: double, words: long>>")
    return F.when(F.col("target") > 0, F.filter(every, lambda s: (s["words"] > 0) | (
        (s["finish"] <= 1) & (s["start"] == s["finish"])))).otherwise(none)


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, max_repeats: float = MAX_REPEATS,
        seed: int = SEED) -> DataFrame:
    """The mixed corpus: the columns of ``docs``, a row per serving, range-sorted
    by the servings' virtual finish times.

    A document that is taken more than once has a row for each time; the last
    one may hold only its first words (up to the end of the last word taken).
    Documents of which nothing is taken are left out.
    """
    plan = schedule(docs, weights, share, max_repeats, seed)
    rows = plan.where("taken > 0").withColumn("_hc_serving", F.explode(F.filter("servings", lambda s: s["words"] > 0)))
    some = F.col("_hc_serving")["words"]

    @F.pandas_udf("string")
    def first_words(text: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([_cut(t, k) for t, k in zip(text, n)])

    cut = F.when(some < F.col("size"), first_words(F.col("text").cast("binary"), some)).otherwise(F.col("text"))
    return rows.withColumn("text", cut).orderBy(F.col("_hc_serving")["finish"], "doc_id") \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def _cut(text: bytes | None, n: int) -> str | None:
    if text is None:
        return None
    buf = np.frombuffer(text, np.uint8)
    ends = C.spans(buf, np.array([0, len(buf)])).ends
    return text[:ends[n - 1]].decode("utf-8", "replace") if 0 < n <= len(ends) else ""
