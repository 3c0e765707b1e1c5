"""Connected components of a link table, all in DataFrames."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holecard.session import write_table

#: Links that a task contracts at once.
CHUNK = 1 << 18


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` for every id of ``edges (a, b)``; the component is
    the smallest id of its members.

    Tasks first contract the links that they hold, in chunks of CHUNK, to a
    spanning forest.  While some id is not directly under its smallest one,
    large-star and small-star steps follow in turn: each links neighbours to
    the smallest id around a node and keeps as many links as there were.  A
    step is a combinable minimum and a join; the table of every step is written
    to the checkpoint folder, and only whether another is needed comes to the
    driver.  Null ids are ignored; an empty table gives an empty result.
    """
    edges = _ordered(edges.where("a IS NOT NULL AND b IS NOT NULL"))
    edges = write_table(_contracted(_ordered(_contracted(edges))), "links")
    while not _flat(edges):
        edges = write_table(_star(edges, large=True), "links")
        edges = write_table(_contracted(_star(edges, large=False)), "links")
    pairs = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return write_table(pairs.unionByName(roots), "components")


def forest(a: list, b: list) -> dict:
    """Union-find over links: the root of every id that has one, its smallest."""
    up: dict = {}

    def root(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(a, b):
        x, y = root(x), root(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return {x: root(x) for x in list(up)}


def _contracted(edges: DataFrame) -> DataFrame:
    """As few links, with the same components, as each task's chunks allow."""
    kind = edges.schema["a"].dataType

    def work(batches):
        a, b = [], []

        def flush():
            moved = [(x, y) for x, y in forest(a, b).items() if x != y]
            a.clear()
            b.clear()
            return pa.RecordBatch.from_pydict({"a": [x for x, _ in moved], "b": [y for _, y in moved]},
                                              schema=schema)

        schema = None
        for batch in batches:
            schema = batch.schema
            a += batch.column(0).to_pylist()
            b += batch.column(1).to_pylist()
            if len(a) >= CHUNK:
                yield flush()
        if a:
            yield flush()

    return edges.select("a", "b").mapInArrow(work, f"a {kind.simpleString()}, b {kind.simpleString()}")


def _flat(edges: DataFrame) -> bool:
    """Whether every id has one link at most, to an id without one of its own."""
    ends = edges.select(F.col("a").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("root")) \
        .unionByName(edges.select(F.col("b").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("root")))
    seen = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("root").alias("root"))
    return seen.where("up > 1 OR (up = 1 AND root = 1)").isEmpty()


def _ordered(pairs: DataFrame) -> DataFrame:
    """Links from the larger to the smaller id, each once."""
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")) \
        .where("a <> b").distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every larger neighbour of a node goes to the smallest id
    around it; small star: every smaller neighbour and the node itself do."""
    flipped = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges.unionByName(flipped) if large else edges
    least = around.groupBy("a").agg(F.min("b").alias("m")) \
        .select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
    joined = around.join(least, around["a"] == least["n"])
    if large:
        return _ordered(joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
    out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return _ordered(out)
