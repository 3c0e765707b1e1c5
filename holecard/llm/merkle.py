"""Merkle manifest of a data set with nested-interval labels.

Rows are leaves.  The leaves of a group (for instance a source) ascend by an
order column; the nodes over them carry the interval ``[lo, hi)`` of the leaf
ranks that they cover.  Every ``FAN_OUT`` consecutive nodes of a level have one
parent.  The tops of the groups' trees, in the order of the groups, are the
leaves of one more tree, whose top is the root.

Levels grow by a combinable grouping of a third of the rows each time and are
written to the checkpoint folder.  Proofs go down the levels: a node's parent
is the one node of its bucket (``lo`` divided by the width of the parent's
level) whose interval contains the node's, and its siblings are the children of
the parent that lie in the difference of the two intervals.  No key holds more
than ``FAN_OUT`` nodes, whatever the size of a group; texts stay in the scan.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holecard.session import write_table

FAN_OUT = 3

_PATH = "array<struct<left: string, right: string>>"


class Manifest(NamedTuple):
    """``leaves``: (tree, n, lo, hi, digest, group, order and carried columns);
    ``groups``: (group, n, tree); ``levels``: nodes (tree, n, lo, hi, digest,
    kids) of every level from the leaves up; ``top_levels``: the same over the
    groups' tops, where a leaf's rank is its tree's number."""

    leaves: DataFrame
    groups: DataFrame
    levels: list[DataFrame]
    top_levels: list[DataFrame]


def leaf_digest(*fields: Column) -> Column:
    """Hex sha256 of the fields one after another: ``-`` for a null, otherwise
    the count of UTF-8 bytes, ``:`` and the value."""
    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(part, fields)), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and the siblings of its path lead to."""
    return F.aggregate(path, leaf, lambda low, step: F.sha2(F.concat(step["left"], low, step["right"]), 256))


def path_digest(path: Column) -> Column:
    """Hex sha256 of all siblings of a path, from the leaf's level to the root's."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with the rank ``lo`` of a row in its group and the group's size ``n``.

    Rows are range-sorted by group and order, so a group of any size lies in
    as many partitions as it fills; a row's place in its partition and the
    counts of the partitions before it give the rank.  Equal rows rank by
    their place in the input files, which a retried task finds again.
    """
    keys = [group, *order, "_hc_row"]
    rows = rows.withColumn("_hc_row", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys) \
        .withColumn("_hc_at", F.monotonically_increasing_id()).drop("_hc_row") \
        .withColumn("_hc_part", F.shiftright("_hc_at", 33))
    rows = write_table(rows, "ranked")
    earlier = Window.partitionBy("_hc_of").orderBy("_hc_in").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(F.col("_hc_part").alias("_hc_in"), F.col(group).alias("_hc_of")) \
        .agg(F.min("_hc_at").alias("_hc_first"), F.count(F.lit(1)).alias("_hc_count")) \
        .withColumn("_hc_before", F.coalesce(F.sum("_hc_count").over(earlier), F.lit(0))) \
        .withColumn("n", F.sum("_hc_count").over(Window.partitionBy("_hc_of")))
    on = (rows["_hc_part"] == parts["_hc_in"]) & rows[group].eqNullSafe(parts["_hc_of"])
    return rows.join(parts, on) \
        .withColumn("lo", F.col("_hc_at") - F.col("_hc_first") + F.col("_hc_before")) \
        .drop("_hc_in", "_hc_of", "_hc_at", "_hc_part", "_hc_first", "_hc_count", "_hc_before")


def build(docs: DataFrame, leaf: Column, order: str = "doc_id", group: str = "source",
          carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``carry`` names columns that stay with a leaf.

    Null groups are one group, the first; null order values come first in
    their group, and rows with one order value rank by their digests.  Other
    columns of ``docs``, whatever their names, aren't read.  An empty table
    has a manifest without nodes.
    """
    carried = {f"carried_{name}": col for name, col in (carry or {}).items()}
    rows = docs.select(F.col(f"`{group}`").alias("group"), F.col(f"`{order}`").alias("order"),
                       leaf.alias("digest"), *[c.alias(n) for n, c in carried.items()])
    rows = ranked(write_table(rows, "leaves"), "group", ["order", "digest"])
    groups = write_table(rows.groupBy("group").agg(F.first("n").alias("n")), "groups")
    trees = ranked(groups.withColumnRenamed("n", "size").withColumn("_hc_all", F.lit(0)), "_hc_all", ["group"])
    trees = write_table(trees.select(F.col("group").alias("_hc_group"), F.col("lo").alias("tree"), "size"), "trees")
    leaves = rows.join(trees.select("_hc_group", "tree"), rows["group"].eqNullSafe(F.col("_hc_group"))) \
        .select("tree", "n", "lo", (F.col("lo") + 1).alias("hi"), "digest", "group", "order", *carried)
    leaves = write_table(leaves, "placed")
    levels = grow(leaves)
    tops = None
    for k, level in enumerate(levels):
        top = level.where(_depth_is(k)).select("tree", "digest")
        tops = top if tops is None else tops.unionByName(top)
    count = trees.count()
    tops = tops.select(F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"),
                       F.col("tree").alias("lo"), (F.col("tree") + 1).alias("hi"), "digest")
    top_levels = grow(write_table(tops, "tops"))
    return Manifest(leaves, trees.withColumnRenamed("_hc_group", "group"), levels, top_levels)


def _depth_is(k: int) -> Column:
    """Trees whose top is at level ``k``."""
    found = F.col("n") <= FAN_OUT ** k
    return found if k == 0 else found & (F.col("n") > FAN_OUT ** (k - 1))


def _bucket(k: int) -> Column:
    """The bucket of level ``k`` that a node lies in."""
    return F.expr(f"lo div {FAN_OUT ** k}L")


def grow(leaves: DataFrame) -> list[DataFrame]:
    """Nodes of all levels; a tree ends at the level where it has one node."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    levels = [leaves]
    while largest > FAN_OUT ** (len(levels) - 1):
        k = len(levels)
        below = levels[-1].where(F.col("n") > FAN_OUT ** (k - 1))
        kids = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
        level = below.groupBy("tree", "n", _bucket(k).alias("_hc_bucket")) \
            .agg(kids.alias("kids")) \
            .select("tree", "n", F.col("kids")[0]["lo"].alias("lo"),
                    F.element_at("kids", -1)["hi"].alias("hi"),
                    F.sha2(F.array_join(F.col("kids")["digest"], ""), 256).alias("digest"), "kids")
        levels.append(write_table(level, f"level{k}"))
    return levels


def _descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest level with ``path``: from every node's siblings to those of
    its tree's top, followed by the path of ``tops (_hc_tree, top, top_path)``."""
    above = None
    for k in range(len(levels) - 1, -1, -1):
        level = levels[k]
        found = level.where(_depth_is(k)).join(tops, F.col("tree") == F.col("_hc_tree")) \
            .drop("_hc_tree").withColumnRenamed("top_path", "path")
        if above is not None:
            parents = above.select(
                F.col("tree").alias("p_tree"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"),
                _bucket(k + 1).alias("p_bucket"), F.col("kids").alias("p_kids"),
                F.col("path").alias("p_path"), "top")
            inner = level.where(F.col("n") > FAN_OUT ** k).join(
                parents, (F.col("tree") == F.col("p_tree")) & (_bucket(k + 1) == F.col("p_bucket"))
                & (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi")))
            left = F.filter("p_kids", lambda s: s["hi"] <= F.col("lo"))
            right = F.filter("p_kids", lambda s: s["lo"] >= F.col("hi"))
            step = F.struct(F.array_join(left["digest"], "").alias("left"),
                            F.array_join(right["digest"], "").alias("right"))
            inner = inner.withColumn("path", F.concat(F.array(step), F.col("p_path"))) \
                .drop("p_tree", "p_lo", "p_hi", "p_bucket", "p_kids", "p_path")
            found = found.unionByName(inner)
        above = found
    return above


def proofs(manifest: Manifest) -> DataFrame:
    """``(group, order, carried columns, lo, hi, digest, top, root, path)`` of
    every leaf: its group's top, the root, and the siblings on the way there."""
    start = manifest.top_levels[-1].select(
        F.col("tree").alias("_hc_tree"), F.col("digest").alias("top"), F.array().cast(_PATH).alias("top_path"))
    groups = _descend(manifest.top_levels, start)
    groups = groups.select(F.col("lo").alias("_hc_tree"), F.struct(F.col("digest").alias("group"),
                           F.col("top").alias("root")).alias("top"), F.col("path").alias("top_path"))
    found = _descend(manifest.levels, write_table(groups, "tops"))
    kept = [c for c in manifest.leaves.columns if c not in ("tree", "n")]
    return found.select(*kept, F.col("top")["group"].alias("top"), F.col("top")["root"].alias("root"), "path")
