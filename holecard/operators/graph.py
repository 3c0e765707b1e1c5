"""Graph exploration on node and edge tables (H1-H5).

``nodes(id, ...)`` and ``edges(src, dst, ...)``; edges are undirected for
neighbourhoods.  Everything is joins and aggregates: frontiers are deduplicated
before they are joined again, and hub nodes are handled by AQE (the frontier
of a hub is as large as its degree, so its join side is not broadcast on
faith; AQE converts it at run time when it turns out small).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: tier names, nearest first ---
TIERS = ("self", "1-hop", "2-hop")
REST = "rest"


def neighbours(edges: DataFrame, frontier: DataFrame) -> DataFrame:
    """``id`` of every node that an edge joins to one of ``frontier (id)``:
    a semi-join of the edges on either end, never the whole edge table sorted."""
    ahead = edges.join(frontier, edges["src"] == frontier["id"], "left_semi").select(F.col("dst").alias("id"))
    back = edges.join(frontier, edges["dst"] == frontier["id"], "left_semi").select(F.col("src").alias("id"))
    return ahead.unionByName(back).distinct()


def neighbourhood_tiers(nodes: DataFrame, edges: DataFrame, selected: str,
                        degrees: int = 2) -> DataFrame:
    """H1/H5: ``(id, hop, tier)``; hop 0 for the selected node, then 1, 2 ..
    up to ``degrees``; the nearest tier wins; other nodes are ``rest``.

    The first hop is a filter on the scan; each further one reads the edges
    once for either end.  A selected id that is no node has no neighbours.
    """
    here = nodes.where(F.col("id") == selected).select("id").distinct()
    reached = here.select("id", F.lit(0).alias("hop"))
    exists = here.select(F.count(F.lit(1))).scalar() > 0
    frontier = edges.where(((F.col("src") == selected) | (F.col("dst") == selected)) & exists) \
        .select(F.when(F.col("src") == selected, F.col("dst")).otherwise(F.col("src")).alias("id")).distinct()
    for hop in range(1, degrees + 1):
        if hop > 1:
            frontier = neighbours(edges, frontier)
        reached = reached.unionByName(frontier.select("id", F.lit(hop).alias("hop")))
    best = reached.groupBy("id").agg(F.min("hop").alias("hop"))
    tier = F.lit(REST)
    for i in range(degrees, -1, -1):
        tier = F.when(F.col("hop") == i, F.lit(TIERS[i] if i < len(TIERS) else f"{i}-hop")).otherwise(tier)
    return nodes.select("id").join(best, "id", "left").select("id", "hop", tier.alias("tier"))


def _as_text(df: DataFrame, prop: str) -> Column:
    """A property as JavaScript writes it: a whole number has no fraction."""
    c = F.col(prop)
    if df.schema[prop].dataType.typeName() in ("double", "float"):
        whole = (c == F.floor(c)) & (F.abs(c) < 1e15)
        return F.when(whole, c.cast("long").cast("string")).otherwise(c.cast("string"))
    if df.schema[prop].dataType.typeName().startswith("decimal"):
        return F.regexp_replace(F.regexp_replace(c.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    return c.cast("string")


def _truthy(df: DataFrame, prop: str) -> Column:
    """JavaScript truthiness of a property: null, 0, NaN, '' and false fail."""
    c = F.col(prop)
    kind = df.schema[prop].dataType.typeName()
    if kind == "string":
        return c.isNotNull() & (c != "")
    if kind == "boolean":
        return F.coalesce(c, F.lit(False))
    return c.isNotNull() & (c != 0) & ~F.isnan(c.cast("double"))


def nodes_with_property(nodes: DataFrame, prop: str, values: list[str]) -> DataFrame:
    """H3: ids of nodes whose property, as text, is one of ``values``."""
    return nodes.where(_truthy(nodes, prop) & _as_text(nodes, prop).isin(*values)).select("id")


def edge_endpoints_with_property(edges: DataFrame, prop: str, values: list[str]) -> DataFrame:
    """H4: distinct endpoints of the edges whose property is one of ``values``."""
    hit = edges.where(_truthy(edges, prop) & _as_text(edges, prop).isin(*values))
    return hit.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def visible_flag(nodes: DataFrame, selection: DataFrame) -> DataFrame:
    """H2/H5: ``(id, visible)``; visible iff selected, all visible when the
    selection is empty.  The emptiness test is a scalar subquery (one number
    computed once), not a join."""
    sel = selection.select("id").distinct().withColumn("_sel", F.lit(True))
    n_sel = selection.select(F.count(F.lit(1))).scalar()
    return nodes.select("id").join(sel, "id", "left").select(
        "id", (F.coalesce("_sel", F.lit(False)) | (n_sel == 0)).alias("visible"))
