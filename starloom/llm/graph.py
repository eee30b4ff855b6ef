"""Connected components over an edge table, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.staging import settle


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)``: one row (node, component) per node named in an edge.

    ``component`` is the smallest node reachable. Edges are undirected; repeated edges and
    loops are allowed, edges with a null end are left out. An empty table gives an empty one.

    Rounds of two steps until nothing changes: each node hands its larger neighbours to its
    smallest one, then each node joins its smallest with its smaller ones. A node's edges are
    aggregated to a minimum, which is summed before the shuffle and written; then edges meet it
    in a join of two plain tables, so that the edges of one node can be split. Every round is a
    written table.
    """
    node = edges.schema["a"].dataType
    edges = edges.select(F.col("a").cast(node), F.col("b").cast(node)).where(
        F.col("a").isNotNull() & F.col("b").isNotNull()
    )
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    current = settle(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state = _state(current)
    while state[0]:
        both = current.union(current.select("b", "a"))
        least = settle(both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")), "least")
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.where("a <> b").distinct()
        large = settle(large, "edges")
        least = settle(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a")
        small = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        current = settle(small, "edges")
        before, state = state, _state(current)
        if state == before:
            break
    return nodes.join(
        current.groupBy("a").agg(F.min("b").alias("component")),
        nodes["node"] == F.col("a"),
        "left",
    ).select("node", F.coalesce("component", "node").alias("component"))
