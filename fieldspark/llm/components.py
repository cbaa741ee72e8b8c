"""Connected components of a distributed edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import discard, stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours are tied to the least of them and itself: larger neighbours in a large star, smaller ones and the node in a small one."""
    if large:
        near = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        near = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    tied = near.join(least, "a")
    if large:
        out = tied.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = tied.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def _is_forest(edges: DataFrame) -> bool:
    """Whether every edge leads from a node to its root: nodes have one edge each, and roots none."""
    many = edges.groupBy("a").count().where(F.col("count") > 1).limit(1)
    inner = edges.join(edges.select(F.col("a").alias("b")), "b", "left_semi").limit(1)
    return not many.select(F.lit(1)).unionAll(inner.select(F.lit(1))).limit(1).collect()


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(id, component): the least id reachable, for every node that has an edge (columns a, b) and isn't that least id itself.

    Each round's edges are staged.  Work of a round is two joins and two aggregations on nodes; a node with many edges is an
    aggregation with partial sums and a join whose large partitions can be split.  Self-loops and null ends are dropped.
    """
    now = stage(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while not _is_forest(now):
        old, now = now, stage(_star(_star(now, large=True), large=False), name)
        discard(old)
    return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
