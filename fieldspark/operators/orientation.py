"""Normals turned the same way across a cloud, along the minimum spanning tree of its neighbourhood graph.

The tree is never built as such.  In each round every part of the graph takes its cheapest edge to another part (edges are in one strict order, so the tree is unique),
parts that hang together become one, and each remembers whether its own reference normal agrees with the new part's.  Parts halve at least from round to round; all of
a round's steps are joins and aggregations over edges, and its tables are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.spatial import AXES, knn
from fieldspark.session import kept

NORMAL = ("nx", "ny", "nz")


def neighbour_edges(points: DataFrame, k: int, edge: float) -> DataFrame:
    """u < v, w, s: each point's k nearest others as undirected edges; w is one less the absolute cosine of the two normals, s the sign of their product."""
    near = knn(points, points, k + 1, edge).where((F.col("q") != F.col("n")))
    pairs = near.select(F.least("q", "n").alias("u"), F.greatest("q", "n").alias("v")).distinct()
    length = F.sqrt(sum((F.col(c) * F.col(c) for c in NORMAL[1:]), F.col("nx") * F.col("nx")))
    own = points.select("pid", F.struct(*NORMAL, length.alias("l")).alias("m"))
    both = pairs.join(own.toDF("u", "mu"), "u").join(own.toDF("v", "mv"), "v")
    dot = F.col("mu.nx") * F.col("mv.nx") + F.col("mu.ny") * F.col("mv.ny") + F.col("mu.nz") * F.col("mv.nz")
    return both.select("u", "v", (1.0 - F.abs(dot) / (F.col("mu.l") * F.col("mv.l"))).alias("w"), F.when(dot < 0, -1).otherwise(1).alias("s"))


def _cheapest(edges: DataFrame) -> DataFrame:
    """c, other, u, v, s of each part's cheapest edge."""
    ends = [edges.select(F.col(own).alias("c"), F.struct("w", "u", "v", F.col(far).alias("other"), "s").alias("e")) for own, far in (("a", "b"), ("b", "a"))]
    return ends[0].unionByName(ends[1]).groupBy("c").agg(F.min("e").alias("e")).select("c", "e.other", "e.u", "e.v", "e.s")


def _jump(links: DataFrame) -> DataFrame:
    """c, p, s with p replaced by p's own p."""
    on = links.select(F.col("c").alias("p"), F.col("p").alias("__p"), F.col("s").alias("__s"))
    return links.join(on, "p").select("c", F.col("__p").alias("p"), (F.col("s") * F.col("__s")).alias("s"))


def _merged(best: DataFrame) -> DataFrame:
    """c, p, s: each part's place in a larger one, whose name is one of its parts', and the sign between the two.

    Cheapest edges lead to exactly one pair of parts that chose each other; the smaller of the two names the whole.
    """
    back = best.select(F.col("c").alias("other"), F.struct("u", "v").alias("__chosen"))
    root = (F.col("__chosen") == F.struct("u", "v")) & (F.col("c") < F.col("other"))
    links = kept(best.join(back, "other").select("c", F.when(root, F.col("c")).otherwise(F.col("other")).alias("p"), F.when(root, 1).otherwise(F.col("s")).alias("s")), "links")
    while True:
        links = kept(_jump(_jump(links)), "links")
        names = links.where(F.col("c") == F.col("p")).select(F.col("c").alias("p"))
        if links.join(names, "p", "left_anti").isEmpty():
            return links


def _contracted(edges: DataFrame, links: DataFrame) -> DataFrame:
    """The edges between the larger parts, of parallel ones the cheapest."""
    end = lambda c: links.select(F.col("c").alias(c), F.col("p").alias(f"p{c}"), F.col("s").alias(f"s{c}"))
    both = edges.join(end("a"), "a").join(end("b"), "b").where(F.col("pa") != F.col("pb"))
    ends = [F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")]
    return both.groupBy(*ends).agg(F.min(F.struct("w", "u", "v", (F.col("s") * F.col("sa") * F.col("sb")).alias("s"))).alias("e")).select("a", "b", "e.*")


def tree_signs(edges: DataFrame) -> DataFrame:
    """c, p, s of each end of the edges (u, v, w, s): the part of the graph that it is in, and its sign against the one that names the part, along the minimum spanning tree."""
    now, rounds = kept(edges.select(F.col("u").alias("a"), F.col("v").alias("b"), "w", "u", "v", "s"), "edges"), []
    while not now.isEmpty():
        rounds.append(_merged(kept(_cheapest(now), "best")))
        now = kept(_contracted(now, rounds[-1]), "edges")
    if not rounds:
        return edges.select(F.col("u").alias("c"), F.col("v").alias("p"), "s")
    out = rounds[-1]
    for links in reversed(rounds[:-1]):  # from large parts back to points: tables double from step to step
        on = out.select(F.col("c").alias("p"), F.col("p").alias("__p"), F.col("s").alias("__s"))
        out = kept(links.join(on, "p", "left").select("c", F.coalesce("__p", "p").alias("p"), (F.col("s") * F.coalesce("__s", F.lit(1))).alias("s")), "signs")
    return out


def _upward(n: Column) -> Column:
    """1 or -1, so that the normal times it points up; a level one towards positive y, then x."""
    down = (n["nz"] < 0) | (n["nz"] == 0) & ((n["ny"] < 0) | (n["ny"] == 0) & (n["nx"] < 0))
    return F.when(down, -1).otherwise(1)


def consistent(points: DataFrame, k: int = 10, edge: float = 0.1) -> DataFrame:
    """The points (pid, x, y, z, nx, ny, nz, more), each normal turned or left, so that neighbours agree along the spanning tree.

    The graph joins each point to its k nearest.  In each connected part the highest point (of equally high ones the least pid) has its normal turned up, so a
    closed surface's normals point outward; parts that no edge joins are turned each for itself.  pid is unique.  Points without a normal (null, NaN or zero) or without a place are
    no part of the graph and stay as they are; so does a single point but for its turn up.  An empty cloud gives an empty one.
    """
    length = sum((F.col(c) * F.col(c) for c in NORMAL[1:]), F.col("nx") * F.col("nx"))
    whole = [F.col(c).isNotNull() & ~F.isnan(c) for c in (*AXES, *NORMAL)]
    known = F.lit(True)
    for c in whole:
        known = known & c
    given = kept(points.where(known & F.col("pid").isNotNull() & (length > 0)).select("pid", *[F.col(c).cast("double").alias(c) for c in (*AXES, *NORMAL)]), "oriented")
    signs = tree_signs(neighbour_edges(given, k, edge)).select(F.col("c").alias("pid"), "p", "s")
    own = given.join(signs, "pid", "left").select("pid", "z", *[(F.col(c) * F.coalesce("s", F.lit(1))).alias(c) for c in NORMAL], F.coalesce("p", "pid").alias("p"), F.coalesce("s", F.lit(1)).alias("s"))
    top = own.groupBy("p").agg(F.max(F.struct("z", (-F.col("pid")).alias("least"), *NORMAL)).alias("top")).select("p", _upward(F.col("top")).alias("turn"))
    turned = own.join(top, "p").select("pid", (F.col("s") * F.col("turn")).alias("__turn"))
    out = points.join(turned, "pid", "left")
    return out.select(*[(F.col(c) * F.coalesce("__turn", F.lit(1))).alias(c) if c in NORMAL else F.col(c) for c in points.columns])
