"""Triangle meshes: vertices(vid, x, y, z, ...) and triangles(tid, v0, v1, v2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_vertices(triangles: DataFrame, kept: DataFrame) -> DataFrame:
    """Triangles all of whose vertices are kept."""
    out = triangles
    for v in ("v0", "v1", "v2"):
        out = out.join(kept.select(F.col("vid").alias(v)), v, "left_semi")
    return out.select(*triangles.columns)


def corners(triangles: DataFrame) -> DataFrame:
    """tid, corner, vid."""
    each = F.posexplode(F.array("v0", "v1", "v2")).alias("corner", "vid")
    return triangles.select("tid", each)


def vertex_normals(vertices: DataFrame, triangles: DataFrame) -> DataFrame:
    """vid, nx, ny, nz: the unit sum of the area-weighted normals of a vertex's triangles; zero where they cancel."""
    at = corners(triangles).join(vertices.select("vid", "x", "y", "z"), "vid")
    points = at.groupBy("tid").agg(*[F.max(F.when(F.col("corner") == k, F.struct("vid", "x", "y", "z"))).alias(f"p{k}") for k in range(3)]).where(F.col("p0").isNotNull() & F.col("p1").isNotNull() & F.col("p2").isNotNull())
    d = lambda a, k: F.col(f"p{k}.{a}") - F.col(f"p0.{a}")
    cross = [d("y", 1) * d("z", 2) - d("z", 1) * d("y", 2), d("z", 1) * d("x", 2) - d("x", 1) * d("z", 2), d("x", 1) * d("y", 2) - d("y", 1) * d("x", 2)]
    faces = points.select(F.explode(F.array("p0.vid", "p1.vid", "p2.vid")).alias("vid"), *[c.alias(n) for c, n in zip(cross, ("fx", "fy", "fz"))])
    total = faces.groupBy("vid").agg(*[F.sum(c).alias(c) for c in ("fx", "fy", "fz")])
    size = F.sqrt(F.col("fx") * F.col("fx") + F.col("fy") * F.col("fy") + F.col("fz") * F.col("fz"))
    return total.select("vid", *[F.when(size > 0, F.col(f) / size).otherwise(0.0).alias(n) for f, n in (("fx", "nx"), ("fy", "ny"), ("fz", "nz"))])


def trim(vertices: DataFrame, triangles: DataFrame, q: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """Without the vertices whose density is below the quantile, and without their triangles."""
    from fieldspark.operators.spatial import quantile_trim

    kept = quantile_trim(vertices, "density", q)
    return kept, with_vertices(triangles, kept)


def info(vertices: DataFrame, triangles: DataFrame) -> DataFrame:
    """One row: counts, and whether vertices have normals and colours."""
    a = vertices.agg(F.count("*").alias("n_vertices"), (F.count("nx") > 0).alias("has_normals"), (F.count("r") > 0).alias("has_colors"))
    return a.join(F.broadcast(triangles.agg(F.count("*").alias("n_triangles"))))
