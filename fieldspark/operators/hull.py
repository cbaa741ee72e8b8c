"""Convex hulls: a small hull grows by the farthest points outside it, and each round drops all points that it has come to hold.

The hull being built is the only thing that the driver has, and `most` bounds it; finding the farthest point beyond each face is one pass with a partial aggregation,
over the points that are still outside.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.spatial import AXES
from fieldspark.session import kept

FACE = "fid int, v0 bigint, v1 bigint, v2 bigint, nx double, ny double, nz double, offset double, beyond double"
NEAR = 1e-9  # of the cloud's extent: as near to a face counts as on it


class Hull:
    """A closed surface of triangles around a tetrahedron, that takes in points from outside."""

    def __init__(self, pids: list[int], places: np.ndarray, near: float):
        self.pids, self.at, self.near = list(pids), [np.asarray(p, float) for p in places], near
        self.middle = np.mean(self.at, axis=0)
        self.faces = np.zeros((0, 3), np.int64)
        self._add([(0, 1, 2), (0, 1, 3), (0, 2, 3), (1, 2, 3)])

    def _add(self, faces: list[tuple[int, int, int]]) -> None:
        at = np.asarray(self.at)
        new = np.array(faces, np.int64)
        n = np.cross(at[new[:, 1]] - at[new[:, 0]], at[new[:, 2]] - at[new[:, 0]])
        inward = np.einsum("ij,ij->i", n, self.middle - at[new[:, 0]]) > 0
        new[inward] = new[inward][:, [0, 2, 1]]
        self.faces = np.concatenate([self.faces, new])
        n = np.cross(at[self.faces[:, 1]] - at[self.faces[:, 0]], at[self.faces[:, 2]] - at[self.faces[:, 0]])
        self.normals = n / np.maximum(np.linalg.norm(n, axis=1), np.finfo(float).tiny)[:, None]
        self.offsets = np.einsum("ij,ij->i", self.normals, at[self.faces[:, 0]])

    @property
    def vertices(self) -> np.ndarray:
        return np.unique(self.faces)

    def take(self, pid: int, place: np.ndarray) -> bool:
        """The hull with this point: the faces that see it give way to a cone over the edge of what it sees."""
        seen = self.normals @ place - self.offsets > self.near
        if not seen.any():
            return False
        edges = {(int(f[i]), int(f[i - 2])) for f in self.faces[seen] for i in range(3)}
        self.pids.append(pid)
        self.at.append(place)
        self.faces = self.faces[~seen]
        self._add([(a, b, len(self.at) - 1) for a, b in edges if (b, a) not in edges])
        return True

    def rows(self, beyond: float) -> list[tuple]:
        return [(i, *[self.pids[v] for v in f], *map(float, n), float(o), beyond) for i, (f, n, o) in enumerate(zip(self.faces, self.normals, self.offsets))]


def _farthest(points: DataFrame, by: Column) -> tuple[float, int, np.ndarray] | None:
    """The point with the largest `by`; of several the last by place, which is a corner, and there the least pid."""
    r = points.agg(F.max(F.struct(by.alias("d"), *AXES, (-F.col("pid")).alias("p"))).alias("m")).first()["m"]
    return None if r is None or r["d"] is None else (r["d"], -r["p"], np.array([r[a] for a in AXES]))


def _tetrahedron(points: DataFrame) -> tuple[Hull, float] | None:
    """Four corners of the cloud, that span a volume."""
    ends = [_farthest(points, sign * F.col(a)) for a in AXES for sign in (1, -1)]
    if ends[0] is None:
        return None
    places = [e[2] for e in ends]
    extent = float(max(np.ptp(np.array(places), axis=0)))
    near = NEAR * extent
    i, j = max(((i, j) for i in range(6) for j in range(i)), key=lambda e: float(np.linalg.norm(places[e[0]] - places[e[1]])))
    a, b = places[i], places[j]
    if not extent > 0:
        return None
    steps = lambda c: F.round(c / F.lit(near))  # noqa: E731  as far but for rounding is as far
    minus = [F.col(c) - float(v) for c, v in zip(AXES, a)]
    dot = lambda v: sum((m * float(x) for m, x in zip(minus[1:], v[1:])), minus[0] * float(v[0]))
    along = (b - a) / np.linalg.norm(b - a)
    square = sum((m * m for m in minus[1:]), minus[0] * minus[0]) - dot(along) * dot(along)
    third = _farthest(points, steps(F.sqrt(F.greatest(square, F.lit(0.0)))))
    flat = np.cross(along, third[2] - a)
    if np.linalg.norm(flat) <= 1e-7 * extent:
        return None
    fourth = _farthest(points, steps(F.abs(dot(flat / np.linalg.norm(flat)))))
    if fourth[0] <= 1:
        return None
    corners = [ends[i], ends[j], third, fourth]
    return Hull([c[1] for c in corners], np.array([c[2] for c in corners]), near), near


def _outside(points: DataFrame, hull: Hull) -> DataFrame:
    """The points beyond some face: pid, x, y, z, the face that they are farthest from, and how far in steps of `near`."""
    normals, offsets, near = hull.normals, hull.offsets, hull.near

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                part = b.slice(lo, 4096)
                far = np.stack([np.asarray(part.column(i)) for i in range(1, 4)], axis=1) @ normals.T - offsets
                face = np.argmax(far, axis=1)
                far = far[np.arange(len(face)), face]
                on = pa.array(far > near)
                yield pa.RecordBatch.from_arrays([*[c.filter(on) for c in part.columns], pa.array(face.astype(np.int32)).filter(on), pa.array(np.round(far / near)).filter(on)], ["pid", *AXES, "face", "far"])

    return points.select("pid", *AXES).mapInArrow(run, "pid bigint, x double, y double, z double, face int, far double")


def convex_hull(points: DataFrame, most: int = 64) -> DataFrame:
    """The faces of the cloud's (pid, x, y, z) convex hull: fid, v0, v1, v2 (pids, anticlockwise from outside), normal, offset (normal times place, on the face), beyond.

    With more than `most` corners the hull is that of `most` of them, the ones farthest out round by round, as collision shapes want it; `beyond` tells how far the
    farthest point is from it then, and is 0 for a whole hull.  `most` (at least 4) bounds the driver's memory, twice as many faces.  Points nearer to a face than 1e-9 of
    the extent are on it; a flat face of more than three corners is several triangles.  Of equal points the least pid counts.  Points with a null or NaN coordinate,
    or without pid, are left out.  A cloud without a volume (empty, fewer than four points, all on a line or a plane) has no faces.
    """
    spark = points.sparkSession
    known = F.col("pid").isNotNull()
    for a in AXES:
        known = known & F.col(a).isNotNull() & ~F.isnan(F.col(a).cast("double")) & (F.abs(F.col(a).cast("double")) < float("inf"))
    left = points.where(known).select(F.col("pid").cast("bigint").alias("pid"), *[F.col(a).cast("double").alias(a) for a in AXES])
    start = _tetrahedron(left)
    if start is None:
        return spark.createDataFrame([], FACE)
    hull, near = start
    while True:
        left = kept(_outside(left, hull), "outside")
        far = left.groupBy("face").agg(F.max(F.struct("far", *AXES, (-F.col("pid")).alias("p"))).alias("m")).collect()  # a row for each face
        far = sorted((r["m"] for r in far), reverse=True)
        if not far:
            return spark.createDataFrame(hull.rows(0.0), FACE)
        for m in far:
            if len(hull.vertices) >= most:
                return spark.createDataFrame(hull.rows(_beyond(left, hull)), FACE)
            hull.take(-m["p"], np.array([m[a] for a in AXES]))


def _beyond(left: DataFrame, hull: Hull) -> float:
    return float(_outside(left, hull).agg(F.max("far")).first()[0] or 0.0) * hull.near


def corners(faces: DataFrame) -> DataFrame:
    """pid and n_edges of each corner of a hull."""
    return edges(faces).select(F.explode(F.array("u", "v")).alias("pid")).groupBy("pid").agg(F.count("*").alias("n_edges"))


def edges(faces: DataFrame) -> DataFrame:
    """u < v of each edge of a hull, by pid."""
    ends = F.array(*[F.struct(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")) for a, b in (("v0", "v1"), ("v1", "v2"), ("v2", "v0"))])
    return faces.select(F.explode(ends).alias("e")).select("e.*").distinct()


def depth(points: DataFrame, faces: DataFrame) -> DataFrame:
    """pid and d of each point against a hull: its largest distance from a face's plane, negative inside; null without faces or place.

    The faces go to all tasks: they are at most twice the hull's `most`.
    """
    shape = faces.agg(F.collect_list(F.struct("nx", "ny", "nz", "offset")).alias("__faces"))
    far = F.array_max(F.transform("__faces", lambda f: f["nx"] * F.col("x") + f["ny"] * F.col("y") + f["nz"] * F.col("z") - f["offset"]))
    return points.crossJoin(F.broadcast(shape)).select("pid", far.alias("d"))
