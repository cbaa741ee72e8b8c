"""Point-cloud operators on columns pid, x, y, z (and attributes).

Neighbour joins hash points to cubic cells and join each query's 27 cells.  A query of k neighbours is accepted only when its
k-th distance is within the cell's edge, since only then no nearer point can lie outside those cells; the others are repeated
with doubled cells.  Ties are broken by the smaller pid.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from fieldspark.session import kept, ready

AXES = ("x", "y", "z")


def bbox(points: DataFrame) -> DataFrame:
    """One row: least, greatest and extent of each axis, and the largest extent."""
    ends = [f(a).alias(f"{n}_{a}") for a in AXES for n, f in (("min", F.min), ("max", F.max))]
    row = points.agg(F.count("*").alias("n"), *ends)
    row = row.withColumns({f"d{a}": F.col(f"max_{a}") - F.col(f"min_{a}") for a in AXES})
    return row.withColumn("max_extent", F.greatest("dx", "dy", "dz"))


def cell(c: Column, edge: float, origin: float = 0.0) -> Column:
    return F.floor((c - F.lit(origin)) / F.lit(edge))


def voxel_downsample(points: DataFrame, edge: float, mean: list[str] | None = None) -> DataFrame:
    """One averaged point for each cell of the grid through the origin: cx, cy, cz, n and the means of x, y, z and `mean`."""
    keys = [cell(F.col(a), edge).alias(f"c{a}") for a in AXES]
    return points.groupBy(*keys).agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in (*AXES, *(mean or []))])


def _d2() -> Column:
    """Squared distance of columns qx.. and nx.., summed in axis order."""
    d = [F.col(f"q{a}") - F.col(f"n{a}") for a in AXES]
    return d[0] * d[0] + d[1] * d[1] + d[2] * d[2]


def _around(x: str, y: str, z: str) -> Column:
    """A row for each of a cell's 27 cells, itself included: x, y, z."""
    steps = F.sequence(F.lit(-1), F.lit(1))
    return F.explode(F.flatten(F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.transform(steps, lambda k: F.struct((F.col(x) + i).alias("x"), (F.col(y) + j).alias("y"), (F.col(z) + k).alias("z"))))))))


def _near(queries: DataFrame, points: DataFrame, edge: float) -> DataFrame:
    """Pairs q, n with d2 of points in a query's 27 cells."""
    q = queries.select(F.col("pid").alias("q"), *[F.col(a).alias(f"q{a}") for a in AXES], *[cell(F.col(a), edge).alias(f"c{a}") for a in AXES])
    q = q.withColumn("c", _around("cx", "cy", "cz")).select("q", *[f"q{a}" for a in AXES], *[F.col(f"c.{a}").alias(f"c{a}") for a in AXES])
    p = points.select(F.col("pid").alias("n"), *[F.col(a).alias(f"n{a}") for a in AXES], *[cell(F.col(a), edge).alias(f"c{a}") for a in AXES])
    return q.join(p, ["cx", "cy", "cz"]).withColumn("d2", _d2()).select("q", "n", "d2")


def _closer(d2: np.ndarray, n: np.ndarray, q: np.ndarray, ids: np.ndarray, xyz: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of each query with more points, whose ids are greater than those before: distances and ids, a row for each query."""
    wide = min(k, d2.shape[1] + len(ids))
    more_d2, more_n = np.empty((len(q), wide)), np.empty((len(q), wide), ids.dtype)
    few = max(1, (1 << 20) // (len(ids) + k))
    for at in range(0, len(q), few):
        part = slice(at, at + few)
        x, y, z = (q[part, i, None] - xyz[None, :, i] for i in range(3))
        all_d2 = np.concatenate([d2[part], x * x + y * y + z * z], 1)
        order = np.argsort(all_d2, axis=1, kind="stable")[:, :wide]
        more_d2[part] = np.take_along_axis(all_d2, order, 1)
        more_n[part] = np.take_along_axis(np.concatenate([n[part], np.broadcast_to(ids, (len(order), len(ids)))], 1), order, 1)
    return more_d2, more_n


def _near_k(queries: DataFrame, points: DataFrame, k: int, edge: float, within: float | None) -> DataFrame:
    """q, n, d2, rank of the k nearest among the points in a query's 27 cells, and whether they are `sure` to be the k nearest of all.

    Points are sent to the cells of queries around them, and a cell's queries meet its points there: only the k nearest of each query leave the task, pairs are never
    shuffled, and a task holds one cell's queries and a batch of points.
    """
    home, at = [f"h{a}" for a in AXES], [f"c{a}" for a in AXES]
    xyz = [F.col(a).cast("double").alias(a) for a in AXES]
    q = queries.select(*[cell(F.col(a), edge).alias(h) for a, h in zip(AXES, home)], F.lit(True).alias("__query"), "pid", *xyz).na.drop(subset=home)
    targets = q.select(*home).distinct().withColumn("c", _around(*home)).select(*home, *[F.col(f"c.{a}").alias(c) for a, c in zip(AXES, at)])
    p = points.select(*[cell(F.col(a), edge).alias(c) for a, c in zip(AXES, at)], F.lit(False).alias("__query"), "pid", *xyz)
    both = q.unionByName(p.join(targets, at).select(q.columns))
    pid = both.schema["pid"].dataType
    out = StructType([StructField("q", pid), StructField("n", pid), *StructType.fromDDL("d2 double, rank bigint, sure boolean").fields])
    arrow = to_arrow_schema(out, prefers_large_types=False)

    def done(ids: np.ndarray, d2: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
        own = np.ones(d2.shape, bool) if within is None else d2 <= within * within
        sure = own[:, k - 1] & (d2[:, k - 1] <= edge * edge) if d2.shape[1] == k else np.zeros(len(ids), bool)
        row, rank = np.nonzero(own)
        return [ids[row], n[own], d2[own], rank + 1, sure[row]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, of, best, ready_ = None, None, None, None, []
        for b in batches:
            h = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
            is_query, pids = (b.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
            place = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in (5, 6, 7)])
            cuts = [*np.flatnonzero(np.append(True, (h[1:] != h[:-1]).any(axis=1))[: len(h)]).tolist(), len(h)]
            for low, high in zip(cuts, cuts[1:]):
                if now != tuple(h[low]):
                    ready_ += [done(ids, *best)] if best else []
                    now, ids, of, best = tuple(h[low]), pids[:0], place[:0], None
                mid = low + int(is_query[low:high].sum())  # a cell's queries come first
                if mid > low:
                    ids, of = np.append(ids, pids[low:mid]), np.concatenate([of, place[low:mid]])
                if high > mid:
                    best = _closer(*(best or (np.empty((len(ids), 0)), np.empty((len(ids), 0), pids.dtype))), of, pids[mid:high], place[mid:high], k)
            if ready_:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*ready_), arrow)], schema=arrow)
                ready_ = []
        if best:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(done(ids, *best), arrow)], schema=arrow)

    ready(queries.sparkSession)
    return both.repartition(*home).sortWithinPartitions(*home, F.desc("__query"), "pid").mapInArrow(run, out)


def radius_neighbours(queries: DataFrame, points: DataFrame, radius: float, most: int | None = None) -> DataFrame:
    """q, n, d2, rank of points within the radius (a point is its own neighbour), the `most` nearest.

    With `most`, cells follow the density as in knn(), and no query meets many more points than that, however dense the cloud; without, all pairs are the result.
    """
    if most is not None:
        return knn(queries, points, most, radius, within=radius)
    pairs = _near(queries, points, radius).where(F.col("d2") <= radius * radius)
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("d2", "n")).cast("bigint"))


def _edge_for(points: DataFrame, k: int, edge: float, widest: float = math.inf) -> float:
    """An edge at which the cell of the average place has about k places, or `widest`: each round is one aggregation to a row, and moves the edge by the cube root of what is wrong.

    So a query meets about as many places however many there are in all.  Points in one place count once, as no cell parts them.
    """
    places = points.select(*AXES).distinct()
    for _ in range(12):
        per_cell = places.groupBy(*[cell(F.col(a), edge).alias(f"c{a}") for a in AXES]).agg(F.count("*").alias("n"))
        m = per_cell.agg((F.sum(F.col("n").cast("double") * F.col("n")) / F.sum("n")).alias("m")).first()["m"] or 0.0
        if not m or 0.75 * k <= m <= 1.33 * k or m < k and edge >= widest:
            break
        edge *= min(8.0, max(0.125, (k / m) ** (1 / 3)))
    return min(edge, widest) if widest > 0 else edge


def knn(queries: DataFrame, points: DataFrame, k: int, edge: float, rounds: int = 64, within: float | None = None) -> DataFrame:
    """q, n, d2, rank of the k nearest points (a point is its own neighbour), only those `within` a distance if it is given; all points if there are fewer.

    Queries in one place have the same neighbours, and of points in one place at most the k of least pid can be among them: places are joined, not points, so
    the pairs that are made don't grow with how often a place repeats.
    """
    places = queries.groupBy(*AXES).agg(F.min("pid").alias("pid"))
    few = points.withColumn("__n", F.row_number().over(Window.partitionBy(*AXES).orderBy("pid"))).where(F.col("__n") <= k).drop("__n")
    found = _nearest(places.select("pid", *AXES), few.select("pid", *AXES), k, edge, rounds, within)
    same = queries.select(F.col("pid").alias("__q"), *AXES).join(places.withColumnRenamed("pid", "q"), list(AXES)).select("__q", "q")
    return same.join(found, "q").select(F.col("__q").alias("q"), "n", "d2", "rank")


def _nearest(queries: DataFrame, points: DataFrame, k: int, edge: float, rounds: int, within: float | None) -> DataFrame:
    """knn() of queries in places of their own.

    The first cells hold some k points at the average point, whatever `edge` says, so regions of any density are resolved among few
    pairs; the queries that are left are repeated with doubled cells (four times as wide where a round resolves few).  Each round's result is
    written to the shared folder, and its unresolved queries are counted; a cell as wide as both clouds, or as `within`, ends it.
    """
    box = queries.select(*AXES).unionByName(points.select(*AXES)).agg(*[(F.max(a) - F.min(a)).alias(a) for a in AXES]).first()
    if box is None or box[0] is None:
        return _near(queries, points, edge).withColumn("rank", F.lit(0).cast("bigint"))
    enough = max(box) if within is None else min(max(box), within)
    edge, parts, left, n_left = _edge_for(points, k, edge, enough), [], queries, queries.count()
    for _ in range(rounds):
        last = edge > enough or within is not None and edge >= enough
        if last and within is not None:
            edge = max(edge, within)
        pairs = _near_k(left, points, k, edge, within)
        if last:
            parts.append(pairs.drop("sure"))
            break
        sure = pairs.where("sure").drop("sure")
        # neither the pairs nor the queries that are left are made again by later rounds
        parts.append(kept(sure, "near"))
        left, before = kept(left.join(parts[-1].where(F.col("rank") == 1).select(F.col("q").alias("pid")), "pid", "left_anti"), "left"), n_left
        n_left = left.count()
        if not n_left:
            break
        edge *= 2 if n_left < 0.9 * before else 4
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def mean_distance(points: DataFrame, k: int, edge: float) -> DataFrame:
    """pid and the mean distance to its k nearest points, itself included."""
    return knn(points, points, k, edge).groupBy(F.col("q").alias("pid")).agg(F.avg(F.sqrt("d2")).alias("mean_d"))


def statistical_outliers(points: DataFrame, k: int = 20, ratio: float = 2.0, edge: float = 0.1) -> DataFrame:
    """Points whose mean neighbour distance is at most mean + ratio * sample deviation over the cloud."""
    d = mean_distance(points, k, edge)
    limit = d.agg((F.avg("mean_d") + F.lit(ratio) * F.stddev_samp("mean_d")).alias("limit"))  # one row
    kept = d.join(F.broadcast(limit)).where(F.col("mean_d") <= F.col("limit"))
    return points.join(kept.select("pid"), "pid", "left_semi")


def _order_statistic(values: DataFrame, column: str, k: int, bins: int = 1024, few: int = 4096) -> float:
    """The k-th smallest value (from 0): rounds of counts in equal bins narrow the range to the bin that holds it, until its values are few or one."""
    lo, hi, n = values.agg(F.min(column), F.max(column), F.count(column)).first()
    while lo < hi and n > few:
        at = F.least(F.floor((F.col(column) - F.lit(lo)) / F.lit((hi - lo) / bins)), F.lit(bins - 1))
        rows = values.where(F.col(column).between(lo, hi)).groupBy(at.alias("b")).agg(F.count("*").alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).orderBy("b").collect()
        for r in rows:  # at most `bins`
            if k < r["n"]:
                break
            k -= r["n"]
        if (r["lo"], r["hi"], r["n"]) == (lo, hi, n):
            break
        lo, hi, n = r["lo"], r["hi"], r["n"]
    if lo == hi:
        return lo
    return values.where(F.col(column).between(lo, hi)).orderBy(column).offset(k).first()[0]


def quantile(values: DataFrame, column: str, q: float) -> float | None:
    """The exact, linearly interpolated quantile; nulls and NaN don't count, and without values it is null."""
    values = values.select(F.col(column).cast("double").alias(column)).where(F.col(column).isNotNull() & ~F.isnan(column))
    n = values.count()
    if not n:
        return None
    at = q * (n - 1)
    low = _order_statistic(values, column, int(at))
    if at == int(at):
        return low
    return low + (at - int(at)) * (_order_statistic(values, column, int(at) + 1) - low)


def quantile_trim(points: DataFrame, column: str, q: float = 0.05) -> DataFrame:
    """Rows not below the exact, linearly interpolated quantile."""
    return points.where(F.col(column) >= F.lit(quantile(points, column, q)).cast("double"))


def crop(points: DataFrame, box: DataFrame) -> DataFrame:
    """Points inside a one-row box as bbox() makes it, its faces included."""
    ends = box.select(*[f"{n}_{a}" for a in AXES for n in ("min", "max")])
    inside = F.lit(True)
    for a in AXES:
        inside = inside & F.col(a).between(F.col(f"min_{a}"), F.col(f"max_{a}"))
    return points.join(F.broadcast(ends)).where(inside).select(*points.columns)


def transfer(queries: DataFrame, points: DataFrame, columns: list[str], edge: float) -> DataFrame:
    """Each query's pid with the columns of its nearest point."""
    near = knn(queries, points, 1, edge).select(F.col("q").alias("pid"), F.col("n").alias("__n"))
    return near.join(points.select(F.col("pid").alias("__n"), *columns), "__n").select("pid", *columns)


def range_filter(points: DataFrame, least: float, most: float) -> DataFrame:
    d = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    return points.where(d.between(least, most))


def radius_outliers(points: DataFrame, radius: float, least: int) -> DataFrame:
    """Points with at least `least` others within the radius."""
    # of the nearest `least` + 1 within the radius at least `least` are others, whether the point itself is among them or not
    n = radius_neighbours(points, points, radius, least + 1).where(F.col("q") != F.col("n")).groupBy("q").agg(F.count("*").alias("m"))
    return points.join(n.where(F.col("m") >= least).select(F.col("q").alias("pid")), "pid", "left_semi")


def scaled(points: DataFrame, factor: float) -> DataFrame:
    return points.withColumns({a: F.col(a) * factor for a in AXES})


def normals(points: DataFrame, radius: float = 0.1, most: int = 30, viewpoint: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> DataFrame:
    """pid, nx, ny, nz: the direction of least spread of each point's neighbours, turned towards the viewpoint.

    Covariances are built-in aggregates; only the 3 by 3 eigenvectors are computed in Python.  With fewer than three neighbours: null.
    """
    pairs = radius_neighbours(points, points, radius, most).select("q", "n")
    at = pairs.join(points.select(F.col("pid").alias("n"), *AXES), "n")
    two = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]
    cov = at.groupBy("q").agg(F.count("*").alias("m"), *[F.covar_pop(a, b).alias(a + b) for a, b in two])

    @F.pandas_udf("struct<nx:double,ny:double,nz:double>")
    def smallest(t: pd.DataFrame) -> pd.DataFrame:
        m, xx, xy, xz, yy, yz, zz, x, y, z = (t[c].to_numpy() for c in t.columns)
        c = np.stack([np.stack([xx, xy, xz], -1), np.stack([xy, yy, yz], -1), np.stack([xz, yz, zz], -1)], -2)
        v = np.linalg.eigh(c)[1][:, :, 0] if len(c) else np.zeros((0, 3))
        away = np.einsum("ij,ij->i", v, np.array(viewpoint) - np.stack([x, y, z], -1)) < 0
        v = np.where(away[:, None], -v, v)
        v[np.asarray(m) < 3] = np.nan
        return pd.DataFrame(v, columns=["nx", "ny", "nz"])

    joined = cov.join(points.select(F.col("pid").alias("q"), *AXES), "q")
    return joined.select(F.col("q").alias("pid"), smallest(F.struct("m", *[a + b for a, b in two], *AXES)).alias("v")).select("pid", "v.*")
