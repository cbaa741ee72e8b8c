"""An occupancy grid from rays: the cell of a ray's end is hit, and the cells that it passes are free.

A ray meets a new cell wherever it crosses a plane between cells; the crossings of the three axes in order cut it into stretches, and each stretch's middle names a cell.
That is one expression over arrays, so rays become cells without a shuffle, and cells that many rays pass are counted before anything moves.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.operators.spatial import AXES

# Probabilities of a hit and a miss, and the least and greatest that a cell keeps.
HIT, MISS, LEAST, MOST = 0.7, 0.4, 0.1192, 0.971


def log_odds(p: float) -> float:
    return math.log(p / (1.0 - p))


def _crossings(o: Column, d: Column, end: Column, edge: float) -> Column:
    """Where along o + t d the planes between o's and end's cells lie, as t."""
    a, b = F.floor(o / edge), F.floor(end / edge)
    planes = F.when(a != b, F.sequence(F.least(a, b) + 1, F.greatest(a, b))).otherwise(F.array().cast("array<bigint>"))
    return F.transform(planes, lambda i: (i * F.lit(edge) - o) / d)


def passed_cells(rays: DataFrame, edge: float, most: float) -> Column:
    """Cells (cx, cy, cz) of a ray from ox, oy, oz to x, y, z, or to `most` along it, in order."""
    o, d = [F.col(f"o{a}") for a in AXES], [F.col(a) - F.col(f"o{a}") for a in AXES]
    length = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    stop = F.when(length > most, F.lit(most) / length).otherwise(F.lit(1.0))
    crossed = [_crossings(o[k], d[k], o[k] + d[k] * stop, edge) for k in range(3)]
    inside = F.filter(F.concat(*crossed), lambda t: (t > 0.0) & (t < stop))
    at = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), stop), inside)))
    middles = lambda at: F.transform(F.slice(at, 2, F.size(at)), lambda t, i: (t + F.get(at, i)) / 2.0)
    cells = lambda at: F.transform(middles(at), lambda t: F.struct(*[F.floor((o[k] + d[k] * t) / edge).alias(f"c{a}") for k, a in enumerate(AXES)]))
    return F.flatten(F.transform(F.array(at), cells))  # the crossings are made once


def grid(rays: DataFrame, edge: float, least: float = 0.0, most: float = math.inf, hit: float = HIT, miss: float = MISS, low: float = LEAST, high: float = MOST) -> DataFrame:
    """cx, cy, cz, hits, misses, log_odds, occupied of all cells that rays (scan, ox, oy, oz, x, y, z) pass or end in.

    A scan hits a cell if any of its rays ends there, and else misses it if any passes: each scan counts once for a cell.  Log-odds of hits and misses are summed and kept within
    `low` and `high`; a cell is occupied if the sum is above 0.  Rays shorter than `least` are left out; those longer than `most` are followed so far and end in no cell.
    A ray of no length hits its own cell.  Rays with a null or NaN coordinate are left out; a null scan is a scan of its own; without rays the grid is empty.
    """
    xyz = [*AXES, *[f"o{a}" for a in AXES]]
    rays = rays.select("scan", *[F.col(c).cast("double").alias(c) for c in xyz])
    for c in xyz:
        rays = rays.where(F.col(c).isNotNull() & ~F.isnan(c))
    d = [F.col(a) - F.col(f"o{a}") for a in AXES]
    length = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    rays = rays.where(length >= least).withColumn("__end", F.struct(*[F.floor(F.col(a) / edge).alias(f"c{a}") for a in AXES]))
    within = length <= most
    free = F.filter(passed_cells(rays, edge, most), lambda c: ~within | (c != F.col("__end")))
    both = F.concat(F.transform(free, lambda c: F.struct(c.alias("c"), F.lit(0).alias("hit"))), F.when(within, F.array(F.struct(F.col("__end").alias("c"), F.lit(1).alias("hit")))).otherwise(F.array().cast("array<struct<c:struct<cx:bigint,cy:bigint,cz:bigint>,hit:int>>")))
    seen = rays.select("scan", F.explode(both).alias("x")).select("scan", "x.c.*", "x.hit").groupBy("scan", "cx", "cy", "cz").agg(F.max("hit").alias("hit"))
    cells = seen.groupBy("cx", "cy", "cz").agg(F.sum("hit").alias("hits"), F.sum(1 - F.col("hit")).alias("misses"))
    total = F.col("hits") * log_odds(hit) + F.col("misses") * log_odds(miss)
    return cells.withColumn("log_odds", F.greatest(F.lit(log_odds(low)), F.least(F.lit(log_odds(high)), total))).withColumn("occupied", F.col("log_odds") > 0)
