"""Orientation from inertial samples: turn rates integrated, and drawn towards gravity by a gradient step (Madgwick's filter without a magnetometer)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE = ("gx", "gy", "gz", "ax", "ay", "az")
QUATERNION = ("qw", "qx", "qy", "qz")
Turn = tuple[float, float, float, float]


def _unit(*v: float) -> tuple[float, ...] | None:
    """The vector with length 1; None for one that has no direction."""
    length = math.sqrt(sum(c * c for c in v))
    return tuple(c / length for c in v) if 0 < length < math.inf else None


def level(a: tuple[float, ...] | None) -> Turn:
    """The least turn that explains the direction of gravity; none, if that is unknown."""
    if a is None:
        return 1.0, 0.0, 0.0, 0.0
    s = math.sqrt(2 * (1 + a[2]))
    return (s / 2, a[1] / s, -a[0] / s, 0.0) if s > 1e-6 else (0.0, 1.0, 0.0, 0.0)


def step(q: Turn | None, dt: float, sample: tuple, gain: float) -> Turn:
    """The orientation after one more sample, dt seconds after the last; the first one starts level."""
    g, a = sample[:3], sample[3:]
    a = _unit(*a) if all(x is not None and math.isfinite(x) for x in a) else None
    if q is None:
        return level(a)
    if not all(x is not None and math.isfinite(x) for x in g):
        g = (0.0, 0.0, 0.0)
    w, x, y, z = q
    dw, dx, dy, dz = 0.5 * (-x * g[0] - y * g[1] - z * g[2]), 0.5 * (w * g[0] + y * g[2] - z * g[1]), 0.5 * (w * g[1] - x * g[2] + z * g[0]), 0.5 * (w * g[2] + x * g[1] - y * g[0])
    if a is not None:
        e, f, h = 2 * (x * z - w * y) - a[0], 2 * (w * x + y * z) - a[1], 1 - 2 * (x * x + y * y) - a[2]
        s = _unit(2 * x * f - 2 * y * e, 2 * z * e + 2 * w * f - 4 * x * h, 2 * z * f - 2 * w * e - 4 * y * h, 2 * x * e + 2 * y * f)
        if s is not None:
            dw, dx, dy, dz = dw - gain * s[0], dx - gain * s[1], dy - gain * s[2], dz - gain * s[3]
    return _unit(w + dw * dt, x + dx * dt, y + dy * dt, z + dz * dt) or q


def segments(samples: DataFrame, restart_us: int, device: str, t: str, order: list[str]) -> DataFrame:
    """The samples with `__segment`, the time at which their device's current run without a silence beyond `restart_us` began.

    A device's times are cut into buckets as wide as the silence, so a silence shows from a bucket and the one before; only the buckets' own rows go by device.
    """
    here = Window.partitionBy(device, "__bucket").orderBy(t, *order)
    cut = samples.withColumn("__bucket", F.floor(F.col(t) / restart_us)).withColumn("__before", F.lag(t).over(here))
    ends = cut.groupBy(device, "__bucket").agg(F.max(t).alias("__end"))
    ends = ends.select(F.col(device).alias("__device"), (F.col("__bucket") + 1).alias("__next"), "__end")
    cut = cut.join(ends, F.col(device).eqNullSafe(F.col("__device")) & F.col("__bucket").eqNullSafe(F.col("__next")), "left")
    before = F.coalesce("__before", "__end")
    cut = cut.withColumn("__start", F.when(before.isNull() | (F.col(t) - before > restart_us), F.col(t))).drop("__device", "__next", "__end", "__before")
    runs = cut.groupBy(device, "__bucket").agg(F.max("__start").alias("__last"))
    runs = runs.select(F.col(device).alias("__device"), F.col("__bucket").alias("__own"), F.max("__last").over(Window.partitionBy(device).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)).alias("__carried"))
    cut = cut.join(runs, F.col(device).eqNullSafe(F.col("__device")) & F.col("__bucket").eqNullSafe(F.col("__own")))
    began = F.max("__start").over(here.rowsBetween(Window.unboundedPreceding, 0))
    return cut.withColumn("__segment", F.coalesce(began, "__carried")).drop("__device", "__own", "__carried", "__start", "__bucket")


def orientation(samples: DataFrame, gain: float = 0.1, restart_us: int | None = None, device: str = "device", stamp: str = "stamp", order: list[str] | None = None) -> DataFrame:
    """The samples (device, stamp, gx, gy, gz in radians a second, ax, ay, az, more) with qw, qx, qy, qz, the turn from the sensor to a level frame after each.

    A device's first sample starts level with its gravity and heads to 0; so does one after a silence longer than `restart_us`, if that is given.  An unknown turn rate is no turn,
    an unknown, infinite or zero acceleration corrects nothing, and a sample without a stamp has no orientation.  Rows without a device are one device; equal stamps go by `order`
    (default: id, where there is one); repeated rows are samples each.  Each orientation needs the one before, so a run of samples (a device's, or with `restart_us` that of one
    stretch) is read in order by one task, which holds a batch and one orientation.
    """
    order = order if order is not None else [c for c in ("id",) if c in samples.columns]
    names = samples.columns
    sent = samples.withColumn("__t", F.unix_micros(F.col(stamp).cast("timestamp")))
    sent = segments(sent, restart_us, device, "__t", order) if restart_us else sent.withColumn("__segment", F.lit(None).cast("bigint"))
    key = F.coalesce(F.concat(F.lit("d"), F.col(device).cast("string")), F.lit("")).alias("__key")
    sent = sent.select(key, "__segment", "__t", *[F.col(c).cast("double").alias(f"__{c}") for c in SAMPLE], *names)
    lead, out = len(sent.columns) - len(names), samples.drop(*QUATERNION)
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields], *[f"{c} double" for c in QUATERNION]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, q, last = None, None, 0
        for b in batches:
            turns: list[Turn | tuple] = []
            for who, segment, t, *sample in zip(*[b.column(i).to_pylist() for i in range(lead)]):
                if t is None:
                    turns.append((None,) * 4)
                    continue
                if (who, segment) != now:
                    now, q, last = (who, segment), None, t
                q = step(q, (t - last) / 1e6, tuple(sample), gain)
                last = t
                turns.append(q)
            own = [(n, b.column(lead + i)) for i, n in enumerate(names) if n not in QUATERNION]
            found = [pa.array(c, pa.float64()) for c in (zip(*turns) if turns else ((),) * 4)]
            yield pa.RecordBatch.from_arrays([*[c for _, c in own], *found], [*[n for n, _ in own], *QUATERNION])

    return sent.repartition("__key", "__segment").sortWithinPartitions("__key", "__segment", "__t", *order).mapInArrow(run, schema)
