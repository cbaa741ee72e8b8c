"""Scores, penalties and bands of measured runs, as columns.

round_to is the plain floor(x * 10^d + 0.5) / 10^d, which engines agree on; python_round follows the exact binary value.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

HD_PIXELS = 1280 * 720


def round_to(c: Column, digits: int) -> Column:
    return F.floor(c * float(10**digits) + 0.5) / float(10**digits)


@F.pandas_udf(DoubleType())
def python_round(x: pd.Series, digits: pd.Series) -> pd.Series:
    """Python's round on each value, for byte parity with reports made in Python."""
    return pd.Series([None if pd.isna(v) else round(v, int(d)) for v, d in zip(x, digits)])


def ratio(n: Column, d: Column) -> Column:
    """n / d, and 0 where d isn't positive."""
    return F.when(d > 0, n / d).otherwise(0.0)


def drop_pct(hz: Column, fps: Column) -> Column:
    return F.when(fps > 0, F.greatest(F.lit(0.0), (fps - hz) / fps * 100.0)).otherwise(100.0)


def fps_score(hz: Column, fps: Column) -> Column:
    return F.least(F.lit(1.0), ratio(hz, fps)) * 60.0


def quality_score(width: Column, height: Column, fps: Column) -> Column:
    return width * height / float(HD_PIXELS) * 15.0 + fps / 30.0 * 15.0


def qos_score(qos: Column) -> Column:
    return F.when(qos == "SENSOR_DATA", 10.0).otherwise(5.0)


def width_of(resolution: Column) -> Column:
    return F.split(resolution, "x")[0].cast("int")


def height_of(resolution: Column) -> Column:
    return F.split(resolution, "x")[1].cast("int")


def odom_score(hz: Column, rate: Column) -> Column:
    """Against the detection rate, 5 where none is given."""
    return F.least(F.lit(1.0), hz / F.greatest(F.coalesce(rate, F.lit(5)), F.lit(1))) * 40.0


def color_score(hz: Column, fps: Column) -> Column:
    return F.least(F.lit(1.0), ratio(hz, fps)) * 20.0


def map_score(hz: Column) -> Column:
    return F.when(hz > 0, 10.0).otherwise(0.0)


def cpu_penalty(camera: Column, slam: Column) -> Column:
    return F.least(F.lit(15.0), (camera + slam) * 0.1)


def io_penalty(mb_per_min: Column) -> Column:
    return F.least(F.lit(15.0), mb_per_min * 0.5)


def inlier_bonus(inliers: Column) -> Column:
    return F.when(F.coalesce(inliers, F.lit(10)) >= 10, 10.0).otherwise(5.0)


def camera_ok(hz: Column, fps: Column) -> Column:
    return hz >= fps * 0.8


def slam_ok(hz: Column) -> Column:
    return hz >= 1.0


def drop_band(pct: Column) -> Column:
    return F.when(pct < 10, "green").when(pct < 25, "yellow").otherwise("red")


def run_band(camera: Column, slam: Column) -> Column:
    return F.when(camera & slam, "green").when(slam, "yellow").otherwise("red")


def topic_status(hz: Column, least: Column) -> Column:
    return F.when(hz >= least, "OK").when(hz > 0, "DEGRADED").otherwise("MISSING")


def fps_gate(hz: Column, least: Column) -> Column:
    """A rate that couldn't be measured fails; a low one warns."""
    return F.when(hz.isNull(), "fail").when(hz < least, "warn").otherwise("pass")


def inspector_status(topic: Column, fps: Column, least: float = 15.0) -> Column:
    """Compressed topics must reach `least`; raw images are informational, since the transport limits them."""
    compressed = topic.contains("compressed")
    raw = (topic.contains("color/image_raw") | topic.contains("aligned_depth_to_color/image_raw")) & ~compressed
    return F.when(fps <= 0, "INACTIVE").when(compressed & (fps >= least), "OK").when(compressed, "BAD").when(raw, "INFO").when(fps >= least, "OK").otherwise("DEGRADED")


def medal(rank: Column) -> Column:
    return F.when(rank == 1, "🥇").when(rank == 2, "🥈").when(rank == 3, "🥉").otherwise(rank.cast("string"))


def verdict(all_ok: Column, slam_live: Column) -> Column:
    return F.when(all_ok, "ALL_OK").when(slam_live, "DEGRADED").otherwise("DOWN")


def usb_kind(text: Column) -> Column:
    return F.when(text.contains("2.1") | text.contains("2.0"), "USB 2").when(text.contains("3."), "USB 3").otherwise("Unknown")


def kb_to_mb(c: Column) -> Column:
    return c / 1024.0


def bytes_to_mb(c: Column) -> Column:
    return c / 1048576.0


def mb_per_minute(mb: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, mb / (seconds / 60.0)).otherwise(0.0)
