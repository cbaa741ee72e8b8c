"""Expected against measured topics: status, verdict, and missing ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.functions import scores


def topic_health(expected: DataFrame, rates: DataFrame) -> DataFrame:
    """Each expected topic (topic, label, min_hz) with its measured rate (topic, hz; 0 if there is none) and status.

    `rates` has a row for each topic: after its aggregation either side is of the number of topics.
    """
    hz = F.coalesce(F.col("hz"), F.lit(0.0))
    return expected.join(rates, "topic", "left").select("topic", "label", "min_hz", hz.alias("measured_hz"), scores.topic_status(hz, F.col("min_hz")).alias("status"))


def pipeline_verdict(health: DataFrame, odometry: str, mapping: str) -> DataFrame:
    """One row: whether all topics are OK, whether odometry and mapping are alive, and the verdict.  Without topics nothing is OK."""
    live = lambda t: F.coalesce(F.bool_or((F.col("topic") == t) & (F.col("status") != "MISSING")), F.lit(False))
    row = health.agg(F.coalesce(F.bool_and(F.col("status") == "OK"), F.lit(False)).alias("all_ok"), live(odometry).alias("slam_live"), live(mapping).alias("map_live"))
    return row.withColumn("verdict", scores.verdict(F.col("all_ok"), F.col("slam_live")))


def missing(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return required.join(present.select(key), key, "left_anti")


def present(required: DataFrame, present_: DataFrame, key: str) -> DataFrame:
    return required.join(present_.select(key), key, "left_semi")


def with_defaults(configs: DataFrame, runs: DataFrame, key: str, zero: list[str]) -> DataFrame:
    """Every config, with zeros for those that gave no run, and a drop of 100 percent."""
    joined = configs.join(runs, key, "left")
    fill = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in zero}
    if "drop_pct" in runs.columns:
        fill["drop_pct"] = F.coalesce(F.col("drop_pct"), F.lit(100.0))
    return joined.withColumns(fill)
