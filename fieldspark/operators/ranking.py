"""Scoring and ranking of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions import params, scores


def stage1_score(runs: DataFrame, hz: str = "color_hz") -> DataFrame:
    """Adds drop_pct, its parts and score to runs with resolution, target_fps, qos and a measured rate (`measured_fps` in sensor runs)."""
    c = F.col
    parts = {
        "drop_pct": scores.drop_pct(c(hz), c("target_fps")),
        "fps_score": scores.fps_score(c(hz), c("target_fps")),
        "quality_score": scores.quality_score(scores.width_of(c("resolution")), scores.height_of(c("resolution")), c("target_fps")),
        "qos_score": scores.qos_score(c("qos")),
    }
    return runs.withColumns(parts).withColumn("score", scores.round_to(c("fps_score") + c("quality_score") + c("qos_score"), 1))


def stage2_score(runs: DataFrame, rate_key: str = "Rtabmap/DetectionRate", inlier_key: str = "Vis/MinInliers") -> DataFrame:
    """Adds liveness flags, parts, penalties and score to runs with params, target_fps, rates, CPU and growth."""
    c = F.col
    parts = {
        "camera_ok": scores.camera_ok(c("color_hz"), c("target_fps")),
        "slam_ok": scores.slam_ok(c("odom_hz")),
        "odom_score": scores.odom_score(c("odom_hz"), params.value(c("params"), rate_key).cast("int")),
        "color_score": scores.color_score(c("color_hz"), c("target_fps")),
        "map_score": scores.map_score(c("map_hz")),
        "cpu_penalty": scores.cpu_penalty(c("cpu_cam"), c("cpu_slam")),
        "io_penalty": scores.io_penalty(c("db_growth_mb_min")),
        "inlier_bonus": scores.inlier_bonus(params.value(c("params"), inlier_key).cast("int")),
    }
    total = c("odom_score") + c("color_score") + c("map_score") + c("inlier_bonus") - c("cpu_penalty") - c("io_penalty")
    return runs.withColumns(parts).withColumn("score", scores.round_to(total, 1)).withColumn("band", scores.run_band(c("camera_ok"), c("slam_ok")))


def ranked(runs: DataFrame) -> DataFrame:
    """Rank by score, the earlier run (seq) first among equal ones, and medal.

    The whole order is one window: meant for tables of runs, of which an experiment has few.
    """
    rank = F.row_number().over(Window.orderBy(F.desc("score"), F.asc("seq"))).cast("bigint")
    return runs.withColumn("rank", rank).withColumn("medal", scores.medal(F.col("rank")))


def best(runs: DataFrame) -> DataFrame:
    """The row that ranks first, by one aggregation."""
    return runs.agg(F.max_by(F.struct(*runs.columns), F.struct("score", -F.col("seq"))).alias("b")).where(F.col("b").isNotNull()).select("b.*")


def stage_document(runs: DataFrame) -> DataFrame:
    """One row: the best run, and all runs in rank order."""
    rows = ranked(runs)
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.struct(*runs.columns).alias("row"))))
    return rows.agg(F.min_by(F.struct(*runs.columns), "rank").alias("best"), F.transform(ordered, lambda x: x["row"]).alias("all"))
