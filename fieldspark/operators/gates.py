"""Quality gates: pass, warn or fail for each artifact, and the combined verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.functions.scores import bytes_to_mb


def database(exists: Column, length: Column, integrity: Column | None = None) -> Column:
    """Missing, below 0.1 MB or not intact: fail; below 5 MB: warn."""
    mb = bytes_to_mb(length)
    out = F.when(~exists, "fail").when(mb < 0.1, "fail")
    if integrity is not None:
        out = out.when(F.coalesce(integrity, F.lit("")) != "ok", "fail")
    return out.when(mb < 5.0, "warn").otherwise("pass")


def cloud_file(exists: Column, length: Column) -> Column:
    return F.when(~exists | (length / 1024.0 < 1.0), "fail").otherwise("pass")


def cloud_count(n: Column) -> Column:
    return F.when(n < 100, "fail").when(n < 10000, "warn").otherwise("pass")


def cloud_colors(n_colored: Column) -> Column:
    return F.when(n_colored > 0, "pass").otherwise("warn")


def cloud_extent(dx: Column, dy: Column, dz: Column) -> Column:
    most = F.greatest(dx, dy, dz)
    return F.when(most > 50.0, "warn").when(most < 0.1, "warn").otherwise("pass")


def mesh(exists: Column, length: Column, vertices: Column, triangles: Column) -> Column:
    return F.when(~exists | (length / 1024.0 < 1.0), "fail").when((vertices == 0) | (triangles == 0), "fail").otherwise("pass")


def combined(verdicts: DataFrame, force: bool = False) -> DataFrame:
    """One row: whether no gate failed, or `force`; warnings don't stop anything."""
    ok = F.bool_and(F.col("verdict") != "fail")
    return verdicts.agg((F.coalesce(ok, F.lit(True)) | F.lit(force)).alias("ok"), F.count_if(F.col("verdict") == "warn").alias("warnings"))


def sequence(steps: DataFrame, force: bool = False) -> DataFrame:
    """Gates in a row (ord, gate, verdict): a gate is reached only if none before it failed, or with `force`; the others are `skipped`.

    The order is one window: a pipeline has few gates.
    """
    before = F.max((F.col("verdict") == "fail").cast("int")).over(Window.orderBy("ord").rowsBetween(Window.unboundedPreceding, -1))
    stopped = (F.coalesce(before, F.lit(0)) == 1) & ~F.lit(force)
    return steps.withColumn("outcome", F.when(stopped, "skipped").otherwise(F.col("verdict")))


def exit_code(verdicts: DataFrame, force: bool = False) -> int:
    """0 if no gate failed, or with `force`; 1 otherwise."""
    return 0 if combined(verdicts, force).first()["ok"] else 1
