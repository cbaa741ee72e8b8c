"""Structured Streaming twins of the batch operators."""

from __future__ import annotations

import threading
import time
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fieldspark.operators.keyframes import moved


def messages(spark: SparkSession, folder: str, schema, stamp: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the Parquet files in a folder that are called `name`, or lie in its subfolder of that name, with a zoned event time."""
    reader = spark.readStream.schema(schema)
    at = f"{folder}/{name}"
    if spark.read.parquet(at).inputFiles()[0].endswith(f"/{name}"):
        reader, at = reader.option("pathGlobFilter", name), folder
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(at).withColumn(stamp, F.col(stamp).cast("timestamp"))


def windowed_rate(stream: DataFrame, length: str, lateness: str, topic: str = "topic", stamp: str = "stamp", last: list[str] | None = None) -> DataFrame:
    """Counts by window and topic, with the last message's columns; late messages beyond the watermark are dropped."""
    more = [F.max_by(F.struct(*last), F.col(stamp)).alias("last")] if last else []
    grouped = stream.withWatermark(stamp, lateness).groupBy(F.window(stamp, length).alias("w"), topic)
    return grouped.agg(F.count("*").alias("n"), *more).select(F.col("w.start").alias("start"), topic, "n", *(["last.*"] if last else []))


def interval_join(left: DataFrame, right: DataFrame, tolerance_us: int, lateness: str, on: Column | None = None) -> DataFrame:
    """Pairs of two streams (columns l_stamp and r_stamp) that are at most the tolerance apart; state is bounded by the watermarks.

    Stream joins need an equality: messages are dealt to buckets as wide as the tolerance, right ones to their own bucket and both neighbours.
    """
    bucket = lambda c: F.floor(F.unix_micros(c) / F.lit(tolerance_us))
    a = left.withWatermark("l_stamp", lateness).withColumn("__l", bucket(F.col("l_stamp")))
    b = right.withWatermark("r_stamp", lateness).withColumn("__r", F.explode(F.array(*[bucket(F.col("r_stamp")) + k for k in (-1, 0, 1)])))
    width = f"INTERVAL {tolerance_us / 1e6:.6f} SECONDS"
    near = (F.col("__l") == F.col("__r")) & F.expr(f"r_stamp BETWEEN l_stamp - {width} AND l_stamp + {width}")
    return a.join(b, near if on is None else near & on).drop("__l", "__r")


def throttle(stream: DataFrame, interval: str, lateness: str, topic: str = "topic", stamp: str = "stamp") -> DataFrame:
    """One message for each topic and interval: the first that arrives in the interval's window."""
    return stream.withColumn("__slot", F.window(stamp, interval)["start"]).withWatermark(stamp, lateness).dropDuplicatesWithinWatermark([topic, "__slot"]).drop("__slot")


def keyframes(stream: DataFrame, linear: float, angular: float, device: str = "device") -> DataFrame:
    """Rows that moved far enough from their device's last keyframe, kept as state; rows of one trigger are taken in order of stamp and id.

    The rule is that of the batch form: unknown distances and angles are no motion, and known ones after unknown ones are.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(["stamp", "id"], na_position="first")
        last, keep = (state.get if state.exists else None), []
        for d, a in zip(rows["distance"].astype(float), rows["angle"].astype(float)):
            hit = last is None or moved(d, last[0], linear) or moved(a, last[1], angular)
            last = (d, a) if hit else last
            keep.append(hit)
        if last is not None:
            state.update((float(last[0]), float(last[1])))
        yield rows[keep]

    return stream.groupBy(device).applyInPandasWithState(step, stream.schema, "distance double, angle double", "append", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Process everything that is there, then stop."""
    q = stream.writeStream.format(fmt).outputMode(mode).option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def wait_for_message(stream: DataFrame, checkpoint: str, timeout: float) -> bool:
    """Whether a message comes within `timeout` seconds: the stream is read until its first batch that isn't empty."""
    came = threading.Event()

    def look(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            came.set()

    q = stream.writeStream.foreachBatch(look).option("checkpointLocation", checkpoint).start()
    try:
        end = time.monotonic() + timeout
        while not came.wait(0.1) and time.monotonic() < end and q.isActive:
            pass
        return came.is_set()
    finally:
        q.stop()


def decode_frames(stream: DataFrame, frames_to: str, errors_to: str, checkpoint: str, data: str = "data") -> None:
    """Decode a stream of depth payloads that is there now: frames go to one table, and messages that can't be decoded to another, with the reason.

    Each trigger's batch is written under its number, so a batch that is repeated after a failure replaces what it had written.
    """
    from fieldspark.functions.frames import decode_depth

    def write(batch: DataFrame, number: int) -> None:
        out = batch.withColumn("__f", decode_depth(data)).drop(data).persist()
        ok = F.col("__f.error").isNull()
        out.where(ok).select("*", "__f.width", "__f.height", "__f.encoding", "__f.data").drop("__f").write.mode("overwrite").parquet(f"{frames_to}/batch={number}")
        out.where(~ok).select("*", "__f.error").drop("__f").write.mode("overwrite").parquet(f"{errors_to}/batch={number}")
        out.unpersist()

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def record(stream: DataFrame, path: str, checkpoint: str, topic: str = "topic") -> None:
    """Record the messages that are there now, in one folder for each topic."""
    q = stream.writeStream.format("parquet").partitionBy(topic).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
