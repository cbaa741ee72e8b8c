"""A camera's messages without a camera: regular stamps with jitter and loss, the same for the same seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def chance(seed: int, what: Column | str, n: Column) -> Column:
    """0 to 1, from a hash of seed, name and number alone: it doesn't depend on partitions, and numbers that follow each other have nothing in common."""
    name = F.lit(what) if isinstance(what, str) else what
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), name, n.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def lossy(messages: DataFrame, loss: float, jitter_us: int = 0, seed: int = 0, topic: str = "topic", stamp: str = "stamp", order: str = "msg_id") -> DataFrame:
    """A recording as a best-effort link delivers it: a share `loss` of each topic's messages is missing, and the others are up to `jitter_us` late."""
    late = F.floor(chance(seed, F.concat(F.lit("late "), F.col(topic)), F.col(order)) * (jitter_us + 1)).cast("bigint")
    return messages.where(chance(seed, F.concat(F.lit("loss "), F.col(topic)), F.col(order)) >= loss).withColumn(stamp, F.timestamp_micros(F.unix_micros(stamp) + late))


def messages(spark: SparkSession, topics: dict[str, float], seconds: float, start_us: int = 0, jitter_us: int = 0, loss: float = 0.0, seed: int = 0) -> DataFrame:
    """msg_id, topic, n, stamp_us of each topic at its rate (Hz): stamps are up to `jitter_us` late, and a share `loss` is missing."""
    parts = []
    for k, (topic, hz) in enumerate(sorted(topics.items())):
        n = F.col("id")
        late = F.floor(chance(seed, f"late {topic}", n) * (jitter_us + 1))
        rows = spark.range(int(seconds * hz)).where(chance(seed, f"loss {topic}", n) >= loss)
        parts.append(rows.select((n * len(topics) + k).alias("msg_id"), F.lit(topic).alias("topic"), n.alias("n"), (F.lit(start_us) + F.floor(n * (1e6 / hz)) + late).cast("bigint").alias("stamp_us")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def camera_stream(spark: SparkSession, hz: int, loss: float = 0.0, seed: int = 0) -> DataFrame:
    """The same as a stream: Spark's rate source, some of whose messages are lost on the way."""
    return spark.readStream.format("rate").option("rowsPerSecond", hz).load().where(chance(seed, "loss", F.col("value")) >= loss).select(F.col("value").alias("msg_id"), F.lit("camera").alias("topic"), F.col("timestamp").alias("stamp"))
