"""A recording played as a stream, at two rates and across a restart."""

import time

import pytest
from pyspark.sql import functions as F

from fieldspark.session import ready
from fieldspark.sources import replay


@pytest.fixture
def recording(spark, tmp_path):
    ready(spark)
    spark.dataSource.register(replay.ReplaySource)
    rows = [(i, 1_700_000_000_000_000 + i * 20_000) for i in range(500)] + [(500, None), (501, 1_700_000_000_000_000)]
    df = spark.createDataFrame(rows, "msg_id bigint, t bigint").select("msg_id", F.timestamp_micros("t").alias("stamp"), F.lit("x").alias("note"))
    df.repartition(3).write.option("parquet.block.size", 2048).parquet(str(tmp_path / "rec"))
    return tmp_path


def run(spark, at, rate, begin, least):
    """Play until at least so many messages have come."""
    stream = spark.readStream.format("replay").option("path", str(at / "rec")).option("rate", rate).option("begin", begin).load()
    q = stream.writeStream.format("parquet").option("path", str(at / "out")).option("checkpointLocation", str(at / "ck")).trigger(processingTime="100 milliseconds").start()
    end = time.monotonic() + 60
    try:
        while time.monotonic() < end and q.exception() is None and sum(p["numInputRows"] for p in q.recentProgress) < least:
            time.sleep(0.05)
        assert q.exception() is None
    finally:
        q.stop()
    return sorted(r["msg_id"] for r in spark.read.parquet(str(at / "out")).collect())


WHOLE = list(range(500)) + [501]  # the row without a stamp is never played


@pytest.mark.parametrize("rate", [0.5, 2.0])
def test_a_restart_goes_on(spark, recording, rate):
    """Ten seconds of recording: a part is played before the query stops, the rest after it starts again, and nothing twice."""
    begin = time.time() + 3 - 2 / rate  # two seconds of the recording have been played when the query is up
    played = run(spark, recording, rate, begin, 1)
    assert played == sorted(set(played)) and 0 < len(played) < len(WHOLE)
    # the clock has run on meanwhile; the slow one is put to the recording's end
    assert run(spark, recording, rate, begin if rate > 1 else begin - 100, len(WHOLE) - len(played)) == WHOLE


def test_only_groups_of_the_stretch_are_read(spark, recording):
    reader = replay.ReplayReader(str(recording / "rec"), "stamp", 1.0, time.time() - 100, ["msg_id"])
    assert reader.latestOffset() == {"t": 1_700_000_000_000_000 + 499 * 20_000 + 1} and reader.initialOffset() == {"t": 1_700_000_000_000_000}
    assert replay.ReplayReader(str(recording / "rec"), "stamp", 1.0, time.time() + 100, ["msg_id"]).latestOffset() == reader.initialOffset()
    assert len(reader.partitions({"t": 0}, reader.latestOffset())) == len(reader.groups) and reader.partitions({"t": 0}, reader.initialOffset()) == []
    with pytest.raises(ValueError):
        replay.ReplayReader(str(recording / "rec"), "no such", 1.0, 0, ["msg_id"])
