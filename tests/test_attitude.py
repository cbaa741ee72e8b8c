"""Orientation from inertial samples: against a plain loop, on awkward rows, and the stream against the batch."""

import math
import random
import time

import pytest
from pyspark.sql import functions as F

from fieldspark.operators import attitude
from fieldspark.session import ready
from fieldspark.streaming import stateful
from tests.test_stateful import as_stream, in_parts

SCHEMA = "device string, t bigint, id bigint, " + ", ".join(f"{c} double" for c in attitude.SAMPLE)


@pytest.fixture(autouse=True)
def _ready(spark):
    ready(spark)


def stamped(df):
    return df.select("device", F.timestamp_micros("t").alias("stamp"), "id", *attitude.SAMPLE)


def samples(r, n, devices=("a", "b", None)):
    t, out = 1_700_000_000_000_000, []
    for i in range(n):
        t += r.choice([0, 10_000, 20_000, 3_000_000])
        out.append((r.choice(devices), t, i, *[r.uniform(-1, 1) for _ in range(3)], r.uniform(-0.5, 0.5), r.uniform(-0.5, 0.5), r.choice([None, 1.0, 9.8])))
    return out


def plain(rows, gain, restart_us):
    out, held = {}, {}
    for device, t, i, *s in sorted(rows, key=lambda m: (m[1], m[2])):
        last, q = held.get(device, (t, None))
        if restart_us and t - last > restart_us:
            last, q = t, None
        q = attitude.step(q, (t - last) / 1e6, tuple(s), gain)
        held[device] = (t, q)
        out[i] = q
    return out


def turns(df):
    return {r["id"]: tuple(r[c] for c in attitude.QUATERNION) for r in df.collect()}


@pytest.mark.parametrize("restart", [None, 1_000_000])
def test_against_a_plain_loop(spark, restart):
    rows = samples(random.Random(5), 400)
    random.Random(6).shuffle(rows)
    got = turns(attitude.orientation(stamped(spark.createDataFrame(rows, SCHEMA)), 0.1, restart))
    assert got == plain(rows, 0.1, restart)


def test_rates_turn_and_gravity_corrects(spark):
    # a quarter turn about z in a second, level all the time; then a wrong start is drawn to gravity
    turn = [("z", 1_000_000 + 10_000 * i, i, 0.0, 0.0, math.pi / 2, 0.0, 0.0, 9.81) for i in range(101)]
    lean = [("x", 1_000_000, 1000, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0)] + [("x", 1_000_000 + 10_000 * i, 1000 + i, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0) for i in range(1, 3000)]
    got = turns(attitude.orientation(stamped(spark.createDataFrame(turn + lean, SCHEMA)), 0.1))
    w, x, y, z = got[100]
    assert (x, y) == (0.0, 0.0) and abs(2 * math.atan2(z, w) - math.pi / 2) < 1e-3
    w, x, y, z = got[3999]
    assert 1 - 2 * (x * x + y * y) > 0.9999
    assert all(abs(sum(c * c for c in q) - 1) < 1e-9 for q in got.values())


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        ("a", None, 1, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0), ("a", 10, 2, None, 1.0, 1.0, None, None, None), ("a", 20, 3, nan, 0.0, inf, 0.0, 0.0, 0.0),
        ("a", 20, 3, 0.0, 0.0, 0.0, inf, 0.0, 0.0), (None, 5, 4, 0.0, 0.0, 0.0, 0.0, 0.0, -1.0), ("", 5, 5, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0),
    ]
    df = stamped(spark.createDataFrame(rows, SCHEMA)).withColumn("qw", F.lit("kept out")).withColumn("__note", F.lit(7))
    for restart in (None, 5):
        out = attitude.orientation(df, restart_us=restart)
        assert out.columns == ["device", "stamp", "id", *attitude.SAMPLE, "__note", *attitude.QUATERNION]
        got = out.collect()
        assert len(got) == 6 and all(r["__note"] == 7 for r in got)
        q = {r["id"]: tuple(r[c] for c in attitude.QUATERNION) for r in got}
        assert q == {1: (None,) * 4, 2: (1.0, 0.0, 0.0, 0.0), 3: (1.0, 0.0, 0.0, 0.0), 4: (0.0, 1.0, 0.0, 0.0), 5: (1.0, 0.0, 0.0, 0.0)}
        assert attitude.orientation(df.limit(0), restart_us=restart).collect() == []


@pytest.mark.parametrize("restart", [None, 1_000_000])
def test_stream_equals_batch(spark, tmp_path, restart):
    r = random.Random(9)
    rows = samples(r, 240)
    want = turns(attitude.orientation(stamped(spark.createDataFrame(rows, SCHEMA)), 0.2, restart))
    rows.append(("end", rows[-1][1] + 60_000_000, 10_000, *[0.0] * 6))
    parts = in_parts(r, [(m[1],) for m in rows], 50, 4_000_000)
    stream = stamped(as_stream(spark, tmp_path, rows, SCHEMA, parts))
    out = stateful.orientation(stream, 0.2, "5 seconds", restart)
    out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    assert turns(spark.read.schema(out.schema).parquet(str(tmp_path / "out"))) == want


def test_many_samples_of_a_device(spark, tmp_path):
    shape = spark.range(400_000).select(F.when(F.col("id") < 399_999, "a").otherwise("end").alias("device"), (F.col("id") * 10_000 + 1_000_000 + F.when(F.col("id") < 399_999, 0).otherwise(10**11)).alias("t"), "id", *[(F.col("id") % (7 + n) / 10).alias(c) for n, c in enumerate(attitude.SAMPLE)])
    shape.write.parquet(str(tmp_path / "in"))
    start = time.monotonic()
    stream = stamped(spark.readStream.schema(shape.schema).parquet(str(tmp_path / "in")))
    out = stateful.orientation(stream, 0.1, "0 seconds")
    out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).option("path", str(tmp_path / "out")).trigger(availableNow=True).start().awaitTermination()
    assert time.monotonic() - start < 40  # each sample moved all that came after it
    got, want = (x.where("device = 'a'").select("id", *attitude.QUATERNION) for x in (spark.read.schema(out.schema).parquet(str(tmp_path / "out")), attitude.orientation(stamped(shape), 0.1)))
    assert got.count() == 399_999 and got.exceptAll(want).isEmpty()
