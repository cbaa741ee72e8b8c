"""Sets, silences, queues and order: batch against plain Python, and streams over several triggers against batch."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark import cli, streaming
from fieldspark.operators import keyframes, rates, sync
from fieldspark.session import ready
from fieldspark.sources import geometry
from fieldspark.streaming import stateful


@pytest.fixture(autouse=True)
def _ready(spark):
    ready(spark)


def micros(c="t"):
    return F.timestamp_micros(F.col(c)).alias("stamp")


def as_stream(spark, tmp_path, rows, schema, parts, name="in"):
    """Rows as files that are read one a trigger, in the order of `parts`."""
    for n, part in enumerate(parts):
        df = spark.createDataFrame([rows[i] for i in part], schema).coalesce(1)
        df.write.parquet(str(tmp_path / name / f"{n:03d}"))
        for f in (tmp_path / name / f"{n:03d}").glob("*.parquet"):
            import os

            os.utime(f, (1_700_000_000 + n, 1_700_000_000 + n))
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))


def in_parts(r, rows, size, mess):
    """Numbers of rows in order of time, with those at most `mess` apart mixed, in parts."""
    order = sorted(range(len(rows)), key=lambda i: rows[i][0] + r.uniform(0, mess))
    return [order[i : i + size] for i in range(0, len(order), size)]


def greedy(rows, n, tolerance):
    """Sets of sorted (t, k, id), by trying: from each start the next message of every stream."""
    rows, out, at = sorted(rows), [], 0

    def begin(i):
        found = [next((m for m in rows[i:] if m[1] == k), None) for k in range(n)]
        return None if None in found or max(found)[0] - rows[i][0] > tolerance else (max(found), max(found)[0] - rows[i][0], tuple(m[2] for m in found))

    while at < len(rows):
        first = begin(at)
        if first is None:
            at += 1
            continue
        choices = [(begin(i), i) for i in range(at, rows.index(first[0]) + 1)]
        best, _ = min(((c, i) for c, i in choices if c), key=lambda x: (x[0][1], x[1]))
        out.append((*best[2], best[1]))
        at = rows.index(best[0]) + 1
    return sorted(out)


def messages(seed, n=260, streams=3):
    r = random.Random(seed)
    return [(r.randrange(0, 40_000) * 100, r.randrange(streams), i) for i in range(n)]


MESSAGE = "t bigint, k int, id bigint"


@pytest.mark.parametrize("seed,streams,tolerance", [(1, 3, 60_000), (2, 2, 9_000), (3, 4, 200_000), (4, 3, 0), (5, 1, 10)])
def test_sets_equal_trying(spark, seed, streams, tolerance):
    rows = messages(seed, streams=streams)
    df = spark.createDataFrame(rows + [(None, 0, 1), (5, 1 % streams, None)], MESSAGE)
    got = sync.together({f"s{k}": df.where(F.col("k") == k) for k in range(streams)}, tolerance)
    assert got.columns == [*[f"s{k}_id" for k in range(streams)], "spread_us"]
    assert sorted(map(tuple, got.collect())) == greedy(rows, streams, tolerance)


def test_sets_by_key(spark):
    rows = [(*m, ["x", None, "y"][m[2] % 3]) for m in messages(8)] + [(77, 0, 999, "z")]
    df = spark.createDataFrame(rows, MESSAGE + ", device string")
    got = sync.together({"a": df.where("k = 0"), "b": df.where("k = 1"), "c": df.where("k = 2")}, 100_000, by=["device"]).collect()
    for dev in ("x", "y", "z", None):
        assert sorted(tuple(g)[1:] for g in got if g["device"] == dev) == greedy([m[:3] for m in rows if m[3] == dev], 3, 100_000)
    assert sync.together({"a": df.where("k = 0"), "b": df.where("k = 9")}, 100_000).collect() == []


@pytest.mark.parametrize("by", [None, ["device"]])
def test_streamed_sets_equal_batch(spark, tmp_path, by):
    r = random.Random(6)
    rows = [(*m, "xy"[m[2] % 2]) for m in messages(6)] + [(10**10, 2, 10_000, "x"), (10**10, 2, 10_001, "y")]
    schema = MESSAGE + ", device string"
    stream = as_stream(spark, tmp_path, rows, schema, in_parts(r, rows, 50, 15_000))
    of = lambda df, k: df.where(F.col("k") == k)
    live = stateful.together({n: of(stream, k).select("device", "id", micros()) for k, n in enumerate("abc")}, 60_000, "40 milliseconds", by)
    streaming.run_once(live, str(tmp_path / "out"), str(tmp_path / "ck"))
    df = spark.createDataFrame(rows, schema)
    want = sync.together({n: of(df, k) for k, n in enumerate("abc")}, 60_000, by)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect())) != []


def test_streamed_absences_equal_batch(spark, tmp_path):
    r = random.Random(3)
    rows = [(1_000_000 + int(sum(r.expovariate(1) for _ in range(i % 90)) * 100_000), "ab"[i % 2], i) for i in range(180)] + [(700_000_000, "end", 0), (40_000_000, "late start", 1), (41_000_000, "late start", 2)]
    schema = "t bigint, topic string, msg_id bigint"
    awaited = spark.createDataFrame([(0, "a"), (500_000, "never"), (900_000_000, "b"), (39_900_000, "late start")], "t bigint, topic string").select("topic", micros())
    awaited.coalesce(1).write.parquet(str(tmp_path / "awaited"))
    expected = spark.readStream.schema("topic string, stamp timestamp").parquet(str(tmp_path / "awaited"))
    # the wait that begins far ahead would push the watermark past everything
    parts = in_parts(r, rows, 40, 100_000)
    stream = as_stream(spark, tmp_path, rows, schema, parts).select("topic", micros())
    live = stateful.absences(stream, 300_000, "200 milliseconds", expected.where("topic <> 'b'"))
    streaming.run_once(live, str(tmp_path / "out"), str(tmp_path / "ck"))
    batch = rates.absences(spark.createDataFrame(rows, schema).select("topic", micros()), 300_000, 699_800_000, awaited)
    got = sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()))
    want = sorted(map(tuple, batch.collect()))
    assert (set(got) - set(want), set(want) - set(got)) == (set(), set()) and len(got) == len(want)
    assert ("never", "absent", 500_000) in got and ("late start", "back", 40_000_000) not in got
    assert len(got) > 20


def test_absences_by_hand(spark):
    rows = spark.createDataFrame([(t, n) for n, ts in {"a": [0, 10, 25, 26], "b": [5], None: [0, 50]}.items() for t in ts], "t bigint, topic string").select("topic", micros())
    nothing = spark.createDataFrame([("c", None)], "topic string, stamp timestamp")
    got = rates.absences(rows.unionByName(nothing), 10, 36).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("a", "absent", 10), ("a", "back", 25), ("b", "absent", 5), (None, "absent", 0), (None, "back", 50)]))
    assert rates.absences(rows.where("topic = 'x'"), 10, 36).collect() == []


@pytest.mark.parametrize("depth", [1, 3])
def test_queues(spark, tmp_path, depth):
    r = random.Random(depth)
    rows = [(r.randrange(0, 5_000_000), r.choice(["a", "b", None]), i) for i in range(200)] + [(30_000_000, "end", 999)]
    schema = "t bigint, topic string, msg_id bigint"
    df = spark.createDataFrame(rows, schema).select("topic", micros(), "msg_id")
    got = {(g["topic"], g["slot"]): (g["n"], g["dropped"], g["ids"]) for g in rates.keep_last(df, depth, 1_000_000).collect()}
    want = {}
    for t, topic, i in sorted(rows, key=lambda m: (m[0], m[2])):
        want.setdefault((topic, t // 1_000_000), []).append(i)
    assert got == {k: (len(v), max(0, len(v) - depth), v[-depth:]) for k, v in want.items()}
    stream = as_stream(spark, tmp_path, rows, schema, in_parts(r, rows, 60, 150_000)).select("topic", micros(), "msg_id")
    streaming.run_once(stateful.keep_last(stream, depth, 1_000_000, "200 milliseconds"), str(tmp_path / "out"), str(tmp_path / "ck"))
    live = {(g["topic"], g["slot"]): (g["n"], g["dropped"], g["ids"]) for g in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert live == {k: v for k, v in got.items() if k[0] != "end"}


def test_order_is_restored(spark, tmp_path):
    r = random.Random(12)
    rows = [(r.randrange(0, 3_000_000), "ab"[i % 2], i, None if i % 5 else f"v{i}") for i in range(150)] + [(30_000_000, "a", 999, "x"), (30_000_000, "b", 998, None)]
    schema = "t bigint, topic string, msg_id bigint, note string"
    stream = as_stream(spark, tmp_path, rows, schema, in_parts(r, rows, 40, 90_000)).select("topic", micros(), "msg_id", "note")
    streaming.run_once(stateful.in_order(stream, "100 milliseconds", ["topic"]), str(tmp_path / "out"), str(tmp_path / "ck"))
    out = spark.read.parquet(str(tmp_path / "out")).select("topic", "place", F.unix_micros("stamp").alias("t"), "msg_id", "note").collect()
    for topic in "ab":
        want = sorted(m for m in rows if m[1] == topic and m[0] < 30_000_000)
        got = sorted((g["place"], g["t"], g["msg_id"], g["note"]) for g in out if g["topic"] == topic)
        assert got == [(i, m[0], m[2], m[3]) for i, m in enumerate(want)]


def test_streamed_keyframes_equal_batch_on_nulls(spark, tmp_path):
    schema = "device string, stamp bigint, id bigint, distance double, angle double"
    rows = [("a", 1, 1, None, None), ("a", 2, 2, 0.0, None), ("a", 3, 3, 5.0, 0.0), ("a", 4, 4, 5.0, None), ("a", 5, 5, 10.0, 0.0), (None, 1, 6, 1.0, 1.0), (None, 2, 7, 1.0, 1.0), ("b", 1, 8, None, None), ("b", 2, 9, None, 3.0)]
    for size in (2, 9):
        at = tmp_path / str(size)
        stream = as_stream(spark, at, rows, schema, [list(range(i, min(len(rows), i + size))) for i in range(0, len(rows), size)])
        streaming.run_once(streaming.keyframes(stream, 0.1, 0.1), str(at / "out"), str(at / "ck"))
        want = sorted(x["id"] for x in keyframes.select(spark.createDataFrame(rows, schema), 0.1, 0.1).collect())
        assert sorted(x["id"] for x in spark.read.parquet(str(at / "out")).collect()) == want
    assert want == [1, 2, 3, 5, 6, 8, 9]


def test_validate_names_its_artifacts(spark, tmp_path, capsys):
    assert cli.main(["validate"], spark) == 1 and "--mesh" in capsys.readouterr().err
    assert cli.main(["validate", "--force"], spark) == 1
    r = np.random.default_rng(1).random((120, 3))
    head = f"ply\nformat ascii 1.0\nelement vertex {len(r)}\nproperty float x\nproperty float y\nproperty float z\nelement face 40\nproperty list uchar int vertex_indices\nend_header\n"
    (tmp_path / "m.ply").write_text(head + "".join(" ".join(map(str, p)) + "\n" for p in r) + "".join(f"3 {k} {k + 1} {k + 2}\n" for k in range(40)))
    facet = lambda t: "facet normal 0 0 0\nouter loop\n" + "".join(f"vertex {p[0]} {p[1]} {p[2]}\n" for p in r[t : t + 3]) + "endloop\nendfacet\n"
    (tmp_path / "m.STL").write_text("solid x\n" + "".join(facet(t) for t in range(40)) + "endsolid x\n")
    for name in ("m.ply", "m.STL"):
        assert cli.main(["validate", "--mesh", str(tmp_path / name)], spark) == 0
        vertices, triangles = geometry.read_mesh(spark, str(tmp_path / name))
        assert triangles.count() == 40 and {"vid", "x", "y", "z"} <= set(vertices.columns) and {"tid", "v0", "v1", "v2"} <= set(triangles.columns)
    (tmp_path / "points.ply").write_bytes(geometry.ply_bytes([tuple(map(float, p)) for p in r]))
    assert cli.main(["validate", "--mesh", str(tmp_path / "points.ply")], spark) == 1


def in_one_trigger(spark, tmp_path, rows, live):
    """The rows, and the seconds that a stream took which reads them all at once."""
    start = time.monotonic()
    rows.write.parquet(str(tmp_path / "in"))
    streaming.run_once(live(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "ck"))
    return spark.read.parquet(str(tmp_path / "out")), time.monotonic() - start


def test_many_sets_in_one_trigger(spark, tmp_path):
    rows = spark.range(150_000).select((F.floor(F.col("id") * 7919 % 150_000 / 2) * 1000 + 1_000_000).alias("t"), (F.xxhash64("id") % 3).alias("k"), "id").unionByName(spark.createDataFrame([(10**11, 0, 999_999)], MESSAGE)).withColumn("k", F.abs("k").cast("int"))
    of = lambda df, k: df.where(F.col("k") == k)
    got, took = in_one_trigger(spark, tmp_path, rows, lambda s: stateful.together({n: of(s, k).select("id", micros()) for k, n in enumerate("abc")}, 1_000_000, "0 seconds"))
    want = sync.together({n: of(rows, k) for k, n in enumerate("abc")}, 1_000_000)
    assert got.count() > 5_000 and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert took < 60  # minutes, when each set went through all that were held


def test_sets_in_parts(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(4)
    t = np.sort(rng.integers(0, 3_000, 500))
    k, ids = rng.integers(0, 3, 500).astype("int32"), np.arange(500)
    order = np.lexsort((ids, k, t))
    rows = list(zip(t[order].tolist(), k[order].tolist(), ids[order].tolist()))
    whole, *_ = stateful._sets(t[order], k[order], ids[order], 3, 40, 10**6)
    assert sorted(map(tuple, whole.tolist())) == greedy(rows, 3, 40) != []
    at, found = 0, []
    for end in range(7, 500, 7):  # as watermarks come
        some, passed, _, _ = stateful._sets(t[order][at:end], k[order][at:end], ids[order][at:end], 3, 40, int(t[order][end]))
        at, found = at + passed, found + some.tolist()
    rest, *_ = stateful._sets(t[order][at:], k[order][at:], ids[order][at:], 3, 40, 10**6)
    assert found + rest.tolist() == whole.tolist()


def test_many_messages_without_silence(spark, tmp_path):
    rows = spark.range(800_000).select(F.lit("a").alias("topic"), (F.col("id") * 1000 + F.when(F.col("id") >= 700_000, 50_000_000).otherwise(0)).alias("t")).unionByName(spark.createDataFrame([("end", 10**11)], "topic string, t bigint"))
    got, took = in_one_trigger(spark, tmp_path, rows, lambda s: stateful.absences(s.select("topic", micros()), 2_000_000, "0 seconds"))
    assert sorted(map(tuple, got.collect())) == [("a", "absent", 699_999_000), ("a", "absent", 849_999_000), ("a", "back", 750_000_000)]
    assert took < 60  # each message moved all that came after it


def test_queues_of_a_topic_are_many_keys(spark, tmp_path):
    rows = spark.range(20_000).select(F.lit("a").alias("topic"), (F.col("id") * 50_000).alias("t"), F.col("id").alias("msg_id"))
    rows.write.parquet(str(tmp_path / "in"))
    live = stateful.keep_last(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")).select("topic", micros(), "msg_id"), 2, 1_000_000, "1 hour")
    q = live.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress) == 16  # of 1000 slots that are open
