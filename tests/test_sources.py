"""Readers, writers, frames and streams on small files made here."""

import json
import sqlite3
import struct
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark import cli, schemas, streaming
from fieldspark.functions import frames
from fieldspark.operators import gates, keyframes, mesh, ranking, spatial, sync
from fieldspark.plans import report
from fieldspark.session import ready
from fieldspark.sources import config, database, geometry, synthetic, tables


@pytest.fixture(autouse=True)
def _ready(spark):
    ready(spark)


@pytest.mark.parametrize("ascii_", [False, True])
def test_ply(spark, tmp_path, ascii_):
    spark.dataSource.register(geometry.PlySource)
    points = [(0.0, 1.5, -2.0), (3.25, 4.0, 5.0)]
    (tmp_path / "c.ply").write_bytes(geometry.ply_bytes(points, [(0, 51, 255), (1, 2, 3)], ascii_))
    rows = spark.read.format("ply").load(str(tmp_path / "c.ply")).orderBy("pid").collect()
    assert [(r["x"], r["y"], r["z"]) for r in rows] == points and rows[0]["g"] == pytest.approx(0.2) and rows[0]["nx"] is None


def test_ply_faces_and_pcd(spark, tmp_path):
    spark.dataSource.register(geometry.PlySource)
    (tmp_path / "m.ply").write_text("ply\nformat ascii 1.0\nelement vertex 4\nproperty float x\nproperty float y\nproperty float z\nelement face 2\nproperty list uchar int vertex_indices\nend_header\n0 0 0\n1 0 0\n1 1 0\n0 1 0\n4 0 1 2 3\n3 0 1 3\n")
    rows = spark.read.format("ply").option("element", "face").load(str(tmp_path / "m.ply")).orderBy("tid").collect()
    assert [tuple(r)[2:] for r in rows] == [(0, 1, 2), (0, 2, 3), (0, 1, 3)]
    head = "# .PCD v0.7\nVERSION 0.7\nFIELDS x y z rgb\nSIZE 4 4 4 4\nTYPE F F F U\nCOUNT 1 1 1 1\nWIDTH 2\nHEIGHT 1\nPOINTS 2\n"
    (tmp_path / "a.pcd").write_text(head + "DATA ascii\n1 2 3 16711680\n4 5 6 255\n")
    (tmp_path / "b.pcd").write_bytes((head + "DATA binary\n").encode() + struct.pack("<fffI", 1, 2, 3, 0xFF0000) + struct.pack("<fffI", 4, 5, 6, 0xFF))
    for name in ("a", "b"):
        got = spark.read.format("ply").load(str(tmp_path / f"{name}.pcd")).orderBy("pid").collect()
        assert [(r["x"], r["z"], r["r"], r["b"]) for r in got] == [(1.0, 3.0, 1.0, 0.0), (4.0, 6.0, 0.0, 1.0)]


def test_obj_round_trip(spark, tmp_path):
    v = spark.createDataFrame([(0, 0.0, 0.0, 0.0), (1, 1.0, 0.0, 0.0), (2, 1.0, 1.0, 0.0), (3, 0.0, 1.0, 0.0)], "vid bigint, x double, y double, z double")
    t = spark.createDataFrame([(0, 0, 1, 2), (1, 0, 2, 3)], schemas.TRIANGLE)
    geometry.write_obj(v, t, str(tmp_path / "deep" / "m.obj"))
    v2, t2 = geometry.read_obj(spark, str(next((tmp_path / "deep" / "m.obj").glob("part-*"))))
    assert v2.orderBy("vid").collect() == v.collect() and t2.orderBy("tid").collect() == t.collect()
    (tmp_path / "quad.obj").write_text("# made\nv 0 0 0\nv 1 0 0\nv 1 1 0\nv 0 1 0\nf 1/1 2/2 3/3 4/4\n")
    assert [tuple(r) for r in geometry.read_obj(spark, str(tmp_path / "quad.obj"))[1].orderBy("tid").collect()] == [(0, 0, 1, 2), (1, 0, 2, 3)]


def test_database_gate(spark, tmp_path):
    with sqlite3.connect(tmp_path / "a.db") as db:
        db.execute("CREATE TABLE NodeData(id INTEGER PRIMARY KEY)")
        db.execute("INSERT INTO NodeData VALUES (1)")
    (tmp_path / "b.db").write_bytes(b"no database" * 100)
    paths = spark.createDataFrame([(str(tmp_path / n),) for n in ("a.db", "b.db", "c.db")], "path string")
    got = {r["path"][-4:]: r["integrity"] for r in database.integrity(paths).collect()}
    assert got["a.db"] == "ok" and got["b.db"] != "ok" and got["c.db"].startswith("error")
    found = tables.artifacts(spark, str(tmp_path), "*.db").withColumn("path", F.regexp_replace("path", "^file:", ""))
    expected = paths.withColumn("kind", F.lit("db"))
    rows = tables.expected_artifacts(expected, found).join(database.integrity(paths), "path")
    assert {r["v"] for r in rows.select(gates.database(F.col("exists"), F.col("length"), F.col("integrity")).alias("v")).collect()} == {"fail"}


@pytest.mark.parametrize("kind", range(5))
@pytest.mark.parametrize("dtype", [np.uint8, np.uint16])
def test_png_filters(kind, dtype):
    r = np.random.default_rng(kind)
    image = r.integers(0, np.iinfo(dtype).max, (7, 9)).astype(dtype)
    assert np.array_equal(frames.decode_png(frames.encode_png(image, [kind, 0, kind])), image)


def test_depth_frames(spark):
    image = np.full((10, 10), 1000, np.uint16)
    png = frames.encode_png(image)
    rows = [(0, b"\0" * 12 + png), (1, b"\xe2\x82\xac" + png), (2, b"\0" * 12 + b"junk"), (3, png[:45])]
    got = {r["i"]: r["f"] for r in spark.createDataFrame([(i, bytearray(d)) for i, d in rows], "i int, d binary").select("i", frames.decode_depth("d").alias("f")).collect()}
    for i in (0, 1):
        assert (got[i]["width"], got[i]["height"], got[i]["encoding"]) == (10, 10, "16UC1") and np.frombuffer(got[i]["data"], "<u2").tolist() == [1000] * 100
    assert got[2]["error"] and got[3]["error"] and got[2]["data"] is None
    assert frames.payload(b"x" * 12 + b"rest") == b"rest"


def test_stage_documents_and_report(spark, tmp_path):
    rows = [(0, "fast", "UDP", "640x480", 30, "SENSOR_DATA", 30.0, 29.0, 0.0, 5.0, 100.0, 0.0)]
    runs = ranking.stage1_score(spark.createDataFrame(rows, schemas.STAGE1_RUN)).select(*[x.split()[0] for x in schemas.STAGE1_RUN.split(", ")])
    tables.write_stage_json(ranking.stage_document(runs), str(tmp_path / "stage"))
    path = next((tmp_path / "stage").glob("part-*"))
    assert json.loads(path.read_text())["best"]["rmw"] == "fast"
    assert tables.stage_json(spark, str(path), schemas.STAGE1_RUN).first()["all"][0]["score"] == runs.first()["score"]
    out = report.write(str(tmp_path / "r.md"), "Report", [("Stage 1", report.RUN, ranking.ranked(runs), "rank")])
    assert "|1|fast|UDP|640x480|30|SENSOR_DATA|30.0|29.0|0.0|5.0|100.0|" in open(out, encoding="utf-8").read()


def test_config(spark, tmp_path):
    (tmp_path / "t.yaml").write_text("camera:\n  depth_topic: /d\nmapper:\n  frame_id: base\n")
    tree = config.load_config(str(tmp_path / "none.yaml"), str(tmp_path / "t.yaml"))
    assert tree["camera"]["depth_topic"] == "/d" and config.load_config(str(tmp_path / "none.yaml")) == {}
    assert config.config_table(spark, tree).count() == 2 and config.system_info(spark).first()["nproc"] > 0 and config.disk_free(spark).first()["free_mb"] > 0


def test_logs(spark, tmp_path):
    (tmp_path / "a.log").write_text("x\naverage rate: 3.5  \n")
    lines = [f"line {k} {'y' * (k % 90)}" for k in range(4000)]
    (tmp_path / "b.log").write_text("\n".join(lines))
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = tables.log_lines(spark, str(tmp_path)).orderBy("source", "line_no").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    assert [(r["line_no"], r["line"]) for r in got[:2]] == [(0, "x"), (1, "average rate: 3.5")]
    assert [(r["line_no"], r["line"]) for r in got[2:]] == list(enumerate(x.rstrip() for x in lines))


def test_sync_boundary(spark):
    left = spark.createDataFrame([(1, 1_000_000), (2, 10_000_000)], "id bigint, t bigint")
    right = spark.createDataFrame([(7, 1_151_000), (8, 1_150_000), (9, 9_849_999), (10, 10_000_000), (11, 10_000_000)], "id bigint, t bigint")
    assert {r["id"]: (r["right_id"], r["dt_us"]) for r in sync.nearest(left, right, 150_000).collect()} == {1: (8, 150_000), 2: (10, 0)}
    assert {r["id"]: r["right_id"] for r in sync.latest(left, right, 150_000).collect()} == {2: 11}


def test_geometry_by_numpy(spark):
    r = np.random.default_rng(5)
    xyz = r.normal(0, 1, (150, 3))
    xyz[149] = (40, 40, 40)
    p = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(xyz)], "pid bigint, x double, y double, z double")
    d2 = ((xyz[:, None] - xyz[None]) ** 2).sum(-1)
    got = {}
    for row in spatial.knn(p, p, 5, 0.2).collect():
        got.setdefault(row["q"], []).append((row["rank"], row["n"]))
    assert {q: [n for _, n in sorted(v)] for q, v in got.items()} == {q: np.argsort(d2[q], kind="stable")[:5].tolist() for q in range(150)}
    mean = np.sqrt(np.sort(d2, 1)[:, :20]).mean(1)
    keep = set(np.flatnonzero(mean <= mean.mean() + 2 * mean.std(ddof=1)).tolist())
    assert {x["pid"] for x in spatial.statistical_outliers(p, 20, 2.0, 0.5).collect()} == keep and 149 not in keep
    assert spatial.voxel_downsample(p, 0.5).agg(F.sum("n")).first()[0] == 150
    plane = spark.createDataFrame([(i, float(i % 10) / 20, float(i // 10) / 20, 1.0) for i in range(100)], "pid bigint, x double, y double, z double")
    for row in spatial.normals(plane, 0.1, 30).collect():
        assert (row["nx"], row["ny"], row["nz"]) == pytest.approx((0, 0, -1), abs=1e-6)


def test_mesh(spark):
    v = spark.createDataFrame([(i, float(x), float(y), 0.0, float(i), None, None) for i, (x, y) in enumerate([(0, 0), (1, 0), (0, 1), (1, 1)])], "vid bigint, x double, y double, z double, density double, nx double, r double")
    t = spark.createDataFrame([(0, 0, 1, 2), (1, 1, 3, 2)], schemas.TRIANGLE)
    assert all((n["nx"], n["ny"], n["nz"]) == (0, 0, 1) for n in mesh.vertex_normals(v, t).collect())
    kept, left = mesh.trim(v, t, 0.05)
    assert kept.count() == 3 and [r["tid"] for r in left.collect()] == [1]
    assert mesh.info(v, t).first().asDict() == {"n_vertices": 4, "has_normals": False, "has_colors": False, "n_triangles": 2}


def test_keyframes_batch_and_stream(spark, tmp_path):
    r = np.random.default_rng(2)
    rows = [(int(r.integers(0, 3)), i, i, float(d), float(a)) for i, (d, a) in enumerate(zip(np.cumsum(r.normal(0, 0.06, 200)), np.cumsum(r.normal(0, 0.06, 200))))]
    schema = "device bigint, stamp bigint, id bigint, distance double, angle double"
    want, last = [], {}
    for dev, _, i, d, a in rows:
        if dev not in last or abs(d - last[dev][0]) >= 0.1 or abs(a - last[dev][1]) >= 0.1:
            last[dev] = (d, a)
            want.append(i)
    poses = spark.createDataFrame(rows, schema)
    assert sorted(x["id"] for x in keyframes.select(poses, 0.1, 0.1).collect()) == want
    for k in range(2):
        poses.where(f"id div 100 = {k}").coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    streaming.run_once(streaming.keyframes(stream, 0.1, 0.1), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(x["id"] for x in spark.read.parquet(str(tmp_path / "out")).collect()) == want


def test_stream_join_and_throttle(spark, tmp_path):
    rows = [(k, f"2024-01-01 00:00:{k // 10:02d}.{k % 10}") for k in range(100)]
    spark.createDataFrame(rows, "id int, s string").select("id", F.lit("t").alias("topic"), F.col("s").cast("timestamp").alias("stamp")).coalesce(1).write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema("id int, topic string, stamp timestamp").parquet(str(tmp_path / "in"))
    a = read().select(F.col("id").alias("a"), F.col("stamp").alias("l_stamp"))
    b = read().select(F.col("id").alias("b"), F.col("stamp").alias("r_stamp"))
    streaming.run_once(streaming.interval_join(a, b, 150_000, "1 second"), str(tmp_path / "j"), str(tmp_path / "cj"))
    assert spark.read.parquet(str(tmp_path / "j")).count() == 100 + 2 * 99
    streaming.run_once(streaming.throttle(read(), "2 seconds", "1 second"), str(tmp_path / "t"), str(tmp_path / "ct"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_sync_by_key_against_all_pairs(spark):
    r = np.random.default_rng(7)
    left = [(i, int(t), int(k)) for i, (t, k) in enumerate(zip(r.integers(0, 4000, 150), r.integers(0, 3, 150)))]
    right = [(1000 + i, int(t), int(k)) for i, (t, k) in enumerate(zip(r.integers(0, 4000, 200), r.integers(0, 3, 200)))]
    a, b = (spark.createDataFrame(x, "id bigint, t bigint, k bigint") for x in (left, right))
    near, before = {}, {}
    for i, t, k in left:
        pairs = [(abs(t - u), j) for j, u, m in right if m == k and abs(t - u) <= 60]
        past = [(u, j) for j, u, m in right if m == k and 0 <= t - u <= 60]
        if pairs:
            near[i] = min(pairs)[::-1]
        if past:
            before[i] = (max(past)[1], t - max(past)[0])
    assert {x["id"]: (x["right_id"], x["dt_us"]) for x in sync.nearest(a, b, 60, ["k"]).collect()} == near
    assert {x["id"]: (x["right_id"], x["dt_us"]) for x in sync.latest(a, b, 60, ["k"]).collect()} == before


def test_rows_without_a_device_are_one(spark):
    rows = [(None, k, k, 0.0, 0.0) for k in range(5)] + [(7, k, 10 + k, 0.0, 0.0) for k in range(5)] + [(None, 9, 20, 1.0, 0.0), ((1 << 60) + 1, 1, 21, None, 0.0), ((1 << 60) + 1, 2, 22, 0.5, 0.0), ((1 << 60) + 1, 3, 23, None, None)]
    got = keyframes.select(spark.createDataFrame(rows, "device bigint, stamp bigint, id bigint, distance double, angle double"), 0.1, 0.1).collect()
    assert sorted((x["device"] or 0, x["id"]) for x in got) == [(0, 0), (0, 20), (7, 10), ((1 << 60) + 1, 21), ((1 << 60) + 1, 22)]


def test_dense_clouds_make_few_pairs(spark):
    r = np.random.default_rng(8)
    xyz = np.concatenate([r.random((1500, 3)) * 0.02, r.random((50, 3)) * 5, np.zeros((30, 3))])
    p = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(xyz)], "pid bigint, x double, y double, z double")
    d2 = ((xyz[:, None] - xyz[None]) ** 2).sum(-1)
    edge = spatial._edge_for(p, 4, 1.0)
    assert edge < 0.02 and spatial._near(p, p, edge).count() < 0.3 * len(xyz) ** 2
    got = spatial.radius_neighbours(p, p, 0.01, 4).collect()
    want = {(i, int(j)) for i in range(len(xyz)) for j in np.lexsort((np.arange(len(xyz)), d2[i]))[:4] if d2[i, j] <= 0.01**2}
    assert {(x["q"], x["n"]) for x in got} == want


@pytest.mark.parametrize("values", [[3.0], [1.0, 1.0, 1.0, 2.0], list(range(5000)), [0.0] * 6000 + [1e9, -1e9], [float(x * x % 7919) for x in range(20000)]])
def test_quantile(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    for q in (0.0, 0.05, 0.5, 0.999, 1.0):
        assert spatial.quantile(df, "v", q) == pytest.approx(float(np.quantile(np.array(values, float), q)), rel=1e-12)
    assert spatial.quantile(df.where("v > 1e300"), "v", 0.5) is None and spatial.quantile_trim(df.where("v > 1e300"), "v").count() == 0


def test_stl_round_trip(spark, tmp_path):
    v = spark.createDataFrame([(0, 0.0, 0.0, 0.0), (1, 1.0, 0.0, 0.0), (2, 1.0, 1.0, 0.0), (3, 0.0, 1.0, 0.0)], "vid bigint, x double, y double, z double")
    t = spark.createDataFrame([(0, 0, 1, 2), (1, 0, 2, 3)], schemas.TRIANGLE)
    geometry.write_stl(v, t, str(tmp_path / "m"))
    facets = [(0, 0, 0, 1, 0, 0, 1, 1, 0), (0, 0, 0, 1, 1, 0, 0, 1, 0)]
    (tmp_path / "b.stl").write_bytes(b" " * 80 + struct.pack("<I", 2) + b"".join(struct.pack("<12fH", 0, 0, 1, *f, 0) for f in facets))
    for path in (next((tmp_path / "m").glob("part-*")), tmp_path / "b.stl"):
        v2, t2 = geometry.read_stl(spark, str(path))
        at = {r["vid"]: (r["x"], r["y"], r["z"]) for r in v2.collect()}
        assert len(at) == 4 and [sum((at[r[c]] for c in ("v0", "v1", "v2")), ()) for r in t2.orderBy("tid").collect()] == facets


def test_empty_cloud_is_an_error(spark, tmp_path):
    spark.dataSource.register(geometry.PlySource)
    (tmp_path / "e.ply").write_bytes(geometry.ply_bytes([]))
    with pytest.raises(ValueError, match="no points"):
        geometry.load_cloud(spark, str(tmp_path / "e.ply"))


def test_jpeg_to_rgb(spark, tmp_path):
    jvm = spark.sparkContext._jvm
    image = jvm.java.awt.image.BufferedImage(8, 8, 1)
    for x in range(8):
        for y in range(8):
            image.setRGB(x, y, 0xC82814)
    jvm.javax.imageio.ImageIO.write(image, "jpeg", jvm.java.io.File(str(tmp_path / "a.jpg")))
    (tmp_path / "b.jpg").write_bytes(b"no image")
    (row,) = tables.images(spark, str(tmp_path)).collect()
    assert (row["width"], row["height"]) == (8, 8) and np.abs(np.frombuffer(row["rgb"], np.uint8).reshape(-1, 3).astype(int) - (200, 40, 20)).max() <= 6


def test_gates_by_command_line(spark, tmp_path, capsys):
    r = np.random.default_rng(9)
    (tmp_path / "c.ply").write_bytes(geometry.ply_bytes([tuple(map(float, x)) for x in r.random((200, 3))], [(1, 2, 3)] * 200))
    (tmp_path / "m.obj").write_text("v 0 0 0\n" * 200 + "f 1 2 3\n")
    good = ["validate", "--ply", str(tmp_path / "c.ply"), "--mesh", str(tmp_path / "m.obj")]
    assert cli.main(good, spark) == 0
    assert [x.split()[0] for x in capsys.readouterr().out.splitlines()] == ["[PASS", "[WARN", "[PASS", "[PASS", "[PASS"]
    missing = [*good, "--db", str(tmp_path / "none.db")]
    assert cli.main(missing, spark) == 1 and capsys.readouterr().out.splitlines()[1].startswith("[SKIPPED")
    assert cli.main([*missing, "--force"], spark) == 0
    assert cli.main(["report", "--stage1", str(tmp_path / "none.json"), "--out", str(tmp_path / "r.md")], spark) == 1
    row = "{\"seq\": 1, \"rmw\": \"fast\", \"drop_pct\": 3.0, \"score\": 2.5}"
    (tmp_path / "s.json").write_text(f"{{\"best\": {row}, \"all\": [{row}]}}")
    assert cli.main(["report", "--stage1", str(tmp_path / "s.json"), "--out", str(tmp_path / "r.md")], spark) == 0
    assert "|1|fast|-|" in (tmp_path / "r.md").read_text()


def test_streams_of_frames_and_first_messages(spark, tmp_path):
    rows = [(0, bytearray(b"\0" * 12 + frames.encode_png(np.full((4, 6), 9, np.uint16)))), (1, bytearray(b"junk"))]
    spark.createDataFrame(rows, "msg_id bigint, data binary").coalesce(1).write.parquet(str(tmp_path / "in"))
    (tmp_path / "empty").mkdir()
    read = lambda name: spark.readStream.schema("msg_id bigint, data binary").parquet(str(tmp_path / name))
    streaming.decode_frames(read("in"), str(tmp_path / "frames"), str(tmp_path / "errors"), str(tmp_path / "c1"))
    (ok,) = spark.read.parquet(str(tmp_path / "frames")).collect()
    (bad,) = spark.read.parquet(str(tmp_path / "errors")).collect()
    assert (ok["msg_id"], ok["width"], ok["height"], ok["encoding"]) == (0, 6, 4, "16UC1") and bad["msg_id"] == 1 and bad["error"]
    assert streaming.wait_for_message(read("in"), str(tmp_path / "c2"), 60) and not streaming.wait_for_message(read("empty"), str(tmp_path / "c3"), 2)


def test_camera_stream(spark, tmp_path):
    q = synthetic.camera_stream(spark, 50, loss=0.2).writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        q.processAllAvailable()
        for _ in range(60):
            if any((tmp_path / "o").glob("*.parquet")) and spark.read.parquet(str(tmp_path / "o")).count():
                break
            time.sleep(0.5)
    finally:
        q.stop()
    got = spark.read.parquet(str(tmp_path / "o"))
    n, last = got.agg(F.count("*"), F.max("msg_id")).first()
    assert 0 < n <= last + 1


def test_moves_copies_and_probes(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "staged"))
    spark.range(9).write.parquet(str(tmp_path / "deep" / "final"))
    tables.move_in(spark, str(tmp_path / "staged"), str(tmp_path / "deep" / "final"))
    assert spark.read.parquet(str(tmp_path / "deep" / "final")).count() == 3 and not (tmp_path / "staged").exists()
    assert tables.copy_if_possible(spark, str(tmp_path / "deep"), str(tmp_path / "copy")) and not tables.copy_if_possible(spark, str(tmp_path / "none"), str(tmp_path / "copy"))
    assert config.capable(["python", "--help"], "usage") and not config.capable(["python", "--help"], "no such word") and not config.capable(["no-such-command-here"], "x")
    with pytest.raises(FileNotFoundError):
        config.required_file(None, "a stage")
