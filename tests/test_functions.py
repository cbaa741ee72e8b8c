"""Formulas, bands, gates, parameter maps and text by hand-computed cases."""

import pytest
from pyspark.sql import functions as F

from fieldspark.functions import params, scores, text
from fieldspark.operators import gates, health, ranking, rates, sweep


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(("hz", "fps", "pct", "band"), [(0.0, 0, 100.0, "red"), (40.0, 30, 0.0, "green"), (0.0, 30, 100.0, "red"), (27.0, 30, 10.0, "yellow"), (22.5, 30, 25.0, "red"), (27.3, 30, 9.0, "green")])
def test_drop(spark, hz, fps, pct, band):
    drop = scores.drop_pct(F.lit(hz), F.lit(fps))
    assert value(spark, drop) == pytest.approx(pct)
    assert value(spark, scores.drop_band(scores.round_to(drop, 6))) == band


def test_stage1_score(spark):
    runs = spark.createDataFrame([(0, "1280x720", 30, "SENSOR_DATA", 30.0), (1, "640x480", 15, "DEFAULT", 7.5), (2, "640x480", 0, "DEFAULT", 5.0), (3, "1280x720", 30, "SENSOR_DATA", 33.0)], "seq int, resolution string, target_fps int, qos string, color_hz double")
    got = {r["seq"]: r for r in ranking.ranked(ranking.stage1_score(runs)).collect()}
    assert got[0]["score"] == 100.0 and got[3]["score"] == 100.0
    assert got[1]["score"] == pytest.approx(30 + 5 + 7.5 + 5)
    assert got[2]["score"] == pytest.approx(0 + 5 + 0 + 5) and got[2]["drop_pct"] == 100
    assert [got[k]["rank"] for k in (0, 3, 1, 2)] == [1, 2, 3, 4] and [got[k]["medal"] for k in (0, 3, 1, 2)] == ["🥇", "🥈", "🥉", "4"]
    assert ranking.best(ranking.stage1_score(runs)).first()["seq"] == 0
    doc = ranking.stage_document(ranking.stage1_score(runs)).first()
    assert doc["best"]["seq"] == 0 and [r["seq"] for r in doc["all"]] == [0, 3, 1, 2]


def test_stage2_score(spark):
    rows = [
        (0, {"Vis/MinInliers": "9"}, 30, 30.0, 5.0, 1.0, 0.0, 0.0, 0.0),
        (1, {"Rtabmap/DetectionRate": "10"}, 30, 15.0, 5.0, 0.0, 100.0, 100.0, 100.0),
        (2, {"Vis/MinInliers": "10", "Rtabmap/DetectionRate": "0"}, 30, 24.0, 0.5, 2.0, 10.0, 20.0, 2.0),
    ]
    runs = spark.createDataFrame(rows, "seq int, params map<string,string>, target_fps int, color_hz double, odom_hz double, map_hz double, cpu_cam double, cpu_slam double, db_growth_mb_min double")
    got = {r["seq"]: r for r in ranking.stage2_score(runs).collect()}
    assert got[0]["score"] == 40 + 20 + 10 + 5 and got[0]["band"] == "green"
    assert got[1]["score"] == 20 + 10 + 0 + 10 - 15 - 15 and got[1]["band"] == "yellow"
    assert got[2]["score"] == 20 + 16 + 10 + 10 - 3 - 1 and got[2]["band"] == "red" and got[2]["camera_ok"]


def test_python_round_follows_the_binary_value(spark):
    assert [r[0] for r in spark.createDataFrame([(0.25,), (0.35,), (2.675,), (None,)], "x double").select(scores.python_round("x", F.lit(1))).collect()] == [0.2, 0.3, 2.7, None]


def test_sweep_sizes(spark):
    for axes, n in ((sweep.FULL, 16), (sweep.QUICK, 5)):
        configs = sweep.one_at_a_time(sweep.axes_table(spark, axes))
        assert configs.count() == n == 1 + sum(len(o) - 1 for _, o in axes)
    full = sweep.one_at_a_time(sweep.axes_table(spark, sweep.FULL))
    assert sweep.valid(full, 4).count() == 15 and sweep.valid(full, 8).count() == 16
    assert full.orderBy("seq").first()["label"].startswith("EST=PnP(3D-2D) | ALIGN=off | DR=2")
    twice = [("a", [("A", {"k": "1"}), ("B", {"k": "1"}), ("C", {"k": "2"})])]
    assert [r["label"] for r in sweep.one_at_a_time(sweep.axes_table(spark, twice)).orderBy("seq").collect()] == ["A", "C"]


def test_cross_product_sizes(spark):
    one, two = ["rmw_fastrtps_cpp"], ["rmw_fastrtps_cpp", "rmw_cyclonedds_cpp"]
    assert [sweep.sensor_configs(spark, r, q).count() for r, q in ((one, False), (two, False), (one, True), (two, True))] == [32, 48, 3, 6]


def test_parameter_text_round_trip(spark):
    m = {"Vis/MinInliers": "10", "Grid/3D": "true", "Name": "two words"}
    df = spark.createDataFrame([(m, {"Grid/3D": "false"})], "m map<string,string>, o map<string,string>")
    assert df.select(params.from_cli(params.to_cli(F.col("m")))).first()[0] == m
    assert df.select(params.merged(F.col("m"), F.col("o"))).first()[0] == {**m, "Grid/3D": "false"}
    assert df.select(params.without(F.col("m"), ["Name"])).first()[0] == {k: v for k, v in m.items() if k != "Name"}
    assert value(spark, params.from_cli(F.lit("--a 1 --b --a 2"))) == {"b": "", "a": "2"}
    assert value(spark, params.flag(F.create_map(F.lit("x"), F.lit("False")), "x")) is False
    assert value(spark, params.value(F.create_map(F.lit("x"), F.lit("1")), "y", "5")) == "5"


def test_text(spark):
    assert value(spark, text.basename(F.lit("/a/b/c.db"))) == "c.db" and value(spark, text.dirname(F.lit("/a/b/c.db"))) == "/a/b" and value(spark, text.dirname(F.lit("c.db"))) == "."
    assert value(spark, text.without_suffix(F.lit("x.db"), ".db")) == "x" and value(spark, text.without_suffix(F.lit("xdb"), ".db")) == "xdb"
    assert value(spark, text.without_prefix(F.lit("--depth=8=9"))) == "8=9"
    assert value(spark, text.file_stamp(F.lit("2024-01-02 03:04:05").cast("timestamp"))) == "20240102_030405"


def test_log_rates(spark):
    lines = [("a", k, t) for k, t in enumerate(["start", "average rate: 5.22", "average rate: 6.30", "average rate:  7"])] + [("b", 0, "no new messages")]
    log = spark.createDataFrame(lines, "source string, line_no int, line string")
    assert {r["source"]: r["hz"] for r in rates.log_rate(log, "first").collect()} == {"a": 5.22, "b": 0.0}
    assert {r["source"]: r["hz"] for r in rates.log_rate(log, "last").collect()} == {"a": 7.0, "b": 0.0}


def test_resources(spark):
    rows = [("2024-01-01 00:00:00", 0, "cam_node", 10.0, 1024.0), ("2024-01-01 00:00:00", 1, "cam_node", 30.0, 3072.0), ("2024-01-01 00:00:01", 0, "cam_node", 20.0, 2048.0), ("2024-01-01 00:00:01", 1, "other", 99.0, 1.0)]
    s = spark.createDataFrame(rows, "ts string, proc_ord int, cmd string, cpu_pct double, rss_kb double")
    got = {k: tuple(rates.resources(s, "cam", k).first()) for k in ("mean", "first", "sum")}
    assert got == {"mean": (20.0, 2.0), "first": (15.0, 1.5), "sum": (30.0, 3.0)}
    assert tuple(rates.resources(s, "absent").first()) == (0.0, 0.0)


def test_health_and_verdicts(spark):
    expected = spark.createDataFrame([("a", "A", 15), ("b", "B", 15), ("c", "C", 1)], "topic string, label string, min_hz int")
    hz = spark.createDataFrame([("a", 15.0), ("b", 14.9)], "topic string, hz double")
    rows = health.topic_health(expected, hz)
    assert {r["topic"]: r["status"] for r in rows.collect()} == {"a": "OK", "b": "DEGRADED", "c": "MISSING"}
    assert health.pipeline_verdict(rows, "b", "c").first().asDict() == {"all_ok": False, "slam_live": True, "map_live": False, "verdict": "DEGRADED"}
    assert health.pipeline_verdict(rows, "c", "a").first()["verdict"] == "DOWN"
    assert health.pipeline_verdict(rows.where("topic = 'a'"), "a", "a").first()["verdict"] == "ALL_OK"
    assert not health.pipeline_verdict(rows.where("false"), "a", "a").first()["all_ok"]


@pytest.mark.parametrize(("length", "verdict"), [(104857, "fail"), (104858, "warn"), (5242879, "warn"), (5242880, "pass")])
def test_database_gate(spark, length, verdict):
    assert value(spark, gates.database(F.lit(True), F.lit(length), F.lit("ok"))) == verdict
    assert value(spark, gates.database(F.lit(False), F.lit(length))) == "fail"
    assert value(spark, gates.database(F.lit(True), F.lit(length), F.lit("page 3 is never used"))) == "fail"


def test_other_gates(spark):
    assert [value(spark, gates.cloud_count(F.lit(n))) for n in (99, 100, 9999, 10000)] == ["fail", "warn", "warn", "pass"]
    assert [value(spark, gates.cloud_extent(F.lit(d), F.lit(0.0), F.lit(0.05))) for d in (0.09, 0.1, 50.0, 50.1)] == ["warn", "pass", "pass", "warn"]
    assert [value(spark, gates.cloud_file(F.lit(e), F.lit(n))) for e, n in ((True, 1023), (True, 1024), (False, 9999))] == ["fail", "pass", "fail"]
    assert [value(spark, gates.mesh(F.lit(True), F.lit(2048), F.lit(v), F.lit(t))) for v, t in ((0, 1), (1, 0), (1, 1))] == ["fail", "fail", "pass"]
    v = spark.createDataFrame([("a", "pass"), ("b", "warn")], "gate string, verdict string")
    assert gates.combined(v).first().asDict() == {"ok": True, "warnings": 1}
    bad = v.unionByName(spark.createDataFrame([("c", "fail")], "gate string, verdict string"))
    assert not gates.combined(bad).first()["ok"] and gates.combined(bad, force=True).first()["ok"]
    assert [value(spark, scores.fps_gate(F.lit(x).cast("double"), F.lit(15))) for x in (None, 14.0, 15.0)] == ["fail", "warn", "pass"]


def test_inspector(spark):
    topics = {"/x/color/image_raw": 3, "/x/color/image_raw/compressed": 14, "/x/imu": 14, "/y/imu": 15, "/z/compressed": 15, "/w/imu": 0}
    df = spark.createDataFrame(list(topics.items()), "t string, f int")
    got = {r["t"]: r["s"] for r in df.select("t", scores.inspector_status(F.col("t"), F.col("f")).alias("s")).collect()}
    assert list(got.values()) == ["INFO", "BAD", "DEGRADED", "OK", "OK", "INACTIVE"]
    assert [value(spark, scores.usb_kind(F.lit(x))) for x in ("bcdUSB 2.1", "3.20", "none")] == ["USB 2", "USB 3", "Unknown"]


def test_zero_rows(spark):
    configs, runs = spark.createDataFrame([(1,), (2,)], "seq int"), spark.createDataFrame([(1, 3.0, 5.0)], "seq int, color_hz double, drop_pct double")
    got = {r["seq"]: (r["color_hz"], r["drop_pct"]) for r in health.with_defaults(configs, runs, "seq", ["color_hz"]).collect()}
    assert got == {1: (3.0, 5.0), 2: (0.0, 100.0)}
