"""Queries over the driver's tables and the DuckDB SQL that gives the same rows.

The tables stand in for recordings: events are messages (event_type the topic), embeddings' first three numbers are points,
aggregates of line items and orders are runs.  Floating results are rounded to six digits by the same plain formula on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark import schemas
from fieldspark.functions import frames, params, scores, text
from fieldspark.operators import attitude, gates, health, hull, keyframes, mesh, occupancy, orientation, ranking, rates, spatial, sweep, sync
from fieldspark.plans import report
from fieldspark.session import ready, scratch
from fieldspark.sources import database, synthetic, tables
from fieldspark.sources.tables import table

MONTH_S = 30 * 86400.0
# topic, label, least messages a day
EXPECTED = [("view", "camera", 66), ("click", "depth", 66), ("error", "info", 67), ("purchase", "imu", 100), ("signup", "odometry", 2), ("heartbeat", "map", 1)]


def r6(c: Column) -> Column:
    return scores.round_to(c, 6)


def sql6(x: str) -> str:
    return f"floor(({x}) * 1000000.0 + 0.5) / 1000000.0"


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").alias("msg_id"), F.col("event_type").alias("topic"), F.col("ts").alias("stamp"), "user_id", "value", "props")


def points(spark: SparkSession, d: str) -> DataFrame:
    xyz = [F.col("embedding")[k].cast("double").alias(a) for k, a in enumerate("xyz")]
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("pid"), *xyz, "label")


POINTS = "(SELECT vec_id AS pid, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, label FROM embeddings)"
VALUES = "(VALUES " + ", ".join(f"('{t}', '{n}', {m})" for t, n, m in EXPECTED) + ") AS e(topic, label, min_hz)"


def topic_counts(spark, d):
    return rates.counts(events(spark, d))


def topic_rate(spark, d):
    return rates.fixed_window_rate(events(spark, d), MONTH_S).select("topic", scores.round_to(F.col("hz"), 9).alias("hz"))


def topic_interarrival_rate(spark, d):
    return rates.interarrival_rate(events(spark, d)).select("topic", scores.round_to(F.col("hz"), 9).alias("hz"))


def topic_last_value(spark, d):
    return rates.last_value(events(spark, d), ["props", "msg_id"])


def _health(spark, d):
    daily = rates.fixed_window_rate(events(spark, d), 30.0)
    return health.topic_health(spark.createDataFrame(EXPECTED, "topic string, label string, min_hz int"), daily)


def topic_health(spark, d):
    return _health(spark, d).withColumn("measured_hz", r6(F.col("measured_hz")))


def pipeline_verdict(spark, d):
    return health.pipeline_verdict(_health(spark, d), odometry="signup", mapping="heartbeat")


HEALTH_SQL = f"""SELECT e.topic, e.label, e.min_hz::INT AS min_hz, coalesce(r.hz, 0.0) AS measured_hz,
 CASE WHEN coalesce(r.hz, 0) >= e.min_hz THEN 'OK' WHEN coalesce(r.hz, 0) > 0 THEN 'DEGRADED' ELSE 'MISSING' END AS status
 FROM {VALUES} LEFT JOIN (SELECT event_type AS topic, count(*) / 30.0::DOUBLE AS hz FROM events GROUP BY 1) r USING (topic)"""


def inspector_status(spark, d):
    name = F.concat(F.lit("/camera/"), F.when(F.col("topic") == "view", "color/image_raw").when(F.col("topic") == "click", "color/image_raw/compressed").when(F.col("topic") == "error", "depth/compressed").otherwise(F.col("topic")))
    hz = rates.fixed_window_rate(events(spark, d), 30.0).select(name.alias("topic"), (F.col("hz") / 4.47).alias("fps"))
    return hz.select("topic", r6(F.col("fps")).alias("fps"), scores.inspector_status(F.col("topic"), F.col("fps")).alias("status"))


def daily_drop_bands(spark, d):
    daily = rates.tumbling(events(spark, d), "1 day")
    pct = scores.drop_pct(F.col("n").cast("double"), F.lit(70))
    return daily.select(F.unix_micros("start").alias("start_us"), "topic", "n", r6(pct).alias("drop_pct"), scores.drop_band(pct).alias("band"))


def _stage1_runs(spark, d):
    line = table(spark, d, "lineitem").groupBy("l_returnflag", "l_linenumber").agg(F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("dc"), F.sum("l_tax").alias("tx"), F.count("*").alias("n"))
    c, k = F.col, F.col("l_linenumber")
    return line.select(
        (F.ascii("l_returnflag") * 10 + k).cast("int").alias("seq"), F.concat(F.lit("rmw_"), F.lower("l_returnflag")).alias("rmw"), F.when(k % 2 == 0, "SHM").otherwise("UDP").alias("shm"),
        F.when(k % 3 == 0, "1280x720").otherwise("640x480").alias("resolution"), F.when(k > 5, 15).otherwise(30).cast("int").alias("target_fps"), F.when(k % 2 == 1, "SENSOR_DATA").otherwise("DEFAULT").alias("qos"),
        scores.round_to(c("q"), 2).alias("color_hz"), scores.round_to(c("q") / 2.0, 2).alias("depth_hz"), scores.round_to(c("dc") * 100.0, 1).alias("cpu_pct"), (c("n") / 8.0).alias("ram_mb"),
    )


STAGE1_RUNS = """(SELECT (ascii(l_returnflag) * 10 + l_linenumber)::INT AS seq, 'rmw_' || lower(l_returnflag) AS rmw, CASE WHEN l_linenumber % 2 = 0 THEN 'SHM' ELSE 'UDP' END AS shm,
 CASE WHEN l_linenumber % 3 = 0 THEN '1280x720' ELSE '640x480' END AS resolution, CASE WHEN l_linenumber > 5 THEN 15 ELSE 30 END AS target_fps,
 CASE WHEN l_linenumber % 2 = 1 THEN 'SENSOR_DATA' ELSE 'DEFAULT' END AS qos, floor(avg(l_quantity) * 100.0 + 0.5) / 100.0 AS color_hz, floor(avg(l_quantity) / 2.0 * 100.0 + 0.5) / 100.0 AS depth_hz,
 floor(avg(l_discount) * 100.0 * 10.0 + 0.5) / 10.0 AS cpu_pct, count(*) / 8.0::DOUBLE AS ram_mb FROM lineitem GROUP BY l_returnflag, l_linenumber)"""
STAGE1_SQL = f"""SELECT *, floor((fps_score + quality_score + qos_score) * 10.0 + 0.5) / 10.0 AS score FROM (SELECT *,
 greatest(0.0, (target_fps - color_hz) / target_fps * 100.0) AS drop_pct, least(1.0, color_hz / target_fps) * 60.0 AS fps_score,
 split_part(resolution, 'x', 1)::INT * split_part(resolution, 'x', 2)::INT / 921600.0::DOUBLE * 15.0 + target_fps / 30.0::DOUBLE * 15.0 AS quality_score,
 CASE WHEN qos = 'SENSOR_DATA' THEN 10.0 ELSE 5.0 END AS qos_score FROM {STAGE1_RUNS})"""
STAGE1_OUT = "seq, rmw, shm, resolution, target_fps, qos, color_hz, depth_hz, cpu_pct, ram_mb, " + ", ".join(f"{sql6(c)} AS {c}" for c in ("drop_pct", "fps_score", "quality_score")) + ", qos_score::DOUBLE AS qos_score, score"


def _stage1(spark, d):
    return ranking.stage1_score(_stage1_runs(spark, d))


def _stage1_out(df: DataFrame, *more: str) -> DataFrame:
    return df.select("seq", "rmw", "shm", "resolution", "target_fps", "qos", "color_hz", "depth_hz", "cpu_pct", "ram_mb", *[r6(F.col(c)).alias(c) for c in ("drop_pct", "fps_score", "quality_score")], "qos_score", "score", *more)


def stage1_score(spark, d):
    return _stage1_out(_stage1(spark, d))


def run_ranking(spark, d):
    return ranking.ranked(_stage1(spark, d)).select("seq", "score", "rank", "medal")


def best_run(spark, d):
    return _stage1_out(ranking.best(_stage1(spark, d)))


def _stage2_runs(spark, d):
    o = table(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.avg("o_totalprice").alias("p"), F.count("*").alias("n"))
    k = F.substring("o_orderpriority", 1, 1).cast("int")
    rate = F.when(k == 2, F.create_map(F.lit("Rtabmap/DetectionRate"), F.lit("2"))).when(k == 3, F.create_map(F.lit("Rtabmap/DetectionRate"), F.lit("10"))).otherwise(F.create_map().cast("map<string,string>"))
    inliers = F.when(k % 2 == 1, F.create_map(F.lit("Vis/MinInliers"), (k + 5).cast("string"))).otherwise(F.create_map().cast("map<string,string>"))
    p = scores.round_to(F.col("p") / 10000.0, 3)
    return o.select((F.ascii("o_orderstatus") * 10 + k).cast("int").alias("seq"), F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("label"), F.map_concat(rate, inliers).alias("params"), F.lit(30).alias("target_fps"), p.alias("color_hz"), (p / k).alias("odom_hz"), F.when(k == 4, 0.0).otherwise(1.0).alias("map_hz"), (p * 2).alias("cpu_cam"), (p * k).alias("cpu_slam"), (F.col("n") / 100.0).alias("db_growth_mb_min"))


STAGE2_SQL = f"""WITH base AS (SELECT o_orderstatus AS s, o_orderpriority AS q, floor(avg(o_totalprice) / 10000.0 * 1000.0 + 0.5) / 1000.0 AS p, count(*) AS n, left(o_orderpriority, 1)::INT AS k FROM orders GROUP BY 1, 2),
 runs AS (SELECT (ascii(s) * 10 + k)::INT AS seq, s || '/' || q AS label, CASE k WHEN 2 THEN 2 WHEN 3 THEN 10 END AS dr, CASE WHEN k % 2 = 1 THEN k + 5 END AS inl,
 p AS color_hz, p / k AS odom_hz, CASE WHEN k = 4 THEN 0.0 ELSE 1.0 END AS map_hz, p * 2 AS cpu_cam, p * k AS cpu_slam, n / 100.0::DOUBLE AS growth FROM base),
 parts AS (SELECT *, color_hz >= 30 * 0.8 AS camera_ok, odom_hz >= 1.0 AS slam_ok, least(1.0, odom_hz / greatest(coalesce(dr, 5), 1)) * 40.0 AS odom_score, least(1.0, color_hz / 30) * 20.0 AS color_score,
 CASE WHEN map_hz > 0 THEN 10.0 ELSE 0.0 END AS map_score, least(15.0, (cpu_cam + cpu_slam) * 0.1) AS cpu_penalty, least(15.0, growth * 0.5) AS io_penalty, CASE WHEN coalesce(inl, 10) >= 10 THEN 10.0 ELSE 5.0 END AS inlier_bonus FROM runs)
 SELECT seq, label, camera_ok, slam_ok, {sql6("odom_score")} AS odom_score, {sql6("color_score")} AS color_score, map_score::DOUBLE AS map_score, {sql6("cpu_penalty")} AS cpu_penalty, {sql6("io_penalty")} AS io_penalty,
 inlier_bonus::DOUBLE AS inlier_bonus, floor((odom_score + color_score + map_score + inlier_bonus - cpu_penalty - io_penalty) * 10.0 + 0.5) / 10.0 AS score,
 CASE WHEN camera_ok AND slam_ok THEN 'green' WHEN slam_ok THEN 'yellow' ELSE 'red' END AS band FROM parts"""


def stage2_score(spark, d):
    s = ranking.stage2_score(_stage2_runs(spark, d))
    return s.select("seq", "label", "camera_ok", "slam_ok", r6(F.col("odom_score")).alias("odom_score"), r6(F.col("color_score")).alias("color_score"), "map_score", r6(F.col("cpu_penalty")).alias("cpu_penalty"), r6(F.col("io_penalty")).alias("io_penalty"), "inlier_bonus", "score", "band")


def config_cross_product(spark, d):
    """Every combination of sensor settings with the middlewares that the line items' flags name."""
    flag = F.when(F.col("l_returnflag") == "A", "rmw_fastrtps_cpp").otherwise(F.concat(F.lit("rmw_"), F.lower("l_returnflag")))
    names = table(spark, d, "lineitem").select(flag.alias("rmw")).distinct()
    return sweep.sensor_configs(spark, names.select((F.row_number().over(Window.orderBy("rmw")) - 1).alias("o1"), "rmw"))


CROSS_SQL = """SELECT row_number() OVER (ORDER BY o1, shm DESC, o2, o3, o4) - 1 AS seq, rmw, shm, width, height, fps, qos, compressed
 FROM (SELECT row_number() OVER (ORDER BY rmw) AS o1, rmw FROM (SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 'rmw_fastrtps_cpp' ELSE 'rmw_' || lower(l_returnflag) END AS rmw FROM lineitem)) a,
 (VALUES (true), (false)) s(shm),
 (VALUES (0, 640, 480, 15), (1, 640, 480, 30), (2, 1280, 720, 15), (3, 1280, 720, 30)) b(o2, width, height, fps),
 (VALUES (0, 'SENSOR_DATA'), (1, 'DEFAULT')) c(o3, qos), (VALUES (0, false), (1, true)) e(o4, compressed) WHERE shm OR rmw = 'rmw_fastrtps_cpp'"""
# axis, table, column, prefix of labels, parameter
SWEEP_AXES = [("status", "orders", "o_orderstatus", "ST", "order/Status"), ("priority", "orders", "o_orderpriority", "PR", "order/Priority"), ("threads", "lineitem", "l_linenumber", "TH", "Vis/CornerNbThreads"), ("kind", "part", "p_type", "KIND", "part/Type")]


def _sweep(spark, d):
    axes = [sweep.options(table(spark, d, t), c, axis, k, prefix, key) for k, (axis, t, c, prefix, key) in enumerate(SWEEP_AXES)]
    out = axes[0]
    for a in axes[1:]:
        out = out.unionByName(a)
    return sweep.one_at_a_time(out)


def _sweep_out(df: DataFrame) -> DataFrame:
    return df.select("seq", "label", params.canonical(F.col("params")).alias("params"))


def oat_sweep(spark, d):
    """One axis at a time over the values that the tables' columns have."""
    return _sweep_out(_sweep(spark, d))


def sweep_valid(spark, d):
    return _sweep_out(sweep.valid(_sweep(spark, d), nproc=4))


def _axes_sql() -> str:
    return "(" + " UNION ALL ".join(f"SELECT {a} AS a, row_number() OVER (ORDER BY v) - 1 AS o, '{p}=' || v AS label, '{key}' AS k, v FROM (SELECT DISTINCT {c}::VARCHAR AS v FROM {t} WHERE {c} IS NOT NULL)" for a, (_, t, c, p, key) in enumerate(SWEEP_AXES)) + ")"


OAT_SQL = f"""WITH x AS (SELECT * FROM {_axes_sql()}), variants AS (SELECT DISTINCT a AS va, o AS vo FROM x WHERE o > 0 UNION ALL SELECT -1, 0),
 chosen AS (SELECT va, vo, x.* FROM variants, x WHERE x.o = CASE WHEN x.a = va THEN vo ELSE 0 END)
 SELECT row_number() OVER (ORDER BY va, vo) - 1 AS seq, label, params, threads FROM (SELECT va, vo, (SELECT string_agg(l, ' | ' ORDER BY a) FROM (SELECT DISTINCT a, label AS l FROM chosen c2 WHERE c2.va = c.va AND c2.vo = c.vo)) AS label,
 string_agg(k || '=' || v, ';' ORDER BY k) AS params, max(CASE WHEN k = 'Vis/CornerNbThreads' THEN v::INT END) AS threads FROM chosen c GROUP BY va, vo)"""
BASE = {"Vis/MinDepth": "0.3", "Vis/MaxDepth": "8.0", "Vis/Robust": "true", "approx_sync": "true"}


def params_to_cli(spark, d):
    """Each message's parameters over the base: half of the messages give a greatest depth of their own."""
    own = F.create_map(F.lit("Vis/MinInliers"), (F.col("msg_id") % 13).cast("string"), F.lit("topic"), F.col("topic"))
    over = F.when(F.col("msg_id") % 2 == 0, F.map_concat(own, F.create_map(F.lit("Vis/MaxDepth"), (F.col("user_id") % 10).cast("string")))).otherwise(own)
    merged = sweep.with_base(events(spark, d).select("msg_id", over.alias("params")), BASE)
    return merged.select("msg_id", params.to_cli(params.without(F.col("params"), ["approx_sync"])).alias("cli"))


def cli_to_params(spark, d):
    """A command line made of each message, taken apart again."""
    text = F.concat(F.lit("--Vis/MinInliers "), (F.col("msg_id") % 13).cast("string"), F.lit(" --note seen by "), F.col("user_id").cast("string"), F.lit(" --topic "), F.col("topic"))
    return events(spark, d).select("msg_id", F.explode(params.from_cli(text))).select("msg_id", F.col("key").alias("k"), F.col("value").alias("v"))


def _urgent(spark, d):
    return table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))


def missing_required(spark, d):
    return health.missing(table(spark, d, "customer").select("c_custkey"), _urgent(spark, d), "c_custkey")


def present_required(spark, d):
    return health.present(table(spark, d, "customer").select("c_custkey"), _urgent(spark, d), "c_custkey")


def best_broadcast_runs(spark, d):
    best = ranking.best(_stage1(spark, d)).select(F.col("seq").alias("best_seq"), "resolution", "target_fps")
    return _sweep(spark, d).join(F.broadcast(best)).select("seq", "label", "best_seq", "resolution", "target_fps")  # one row of best


def _log(spark, d):
    line = F.when(F.col("msg_id") % 3 == 0, F.concat(F.lit("average rate: "), F.format_string("%.3f", "value"))).otherwise(F.concat(F.lit("no new messages "), F.col("msg_id")))
    return events(spark, d).select(F.col("topic").alias("source"), F.col("msg_id").alias("line_no"), line.alias("line"))


def first_rate_line(spark, d):
    return rates.log_rate(_log(spark, d), "first")


def last_rate_line(spark, d):
    return rates.log_rate(_log(spark, d), "last")


def _rate_sql(f: str) -> str:
    return f"""SELECT source, coalesce({f}(rate, line_no), 0.0) AS hz FROM (SELECT event_type AS source, event_id AS line_no, nullif(regexp_extract(CASE WHEN event_id % 3 = 0 THEN 'average rate: ' || printf('%.3f', value) ELSE 'no new messages ' || event_id END, 'average rate:\\s*([0-9.]+)', 1), '')::DOUBLE AS rate FROM events) WHERE rate IS NOT NULL GROUP BY 1"""


def resource_mean(spark, d):
    samples = events(spark, d).select(F.col("stamp").alias("ts"), F.col("msg_id").cast("int").alias("proc_ord"), F.concat(F.lit("/opt/bin/"), F.col("topic"), F.lit("_node")).alias("cmd"), F.col("value").alias("cpu_pct"), (F.col("user_id") * 1024.0).alias("rss_kb"))
    parts = [rates.resources(samples, n).select(F.lit(n).alias("name"), r6(F.col("cpu_pct")).alias("cpu_pct"), r6(F.col("ram_mb")).alias("ram_mb")) for n in ("view", "purchase_node", "absent")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def growth_rate(spark, d):
    files = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("path"), (F.col("n_chars") * 1000).alias("length"))
    return rates.growth(files, 5.0).select("path", r6(F.col("mb")).alias("mb"), r6(F.col("mb_per_min")).alias("mb_per_min"))


def gate_verdicts(spark, d):
    """Gates of each label's part of the cloud, each source's documents as database and cloud files, and meshes of every third point."""
    cloud = points(spark, d).groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("x") > 0.25).alias("colored"), *[(F.max(a) - F.min(a)).alias(f"d{a}") for a in "xyz"], F.count_if(F.col("pid") % 3 == 0).alias("triangles"))
    docs = table(spark, d, "documents").groupBy(F.coalesce("source", F.lit("none")).alias("source")).agg(F.sum("n_chars").alias("length"), F.count("*").alias("n"))
    whole, exists = F.when(F.col("n") % 3 == 0, F.lit("row 3 missing")).when(F.col("n") % 3 == 1, F.lit("ok")), F.col("n") % 5 != 0
    one = lambda df, key, name, verdict: df.select(F.concat_ws("/", F.lit(name), F.col(key).cast("string")).alias("gate"), verdict.alias("verdict"))
    rows = [
        one(docs, "source", "database", gates.database(exists, F.col("length") * 10, F.coalesce(whole, F.lit("ok")))),
        one(docs, "source", "cloud_file", gates.cloud_file(exists, F.col("length") % 2000)),
        one(cloud, "label", "cloud_count", gates.cloud_count(F.col("n") * (F.col("label") + 1) * 10)),
        one(cloud, "label", "cloud_colors", gates.cloud_colors(F.col("colored"))),
        one(cloud, "label", "cloud_extent", gates.cloud_extent(F.col("dx") * (F.col("label") * 10), F.col("dy"), F.col("dz") * F.col("label"))),
        one(cloud, "label", "mesh", gates.mesh(F.col("label") != 2, F.col("n") * 100, F.col("n"), F.when(F.col("label") == 4, F.col("triangles") * 0).otherwise(F.col("triangles")))),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    total = gates.combined(out).select(F.lit("combined").alias("gate"), F.when(F.col("ok"), "pass").otherwise("fail").alias("verdict"))
    return out.unionByName(total)


GATE_ROWS = f"""WITH c AS (SELECT label, count(*) AS n, count(*) FILTER (x > 0.25) AS colored, max(x) - min(x) AS dx, max(y) - min(y) AS dy, max(z) - min(z) AS dz, count(*) FILTER (pid % 3 = 0) AS tri FROM {POINTS} GROUP BY label),
 t AS (SELECT coalesce(source, 'none') AS source, sum(n_chars) AS len, count(*) AS n FROM documents GROUP BY 1),
 g AS (SELECT 'database/' || source AS gate, CASE WHEN n % 5 = 0 THEN 'fail' WHEN len * 10 / 1048576.0::DOUBLE < 0.1 THEN 'fail' WHEN n % 3 = 0 THEN 'fail' WHEN len * 10 / 1048576.0::DOUBLE < 5.0 THEN 'warn' ELSE 'pass' END AS verdict FROM t
 UNION ALL SELECT 'cloud_file/' || source, CASE WHEN n % 5 = 0 OR len % 2000 / 1024.0::DOUBLE < 1 THEN 'fail' ELSE 'pass' END FROM t
 UNION ALL SELECT 'cloud_count/' || label, CASE WHEN n * (label + 1) * 10 < 100 THEN 'fail' WHEN n * (label + 1) * 10 < 10000 THEN 'warn' ELSE 'pass' END FROM c
 UNION ALL SELECT 'cloud_colors/' || label, CASE WHEN colored > 0 THEN 'pass' ELSE 'warn' END FROM c
 UNION ALL SELECT 'cloud_extent/' || label, CASE WHEN greatest(dx * (label * 10), dy, dz * label) > 50 OR greatest(dx * (label * 10), dy, dz * label) < 0.1 THEN 'warn' ELSE 'pass' END FROM c
 UNION ALL SELECT 'mesh/' || label, CASE WHEN label = 2 OR n * 100 / 1024.0::DOUBLE < 1 OR n = 0 OR label = 4 OR tri = 0 THEN 'fail' ELSE 'pass' END FROM c)"""
GATES_SQL = f"""{GATE_ROWS}
 SELECT * FROM g UNION ALL SELECT 'combined', CASE WHEN bool_and(verdict <> 'fail') THEN 'pass' ELSE 'fail' END FROM g"""


def gate_sequence(spark, d):
    """The gates in order of their names, first stopping at a failure and then forced on."""
    steps = gate_verdicts(spark, d).where(F.col("gate").startswith("cloud")).withColumn("ord", F.row_number().over(Window.orderBy("gate")))
    return gates.sequence(steps).select("gate", "verdict", "outcome").join(gates.sequence(steps, force=True).select("gate", F.col("outcome").alias("forced")), "gate")


def _stream(spark, d, topic: str) -> DataFrame:
    return events(spark, d).where(F.col("topic") == topic).select(F.col("msg_id").alias("id"), F.unix_micros("stamp").alias("t"))


HALF_HOUR = 1800 * 1_000_000


def approx_sync(spark, d):
    return sync.nearest(_stream(spark, d, "purchase"), _stream(spark, d, "view"), HALF_HOUR)


def asof_sync(spark, d):
    return sync.latest(_stream(spark, d, "purchase"), _stream(spark, d, "view"), HALF_HOUR)


STREAMS = "WITH p AS (SELECT event_id AS id, epoch_us(ts) AS t FROM events WHERE event_type = 'purchase'), v AS (SELECT event_id AS id, epoch_us(ts) AS t FROM events WHERE event_type = 'view')"


SETS = ("view", "click", "purchase")


def synced_sets(spark, d):
    """One view, click and purchase each that lie within half an hour: three streams at once."""
    return sync.together({n: _stream(spark, d, n) for n in SETS}, HALF_HOUR)


def _ended(spark, d, end: str, kind: str) -> DataFrame:
    """The file of events as a stream, and a message at the end, which lets the watermark pass the others."""
    from fieldspark import streaming

    at, seen = scratch(spark, "end"), spark.read.parquet(f"{d}/events.parquet")
    seen.limit(1).withColumn("ts", F.lit(end).cast(seen.schema["ts"].dataType)).withColumn("event_type", F.lit(kind)).write.parquet(at)
    stream = streaming.messages(spark, d, seen.schema, "ts", "events.parquet")
    last = spark.readStream.schema(seen.schema).parquet(at).withColumn("ts", F.col("ts").cast("timestamp"))
    return stream.unionByName(last).select(F.col("event_id").alias("msg_id"), F.col("event_type").alias("topic"), F.col("ts").alias("stamp"), "user_id", "value")


def _ran(spark, stream: DataFrame, name: str) -> DataFrame:
    from fieldspark import streaming

    base = scratch(spark, name)
    streaming.run_once(stream, f"{base}/out", f"{base}/ck")
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def stream_sets(spark, d):
    """The same sets, found by a stream that holds what the watermark hasn't passed."""
    from fieldspark.streaming import stateful

    ready(spark)
    seen = _ended(spark, d, "2030-01-01 00:00:00", "view")
    streams = {n: seen.where(F.col("topic") == n).select(F.col("msg_id").alias("id"), "stamp") for n in SETS}
    return _ran(spark, stateful.together(streams, HALF_HOUR, "0 seconds"), "sets")


SETS_SQL = f"""WITH RECURSIVE m AS (SELECT list_position(['view', 'click', 'purchase'], event_type) AS k, epoch_us(ts) AS t, event_id AS id FROM events WHERE event_type IN ('view', 'click', 'purchase')),
 o AS (SELECT *, row_number() OVER (ORDER BY t, k, id) AS pos FROM m),
 n AS (SELECT pos, t, min(CASE WHEN k = 1 THEN pos END) OVER w AS p1, min(CASE WHEN k = 2 THEN pos END) OVER w AS p2, min(CASE WHEN k = 3 THEN pos END) OVER w AS p3 FROM o WINDOW w AS (ORDER BY pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 g AS MATERIALIZED (SELECT n.pos, l.pos AS last, l.t - n.t AS spread, p1, p2, p3 FROM n JOIN o l ON l.pos = greatest(p1, p2, p3) WHERE p1 IS NOT NULL AND p2 IS NOT NULL AND p3 IS NOT NULL AND l.t - n.t <= {HALF_HOUR}),
 c AS (SELECT i.pos, arg_min(e.pos, row(e.spread, e.pos)) AS best FROM g i JOIN g e ON e.pos BETWEEN i.pos AND i.last GROUP BY 1),
 x AS MATERIALIZED (SELECT a.pos, a.best, f.pos AS following FROM (SELECT c.pos, c.best, b.last + 1 AS after FROM c JOIN g b ON b.pos = c.best) a ASOF LEFT JOIN g f ON a.after <= f.pos),
 r AS (SELECT pos, best, following FROM x WHERE pos = (SELECT min(pos) FROM x) UNION ALL SELECT x.pos, x.best, x.following FROM r JOIN x ON x.pos = r.following)
 SELECT v.id AS view_id, k.id AS click_id, u.id AS purchase_id, spread AS spread_us FROM r JOIN g ON g.pos = r.best JOIN o v ON v.pos = p1 JOIN o k ON k.pos = p2 JOIN o u ON u.pos = p3"""
QUIET, WATCH, CLOSE = 5_400_000_000, "2023-12-31 00:00:00", "2024-02-03 00:00:00"


def _awaited(spark) -> DataFrame:
    return spark.createDataFrame([(t,) for t, _, _ in EXPECTED], "topic string").withColumn("stamp", F.lit(WATCH).cast("timestamp"))


def topic_absences(spark, d):
    """Silences of more than an hour and a half, and topics that never come."""
    end = spark.range(1).select(F.unix_micros(F.lit(CLOSE).cast("timestamp"))).first()[0]
    return rates.absences(events(spark, d), QUIET, end, _awaited(spark))


def stream_absences(spark, d):
    """The same, by timers of a stream."""
    from fieldspark.streaming import stateful

    ready(spark)
    at = scratch(spark, "awaited")
    _awaited(spark).write.parquet(at)
    awaited = spark.readStream.schema("topic string, stamp timestamp").parquet(at)
    return _ran(spark, stateful.absences(_ended(spark, d, CLOSE, "end"), QUIET, "0 seconds", awaited), "absences")


ABSENCES_SQL = f"""WITH s AS (SELECT event_type AS topic, epoch_us(ts) AS t FROM events), a AS (SELECT * FROM s UNION ALL SELECT e.topic, epoch_us(TIMESTAMP '{WATCH}') FROM {VALUES} WHERE epoch_us(TIMESTAMP '{WATCH}') < coalesce((SELECT min(t) FROM s WHERE s.topic = e.topic), 9e18::BIGINT)),
 g AS (SELECT topic, t, lag(t) OVER w AS before, coalesce(lead(t) OVER w, epoch_us(TIMESTAMP '{CLOSE}')) AS following FROM a WINDOW w AS (PARTITION BY topic ORDER BY t))
 SELECT topic, 'absent' AS kind, t AS at_us FROM g WHERE following - t > {QUIET} UNION ALL SELECT topic, 'back', t FROM g WHERE t - before > {QUIET}"""
HOUR = 3_600_000_000


def _joined_ids(df: DataFrame) -> DataFrame:
    return df.withColumn("ids", F.array_join(F.transform("ids", lambda x: x.cast("string")), ","))


def queue_drops(spark, d):
    """Queues of three messages, emptied every hour."""
    return _joined_ids(rates.keep_last(events(spark, d), 3, HOUR))


def stream_queue_drops(spark, d):
    """The same, by a stream."""
    from fieldspark.streaming import stateful

    ready(spark)
    return _joined_ids(_ran(spark, stateful.keep_last(_ended(spark, d, "2030-01-01 00:00:00", "end"), 3, HOUR, "0 seconds"), "queues"))


QUEUE_SQL = f"""SELECT topic, slot, n, greatest(n - 3, 0) AS dropped, array_to_string(list_transform(ids[greatest(n - 2, 1):], lambda x: x::VARCHAR), ',') AS ids
 FROM (SELECT event_type AS topic, epoch_us(ts) // {HOUR} AS slot, count(*) AS n, list(event_id ORDER BY ts, event_id) AS ids FROM events GROUP BY 1, 2)"""


def throttle_first(spark, d):
    return rates.throttle(events(spark, d), 3_600_000_000).select("topic", "msg_id", F.unix_micros("stamp").alias("stamp_us"))


def tumbling_rate(spark, d):
    return rates.tumbling(events(spark, d), "1 day").select(F.unix_micros("start").alias("start_us"), "topic", "n")


TUMBLING_SQL = "SELECT epoch_us(date_trunc('day', ts)) AS start_us, event_type AS topic, count(*) AS n FROM events GROUP BY 1, 2"


def cloud_bbox(spark, d):
    return spatial.bbox(points(spark, d)).select("n", *[r6(F.col(c)).alias(c) for c in ("min_x", "max_x", "min_y", "max_y", "min_z", "max_z", "dx", "dy", "dz", "max_extent")])


def voxel_downsample(spark, d):
    return spatial.voxel_downsample(points(spark, d), 0.1).select("cx", "cy", "cz", "n", *[r6(F.col(a)).alias(a) for a in "xyz"])


PAIRS = f"(SELECT a.pid AS q, b.pid AS n, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) AS d2 FROM {POINTS} a, {POINTS} b)"
KNN20 = f"(SELECT q AS pid, avg(sqrt(d2)) AS mean_d FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d2, n) AS k FROM {PAIRS}) WHERE k <= 20 GROUP BY q)"


def knn_mean_distance(spark, d):
    return spatial.mean_distance(points(spark, d), 20, 0.1).select("pid", r6(F.col("mean_d")).alias("mean_d"))


def outlier_filter(spark, d):
    return spatial.statistical_outliers(points(spark, d), 20, 2.0, 0.1).select("pid")


def radius_neighbours(spark, d):
    p = points(spark, d)
    return spatial.radius_neighbours(p, p, 0.1, 30).select("q", "n", r6(F.col("d2")).alias("d2"), "rank")


def quantile_trim(spark, d):
    return spatial.quantile_trim(points(spark, d), "x", 0.05).select("pid")


def crop_bbox(spark, d):
    p = points(spark, d)
    return spatial.crop(p, spatial.bbox(p.where(F.col("label") == 3))).select("pid")


def nn_label_transfer(spark, d):
    p = points(spark, d)
    return spatial.transfer(p.where(F.col("pid") % 2 == 1), p.where(F.col("pid") % 2 == 0), ["label"], 0.1)


def _triangles(spark, d):
    return points(spark, d).where(F.col("pid") % 3 == 0).select(F.col("pid").alias("tid"), F.col("pid").alias("v0"), (F.col("pid") + 1).alias("v1"), (F.col("pid") + 2).alias("v2"))


def _vertices(spark, d):
    return points(spark, d).withColumnRenamed("pid", "vid")


def triangle_cleanup(spark, d):
    kept = spatial.quantile_trim(_vertices(spark, d), "x", 0.05)
    return mesh.with_vertices(_triangles(spark, d), kept)


def normals(spark, d):
    return spatial.normals(points(spark, d), radius=0.2, most=30)


def mesh_vertex_normals(spark, d):
    n = mesh.vertex_normals(_vertices(spark, d), _triangles(spark, d))
    return n.select("vid", *[r6(F.col(c)).alias(c) for c in ("nx", "ny", "nz")])


def keyframe_rows(spark, d):
    poses = events(spark, d).select(F.col("user_id").alias("device"), F.unix_micros("stamp").alias("stamp"), F.col("msg_id").alias("id"), (F.col("value") / 100).alias("distance"), (F.col("msg_id") % 7 / 100).alias("angle"))
    return keyframes.select(poses, 0.1, 0.1)


def json_round_trip(spark, d):
    parsed = F.from_json("props", "map<string,string>")
    return events(spark, d).select("msg_id", parsed["k"].cast("int").alias("k"), F.to_json(F.from_json("props", "k int")).alias("document"))


def stage_document(spark, d):
    """The runs as a stage's document: written, read back without the process handle, and taken apart again."""
    runs = _stage1_out(_stage1(spark, d)).withColumn("handle", F.lit("process 17"))
    path = scratch(spark, "stage")
    tables.write_stage_json(tables.without_handles(ranking.stage_document(runs), ["handle"]), path)
    schema = schemas.stage_document(", ".join(f"{c} {t}" for c, t in runs.drop("handle").dtypes) + ", handle string")
    back = tables.read_document(spark, path, schema)
    return back.select(F.col("best.seq").alias("best_seq"), F.posexplode("all").alias("place", "r")).select("best_seq", "place", "r.seq", "r.rmw", "r.score", F.col("r.handle").isNull().alias("without_handle"))


def report_rows(spark, d):
    return report.lines(ranking.ranked(_stage1(spark, d)), report.RUN, "rank")


def _cells(*cells: str) -> str:
    return "'|' || " + " || '|' || ".join(f"coalesce({c}, '-')" for c in cells) + " || '|'"


def _fixed(x: str, digits: int = 1) -> str:
    return f"printf('%.{digits}f', floor({x} * {10.0**digits} + 0.5) / {10.0**digits})"


REPORT_SQL = f"SELECT rank, {_cells('rank::VARCHAR', 'rmw', 'shm', 'resolution', 'target_fps::VARCHAR', 'qos', _fixed('color_hz'), _fixed('depth_hz'), _fixed('drop_pct'), _fixed('cpu_pct'), _fixed('ram_mb'), _fixed('score'))} AS line FROM (SELECT *, row_number() OVER (ORDER BY score DESC, seq) AS rank FROM ({STAGE1_SQL}))"


def slam_report_rows(spark, d):
    s = ranking.ranked(ranking.stage2_score(_stage2_runs(spark, d)))
    return report.lines(s, {"rank": "%s", "label": "%s", "odom_hz": "%.2f", "slam_ok": "%s", "camera_ok": "%s", "score": "%.1f"}, "rank")


def sensor_report_rows(spark, d):
    """The runs as the sensor stage reports them: every other one sent compressed frames."""
    runs = _stage1(spark, d).withColumns({"shm_status": F.col("shm"), "format": F.when(F.col("seq") % 2 == 0, "compressed").otherwise("raw"), "measured_fps": F.col("color_hz")})
    return report.lines(ranking.ranked(runs), report.SENSOR, "rank")


def diagnostic_report_rows(spark, d):
    return report.lines(_health(spark, d), report.DIAGNOSTIC, "topic")


def inspector_report_rows(spark, d):
    return report.lines(inspector_status(spark, d), report.INSPECTOR, "topic")


def status_line_rows(spark, d):
    return report.status_lines(_health(spark, d), "label", F.col("status"), "topic")


def zero_runs(spark, d):
    """Every customer's run by its first orders; those without one count as measured at 0."""
    runs = table(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT").groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.count("*") / 3.0).alias("hz"), F.lit(0.0).alias("drop_pct"))
    out = health.with_defaults(table(spark, d, "customer").select("c_custkey"), runs, "c_custkey", ["hz"])
    return out.select("c_custkey", r6(F.col("hz")).alias("hz"), "drop_pct", scores.fps_gate(F.when(F.col("hz") > 0, F.col("hz")), F.lit(1.0)).alias("gate"))


def usb_kinds(spark, d):
    text = F.concat(F.lit("bcdUSB "), (F.col("o_orderkey") % 4).cast("string"), F.lit("."), (F.col("o_orderkey") % 3).cast("string"))
    return table(spark, d, "orders").select(scores.usb_kind(text).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


def path_parts(spark, d):
    path = F.concat(F.lit("/data/"), F.coalesce("source", F.lit("none")), F.lit("/"), F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, ".ply").otherwise(".pcd"))
    docs = table(spark, d, "documents").select("doc_id", path.alias("path"))
    return docs.select("doc_id", text.basename(F.col("path")).alias("name"), text.dirname(F.col("path")).alias("folder"), text.without_suffix(F.col("path"), ".ply").alias("stem"), text.without_prefix(F.concat(F.lit("mesh:="), F.col("path"))).alias("arg"))


def stamps(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", text.file_stamp(F.col("o_orderdate")).alias("file"), text.human_stamp(F.col("o_orderdate")).alias("human"))


def parameter_flags(spark, d):
    m = F.create_map(F.lit("n"), F.col("msg_id") % 3, F.lit("user"), F.col("user_id"))
    named = F.map_concat(params.stringified(m), F.create_map(F.lit("on"), F.when(F.col("msg_id") % 4 == 0, "TRUE").when(F.col("msg_id") % 4 == 1, "true").otherwise("1")))
    return events(spark, d).select("msg_id", params.canonical(named).alias("text"), params.flag(named, "on").alias("is_on"), params.flag(named, "absent").alias("is_absent"), scores.round_to(F.col("value"), 0).cast("bigint").alias("whole"))


def run_progress(spark, d):
    return rates.progress(_stage1_runs(spark, d)).select("seq", "progress")


def replay_schedule(spark, d):
    return rates.replay(events(spark, d), 0.5).select("msg_id", r6(F.col("play_s")).alias("play_s"))


def first_message_wait(spark, d):
    start = F.lit("2024-01-05 00:00:00").cast("timestamp")
    return rates.first_message_wait(events(spark, d), start, 900.0).select("topic", r6(F.col("wait_s")).alias("wait_s"), "arrived")


def message_gaps(spark, d):
    return rates.gaps(events(spark, d)).select("msg_id", r6(F.col("gap_s")).alias("gap_s"))


def rate_and_cpu(spark, d):
    samples = events(spark, d).select(F.col("stamp").alias("ts"), F.col("msg_id").cast("int").alias("proc_ord"), F.concat(F.col("topic"), F.lit("_node")).alias("cmd"), F.col("value").alias("cpu_pct"), F.col("user_id").cast("double").alias("rss_kb"))
    return rates.rate_and_cpu(events(spark, d), samples, "click", MONTH_S).select("topic", scores.round_to(F.col("hz"), 9).alias("hz"), r6(F.col("cpu_pct")).alias("cpu_pct"))


def scaled_cloud(spark, d):
    return spatial.scaled(points(spark, d), 0.001).select("pid", *[scores.round_to(F.col(a), 9).alias(a) for a in "xyz"])


def occupancy_points(spark, d):
    """What the occupancy grid sees: points in range with enough neighbours, in cells."""
    near = spatial.radius_outliers(spatial.range_filter(points(spark, d), 0.05, 0.45), 0.1, 2)
    return spatial.voxel_downsample(near, 0.05).select("cx", "cy", "cz", "n")


def oriented_normals(spark, d):
    """The cloud with its next three numbers as normals, turned the same way along the spanning tree."""
    n = [F.col("embedding")[3 + k].cast("double").alias(f"n{a}") for k, a in enumerate("xyz")]
    cloud = table(spark, d, "embeddings").select(F.col("vec_id").alias("pid"), *[F.col("embedding")[k].cast("double").alias(a) for k, a in enumerate("xyz")], *n)
    return orientation.consistent(cloud, k=10, edge=0.1).select("pid", *[r6(F.col(c)).alias(c) for c in ("nx", "ny", "nz")])


# the spanning tree as Kruskal builds it: one step for each edge in order, with the part and sign of every point in lists
ORIENTED_SQL = f"""WITH RECURSIVE p AS (SELECT *, sqrt(nx * nx + ny * ny + nz * nz) AS l, row_number() OVER (ORDER BY pid) AS i FROM (SELECT vec_id AS pid, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, embedding[4]::DOUBLE AS nx, embedding[5]::DOUBLE AS ny, embedding[6]::DOUBLE AS nz FROM embeddings)),
 near AS (SELECT DISTINCT least(q, n) AS u, greatest(q, n) AS v FROM (SELECT a.pid AS q, b.pid AS n, row_number() OVER (PARTITION BY a.pid ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), b.pid) AS k FROM p a, p b) WHERE k <= 11 AND q <> n),
 w AS (SELECT a.i AS ui, b.i AS vi, u, v, a.nx * b.nx + a.ny * b.ny + a.nz * b.nz AS dot, a.l * b.l AS ll FROM near JOIN p a ON a.pid = u JOIN p b ON b.pid = v),
 e AS MATERIALIZED (SELECT ui, vi, CASE WHEN dot < 0 THEN -1 ELSE 1 END AS s, row_number() OVER (ORDER BY 1.0 - abs(dot) / ll, u, v) AS k FROM w),
 r AS (SELECT 0::BIGINT AS k, (SELECT list(i ORDER BY i) FROM p) AS lab, (SELECT list(1 ORDER BY i) FROM p) AS sg
 UNION ALL SELECT e.k, CASE WHEN lab[ui] = lab[vi] THEN lab ELSE list_transform(lab, lambda x: CASE WHEN x = lab[vi] THEN lab[ui] ELSE x END) END,
 CASE WHEN lab[ui] = lab[vi] THEN sg ELSE list_transform(range(1, len(lab) + 1), lambda j: CASE WHEN lab[j] = lab[vi] THEN sg[j] * sg[ui] * s * sg[vi] ELSE sg[j] END) END FROM r JOIN e ON e.k = r.k + 1),
 o AS (SELECT p.*, lab[i] AS part, sg[i] AS s FROM p, (SELECT lab, sg FROM r ORDER BY k DESC LIMIT 1)),
 t AS (SELECT *, first_value(s * nz) OVER w AS tz, first_value(s * ny) OVER w AS ty, first_value(s * nx) OVER w AS tx FROM o WINDOW w AS (PARTITION BY part ORDER BY z DESC, pid)),
 f AS (SELECT pid, s * CASE WHEN tz < 0 OR tz = 0 AND (ty < 0 OR ty = 0 AND tx < 0) THEN -1 ELSE 1 END AS turn, nx, ny, nz FROM t)
 SELECT pid, {sql6("nx * turn")} AS nx, {sql6("ny * turn")} AS ny, {sql6("nz * turn")} AS nz FROM f"""


def occupancy_grid(spark, d):
    """Each label's points as a scan from a place of its own, followed through the cells."""
    rays = points(spark, d).select(F.col("label").alias("scan"), (F.col("label") / 50.0).alias("ox"), F.lit(0.01).alias("oy"), F.lit(-0.02).alias("oz"), *"xyz")
    return occupancy.grid(rays, 0.05, 0.05, 0.45).withColumn("log_odds", r6(F.col("log_odds")))


def _axis_sql(a: str) -> str:
    low, high = f"floor(o{a} / 0.05::DOUBLE)::BIGINT", f"floor((o{a} + d{a} * stop) / 0.05::DOUBLE)::BIGINT"
    return f"list_transform(range(least({low}, {high}) + 1, greatest({low}, {high}) + 1), lambda i: (i * 0.05::DOUBLE - o{a}) / d{a})"


GRID_SQL = f"""WITH p AS (SELECT *, x - ox AS dx, y - oy AS dy, z - oz AS dz FROM (SELECT pid, label AS scan, label / 50.0::DOUBLE AS ox, 0.01::DOUBLE AS oy, -0.02::DOUBLE AS oz, x, y, z FROM {POINTS})),
 l AS (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS len FROM p WHERE sqrt(dx * dx + dy * dy + dz * dz) >= 0.05::DOUBLE),
 s AS (SELECT *, CASE WHEN len > 0.45::DOUBLE THEN 0.45::DOUBLE / len ELSE 1.0::DOUBLE END AS stop FROM l),
 t AS (SELECT *, list_sort(list_distinct(list_concat([0.0::DOUBLE, stop], list_filter(list_concat({_axis_sql("x")}, {_axis_sql("y")}, {_axis_sql("z")}), lambda t: t > 0 AND t < stop)))) AS ts FROM s),
 m AS (SELECT *, unnest(list_transform(range(1, len(ts)), lambda j: (ts[j + 1] + ts[j]) / 2.0::DOUBLE)) AS t FROM t),
 c AS (SELECT scan, floor((ox + dx * t) / 0.05::DOUBLE)::BIGINT AS cx, floor((oy + dy * t) / 0.05::DOUBLE)::BIGINT AS cy, floor((oz + dz * t) / 0.05::DOUBLE)::BIGINT AS cz, 0 AS hit FROM m
 UNION ALL SELECT scan, floor(x / 0.05::DOUBLE)::BIGINT, floor(y / 0.05::DOUBLE)::BIGINT, floor(z / 0.05::DOUBLE)::BIGINT, 1 FROM l WHERE len <= 0.45::DOUBLE),
 g AS (SELECT cx, cy, cz, sum(hit)::BIGINT AS hits, sum(1 - hit)::BIGINT AS misses FROM (SELECT scan, cx, cy, cz, max(hit) AS hit FROM c GROUP BY ALL) GROUP BY ALL),
 o AS (SELECT *, greatest({occupancy.log_odds(occupancy.LEAST)!r}::DOUBLE, least({occupancy.log_odds(occupancy.MOST)!r}::DOUBLE, hits * {occupancy.log_odds(occupancy.HIT)!r}::DOUBLE + misses * {occupancy.log_odds(occupancy.MISS)!r}::DOUBLE)) AS odds FROM g)
 SELECT cx, cy, cz, hits, misses, {sql6("odds")} AS log_odds, odds > 0 AS occupied FROM o"""


def mesh_info(spark, d):
    v = _vertices(spark, d).select("vid", F.when(F.col("label") == 1, F.col("x")).alias("nx"), F.lit(None).cast("double").alias("r"))
    return mesh.info(v, _triangles(spark, d))


def synthetic_loss(spark, d):
    """The recording over a link that loses a tenth and delays up to four milliseconds: what was sent, what came, and the drop."""
    sent = rates.counts(events(spark, d)).withColumnRenamed("n", "sent")
    came = synthetic.lossy(events(spark, d), 0.1, 4000, seed=3).groupBy("topic").agg(F.count("*").alias("n"), F.sum(F.unix_micros("stamp") % 86_400_000_000).alias("stamps"))
    return sent.join(came, "topic").select("topic", "sent", "n", "stamps", r6(scores.drop_pct(F.col("n").cast("double"), F.col("sent"))).alias("drop_pct"))


def recorded_topics(spark, d):
    """The stream of messages recorded by topic, and the record read back."""
    from fieldspark import streaming

    base = scratch(spark, "record")
    stream = streaming.messages(spark, d, spark.read.parquet(f"{d}/events.parquet").schema, "ts", "events.parquet")
    streaming.record(stream, f"{base}/out", f"{base}/ck", topic="event_type")
    return spark.read.parquet(f"{base}/out").groupBy(F.col("event_type").cast("string").alias("topic")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def stream_topic_rate(spark, d):
    """The daily counts, made by a stream over the file, written once the watermark has passed, and read back.

    The last days are still open when the stream ends: a batch twin of the same messages, a year later, lets the watermark pass them.
    """
    from fieldspark import streaming

    base = scratch(spark, "stream")
    seen = spark.read.parquet(f"{d}/events.parquet")
    later = seen.limit(1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 365 DAYS")).withColumn("event_type", F.lit("end"))
    later.write.parquet(f"{base}/later")
    stream = streaming.messages(spark, d, seen.schema, "ts", "events.parquet")
    end = spark.readStream.schema(seen.schema).parquet(f"{base}/later").withColumn("ts", F.col("ts").cast("timestamp"))
    counted = streaming.windowed_rate(stream.unionByName(end), "1 day", "0 seconds", topic="event_type", stamp="ts")
    streaming.run_once(counted, f"{base}/out", f"{base}/ck")
    return spark.read.parquet(f"{base}/out").select(F.unix_micros("start").alias("start_us"), F.col("event_type").alias("topic"), "n")


def frame_decode(spark, d):
    """Each document's bytes as a depth message, and its picture decoded again; documents without text make messages without a picture."""
    ready(spark)
    data = table(spark, d, "documents").select("doc_id", frames.encode_depth(F.col("text").cast("binary")).alias("data")).withColumn("f", frames.decode_depth("data"))
    return data.select("doc_id", "f.width", "f.height", "f.encoding", frames.pixel_sum("f.data").alias("pixels"), F.col("f.error").isNotNull().alias("failed"))


FRAMES_SQL = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents), p AS (SELECT doc_id, len(h) // 2 AS n, h || CASE WHEN len(h) % 4 = 0 THEN '' ELSE '00' END AS h FROM d)
 SELECT doc_id, CASE WHEN n > 0 THEN 512 END::INT AS width, CASE WHEN n > 0 THEN (n + 1023) // 1024 END::INT AS height, CASE WHEN n > 0 THEN '16UC1' END AS encoding,
 CASE WHEN n > 0 THEN list_sum(list_transform(regexp_extract_all(h, '[0-9A-F]{4}'), lambda x: ('0x' || x)::BIGINT))::BIGINT END AS pixels, n = 0 AS failed FROM p"""


# messages as inertial samples, some twentieth of a second to seconds apart; every 23rd lacks its acceleration
IMU = {"gx": "value / 50 - 1", "gy": "event_id % 21 / 10 - 1", "gz": "event_id % 13 / 13", "ax": "event_id % 17 / 17 - 0.5", "ay": "event_id % 19 / 19 - 0.5", "az": "CASE WHEN event_id % 23 > 0 THEN 1 + value / 100 END"}
IMU_RESTART = 1_500_000


def _inertial(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("user_id").alias("device"), F.timestamp_micros(F.expr("unix_micros(stamp) div 100000")).alias("stamp"), F.col("msg_id").alias("id"), *[F.expr(x.replace("event_id", "msg_id").replace("0.5", "0.5D")).alias(c) for c, x in IMU.items()])


def _quaternions(turns: DataFrame) -> DataFrame:
    return turns.select("device", F.unix_micros("stamp").alias("stamp_us"), "id", *[r6(F.col(c)).alias(c) for c in attitude.QUATERNION])


def imu_orientation(spark, d):
    """Each device's orientation after each of its samples; a silence of more than 1.5 seconds starts anew."""
    ready(spark)
    return _quaternions(attitude.orientation(_inertial(events(spark, d)), 0.1, IMU_RESTART))


def stream_imu_orientation(spark, d):
    """The same by a stream that holds each device's orientation."""
    from fieldspark.streaming import stateful

    ready(spark)
    turns = stateful.orientation(_inertial(_ended(spark, d, "2030-01-01 00:00:00", "end")), 0.1, "0 seconds", IMU_RESTART)
    return _quaternions(_ran(spark, turns, "orientation"))


_LEVEL = "CASE WHEN al IS NULL THEN [1, 0, 0, 0]::DOUBLE[] WHEN sqrt(2 * (1 + az / al)) > 0.000001 THEN [sqrt(2 * (1 + az / al)) / 2, ay / al / sqrt(2 * (1 + az / al)), -(ax / al) / sqrt(2 * (1 + az / al)), 0] ELSE [0, 1, 0, 0]::DOUBLE[] END"
_SCALED = "CASE WHEN vl > 0 THEN [{0}[1] / vl, {0}[2] / vl, {0}[3] / vl, {0}[4] / vl] ELSE {1} END"
_LENGTH = "sqrt({0}[1] * {0}[1] + {0}[2] * {0}[2] + {0}[3] * {0}[3] + {0}[4] * {0}[4])"
IMU_SQL = f"""WITH RECURSIVE i AS (SELECT user_id AS device, epoch_us(ts) // 100000 AS t, event_id AS id, {", ".join(f"({x.replace('0.5', '0.5::DOUBLE')})::DOUBLE AS {c}" for c, x in IMU.items())} FROM events),
 b AS (SELECT *, t - lag(t) OVER (PARTITION BY device ORDER BY t, id) AS gap FROM i),
 s AS (SELECT *, sum(CASE WHEN gap <= {IMU_RESTART} THEN 0 ELSE 1 END) OVER (PARTITION BY device ORDER BY t, id) AS seg FROM b),
 p AS (SELECT device, seg, t, id, gap / 1000000.0::DOUBLE AS dt, gx, gy, gz, ax, ay, az, sqrt(ax * ax + ay * ay + az * az) AS al, row_number() OVER (PARTITION BY device, seg ORDER BY t, id) AS k FROM s),
 r AS (SELECT device, seg, k, t, id, {_LEVEL} AS q FROM p WHERE k = 1 UNION ALL SELECT device, seg, k, t, id, {_SCALED.format("v", "q")} FROM (SELECT *, {_LENGTH.format("v")} AS vl FROM (SELECT *,
  [q[1] + (0.5 * (-q[2] * gx - q[3] * gy - q[4] * gz) - n[1]) * dt, q[2] + (0.5 * (q[1] * gx + q[3] * gz - q[4] * gy) - n[2]) * dt, q[3] + (0.5 * (q[1] * gy - q[2] * gz + q[4] * gx) - n[3]) * dt, q[4] + (0.5 * (q[1] * gz + q[2] * gy - q[3] * gx) - n[4]) * dt] AS v
  FROM (SELECT *, CASE WHEN l > 0 THEN [0.1 * (g[1] / l), 0.1 * (g[2] / l), 0.1 * (g[3] / l), 0.1 * (g[4] / l)] ELSE [0, 0, 0, 0]::DOUBLE[] END AS n FROM (SELECT *, {_LENGTH.format("g")} AS l FROM (SELECT *,
  [2 * q[2] * f - 2 * q[3] * e, 2 * q[4] * e + 2 * q[1] * f - 4 * q[2] * h, 2 * q[4] * f - 2 * q[1] * e - 4 * q[3] * h, 2 * q[2] * e + 2 * q[3] * f] AS g
  FROM (SELECT p.*, r.q, 2 * (q[2] * q[4] - q[1] * q[3]) - ax / al AS e, 2 * (q[1] * q[2] + q[3] * q[4]) - ay / al AS f, 1 - 2 * (q[2] * q[2] + q[3] * q[3]) - az / al AS h FROM r JOIN p ON p.device = r.device AND p.seg = r.seg AND p.k = r.k + 1)))))))
 SELECT device, t AS stamp_us, id, {sql6("q[1]")} AS qw, {sql6("q[2]")} AS qx, {sql6("q[3]")} AS qy, {sql6("q[4]")} AS qz FROM r"""


def cloud_hull(spark, d):
    """The edges of the cloud's convex hull."""
    ready(spark)
    return hull.edges(hull.convex_hull(points(spark, d), 4096))


# two points are joined by an edge if all others, seen along it, lie within half a turn
HULL_SQL = f"""WITH p AS (SELECT pid, x, y, z FROM {POINTS}), e AS (SELECT a.pid AS u, b.pid AS v, a.x, a.y, a.z, b.x - a.x AS dx, b.y - a.y AS dy, b.z - a.z AS dz, (SELECT min(pid) FROM p WHERE pid NOT IN (a.pid, b.pid)) AS other FROM p a JOIN p b ON a.pid < b.pid),
 f AS (SELECT u, v, e.x, e.y, e.z, dx / l AS dx, dy / l AS dy, dz / l AS dz, o.x - e.x AS rx, o.y - e.y AS ry, o.z - e.z AS rz FROM (SELECT *, sqrt(dx * dx + dy * dy + dz * dz) AS l FROM e) e JOIN p o ON o.pid = other),
 w AS (SELECT u, v, atan2(dx * (ry * pz - rz * py) + dy * (rz * px - rx * pz) + dz * (rx * py - ry * px), rx * px + ry * py + rz * pz - (rx * dx + ry * dy + rz * dz) * (px * dx + py * dy + pz * dz)) AS turn
  FROM (SELECT f.*, p.x - f.x AS px, p.y - f.y AS py, p.z - f.z AS pz FROM f JOIN p ON p.pid <> u AND p.pid <> v))
 SELECT u, v FROM w GROUP BY u, v HAVING greatest(max(turn), 0) - least(min(turn), 0) < pi()"""


def database_rows(spark, d):
    """The documents written as SQLite databases and read back by ranges of row ids."""
    ready(spark)
    spark.dataSource.register(database.SqliteSource)
    rows = table(spark, d, "documents").select("doc_id", "source", "text", (F.col("n_chars") / 7).alias("share"))
    paths = database.write_sqlite(rows, scratch(spark, "databases"), "documents")
    return spark.read.format("sqlite").option("table", "documents").load(",".join(paths)).drop("file")


QUERIES = {
    f.__name__: f
    for f in (
        topic_counts, topic_rate, topic_interarrival_rate, topic_last_value, topic_health, pipeline_verdict, inspector_status, daily_drop_bands, stage1_score, stage2_score, run_ranking, best_run,
        config_cross_product, oat_sweep, sweep_valid, params_to_cli, cli_to_params, missing_required, present_required, best_broadcast_runs, first_rate_line, last_rate_line, resource_mean, growth_rate, gate_verdicts,
        approx_sync, asof_sync, throttle_first, tumbling_rate, cloud_bbox, voxel_downsample, knn_mean_distance, outlier_filter, radius_neighbours, quantile_trim, crop_bbox, nn_label_transfer, triangle_cleanup, normals,
        mesh_vertex_normals, json_round_trip, report_rows, stream_topic_rate, frame_decode, gate_sequence, stage_document, slam_report_rows, diagnostic_report_rows, inspector_report_rows, status_line_rows,
        zero_runs, usb_kinds, path_parts, stamps, parameter_flags, run_progress, replay_schedule, first_message_wait, message_gaps, rate_and_cpu, scaled_cloud, occupancy_points, mesh_info, synthetic_loss, recorded_topics,
        oriented_normals, occupancy_grid, synced_sets, stream_sets, topic_absences, stream_absences, queue_drops, stream_queue_drops, imu_orientation, stream_imu_orientation, cloud_hull, database_rows, sensor_report_rows,
    )
} | {"keyframes": keyframe_rows}

TRI = f"(SELECT pid AS tid, pid AS v0, pid + 1 AS v1, pid + 2 AS v2 FROM {POINTS} WHERE pid % 3 = 0)"
ORACLES = {
    "topic_counts": "SELECT event_type AS topic, count(*) AS n FROM events GROUP BY 1",
    "topic_rate": "SELECT event_type AS topic, floor(count(*) / 2592000.0::DOUBLE * 1000000000.0 + 0.5) / 1000000000.0 AS hz FROM events GROUP BY 1",
    "topic_interarrival_rate": "SELECT event_type AS topic, floor((count(*) - 1) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE) * 1000000000.0 + 0.5) / 1000000000.0 AS hz FROM events GROUP BY 1",
    "topic_last_value": "SELECT event_type AS topic, arg_max(props, row(ts, event_id)) AS props, arg_max(event_id, row(ts, event_id)) AS msg_id FROM events GROUP BY 1",
    "topic_health": f"SELECT topic, label, min_hz, {sql6('measured_hz')} AS measured_hz, status FROM ({HEALTH_SQL})",
    "pipeline_verdict": f"SELECT *, CASE WHEN all_ok THEN 'ALL_OK' WHEN slam_live THEN 'DEGRADED' ELSE 'DOWN' END AS verdict FROM (SELECT bool_and(status = 'OK') AS all_ok, bool_or(topic = 'signup' AND status <> 'MISSING') AS slam_live, bool_or(topic = 'heartbeat' AND status <> 'MISSING') AS map_live FROM ({HEALTH_SQL}))",
    "inspector_status": f"SELECT topic, {sql6('fps')} AS fps, CASE WHEN fps <= 0 THEN 'INACTIVE' WHEN topic LIKE '%compressed%' THEN CASE WHEN fps >= 15 THEN 'OK' ELSE 'BAD' END WHEN topic LIKE '%color/image_raw%' THEN 'INFO' WHEN fps >= 15 THEN 'OK' ELSE 'DEGRADED' END AS status FROM (SELECT '/camera/' || CASE event_type WHEN 'view' THEN 'color/image_raw' WHEN 'click' THEN 'color/image_raw/compressed' WHEN 'error' THEN 'depth/compressed' ELSE event_type END AS topic, count(*) / 30.0::DOUBLE / 4.47::DOUBLE AS fps FROM events GROUP BY 1)",
    "daily_drop_bands": f"SELECT start_us, topic, n, {sql6('pct')} AS drop_pct, CASE WHEN pct < 10 THEN 'green' WHEN pct < 25 THEN 'yellow' ELSE 'red' END AS band FROM (SELECT *, greatest(0.0, (70 - n::DOUBLE) / 70 * 100.0) AS pct FROM ({TUMBLING_SQL}))",
    "stage1_score": f"SELECT {STAGE1_OUT} FROM ({STAGE1_SQL})",
    "stage2_score": STAGE2_SQL,
    "run_ranking": f"SELECT seq, score, rank, CASE rank WHEN 1 THEN '🥇' WHEN 2 THEN '🥈' WHEN 3 THEN '🥉' ELSE rank::VARCHAR END AS medal FROM (SELECT *, row_number() OVER (ORDER BY score DESC, seq) AS rank FROM ({STAGE1_SQL}))",
    "best_run": f"SELECT {STAGE1_OUT} FROM ({STAGE1_SQL}) ORDER BY score DESC, seq LIMIT 1",
    "config_cross_product": CROSS_SQL,
    "oat_sweep": f"SELECT seq, label, params FROM ({OAT_SQL})",
    "sweep_valid": f"SELECT seq, label, params FROM ({OAT_SQL}) WHERE coalesce(threads, 4) <= 4",
    "params_to_cli": "SELECT event_id AS msg_id, '--Vis/MaxDepth ' || CASE WHEN event_id % 2 = 0 THEN (user_id % 10)::VARCHAR ELSE '8.0' END || ' --Vis/MinDepth 0.3 --Vis/MinInliers ' || event_id % 13 || ' --Vis/Robust true --topic ' || event_type AS cli FROM events",
    "cli_to_params": "SELECT event_id AS msg_id, unnest(['Vis/MinInliers', 'note', 'topic']) AS k, unnest([(event_id % 13)::VARCHAR, 'seen by ' || user_id, event_type]) AS v FROM events",
    "missing_required": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_custkey IS NOT NULL)",
    "present_required": "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "best_broadcast_runs": f"SELECT s.seq, s.label, b.seq AS best_seq, b.resolution, b.target_fps FROM ({OAT_SQL}) s, (SELECT * FROM ({STAGE1_SQL}) ORDER BY score DESC, seq LIMIT 1) b",
    "first_rate_line": _rate_sql("arg_min"),
    "last_rate_line": _rate_sql("arg_max"),
    "resource_mean": f"SELECT name, {sql6('coalesce(avg(value), 0.0)')} AS cpu_pct, {sql6('coalesce(avg(user_id * 1024.0::DOUBLE / 1024.0), 0.0)')} AS ram_mb FROM (VALUES ('view'), ('purchase_node'), ('absent')) v(name) LEFT JOIN events ON contains('/opt/bin/' || event_type || '_node', name) GROUP BY 1",
    "growth_rate": f"SELECT doc_id::VARCHAR AS path, {sql6('n_chars * 1000 / 1048576.0::DOUBLE')} AS mb, {sql6('n_chars * 1000 / 1048576.0::DOUBLE / (5.0::DOUBLE / 60.0::DOUBLE)')} AS mb_per_min FROM documents",
    "gate_verdicts": GATES_SQL,
    "approx_sync": f"{STREAMS} SELECT id, right_id, dt_us FROM (SELECT p.id, v.id AS right_id, abs(p.t - v.t) AS dt_us, row_number() OVER (PARTITION BY p.id ORDER BY abs(p.t - v.t), v.id) AS k FROM p JOIN v ON v.t BETWEEN p.t - {HALF_HOUR} AND p.t + {HALF_HOUR}) WHERE k = 1",
    "asof_sync": f"{STREAMS} SELECT p.id, v.id AS right_id, p.t - v.t AS dt_us FROM p ASOF JOIN v ON p.t >= v.t WHERE p.t - v.t <= {HALF_HOUR}",
    "throttle_first": "SELECT event_type AS topic, arg_min(event_id, row(ts, event_id)) AS msg_id, epoch_us(min(ts)) AS stamp_us FROM events GROUP BY event_type, epoch_us(ts) // 3600000000",
    "tumbling_rate": TUMBLING_SQL,
    "stream_topic_rate": TUMBLING_SQL,
    "cloud_bbox": "SELECT count(*) AS n, " + ", ".join(f"{sql6(f'{f}({a})')} AS {f}_{a}" for a in "xyz" for f in ("min", "max")) + ", " + ", ".join(f"{sql6(f'max({a}) - min({a})')} AS d{a}" for a in "xyz") + f", {sql6('greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z))')} AS max_extent FROM {POINTS}",
    "voxel_downsample": "SELECT floor(x / 0.1::DOUBLE)::BIGINT AS cx, floor(y / 0.1::DOUBLE)::BIGINT AS cy, floor(z / 0.1::DOUBLE)::BIGINT AS cz, count(*) AS n, " + ", ".join(f"{sql6(f'avg({a})')} AS {a}" for a in "xyz") + f" FROM {POINTS} GROUP BY ALL",
    "knn_mean_distance": f"SELECT pid, {sql6('mean_d')} AS mean_d FROM {KNN20}",
    "outlier_filter": f"SELECT pid FROM {KNN20} WHERE mean_d <= (SELECT avg(mean_d) + 2.0 * stddev_samp(mean_d) FROM {KNN20})",
    "radius_neighbours": f"SELECT q, n, {sql6('d2')} AS d2, rank FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d2, n) AS rank FROM {PAIRS} WHERE d2 <= 0.1::DOUBLE * 0.1::DOUBLE) WHERE rank <= 30",
    "quantile_trim": f"SELECT pid FROM {POINTS} WHERE x >= (SELECT quantile_cont(x, 0.05) FROM {POINTS})",
    "crop_bbox": f"SELECT p.pid FROM {POINTS} p, (SELECT min(x) a, max(x) b, min(y) c, max(y) d, min(z) e, max(z) f FROM {POINTS} WHERE label = 3) WHERE x BETWEEN a AND b AND y BETWEEN c AND d AND z BETWEEN e AND f",
    "nn_label_transfer": f"SELECT pid, label FROM (SELECT q AS pid, p.label, row_number() OVER (PARTITION BY q ORDER BY d2, n) AS k FROM {PAIRS} JOIN {POINTS} p ON p.pid = n WHERE q % 2 = 1 AND n % 2 = 0) WHERE k = 1",
    "triangle_cleanup": f"WITH k AS (SELECT pid FROM {POINTS} WHERE x >= (SELECT quantile_cont(x, 0.05) FROM {POINTS})) SELECT * FROM {TRI} WHERE v0 IN (FROM k) AND v1 IN (FROM k) AND v2 IN (FROM k)",
    "mesh_vertex_normals": f"""WITH t AS (SELECT t.*, b.x - a.x AS ux, b.y - a.y AS uy, b.z - a.z AS uz, c.x - a.x AS wx, c.y - a.y AS wy, c.z - a.z AS wz FROM {TRI} t JOIN {POINTS} a ON a.pid = v0 JOIN {POINTS} b ON b.pid = v1 JOIN {POINTS} c ON c.pid = v2),
 f AS (SELECT unnest([v0, v1, v2]) AS vid, uy * wz - uz * wy AS fx, uz * wx - ux * wz AS fy, ux * wy - uy * wx AS fz FROM t), s AS (SELECT vid, sum(fx) AS fx, sum(fy) AS fy, sum(fz) AS fz FROM f GROUP BY 1)
 SELECT vid, {sql6("fx / sqrt(fx * fx + fy * fy + fz * fz)")} AS nx, {sql6("fy / sqrt(fx * fx + fy * fy + fz * fz)")} AS ny, {sql6("fz / sqrt(fx * fx + fy * fy + fz * fz)")} AS nz FROM s""",
    "json_round_trip": "SELECT event_id AS msg_id, (props->>'$.k')::INT AS k, replace(props, ' ', '') AS document FROM events",
    "gate_sequence": f"{GATE_ROWS}, o AS (SELECT gate, verdict, coalesce(max((verdict = 'fail')::INT) OVER (ORDER BY gate ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM g WHERE gate LIKE 'cloud%') SELECT gate, verdict, CASE WHEN stopped = 1 THEN 'skipped' ELSE verdict END AS outcome, verdict AS forced FROM o",
    "stage_document": f"SELECT first_value(seq) OVER w AS best_seq, (row_number() OVER w - 1)::INT AS place, seq, rmw, score, true AS without_handle FROM ({STAGE1_SQL}) WINDOW w AS (ORDER BY score DESC, seq)",
    "slam_report_rows": f"SELECT rank, {_cells('rank::VARCHAR', 'label', _fixed('odom_hz', 2), 'slam_ok::VARCHAR', 'camera_ok::VARCHAR', _fixed('score'))} AS line FROM (SELECT *, row_number() OVER (ORDER BY score DESC, seq) AS rank FROM (SELECT s.*, r.odom_hz FROM ({STAGE2_SQL}) s JOIN (SELECT (ascii(o_orderstatus) * 10 + left(o_orderpriority, 1)::INT)::INT AS seq, floor(avg(o_totalprice) / 10000.0 * 1000.0 + 0.5) / 1000.0 / left(o_orderpriority, 1)::INT AS odom_hz FROM orders GROUP BY o_orderstatus, o_orderpriority) r USING (seq)))",
    "diagnostic_report_rows": f"SELECT topic, {_cells('topic', 'min_hz::VARCHAR', _fixed('measured_hz'), 'status')} AS line FROM ({HEALTH_SQL})",
    "status_line_rows": f"SELECT topic, '[' || rpad(status, 8, ' ') || '] ' || label AS line FROM ({HEALTH_SQL})",
    "zero_runs": f"SELECT c_custkey, {sql6('coalesce(hz, 0.0)')} AS hz, CASE WHEN hz IS NULL THEN 100.0 ELSE 0.0 END::DOUBLE AS drop_pct, CASE WHEN hz IS NULL THEN 'fail' WHEN hz < 1 THEN 'warn' ELSE 'pass' END AS gate FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) / 3.0::DOUBLE AS hz FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1) USING (c_custkey)",
    "usb_kinds": "SELECT CASE WHEN k IN ('2.0', '2.1') THEN 'USB 2' WHEN k LIKE '3.%' THEN 'USB 3' ELSE 'Unknown' END AS kind, count(*) AS n FROM (SELECT (o_orderkey % 4) || '.' || (o_orderkey % 3) AS k FROM orders) GROUP BY 1",
    "path_parts": "SELECT doc_id, doc_id || e AS name, '/data/' || s AS folder, '/data/' || s || '/' || doc_id || CASE e WHEN '.ply' THEN '' ELSE e END AS stem, '/data/' || s || '/' || doc_id || e AS arg FROM (SELECT doc_id, coalesce(source, 'none') AS s, CASE WHEN doc_id % 2 = 0 THEN '.ply' ELSE '.pcd' END AS e FROM documents)",
    "stamps": "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d_%H%M%S') AS file, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS human FROM orders",
    "parameter_flags": "SELECT event_id AS msg_id, 'n=' || (event_id % 3) || ';on=' || o || ';user=' || user_id AS text, lower(o) = 'true' AS is_on, false AS is_absent, floor(value + 0.5)::BIGINT AS whole FROM (SELECT *, CASE event_id % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'true' ELSE '1' END AS o FROM events)",
    "run_progress": f"SELECT seq, row_number() OVER (ORDER BY seq) || '/' || count(*) OVER () AS progress FROM {STAGE1_RUNS}",
    "replay_schedule": f"SELECT event_id AS msg_id, {sql6('(epoch_us(ts) - (SELECT epoch_us(min(ts)) FROM events)) / 1000000.0::DOUBLE / 0.5::DOUBLE')} AS play_s FROM events",
    "first_message_wait": f"SELECT event_type AS topic, {sql6('w')} AS wait_s, w <= 900 AS arrived FROM (SELECT event_type, min(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-05')) / 1000000.0::DOUBLE AS w FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY 1)",
    "message_gaps": f"SELECT event_id AS msg_id, {sql6('(epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY ts, event_id)) / 1000000.0::DOUBLE')} AS gap_s FROM events",
    "rate_and_cpu": f"SELECT event_type AS topic, floor(count(*) / 2592000.0::DOUBLE * 1000000000.0 + 0.5) / 1000000000.0 AS hz, (SELECT {sql6('avg(v)')} FROM (SELECT arg_min(value, event_id) AS v FROM events WHERE event_type = 'click' GROUP BY ts)) AS cpu_pct FROM events GROUP BY 1",
    "scaled_cloud": "SELECT pid, " + ", ".join(f"floor({a} * 0.001::DOUBLE * 1000000000.0 + 0.5) / 1000000000.0 AS {a}" for a in "xyz") + f" FROM {POINTS}",
    "occupancy_points": f"WITH r AS (SELECT * FROM {POINTS} WHERE sqrt(x * x + y * y + z * z) BETWEEN 0.05::DOUBLE AND 0.45::DOUBLE), k AS (SELECT a.pid FROM r a JOIN r b ON a.pid <> b.pid AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) <= 0.1::DOUBLE * 0.1::DOUBLE GROUP BY a.pid HAVING count(*) >= 2) SELECT floor(x / 0.05::DOUBLE)::BIGINT AS cx, floor(y / 0.05::DOUBLE)::BIGINT AS cy, floor(z / 0.05::DOUBLE)::BIGINT AS cz, count(*) AS n FROM r WHERE pid IN (FROM k) GROUP BY ALL",
    "mesh_info": f"SELECT count(*) AS n_vertices, bool_or(label = 1) AS has_normals, false AS has_colors, count(*) FILTER (pid % 3 = 0) AS n_triangles FROM {POINTS}",
    "synthetic_loss": f"""WITH c AS (SELECT event_type AS topic, epoch_us(ts) AS t, ('0x' || substr(md5('3:loss ' || event_type || ':' || event_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS loss, ('0x' || substr(md5('3:late ' || event_type || ':' || event_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS late FROM events)
 SELECT topic, count(*) AS sent, count(*) FILTER (loss >= 0.1) AS n, (sum((t + floor(late * 4001)::BIGINT) % 86400000000) FILTER (loss >= 0.1))::BIGINT AS stamps, {sql6("(count(*) - count(*) FILTER (loss >= 0.1)) / count(*)::DOUBLE * 100.0")} AS drop_pct FROM c GROUP BY 1""",
    "recorded_topics": "SELECT event_type AS topic, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1",
    "keyframes": """WITH RECURSIVE p AS (SELECT user_id AS device, epoch_us(ts) AS stamp, event_id AS id, value / 100 AS distance, event_id % 7 / 100 AS angle, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events),
 r AS (SELECT device, k, stamp, id, distance, angle, distance AS d, angle AS a, true AS hit FROM p WHERE k = 1
 UNION ALL SELECT p.device, p.k, p.stamp, p.id, p.distance, p.angle, CASE WHEN m THEN p.distance ELSE d END, CASE WHEN m THEN p.angle ELSE a END, m
 FROM (SELECT p.*, r.d, r.a, abs(p.distance - r.d) >= 0.1::DOUBLE OR abs(p.angle - r.a) >= 0.1::DOUBLE AS m FROM r JOIN p ON p.device = r.device AND p.k = r.k + 1) p)
 SELECT device, stamp, id, distance, angle FROM r WHERE hit""",
    "report_rows": REPORT_SQL,
}
ORACLES |= {"frame_decode": FRAMES_SQL, "oriented_normals": ORIENTED_SQL, "occupancy_grid": GRID_SQL}
ORACLES |= {"synced_sets": SETS_SQL, "stream_sets": SETS_SQL, "topic_absences": ABSENCES_SQL, "stream_absences": ABSENCES_SQL, "queue_drops": QUEUE_SQL, "stream_queue_drops": QUEUE_SQL}
ORACLES["sensor_report_rows"] = f"SELECT rank, {_cells('rank::VARCHAR', 'rmw', 'shm', 'resolution', 'target_fps::VARCHAR', 'qos', 'format', _fixed('color_hz'), _fixed('drop_pct'), _fixed('cpu_pct'), _fixed('score'))} AS line FROM (SELECT *, CASE WHEN seq % 2 = 0 THEN 'compressed' ELSE 'raw' END AS format, row_number() OVER (ORDER BY score DESC, seq) AS rank FROM ({STAGE1_SQL}))"
ORACLES |= {"imu_orientation": IMU_SQL, "stream_imu_orientation": IMU_SQL, "cloud_hull": HULL_SQL, "database_rows": "SELECT doc_id, source, text, n_chars / 7 AS share FROM documents"}
ORACLES["inspector_report_rows"] = f"SELECT topic, {_cells('topic', _fixed('fps'), 'status')} AS line FROM ({ORACLES['inspector_status']})"
