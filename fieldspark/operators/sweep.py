"""Parameter sweeps: cross products, one axis at a time, and validity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark import schemas
from fieldspark.functions import params

# Axes of the full and the quick sweep, as (axis, [(label, parameters)]); the first option is the default.
FULL = [
    ("estimation_type", [("EST=PnP(3D-2D)", {"Vis/EstimationType": "1"}), ("EST=SVD(3D-3D)", {"Vis/EstimationType": "0"})]),
    ("align_depth", [("ALIGN=off", {"align_depth": "false"}), ("ALIGN=on", {"align_depth": "true"})]),
    ("detection_rate", [("DR=2", {"Rtabmap/DetectionRate": "2"}), ("DR=5", {"Rtabmap/DetectionRate": "5"}), ("DR=10", {"Rtabmap/DetectionRate": "10"})]),
    ("vis_features", [("VF=500", {"Vis/MaxFeatures": "500"}), ("VF=1000", {"Vis/MaxFeatures": "1000"}), ("VF=1500", {"Vis/MaxFeatures": "1500"}), ("VF=2000", {"Vis/MaxFeatures": "2000"})]),
    ("threads", [("TH=2", {"Vis/CornerNbThreads": "2"}), ("TH=4", {"Vis/CornerNbThreads": "4"}), ("TH=8", {"Vis/CornerNbThreads": "8"})]),
    ("f2m_frames", [("F2M=5", {"OdomF2M/MaxFrames": "5"}), ("F2M=10", {"OdomF2M/MaxFrames": "10"}), ("F2M=15", {"OdomF2M/MaxFrames": "15"})]),
    ("keyframe", [(f"KF_{v}", {"RGBD/LinearUpdate": v, "RGBD/AngularUpdate": v}) for v in ("0.1", "0.2", "0.3")]),
    ("min_inliers", [("IN=6", {"Vis/MinInliers": "6"}), ("IN=10", {"Vis/MinInliers": "10"}), ("IN=12", {"Vis/MinInliers": "12"})]),
]
QUICK = [
    FULL[0],
    ("f2m_frames", [("F2M=10", {"OdomF2M/MaxFrames": "10"}), ("F2M=5", {"OdomF2M/MaxFrames": "5"})]),
    ("keyframe", FULL[6][1][:2]),
    ("min_inliers", FULL[7][1][:2]),
]


def axes_table(spark: SparkSession, axes: list) -> DataFrame:
    rows = [(axis, a, o, label, p) for a, (axis, options) in enumerate(axes) for o, (label, p) in enumerate(options)]
    return spark.createDataFrame(rows, schemas.AXIS_OPTION)


def one_at_a_time(axes: DataFrame) -> DataFrame:
    """seq, label, params: the defaults of all axes, then each other option alone; configs with equal parameters count once.

    Labels are the options' labels in axis order.  The row count is one plus the number of options that are no default.
    """
    first = axes.where(F.col("opt_ord") == 0)
    variants = axes.select(F.when(F.col("opt_ord") == 0, F.lit(-1)).otherwise(F.col("axis_ord")).alias("v_axis"), F.when(F.col("opt_ord") == 0, F.lit(0)).otherwise(F.col("opt_ord")).alias("v_opt"), F.col("label").alias("v_label"), F.col("params").alias("v_params")).where((F.col("v_axis") >= 0))
    default = axes.agg(F.lit(-1).alias("v_axis"), F.lit(0).alias("v_opt"), F.lit(None).cast("string").alias("v_label"), F.lit(None).cast("map<string,string>").alias("v_params"))
    base = first.agg(F.array_sort(F.collect_list(F.struct("axis_ord", "label", F.map_entries("params").alias("params")))).alias("base"))  # one row: an option for each axis
    made = variants.unionByName(default).join(F.broadcast(base))
    chosen = F.transform("base", lambda b: F.when(b["axis_ord"] == F.col("v_axis"), F.struct(F.col("v_label").alias("label"), F.map_entries("v_params").alias("params"))).otherwise(F.struct(b["label"].alias("label"), b["params"].alias("params"))))
    rows = made.withColumn("chosen", chosen).select("v_axis", "v_opt", F.array_join(F.transform("chosen", lambda x: x["label"]), " | ").alias("label"), F.map_from_entries(F.flatten(F.transform("chosen", lambda x: x["params"]))).alias("params"))
    unique = rows.withColumn("__n", F.row_number().over(Window.partitionBy(params.canonical(F.col("params"))).orderBy("v_axis", "v_opt"))).where(F.col("__n") == 1)
    return unique.select((F.row_number().over(Window.orderBy("v_axis", "v_opt")) - 1).cast("bigint").alias("seq"), "label", "params")  # a sweep is small


def valid(configs: DataFrame, nproc: int, key: str = "Vis/CornerNbThreads", default: str = "4") -> DataFrame:
    return configs.where(params.value(F.col("params"), key, default).cast("int") <= nproc)


def with_base(configs: DataFrame, base: dict[str, str]) -> DataFrame:
    entries = F.create_map(*[F.lit(x) for kv in base.items() for x in kv]) if base else F.create_map().cast("map<string,string>")
    return configs.withColumn("params", params.merged(entries, F.col("params")))


def options(table: DataFrame, column: str, axis: str, axis_ord: int, prefix: str, key: str) -> DataFrame:
    """An axis whose options are a column's distinct values, in order: the first is the default, labels are `prefix=value`, and `key` is the parameter.  Nulls are no option."""
    values = table.select(F.col(column).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct()
    o = (F.row_number().over(Window.orderBy("v")) - 1).cast("int")  # an axis has few options
    return values.select(F.lit(axis).alias("axis"), F.lit(axis_ord).alias("axis_ord"), o.alias("opt_ord"), F.concat_ws("=", F.lit(prefix), "v").alias("label"), F.create_map(F.lit(key), "v").alias("params"))


def sensor_configs(spark: SparkSession, rmws: list[str] | DataFrame, quick: bool = False) -> DataFrame:
    """Every combination of middleware (names in order, or a table of o1 and rmw), its shared-memory modes, resolution and rate, quality of service and compression, in order.

    Only the first-named fast middleware has a choice of shared memory, and only in a full sweep.
    """
    # Fixed values
    sizes = [(640, 480, 15), (640, 480, 30), (1280, 720, 15), (1280, 720, 30)]
    if quick:
        sizes = [sizes[0], sizes[1], sizes[3]]
    qos, packed = (["SENSOR_DATA"], [False]) if quick else (["SENSOR_DATA", "DEFAULT"], [False, True])
    table = lambda rows, schema: spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], schema)
    a = rmws if isinstance(rmws, DataFrame) else table([(r,) for r in rmws], "o1 int, rmw string")
    a = a.withColumn("shm", F.explode(F.when((F.col("rmw") == "rmw_fastrtps_cpp") & F.lit(not quick), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))))
    b = table(sizes, "o2 int, width int, height int, fps int")
    c = table([(q,) for q in qos], "o3 int, qos string")
    d = table([(p,) for p in packed], "o4 int, compressed boolean")
    rows = a.crossJoin(b).crossJoin(c).crossJoin(d)  # a sweep's axes: tens of rows
    order = Window.orderBy("o1", F.desc("shm"), "o2", "o3", "o4")
    return rows.select((F.row_number().over(order) - 1).cast("bigint").alias("seq"), "rmw", "shm", "width", "height", "fps", "qos", "compressed")
