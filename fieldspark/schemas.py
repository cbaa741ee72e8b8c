"""Schemas of the engine's records, as DDL."""

STAGE1_RUN = "seq int, rmw string, shm string, resolution string, target_fps int, qos string, color_hz double, depth_hz double, drop_pct double, cpu_pct double, ram_mb double, score double"
SENSOR_RUN = "seq int, rmw string, shm_status string, resolution string, target_fps int, qos string, format string, measured_fps double, drop_pct double, cpu_pct double, score double"
STAGE2_RUN = "seq int, label string, params map<string,string>, color_hz double, odom_hz double, map_hz double, cpu_cam double, ram_cam double, cpu_slam double, ram_slam double, db_growth_mb_min double, camera_ok boolean, slam_ok boolean, score double"
DIAGNOSTIC = "topic string, label string, min_hz int, measured_hz double, status string"
AXIS_OPTION = "axis string, axis_ord int, opt_ord int, label string, params map<string,string>"
POINT = "pid bigint, x double, y double, z double, r double, g double, b double, nx double, ny double, nz double"
VERTEX = "vid bigint, x double, y double, z double, density double, nx double, ny double, nz double, r double, g double, b double"
TRIANGLE = "tid bigint, v0 bigint, v1 bigint, v2 bigint"
MESSAGE = "msg_id bigint, topic string, stamp timestamp, frame_id string, width int, height int, encoding string, format string, data binary"
PROCESS_SAMPLE = "ts timestamp, proc_ord int, cmd string, cpu_pct double, rss_kb double"
ARTIFACT = "path string, kind string, exists boolean, length bigint"
SYSTEM_INFO = "rmws array<string>, rmem_max string, usb_type string, nproc int, xml_exists boolean"


def stage_document(row: str) -> str:
    """The document of a stage: its best row and all rows."""
    return f"best struct<{_fields(row)}>, all array<struct<{_fields(row)}>>"


def _fields(row: str) -> str:
    from pyspark.sql.types import StructType

    return StructType.fromDDL(row).simpleString()[len("struct<") : -1]
