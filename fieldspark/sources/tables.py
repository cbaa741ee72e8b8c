"""Tables, stage documents, artifacts and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldspark import schemas
from fieldspark.session import ready


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table; timestamps without a zone are read as UTC."""
    df = ready(spark).read.parquet(f"{folder}/{name}.parquet")
    return df.withColumns({c: F.to_utc_timestamp(F.col(c).cast("timestamp"), F.current_timezone()) for c, kind in df.dtypes if kind == "timestamp_ntz"})


def stage_json(spark: SparkSession, path: str, row: str) -> DataFrame:
    """A stage's JSON document with an explicit schema."""
    return spark.read.schema(schemas.stage_document(row)).json(path, multiLine=True)


def read_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stage's document as write_stage_json() leaves it: one line below `path`."""
    return spark.read.schema(schema).json(path)


def artifacts(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Metadata of files below a path; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "length", "modificationTime")


def expected_artifacts(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Expected (path, kind) with whether and how large they exist."""
    return expected.join(found.select("path", "length"), "path", "left").select("path", "kind", F.col("length").isNotNull().alias("exists"), F.coalesce("length", F.lit(0)).alias("length"))


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of logs with their file and their number in it (from 0).

    Files are read in splits, however long they are.  A line's number is its place in its split, after the lines of the splits before: one small aggregation counts those.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("__at"), F.monotonically_increasing_id().alias("__id"), F.col("value").alias("line"))
    counts = lines.groupBy("source", "__at").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("source").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")  # a row for each split
    number = (F.col("__start") + F.col("__id") - F.col("__first")).alias("line_no")
    return lines.join(starts, ["source", "__at"]).select("source", number, F.rtrim(F.regexp_replace("line", "\r$", "")).alias("line"))


def without_handles(document: DataFrame, handles: list[str]) -> DataFrame:
    """A stage document (best, all) without the fields that name processes of the run that made it."""
    drop = lambda c: F.col(c).dropFields(*handles)
    return document.withColumns({"best": drop("best"), "all": F.transform("all", lambda x: x.dropFields(*handles))})


def move_in(spark: SparkSession, staged: str, path: str) -> None:
    """Move what a job has written to its final place, by one rename in the table's own file system; what was there before goes."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    files = new.getFileSystem(conf)
    if files.exists(new):
        files.delete(new, True)
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"{staged} can't be moved to {path}")


def copy_if_possible(spark: SparkSession, path: str, to: str) -> bool:
    """A copy that may fail: whether it was made."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    old, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    try:
        return bool(jvm.org.apache.hadoop.fs.FileUtil.copy(old.getFileSystem(conf), old, new.getFileSystem(conf), new, False, True, conf))
    except Exception:  # noqa: BLE001  best effort: the caller is told
        return False


def write_stage_json(document: DataFrame, path: str) -> None:
    document.select(F.to_json(F.struct(*document.columns)).alias("value")).write.mode("overwrite").text(path)



def images(spark: SparkSession, path: str) -> DataFrame:
    """path, width, height and the RGB bytes of JPEG or 8-bit PNG files, decoded by Spark's own image source; what isn't an image is left out."""
    from fieldspark.functions.frames import bgr_to_rgb

    rows = spark.read.format("image").option("dropInvalid", "true").load(path).select("image.*")
    return rows.where("nChannels = 3").select(F.col("origin").alias("path"), "width", "height", bgr_to_rgb("data").alias("rgb"))
