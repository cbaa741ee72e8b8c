"""Shared pieces: staging tables, Arrow batches seen as NumPy arrays, and hashing."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import os
import pathlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(pathlib.Path(__file__).resolve().parents[2])
SLICE_BYTES = 2 << 20  # text handled at once by a Python worker, unless one text is longer
ARROW_BYTES = 4 << 20  # of an Arrow batch between Spark and a worker, unless one row is longer
_staged: dict[str, SparkSession] = {}


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package also when it isn't installed there, and bound what goes to them at once."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), ROOT]))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; it is set here only where the session has none (tests, local mode)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = "file:///tmp/checkpoints/fieldspark"
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def _forget(path: str) -> None:
    spark = _staged.pop(path, None)
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session ended before: the folder is then left to the cluster's own clean-up
        pass


@atexit.register
def _forget_all() -> None:
    for path in list(_staged):
        _forget(path)


def staged_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/fieldspark-{name}-{uuid.uuid4().hex}"
    _staged[path] = spark
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: its lineage ends there, and lost executors lose nothing of it."""
    spark = df.sparkSession
    path = staged_path(spark, name)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a staged table that no later step reads."""
    for f in df.inputFiles()[:1]:
        for path in list(_staged):
            if path.split("://")[-1].lstrip("/") in f:
                _forget(path)


def carried(docs: DataFrame, own: list[str]) -> list[str]:
    """The input's columns that an operator passes on: those that have none of its own names (case is ignored, as Spark does)."""
    taken = {x.lower() for x in own}
    return [c for c in docs.columns if c.lower() not in taken]


def crc_of_id(column: str = "doc_id"):
    """crc32 of the id as text, unsigned (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def id_crc(values: list) -> list[int]:
    import zlib

    return [zlib.crc32(b"" if v is None else str(v).encode()) for v in values]


def relax() -> None:
    """Give freed memory back to the system: workers live on after a task, and allocators keep what they once had."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def eased(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of a task, and at its end relax()."""
    try:
        yield from batches
    finally:
        relax()


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Put Arrow batches together or cut them so that each has about `limit` bytes of text, or one row."""
    for b in _together(eased(batches), limit) if limit > ARROW_BYTES else eased(batches):
        sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(column))), 0), dtype=np.int64) + 16)
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit, side="right")))
            yield b.slice(at, end - at)
            at = end


def _together(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts as UTF-8; null is empty."""
    arr = batch.column(batch.schema.get_field_index(column))
    return [x or b"" for x in arr.cast(pa.large_binary() if pa.types.is_large_string(arr.type) else pa.binary()).to_pylist()]


def ids_of(batch: pa.RecordBatch, column: str = "doc_id") -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


class WordHash(dict):
    """64-bit hashes of words, remembered for as many words as `limit`."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... of each range, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total, dtype=np.int64)


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def shards_for(spark: SparkSession) -> int:
    """How many parts keyed blocks are dealt to: the session's shuffle partitions, which follow the input on a cluster that is set up for it."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def map_rows(docs: DataFrame, make, own: str, keep: list[str] | None = None, read: list[str] | None = None, limit: int = SLICE_BYTES) -> DataFrame:
    """Add columns computed from each row in Python, batch by batch.

    make() is called once in each task and gives a function from an Arrow slice to a list of arrays, one for each column of
    `own` (a DDL string).  `keep` lists the input columns that pass through, in order; `read` further ones that make's function needs; `limit` is the bytes of text in a slice.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    own_type = StructType.fromDDL(own)
    keep = carried(docs, own_type.names) if keep is None else keep
    source = docs.select(*keep, *[c for c in (read or ["doc_id", "text"]) if c not in keep])
    out = StructType([source.schema[c] for c in keep] + own_type.fields)
    arrow = to_arrow_schema(out, prefers_large_types=False)

    def run(batches):
        f = make()
        for b in slices(batches, limit=limit):
            cols = [b.column(b.schema.get_field_index(c)) for c in keep] + list(f(b))
            yield pa.RecordBatch.from_arrays([a.cast(t.type) if a.type != t.type else a for a, t in zip(cols, arrow)], schema=arrow)
        del f
        relax()

    return source.mapInArrow(run, out)


def likely(docs: DataFrame, key: str, wanted: DataFrame, most_bits: int = 1 << 27) -> DataFrame:
    """The rows of docs whose key may be among `wanted` (one column), so that a join on it moves few others.

    A bitmap of hashed keys is built by built-in aggregation and broadcast: 16 bits for each wanted key, but at most `most_bits` (16 MB) in all,
    whatever the input.  It never loses a wanted row; with more keys than bits it only lets more of the others through.
    """
    spark = docs.sparkSession
    page = 32768  # bits of one bitmap value
    n = wanted.count()
    bits = min(most_bits, max(page, 1 << (16 * max(1, n) - 1).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c.cast("bigint")), F.lit(bits))
    at = place(F.col(wanted.columns[0]))
    pages = wanted.select(at.alias("p")).groupBy(F.expr(f"p div {page}").alias("page")).agg(F.bitmap_construct_agg(F.expr(f"p % {page}")).alias("b"))
    bitmap = np.zeros(bits // 8, np.uint8)
    for r in pages.collect():  # at most bits / page rows
        own = np.frombuffer(r["b"], np.uint8)
        bitmap[r["page"] * page // 8 :][: len(own)] = own
    sent = spark.sparkContext.broadcast(bitmap)

    def run(batches):
        for b in batches:
            p = np.asarray(b.column(0), dtype=np.int64)
            on = (sent.value[p >> 3] >> (p & 7)) & 1 == 1
            yield pa.RecordBatch.from_arrays(b.columns[1:], schema=pa.schema(list(b.schema)[1:])).filter(pa.array(on))

    return docs.select(place(F.col(key)).alias("__place"), *docs.columns).mapInArrow(run, docs.schema)
