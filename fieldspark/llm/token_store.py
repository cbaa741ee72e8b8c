"""Token ids in shard files, found again by key through a minimal perfect hash index.

A shard is two files.  `shard-N.bin` is the raw payload: little-endian ids of all its documents, in ascending doc_id order.
`shard-N.idx` maps a document key to its place: a minimal perfect hash (levels of bit arrays; a key's number is the rank of
the first bit that it alone sets) gives a slot, which stores the key's fingerprint, its first row and its number of rows; rows
store where they end in the payload.  A look-up costs a few hashes, one slot and one read, whatever the number of documents.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm.common import mix, shards_for, slices, stage, staged_path, texts_of
from fieldspark.llm.tokens import ENCODE_BYTES, Encoder

MAGIC = b"FSIDX01\n"
NULL_KEY = np.uint64(0x6E756C6C)
MANIFEST = "shard int, first_id bigint, last_id bigint, has_null boolean, n_rows bigint, n_tokens bigint"


def key_hashes(ids: pa.Array) -> np.ndarray:
    """64-bit hashes of keys; null is a key of its own."""
    null = np.asarray(ids.is_null())
    h = mix(np.asarray(ids.fill_null(0), dtype=np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return np.where(null, mix(np.array([NULL_KEY]))[0], h)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys by levels of bit arrays."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        counts = np.unpackbits(words.view(np.uint8)).reshape(-1, 64).sum(1, dtype=np.int64) if len(words) else np.zeros(0, np.int64)
        self.rank = np.concatenate([[0], np.cumsum(counts)])
        self.base = np.concatenate([[0], np.cumsum(sizes)])[:-1] if len(sizes) else np.zeros(0, np.int64)

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 2.0) -> PerfectHash:
        sizes, bits = [], []
        while len(keys):
            size = max(64, -(-int(gamma * len(keys)) // 64) * 64)
            at = cls._place(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            keys = keys[~alone[at]]
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), np.packbits(flat, bitorder="little").view(np.uint64))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ np.uint64((level + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)) % np.uint64(size)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number; for a key that wasn't built in, -1 or any number."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            bit = self._place(keys[left], level, size) + self.base[level]
            word, low = bit >> 6, (bit & 63).astype(np.uint64)
            hit = (self.words[word] >> low) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << low) - np.uint64(1))
            n = self.rank[word] + np.unpackbits(below.view(np.uint8).reshape(-1, 8), axis=1).sum(1, dtype=np.int64)
            out[left[hit]] = n[hit]
            left = left[~hit]
        return out


def index_bytes(keys: np.ndarray, row_ends: np.ndarray, width: int) -> bytes:
    """The .idx file of rows with these key hashes (equal keys next to each other) and payload ends."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    own = keys[first]
    h = PerfectHash.build(own)
    at = h.find(own)
    prints, rows, counts = np.empty(len(own), np.uint32), np.empty(len(own), np.int64), np.empty(len(own), np.int64)
    prints[at] = (own >> np.uint64(32)).astype(np.uint32)
    rows[at] = first
    counts[at] = np.diff(np.append(first, len(keys)))
    out = io.BytesIO()
    out.write(MAGIC)
    for a in (np.array([width], np.int64), h.sizes, h.words, prints, rows, counts, row_ends.astype(np.int64)):
        np.lib.format.write_array(out, a, allow_pickle=False)
    return out.getvalue()


class Shard:
    """One shard's files, opened for look-ups."""

    def __init__(self, files: pafs.FileSystem, stem: str):
        with files.open_input_file(f"{stem}.idx") as f:
            data = io.BytesIO(f.read())
        if data.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{stem}.idx is no index")
        width, sizes, words, self.prints, self.rows, self.counts, self.ends = [np.lib.format.read_array(data, allow_pickle=False) for _ in range(7)]
        self.hash, self.dtype = PerfectHash(sizes, words), np.dtype(f"<u{int(width[0])}")
        self.payload = files.open_input_file(f"{stem}.bin")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key hash its first row and number of rows; 0 rows if the stored fingerprint differs."""
        slot = self.hash.find(keys)
        ok = slot >= 0
        ok[ok] = self.prints[slot[ok]] == (keys[ok] >> np.uint64(32)).astype(np.uint32)
        rows, counts = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        rows[ok], counts[ok] = self.rows[slot[ok]], self.counts[slot[ok]]
        return rows, counts

    def read(self, row: int) -> tuple[int, np.ndarray]:
        """A row's first position in the shard's payload, and its ids."""
        start = int(self.ends[row - 1]) if row else 0
        n = int(self.ends[row]) - start
        raw = self.payload.read_at(n * self.dtype.itemsize, start * self.dtype.itemsize)
        return start, np.frombuffer(raw, self.dtype)


def _open(root: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(root)


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as pyarrow reads it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    full = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    return "file://" + full[5:] if full.startswith("file:/") and not full.startswith("file://") else full


class TokenStore:
    """Shard files below a root, and their manifest (one row a shard)."""

    def __init__(self, spark: SparkSession, root: str, manifest: DataFrame):
        self.spark, self.root, self.manifest = spark, root, manifest

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows of the documents with the given doc_ids (column doc_id; repeated keys count once): doc_id, shard, start (ids of all documents before), ids.

        ids are little-endian unsigned 32-bit integers in one binary value.  A doc_id with several rows gives them all; one that
        isn't stored gives none.  Keys are routed to shards by the manifest's ranges and found by each shard's perfect hash.
        """
        root = self.root
        rows = self.manifest.orderBy("shard").collect()  # one row a shard
        shards = np.array([r["shard"] for r in rows], np.int64)
        last = np.array([r["last_id"] if r["last_id"] is not None else -(1 << 63) for r in rows], np.int64)
        starts = {r["shard"]: s for r, s in zip(rows, np.concatenate([[0], np.cumsum([r["n_tokens"] for r in rows])]).tolist())}
        if not rows:
            return self.spark.createDataFrame([], "doc_id bigint, shard int, start bigint, ids binary")

        def route(batches):
            for b in batches:
                ids = b.column(0)
                at = np.searchsorted(last, np.asarray(ids.fill_null(-(1 << 63)), dtype=np.int64))
                at = np.where(np.asarray(ids.is_null()), 0, np.minimum(at, len(shards) - 1))
                yield pa.RecordBatch.from_arrays([ids, pa.array(shards[at].astype(np.int32))], ["doc_id", "shard"])

        def find(batches):
            files, base = _open(root)
            opened: dict[int, Shard] = {}
            for b in batches:
                ids, own = b.column(0), np.asarray(b.column(1))
                keys = key_hashes(ids)
                for s in np.unique(own).tolist():
                    if s not in opened:
                        opened.clear()  # rows come sorted by shard
                        opened[s] = Shard(files, f"{base}/shard-{s:06d}")
                    shard = opened[s]
                    which = np.flatnonzero(own == s)
                    first, counts = shard.find(keys[which])
                    out_id, out_start, out_ids, size = [], [], [], 0
                    for i, r, n in zip(which.tolist(), first.tolist(), counts.tolist()):
                        for row in range(r, r + n):
                            start, got = shard.read(row)
                            out_id.append(i)
                            out_start.append(starts[s] + start)
                            out_ids.append(got.astype("<u4").tobytes())
                            size += len(out_ids[-1])
                        if size > 4 << 20:
                            yield _rows(ids, s, out_id, out_start, out_ids)
                            out_id, out_start, out_ids, size = [], [], [], 0
                    if out_id:
                        yield _rows(ids, s, out_id, out_start, out_ids)

        routed = keys.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct().mapInArrow(route, "doc_id bigint, shard int")
        return routed.repartition(len(rows), "shard").sortWithinPartitions("shard").mapInArrow(find, "doc_id bigint, shard int, start bigint, ids binary")


def _rows(ids: pa.Array, shard: int, at: list[int], starts: list[int], got: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), pa.array([shard] * len(at), pa.int32()), pa.array(starts, pa.int64()), pa.array(got, pa.binary())], ["doc_id", "shard", "start", "ids"])


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, root: str | None = None, n_shards: int | None = None, width: int = 2) -> TokenStore:
    """Encode every text and write shard files in ascending doc_id order.

    Null text counts as empty (it has the end id alone); null doc_ids come first; rows with equal doc_ids are ordered by a hash of their text.
    Shards are ranges of doc_id; equal ids share one.  An empty table writes no shard.  `width` is bytes an id: 2 needs ids below 65536.
    Columns besides doc_id and text are not stored, whatever their names; texts of any length are encoded as a whole.  A task writes its files under its attempt's name and renames them when
    they are whole, so a repeated task leaves the same files.
    """
    spark = docs.sparkSession
    root = _qualified(spark, root or staged_path(spark, "tokens"))
    n = n_shards or shards_for(spark)

    def write(batches):
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        files, base = _open(root)
        stem = f"{base}/shard-{shard:06d}"
        enc, keys, ends, total, first, last, null = Encoder(tokenizer_path), [], [], 0, None, None, False
        sink = None
        for b in slices(batches, limit=ENCODE_BYTES):
            if not b.num_rows:
                continue
            if sink is None:
                files.create_dir(base, recursive=True)
                sink = files.open_output_stream(f"{stem}.bin.{attempt}")
            flat, sizes = enc.encode(texts_of(b), end_id)
            if width == 2 and len(flat) and int(flat.max()) > 65535:
                raise ValueError("an id needs more than two bytes: pass width=4")
            sink.write(flat.astype(f"<u{width}").tobytes())
            ids = b.column(b.schema.get_field_index("doc_id"))
            keys.append(key_hashes(ids))
            ends.append(total + np.cumsum(sizes))
            total += len(flat)
            known = ids.drop_null()
            null |= len(known) < len(ids)
            if len(known):
                first = known[0].as_py() if first is None else first
                last = known[-1].as_py()
        if sink is None:
            return
        sink.close()
        all_keys, all_ends = np.concatenate(keys), np.concatenate(ends)
        with files.open_output_stream(f"{stem}.idx.{attempt}") as f:
            f.write(index_bytes(all_keys, all_ends, width))
        for kind in ("bin", "idx"):
            files.move(f"{stem}.{kind}.{attempt}", f"{stem}.{kind}")
        yield pa.RecordBatch.from_pylist([{"shard": shard, "first_id": first, "last_id": last, "has_null": null, "n_rows": len(all_keys), "n_tokens": total}], schema=pa.schema([("shard", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("has_null", pa.bool_()), ("n_rows", pa.int64()), ("n_tokens", pa.int64())]))

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    ordered = source.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    return TokenStore(spark, root, stage(ordered.mapInArrow(write, MANIFEST), "manifest"))

