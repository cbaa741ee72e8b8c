"""Ranked lexical search by a two-level quantised index.

The index is cut by documents: a row holds some megabytes of text as postings.  Its first level has a byte for each posting, the part of the score
that the document decides, rounded upward; its second level has the exact frequency and the document's length.  A search adds up
bytes times word weights, which bounds each document's score from above and below; the k-th best lower bound over all rows is the mark, and every document whose
upper bound reaches it is scored exactly in integers.  No document is left out that could be among the k best.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import SLICE_BYTES, eased, ids_of, ranges, ready, slices, stage, texts_of

STEP = 3922  # of a byte: parts are below 1,000,000, so they round up to 1 .. 255 steps
SCALE = 1_000_000_000
#: Every ASCII byte that no term has becomes a blank; A-Z become a-z.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
INDEX = "n_docs bigint, doc_ids array<bigint>, terms binary, df binary, docs binary, bytes binary, tf binary, m binary"


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of other characters beyond ASCII; A-Z lower-cased."""
    return text.translate(TABLE).split()


@dataclass
class Index:
    """The staged rows, and what the scores need of all documents: how many have a term, and all their terms."""

    rows: DataFrame
    n_docs: int
    n_terms: int


def _sizes(docs: DataFrame) -> tuple[int, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = length = 0
        for b in slices(batches):
            for t in texts_of(b):
                k = len(terms_of(t))
                n, length = n + (k > 0), length + k
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([length])], names=["n", "length"])

    got = docs.select("text").mapInArrow(run, "n bigint, length bigint").agg(F.sum("n"), F.sum("length")).first()
    return got[0] or 0, got[1] or 0


def _row(ids: list, texts: list[bytes], n_docs: int, n_terms: int) -> dict | None:
    """The index of a batch of documents; those without a term are left out."""
    words: dict[bytes, int] = {}
    number, flat, freq, lengths, own = words.setdefault, [], [], [], []
    for i, text in zip(ids, texts):
        found = Counter(terms_of(text))
        if not found:
            continue
        own.append(i)
        lengths.append((len(found), sum(found.values())))
        flat.extend([number(w, len(words)) for w in found])
        freq.extend(found.values())
    if not own:
        return None
    size, total = np.array(lengths, np.int64).T
    m = np.array([10 + (90 * int(t) * n_docs) // n_terms for t in total], np.int64)
    order = np.array(sorted(words), object)
    rank = np.empty(len(words), np.int64)
    rank[[words[w] for w in order]] = np.arange(len(words))
    word, doc, tf = rank[np.array(flat, np.int64)], np.repeat(np.arange(len(own)), size), np.array(freq, np.int64)
    at = np.argsort(word, kind="stable")
    doc, tf = doc[at], tf[at]
    part = (SCALE * tf) // (1000 * tf + 8 * m[doc])
    return {
        "n_docs": len(own), "doc_ids": own, "terms": b" ".join(order.tolist()), "df": np.bincount(word, minlength=len(words)).astype(np.int32).tobytes(), "docs": doc.astype(np.int32).tobytes(),
        "bytes": (-(-part // STEP)).astype(np.uint8).tobytes(), "tf": tf.astype(np.int32).tobytes(), "m": m.tobytes(),
    }


def build(docs: DataFrame, row_bytes: int = SLICE_BYTES) -> Index:
    """The index of whole texts (doc_id, text), written to the shared folder; one pass counts, the next posts.

    A null or empty text, or one without a term, is in no row and never found.  Repeated rows are documents of their own.  Other columns aren't read.  A row
    holds about `row_bytes` of text, or one longer text.  An empty table gives an index without rows.
    """
    ready(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    n_docs, n_terms = _sizes(docs)
    schema = pa.schema([("n_docs", pa.int64()), ("doc_ids", pa.list_(pa.int64())), *[(c, pa.binary()) for c in ("terms", "df", "docs", "bytes", "tf", "m")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=row_bytes):
            row = _row(ids_of(b).to_pylist(), texts_of(b), n_docs, n_terms)
            if row:
                yield pa.RecordBatch.from_pylist([row], schema=schema)

    return Index(stage(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, INDEX), "lexical"), n_docs, n_terms)


class Queries:
    """A block of queries: their distinct terms, and each query's terms as numbers of those."""

    def __init__(self, texts: list[bytes]):
        each = [set(terms_of(t)) for t in texts]
        self.terms = sorted(set().union(*each)) if each else []
        at = {t: i for i, t in enumerate(self.terms)}
        self.own = [np.array(sorted(at[t] for t in ts), np.int64) for ts in each]
        self.weight = np.zeros(len(self.terms), np.int64)

    def weigh(self, df: dict[int, int], n_docs: int) -> None:
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(i, 0) + 1))) for i in range(len(self.terms))], np.int64)

    def places(self, terms: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Which of the block's terms a row has, and where."""
        there = {w: k for k, w in enumerate(terms.split(b" "))}
        found = [(i, there[t]) for i, t in enumerate(self.terms) if t in there]
        return tuple(np.array(found, np.int64).reshape(-1, 2).T)


class Row:
    """A row of the index as a block of queries sees it: the postings of their terms, one after the other."""

    def __init__(self, row: dict, queries: Queries):
        self.n = row["n_docs"]
        has, at = queries.places(row["terms"])
        df = np.frombuffer(row["df"], np.int32).astype(np.int64)
        start = np.cumsum(df) - df
        take = ranges(start[at], df[at])
        self.doc = np.frombuffer(row["docs"], np.int32)[take].astype(np.int64)
        self.weight = np.repeat(queries.weight[has], df[at])
        self.size = np.zeros(len(queries.terms), np.int64)
        self.size[has] = df[at]
        self.start = np.cumsum(self.size) - self.size
        self.high = np.frombuffer(row["bytes"], np.uint8)[take].astype(np.int64) * STEP
        if "tf" in row:
            self.tf, self.m, self.ids = np.frombuffer(row["tf"], np.int32)[take].astype(np.int64), np.frombuffer(row["m"], np.int64), row["doc_ids"]

    def postings(self, own: np.ndarray) -> np.ndarray:
        return ranges(self.start[own], self.size[own])

    def bounds(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Upper bounds of all documents' scores, and lower ones: a part lies above its byte less one step, and is 0 if the byte is.  Sums stay exact in doubles below 2^53."""
        w, high = self.weight[p], self.high[p]
        upper = np.bincount(self.doc[p], w * high, self.n).astype(np.int64)
        return upper, np.bincount(self.doc[p], w * np.maximum(high - STEP + 1, 0), self.n).astype(np.int64)

    def exact(self, p: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scores of some documents."""
        place = np.full(self.n, -1, np.int64)
        place[docs] = np.arange(len(docs))
        p = p[place[self.doc[p]] >= 0]
        out = np.zeros(len(docs), np.int64)
        np.add.at(out, place[self.doc[p]], self.weight[p] * ((SCALE * self.tf[p]) // (1000 * self.tf[p] + 8 * self.m[self.doc[p]])))
        return out


def _blocks(items: DataFrame, limit: int) -> Iterator[list]:
    """Queries in blocks of about `limit` bytes, read one after the other."""
    block, size = [], 0
    for r in items.toLocalIterator():
        block.append(r)
        size += len(r["text"] or "") + 64
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def _best(scored: DataFrame, k: int, *order) -> DataFrame:
    """The k first of each query: first of each query and salt, then of all."""
    salted = scored.withColumn("__s", F.pmod(F.spark_partition_id(), F.lit(64)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("q", "__s").orderBy(*order))).where(F.col("rank") <= k).drop("rank", "__s")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).where(F.col("rank") <= k)


def _search(index: Index, block: list, k: int) -> DataFrame:
    """q (a query's number in the block), rank, doc_id, score."""
    spark = index.rows.sparkSession
    queries = Queries([(r["text"] or "").encode() for r in block])
    sent = spark.sparkContext.broadcast(queries)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, total = sent.value, np.zeros(len(sent.value.terms), np.int64)
        for b in eased(batches):
            for r in b.to_pylist():
                has, at = q.places(r["terms"])
                total[has] += np.frombuffer(r["df"], np.int32)[at]
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there], pa.int64())], names=["t", "n"])

    counted = index.rows.select("terms", "df").mapInArrow(frequencies, "t int, n bigint").groupBy("t").agg(F.sum("n").alias("n")).collect()  # the block's terms
    queries.weigh({r["t"]: r["n"] for r in counted}, index.n_docs)
    sent.unpersist()
    weighed = spark.sparkContext.broadcast(queries)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = weighed.value
        best = np.zeros((len(q.own), k), np.int64)  # of this task, ascending
        for b in eased(batches):
            for r in b.to_pylist():
                row = Row(r, q)
                for i, own in enumerate(q.own):
                    p = row.postings(own)
                    if len(p):
                        low = row.bounds(p)[1]
                        low = low[low > best[i, 0]]
                        if len(low):
                            low = np.concatenate([best[i], np.partition(low, -k)[-k:] if len(low) > k else low])
                            best[i] = np.sort(low)[-k:]
        i, j = np.nonzero(best)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(best[i, j])], names=["q", "low"])

    low = index.rows.select("n_docs", "terms", "df", "docs", "bytes").mapInArrow(marks, "q int, low bigint")
    kth = _best(low, k, F.desc("low")).groupBy("q").agg(F.min("low").alias("low"), F.count("*").alias("n")).where(F.col("n") == k).collect()  # one number a query
    mark = np.ones(len(block), np.int64)  # with fewer documents than k, all that score count
    mark[[r["q"] for r in kth]] = [r["low"] for r in kth]
    needed = spark.sparkContext.broadcast(mark)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, least = weighed.value, np.maximum(needed.value, 1)
        kept: list[list[tuple]] = [[] for _ in q.own]
        for b in eased(batches):
            for r in b.to_pylist():
                row = Row(r, q)
                for i, own in enumerate(q.own):
                    p = row.postings(own)
                    docs = np.flatnonzero(row.bounds(p)[0] >= least[i]) if len(p) else p
                    if len(docs):
                        exact = row.exact(p, docs)
                        ids = [row.ids[d] for d in docs.tolist()]
                        kept[i] += [(-s, d is None, d or 0) for s, d in zip(exact.tolist(), ids) if s >= least[i]]
                        if len(kept[i]) > k:
                            kept[i] = sorted(kept[i])[:k]
        flat = [(i, None if none else d, -s) for i, rows in enumerate(kept) for s, none, d in rows]
        cols = list(zip(*flat)) if flat else [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], names=["q", "doc_id", "score"])

    found = index.rows.select("n_docs", "doc_ids", "terms", "df", "docs", "bytes", "tf", "m").mapInArrow(scores, "q int, doc_id bigint, score bigint")
    return _best(found, k, F.desc("score"), F.asc_nulls_last("doc_id"))


def search(index: Index, items: DataFrame, k: int = 10, block_bytes: int = 4 << 20) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0, equal scores by ascending doc_id (null last).

    A score sums weight times part over the item's distinct terms, in integers: the weight is floor(1000 ln((2N+2)/(2df+1))), the part 10^9 tf div (1000 tf + 8 m) with
    m = 10 + 90 n N div L.  Items are taken in blocks of about `block_bytes`, each against the whole index; a task holds k numbers for each item of a block.  Each row
    of items is a query of its own, rows with equal item_id too; an item without terms (null, empty) finds nothing; without items, or without documents, the result is empty.
    """
    spark = index.rows.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for block in _blocks(items.select("item_id", "text"), block_bytes):
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(block)], f"q int, item_id {kind}")
        found = _search(index, block, k)
        out = out.unionByName(found.join(F.broadcast(names), "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))  # a block's names
    return out
