"""Phrases of two to four words that occur together more often than their parts allow, by depth-limited count tries.

A shard of text becomes one trie a language: all windows of up to four words, sorted, with counts; a trie's nodes are the windows' prefixes.
Splitters cut the sorted windows into ranges; each range's runs, front-coded, meet in one task, which merges them and counts nodes.  Nodes whose range is
cut by a splitter are summed afterwards.  On the merged trie, the walk in sorted order gives each node its ancestors' counts (a phrase's left parts), and
the link from a node to the one without its first word gives those of right parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import eased, ids_of, ready, shards_for, slices, stage, texts_of

DEPTH = 4
MARK = b"\xff"  # no byte of UTF-8: ends a piece
#: A-Z become a-z; what ends a piece becomes the mark, and a tab a blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else 0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
SHARD_BYTES = 4 << 20  # of text in a trie
RANGE_BYTES = 16 << 20  # of text whose windows meet in a task
HELD = 2_000_000  # windows that a merging task holds before it sums equal ones
RUN = "part int, lang string, words binary, shared binary, ids binary, counts binary"
NODE = "lang string, words array<string>, f bigint, edge boolean"


class _Numbers(dict):
    """Words' numbers in order of first sight, from 1; 0 is the mark."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _ids(text: bytes, numbers: _Numbers) -> np.ndarray:
    words = text.translate(TABLE).replace(MARK, b" \xff ").split(b" ")
    ids = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
    return ids[ids != 1]  # the empty string between two blanks


def _numbers() -> _Numbers:
    n = _Numbers()
    n[MARK], n[b""] = 0, 1
    return n


def _windows(ids: np.ndarray) -> list[np.ndarray]:
    """Columns of the windows of four that begin with each word; 0 from the end of the piece on."""
    padded = np.concatenate([ids, np.zeros(DEPTH, ids.dtype)])
    cols = [padded[k : k + len(ids)].copy() for k in range(DEPTH)]
    for k in range(1, DEPTH):
        cols[k][cols[k - 1] == 0] = 0
    begins = cols[0] != 0
    return [c[begins] for c in cols]


def _keys(cols: list[np.ndarray]) -> np.ndarray:
    """One number for each window, in the windows' order."""
    base = np.int64(max((int(c.max()) for c in cols if len(c)), default=0) + 1)
    pairs = [cols[0] * base + cols[1], cols[2] * base + cols[3]]
    if base < 1 << 15:
        return pairs[0] * (base * base) + pairs[1]
    ranks = [np.unique(p, return_inverse=True)[1].astype(np.int64) for p in pairs]
    return ranks[0] * np.int64((int(ranks[1].max()) if len(ranks[1]) else 0) + 1) + ranks[1]


def _counted(cols: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct windows in order, with the sums of their counts."""
    if not len(cols[0]):
        return cols, np.zeros(0, np.int64)
    keys = _keys([c.astype(np.int64) for c in cols])
    order = np.argsort(keys, kind=None if counts is None else "stable")  # runs that are sorted already are merged
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    total = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts[order], first)
    at = order[first]
    return [c[at] for c in cols], total


def _sorted_words(numbers: _Numbers, cols: list[np.ndarray]) -> tuple[list[bytes], list[np.ndarray]]:
    """The words of `numbers` in byte order, and the windows in numbers of that order (from 1)."""
    words = sorted(w for w, i in numbers.items() if i > 1)
    rank = np.zeros(len(numbers), np.int32)
    rank[[numbers[w] for w in words]] = np.arange(1, len(words) + 1)
    return words, [rank[c] for c in cols]


def _shared(cols: list[np.ndarray]) -> np.ndarray:
    """How many words each window has in common with the one before."""
    same, out = np.ones(len(cols[0]), bool), np.zeros(len(cols[0]), np.uint8)
    same[:1] = False
    for c in cols:
        same[1:] &= c[1:] == c[:-1]
        out += same
    return out


def _coded(part: int, lang: str, words: list[bytes], cols: list[np.ndarray], counts: np.ndarray) -> dict:
    """A run of windows: its own words, and of each window the words that the one before has not."""
    used = np.unique(np.concatenate(cols))
    used = used[used > 0]
    own = np.zeros(len(words) + 1, np.uint32)
    own[used] = np.arange(1, len(used) + 1)
    shared = _shared(cols)
    left = np.stack([own[c] for c in cols], 1)[np.arange(DEPTH) >= shared[:, None]]
    return {"part": part, "lang": lang, "words": b" ".join(words[i - 1] for i in used.tolist()), "shared": shared.tobytes(), "ids": left.astype(np.uint16 if len(used) < 65536 else np.uint32).tobytes(), "counts": counts.astype(np.uint32).tobytes()}


def _decoded(row: dict) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    words = row["words"].split(b" ")
    shared = np.frombuffer(row["shared"], np.uint8)
    ids = np.frombuffer(row["ids"], np.uint16 if len(words) < 65536 else np.uint32)
    given = np.arange(DEPTH) >= shared[:, None]
    table = np.zeros((len(shared), DEPTH), np.int64)
    table[given] = ids
    cols = []
    for k in range(DEPTH):  # a word that isn't given is the last one given above it
        last = np.maximum.accumulate(np.where(given[:, k], np.arange(len(shared)), 0))
        cols.append(table[last, k])
    return words, cols, np.frombuffer(row["counts"], np.uint32).astype(np.int64)


def _cuts(words: list[bytes], cols: list[np.ndarray], splitters: list[tuple[bytes, ...]]) -> np.ndarray:
    """How many of the sorted windows lie before each splitter."""
    order = np.array(words, object)

    def doubled(w: bytes) -> int:  # words are 2, 4, ..; what lies between two words is odd
        at = int(np.searchsorted(order, w))
        return 2 * at + (2 if at < len(words) and words[at] == w else 1)

    base = np.int64(2 * len(words) + 4)
    split = np.array([[doubled(w) for w in s] + [0] * (DEPTH - len(s)) for s in splitters], np.int64).reshape(-1, DEPTH)
    own = [2 * c.astype(np.int64) for c in cols]
    k1, k2, s1, s2 = own[0] * base + own[1], own[2] * base + own[3], split[:, 0] * base + split[:, 1], split[:, 2] * base + split[:, 3]
    low, high = np.searchsorted(k1, s1, "left"), np.searchsorted(k1, s1, "right")
    return np.array([a + np.searchsorted(k2[a:b], s) if a < b else a for a, b, s in zip(low.tolist(), high.tolist(), s2.tolist())], np.int64)


def _tries(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[str, list[bytes], list[np.ndarray], np.ndarray]]:
    """Each shard's trie of each language: words in order, windows, counts."""
    for b in slices(batches, limit=limit):
        by: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        for lang, text in zip(ids_of(b, "lang").to_pylist(), texts_of(b)):
            if text:
                numbers, got = by.setdefault(lang, (_numbers(), []))
                got += [_ids(text, numbers), np.zeros(1, np.int32)]
        for lang, (numbers, got) in by.items():
            words, cols = _sorted_words(numbers, _windows(np.concatenate(got)))
            if words:
                yield lang, words, *_counted(cols)


def _splitters(docs: DataFrame, parts: int, sample_bytes: int) -> dict[str, list[tuple[bytes, ...]]]:
    """Windows that cut the corpus into about `parts` ranges, from texts of about `sample_bytes` chosen by hash; they decide the balance only, not the result."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = min(1.0, sample_bytes / total) if total else 1.0
    chosen = docs.where(F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1)
    every = max(1, int(min(total, sample_bytes) / 6 / (64 * parts)))  # of windows, some six bytes each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, cols, counts in _tries(batches, SHARD_BYTES):
            at = np.searchsorted(np.cumsum(counts), np.arange(every // 2, int(counts.sum()), every), "right")
            named = [b" ".join(words[c[i] - 1] for c in cols if c[i]) for i in at.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(named, pa.binary())], names=["lang", "w"])

    rows = sorted((r["lang"], tuple(bytes(r["w"]).split(b" "))) for r in chosen.mapInArrow(run, "lang string, w binary").collect())  # some 64 a range
    cut = sorted({rows[len(rows) * k // parts] for k in range(1, parts)}) if rows else []
    out: dict[str, list[tuple[bytes, ...]]] = {}
    for n, (lang, w) in enumerate(cut):
        out.setdefault(lang, []).append((n + 1, w))
    return out


def _runs(docs: DataFrame, splitters: dict) -> DataFrame:
    """Each shard's tries, cut into ranges.  A language's windows before its first splitter belong to the range of the splitter before."""
    langs = sorted(splitters)
    sent = docs.sparkSession.sparkContext.broadcast(splitters)  # 64-odd bytes a range
    schema = pa.schema([("part", pa.int32()), ("lang", pa.string()), *[(c, pa.binary()) for c in ("words", "shared", "ids", "counts")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, cols, counts in _tries(batches, SHARD_BYTES):
            own = sent.value.get(lang, [])
            before = max((sent.value[x][-1][0] for x in langs if x < lang), default=0)
            cuts = [0, *_cuts(words, cols, [w for _, w in own]).tolist(), len(counts)]
            for part, a, b in zip([before, *[n for n, _ in own]], cuts[:-1], cuts[1:]):
                if a < b:
                    yield pa.RecordBatch.from_pylist([_coded(part, lang, words, [c[a:b] for c in cols], counts[a:b])], schema=schema)

    return docs.mapInArrow(run, RUN)


class _Merge:
    """The windows of a range and language, summed whenever many are held."""

    def __init__(self):
        self.numbers, self.cols, self.counts, self.held, self.limit = _numbers(), [], [], 0, HELD

    def add(self, row: dict) -> None:
        words, cols, counts = _decoded(row)
        name = np.concatenate([[0], np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words))]).astype(np.int32)
        self.cols.append([name[c] for c in cols])
        self.counts.append(counts)
        self.held += len(counts)
        if self.held > self.limit:
            cols, counts = self.summed()
            self.cols, self.counts, self.held = [cols], [counts], len(counts)
            self.limit = max(HELD, 2 * self.held)

    def summed(self) -> tuple[list[np.ndarray], np.ndarray]:
        return _counted([np.concatenate([c[k] for c in self.cols]) for k in range(DEPTH)], np.concatenate(self.counts))

    def nodes(self, lang: str, least: int) -> Iterator[pa.RecordBatch]:
        """Prefixes that occur `least` times, those on the way to the first and last window whatever their count, and the count of all windows."""
        cols, counts = self.summed()
        words, cols = _sorted_words(self.numbers, cols)
        cols, counts = _counted(cols, counts)
        names = np.array([b"", *words], object)
        new = np.zeros(len(counts), bool)
        new[:1] = True
        out: list[tuple[list[str], int, bool]] = [([], int(counts.sum()), True)]
        for k, c in enumerate(cols):
            new[1:] |= c[1:] != c[:-1]
            first = np.flatnonzero(new)
            total = np.add.reduceat(counts, first)
            edge = np.zeros(len(first), bool)
            edge[[0, -1]] = True
            keep = (c[first] != 0) & (edge | (total >= least))
            rows = zip(*[names[x[first[keep]]].tolist() for x in cols[: k + 1]])
            out += [([w.decode() for w in ws], n, e) for ws, n, e in zip(rows, total[keep].tolist(), edge[keep].tolist())]
        w, f, e = zip(*out)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(w), pa.string()), pa.array(w, pa.list_(pa.string())), pa.array(f, pa.int64()), pa.array(e, pa.bool_())], names=["lang", "words", "f", "edge"])


def count_tries(docs: DataFrame, least: int, sample_bytes: int = 32 << 20) -> DataFrame:
    """lang, words, f: all phrases of one to four words with at least `least` occurrences; and for each language the count of all its words, at words = []."""
    ready(docs.sparkSession)
    docs = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    splitters = _splitters(docs, max(shards_for(docs.sparkSession), total // RANGE_BYTES), sample_bytes)
    parts = 1 + max((n for own in splitters.values() for n, _ in own), default=0)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = None, None
        for b in eased(batches):
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                if (row["part"], row["lang"]) != at:
                    if now:
                        yield from now.nodes(at[1], least)
                    at, now = (row["part"], row["lang"]), _Merge()
                now.add(row)
        if now:
            yield from now.nodes(at[1], least)

    runs = _runs(docs, splitters).repartitionById(parts, F.col("part")).sortWithinPartitions("part", "lang")
    nodes = stage(runs.mapInArrow(merge, NODE), "nodes")
    # a node at the end of a range may lie in the next one too
    whole = nodes.where(~F.col("edge")).select("lang", "words", "f")
    edges = nodes.where("edge").groupBy("lang", "words").agg(F.sum("f").alias("f"))
    return whole.unionByName(edges).where((F.size("words") == 0) | (F.col("f") >= least))


def collocations(docs: DataFrame, least: int = 30, most: int = 2000, cover: int = 80) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `most` best phrases of two to four words that occur `least` times or more.

    Texts are lower-cased (A-Z), cut into pieces at `[.,;:!?]` and line ends, and pieces into words at blanks and tabs; a phrase lies within a piece, and all its occurrences count.
    a is the phrase's count; of its cuts into a left part (count l) and a right part (r) the one with the lowest score floor(2,000,000 a / (l + r)) counts, of equal ones
    that with the shorter left part.  A phrase goes if a longer one of at least `least` contains it and has `cover` percent of its count.  Order: score and a descending, phrase in byte order.
    n counts the language's words.  A null lang is `und`; null and empty texts have no words; repeated rows each count; other columns aren't read; an empty table gives
    an empty result.  Products are decimals of 38 digits, so nothing overflows.
    """
    trie = stage(count_tries(docs, least), "trie")
    words = F.col("words")
    totals = trie.where(F.size(words) == 0).select("lang", F.col("f").alias("n"))  # one row a language
    nodes = trie.where(F.size(words) > 0)
    # the walk: in sorted order the last node of a depth is the ancestor at that depth
    walk = Window.partitionBy("lang", words[0]).orderBy("words").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lefts = F.array(*[F.last(F.when(F.size(words) == k, F.col("f")), ignorenulls=True).over(walk) for k in range(1, DEPTH)])
    nodes = stage(nodes.withColumn("lefts", F.slice(lefts, 1, F.size(words) - 1)).withColumn("phrase", F.array_join(words, " ")), "walk")
    rest = F.array_join(F.slice(words, 2, DEPTH), " ")
    # the links: a node's right parts are the node without its first word, and that one's right parts
    linked = nodes.where(F.size(words) == 1).withColumn("rights", F.array().cast("array<bigint>"))
    out = None
    for k in range(2, DEPTH + 1):
        to = linked.select("lang", F.col("phrase").alias("rest"), F.concat(F.array("f"), "rights").alias("rights"))
        linked = stage(nodes.where(F.size(words) == k).withColumn("rest", rest).join(to, ["lang", "rest"]).select(*nodes.columns, "rights"), "linked")
        out = linked if out is None else out.unionByName(linked)
    cuts = F.transform(F.sequence(F.lit(1), F.size(words) - 1), lambda k: F.struct(k.alias("k"), F.element_at("lefts", k).alias("l"), F.element_at("rights", k).alias("r")))
    scored = out.withColumn("cut", F.explode(cuts)).select("lang", "words", "phrase", F.col("f").alias("a"), "cut.*")
    scored = scored.withColumn("score", F.expr("CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"))
    best = scored.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "words", "phrase", "a", "c.l", "c.r", "c.score")
    longer = out.where(F.size(words) > 2).select("lang", F.col("f").alias("longer"), F.explode(F.flatten(F.transform(F.sequence(F.lit(2), F.size(words) - 1), lambda n: F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " "))))).alias("phrase"))
    over = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = F.expr(f"CAST(100 AS DECIMAL(3,0)) * CAST(longer AS DECIMAL(20,0)) >= CAST({cover} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0))")
    left = best.join(over, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    ranked = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= most)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
