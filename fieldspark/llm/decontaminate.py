"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every word sequence inside any item.  Document words are streamed through it, keeping the length of the
longest match that ends at each word; where that reaches a window's length, the window's words are hit.  Only stretches of
a document whose neighbouring word pairs all come in some item are streamed: a match of two words or more lies inside one.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import ids_of, map_rows, texts_of

# Words: runs of ASCII digits, ASCII letters (lower-cased) and all characters beyond ASCII.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
OWN = "n_words bigint, n_hit bigint, item_ids array<string>, longest int, spans array<struct<start:int,end:int>>, clean_text string, dropped boolean"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class Automaton:
    """Generalised suffix automaton over word ids, with the windows that end in each state."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window, self.ids = window, {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        items = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items if words]
        for _, seq in items:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.items: dict[int, set[str]] = {}  # state of a full window -> items
        self.short: dict[int, dict[int, set[str]]] = {}  # state -> length of an item shorter than a window -> items
        self.least = window
        for name, seq in items:
            if len(seq) < window:
                self.least = min(self.least, len(seq))
                v = self._at(self._walk(seq), len(seq))
                self.short.setdefault(v, {}).setdefault(len(seq), set()).add(name)
                continue
            v = 0
            for i, c in enumerate(seq):
                v = self.next[v][c]
                if i + 1 >= window:
                    self.items.setdefault(self._at(v, window), set()).add(name)
        # the nearest state on the way to the root, itself included, that ends a short item
        self.up = [-1] * len(self.len)
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            self.up[v] = v if v in self.short else self.up[self.link[v]] if self.link[v] > 0 else -1
        pairs = {(a << 32) | b for _, seq in items for a, b in zip(seq, seq[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len

        def split(p: int, q: int) -> int:
            clone = len(length)
            length.append(length[p] + 1)
            nxt.append(dict(nxt[q]))
            link.append(link[q])
            link[q] = clone
            while p >= 0 and nxt[p].get(c) == q:
                nxt[p][c] = clone
                p = link[p]
            return clone

        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else split(last, q)
        cur = len(length)
        length.append(length[last] + 1)
        nxt.append({})
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else split(p, q)
        return cur

    def _walk(self, seq: list[int]) -> int:
        v = 0
        for c in seq:
            v = self.next[v][c]
        return v

    def _at(self, v: int, length: int) -> int:
        """The state that holds the suffix of that length."""
        while self.len[self.link[v]] >= length:
            v = self.link[v]
        return v

    def stream(self, seq: list[int], hit: np.ndarray, found: set[str]) -> int:
        """Mark the words in windows and collect their items; the longest match."""
        nxt, link, length, window = self.next, self.link, self.len, self.window
        v = l = best = 0
        for i, c in enumerate(seq):
            while v and c not in nxt[v]:
                v = link[v]
                l = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                l += 1
            best = max(best, l)
            if l >= window:
                hit[i + 1 - window : i + 1] = True
                found |= self.items[self._at(v, window)]
            u = self.up[v]
            while u > 0:
                for n, names in self.short.get(u, {}).items():
                    if n <= l:
                        hit[i + 1 - n : i + 1] = True
                        found |= names
                u = self.up[link[u]] if link[u] > 0 else -1
        return best

    def match(self, words: list[bytes]) -> tuple[np.ndarray, set[str], int]:
        """The hit words' positions, the items with windows in the text, and the longest match."""
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        none = np.empty(0, np.int64)
        if len(ids) < self.least or not self.ids:
            return none, set(), 0
        known = ids >= 0
        if len(ids) > 1:
            pair = (ids[:-1] << 32) | ids[1:]
            at = np.flatnonzero(known[:-1] & known[1:])
            place = np.searchsorted(self.pairs, pair[at])
            joined = np.zeros(len(ids) - 1, bool)
            if len(self.pairs):
                joined[at] = self.pairs[np.minimum(place, len(self.pairs) - 1)] == pair[at]
            breaks = np.flatnonzero(~joined) + 1
        else:
            breaks = none
        starts, ends = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(ids)]])
        long = (ends - starts >= self.least) & known[starts]
        hits, found, best = [], set(), 0
        for s, e in zip(starts[long].tolist(), ends[long].tolist()):
            hit = np.zeros(e - s, bool)
            best = max(best, self.stream(ids[s:e].tolist(), hit, found))
            if hit.any():
                hits.append(np.flatnonzero(hit) + s)
        return (np.concatenate(hits) if hits else none), found, best


def _spans(positions: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbouring positions as [start, end)."""
    if not len(positions):
        return []
    cut = np.flatnonzero(np.diff(positions) > 1) + 1
    return [(int(p[0]), int(p[-1]) + 1) for p in np.split(positions, cut)]


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from each span's first word to its last."""
    plain = np.frombuffer(text.translate(TABLE), np.uint8) != 32
    edge = np.diff(np.concatenate([[False], plain, [False]]).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out, at = [], 0
    for s, e in spans:
        out.append(text[at : first[s]])
        at = last[e - 1]
    return b"".join([*out, text[at:]])


def _blocks(items: DataFrame, limit: int) -> list[DataFrame]:
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // limit))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def _finish(hits: list[tuple[np.ndarray, set[str], int]], texts: list[bytes], counts: list[int], most: float) -> list[pa.Array]:
    spans = [_spans(h[0]) for h in hits]
    clean = [t if not s else _without(t, s) for t, s in zip(texts, spans)]
    return [
        pa.array(counts, pa.int64()),
        pa.array([len(h[0]) for h in hits], pa.int64()),
        pa.array([sorted(h[1]) for h in hits], pa.list_(pa.string())),
        pa.array([h[2] for h in hits], pa.int32()),
        pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
        pa.array([c.decode() for c in clean], pa.string()),
        pa.array([bool(n) and len(h[0]) > most * n for h, n in zip(hits, counts)], pa.bool_()),
    ]


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, coverage: float = 0.5, block_bytes: int = 8 << 20) -> DataFrame:
    """All rows with OWN added.

    n_words, n_hit: words, and those inside an occurrence of a window (any `window` consecutive words of an item, or all words
    of a shorter one).  item_ids: the items with windows in the text, sorted as strings.  longest: the longest match in words,
    among stretches that could hold a window.  spans: hit words as [start, end).  clean_text: the text without those spans
    (null text gives an empty one).  dropped: more than `coverage` of the words are hit.

    The items are read in blocks of about `block_bytes` of text, each built into one automaton and broadcast: a larger benchmark means more passes over the
    documents, not a larger broadcast.  Null or empty text has no words; items without words have no windows; an empty
    benchmark hits nothing.  Repeated rows are each judged, texts of any length as a whole, and input columns with a result's name are replaced.  Null item_id counts as the text ''.
    """
    spark = docs.sparkSession
    blocks = _blocks(items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text")), block_bytes)
    ready = [spark.sparkContext.broadcast(Automaton([(r["item_id"], words_of(r["text"].encode())) for r in b.collect()], window)) for b in blocks[:1]]

    def whole(sent=ready[0]):
        auto = sent.value

        def f(b: pa.RecordBatch) -> list[pa.Array]:
            texts = texts_of(b)
            words = [words_of(t) for t in texts]
            return _finish([auto.match(w) for w in words], texts, [len(w) for w in words], coverage)

        return f

    if len(blocks) == 1:
        return map_rows(docs, whole, OWN)

    found = None
    keyed = docs.withColumn("__key", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    for k, b in enumerate(blocks):
        sent = ready[0] if not k else spark.sparkContext.broadcast(Automaton([(r["item_id"], words_of(r["text"].encode())) for r in b.collect()], window))

        def part(sent=sent):
            auto = sent.value

            def f(b: pa.RecordBatch) -> list[pa.Array]:
                hits = [auto.match(words_of(t)) for t in texts_of(b)]
                return [pa.array([h[0].tolist() for h in hits], pa.list_(pa.int32())), pa.array([sorted(h[1]) for h in hits], pa.list_(pa.string())), pa.array([h[2] for h in hits], pa.int32())]

            return f

        own = map_rows(keyed, part, "__hits array<int>, __items array<string>, __longest int", keep=["__key"]).where(F.size("__items") > 0).distinct()
        found = own if found is None else found.unionByName(own)
    found = found.groupBy("__key").agg(F.flatten(F.collect_list("__hits")).alias("__hits"), F.flatten(F.collect_list("__items")).alias("__items"), F.max("__longest").alias("__longest"))

    def last():
        def f(b: pa.RecordBatch) -> list[pa.Array]:
            texts = texts_of(b)
            col = lambda n: ids_of(b, n).to_pylist()
            hits = [(np.unique(np.array(h or [], np.int64)), set(i or []), m or 0) for h, i, m in zip(col("__hits"), col("__items"), col("__longest"))]
            return _finish(hits, texts, [len(words_of(t)) for t in texts], coverage)

        return f

    out = map_rows(keyed.join(found, "__key", "left"), last, OWN, read=["doc_id", "text", "__hits", "__items", "__longest"])
    return out.drop("__key", "__hits", "__items", "__longest")

