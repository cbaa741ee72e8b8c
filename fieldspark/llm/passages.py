"""Removal of long repeated passages with run-length indexes.

A byte goes if it lies in a string of `least` bytes that starts anywhere else too.  All strings of that length are compared,
in three steps.

1. Each window of `least` bytes has one anchor: its leftmost least-hashed 32-byte gram.  Neighbouring windows of one anchor are
   a run (cut in three by the anchor's place in the window, so that all windows of a run share a core of most of their
   bytes).  Runs with equal core form a group, and runs with equal content repeat each other as a whole.
2. Only groups with different contents need bytes: one context for each content.  Contexts are gathered by group, and a
   run-length index is built over each batch of groups: the Burrows-Wheeler transform of the contexts, compressed to its
   runs, with the text positions sampled at run starts and run ends.
3. Contexts are streamed through their index.  A position's match with its neighbour in suffix order is computed at run ends
   only; at other positions it is one less than at the position before.  The longer of the matches with both neighbours is
   the matching statistic against everything else, and windows where it reaches `least` are marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import carried, eased, ids_of, map_rows, mix, odd_numbers, relax, shards_for, slices, stage, texts_of
from fieldspark.llm.near_dedup import _blocks

GRAM = 32
SEGMENT = LOT = 1 << 20  # longer texts are read in overlapping parts; so much is looked at once
BYTE = np.random.default_rng(41).integers(0, 1 << 63, 256, dtype=np.uint64)
FACTORS = odd_numbers(5, 42)
PLACE = np.uint64((1 << 24) - 1)
OWN = "n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:bigint,end:bigint>>, kept binary, clean_text string"
RUN = np.dtype([("g", "<u8"), ("c", "<u8"), ("rid", "<i8"), ("lo", "<u4"), ("hi", "<u4"), ("n", "<u4")])
MARK = np.dtype([("rid", "<i8"), ("lo", "<u4"), ("hi", "<u4")])


def row_key() -> Column:
    """A row's name: its id and text."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))


def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """The least of each `w` neighbours, from running minima forwards and backwards in blocks of `w`."""
    n = len(x)
    padded = np.full(-(-n // w) * w, ~np.uint64(0))
    padded[:n] = x
    rows = padded.reshape(-1, w)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - w + 1], forward[w - 1 : n])


def _lots(pieces: list[bytes]) -> Iterator[slice]:
    """Neighbouring pieces of at most LOT bytes together, or one piece."""
    lo = held = 0
    for k, p in enumerate(pieces):
        if k > lo and held + len(p) > min(LOT, int(PLACE) + 1):
            yield slice(lo, k)
            lo, held = k, 0
        held += len(p)
    if pieces:
        yield slice(lo, len(pieces))


def runs_of(pieces: list[bytes], least: int) -> tuple[np.ndarray, ...] | None:
    """Runs of windows in texts put in a row: (piece, core hash, content hash, first window, last window), windows counted within the piece."""
    buf = np.frombuffer(b"".join(pieces), np.uint8)
    if len(buf) > int(PLACE) + 1:
        raise ValueError(f"{len(buf)} bytes at once are more than anchors have places for")
    sizes = np.array([len(p) for p in pieces], np.int64)
    if len(buf) < least:
        return None
    owner = np.repeat(np.arange(len(pieces)), sizes)
    windows = np.flatnonzero(owner[: len(buf) - least + 1] == owner[least - 1 :])
    if not len(windows):
        return None
    h, step = BYTE[buf], 1
    for f in FACTORS:
        h = h[:-step] * f + h[step:]
        step *= 2
    h = (mix(h) & ~PLACE) | np.arange(len(h), dtype=np.uint64)  # equal hashes: the leftmost
    width = least - GRAM + 1
    anchor = (_window_min(h, width) & PLACE).astype(np.int64)[windows]
    cut = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)]))
    at, lo, hi = anchor[cut], windows[cut], windows[np.append(cut[1:], len(windows)) - 1]
    part = -(-width // 3)
    first, last = (at - hi) // part, (at - lo) // part
    n = last - first + 1
    again = np.repeat(np.arange(len(at)), n)
    q = first[again] + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    at = at[again]
    far = np.minimum(q * part + part - 1, width - 1)  # of the part's windows, how far before the anchor they start at most
    lo, hi = np.maximum(lo[again], at - far), np.minimum(hi[again], at - q * part)
    view = memoryview(buf)
    digest = xxhash.xxh3_64_intdigest
    core = np.array([digest(view[a:b], seed=s) for a, b, s in zip((at - q * part).tolist(), (at - far + least).tolist(), q.tolist())], np.uint64)
    content = np.array([digest(view[a : b + least], seed=s) for a, b, s in zip(lo.tolist(), hi.tolist(), (at - lo).tolist())], np.uint64)
    start = (np.cumsum(sizes) - sizes)[owner[lo]]
    return owner[lo], core, content, lo - start, hi - start


def _find_runs(least: int, shards: int, flush: int = 300_000):
    """Runs dealt by core as blocks, from rows (rid, start, text).  Runs that repeat within the task are marked here, and one of them goes on for all."""

    def emit(parts: list[np.ndarray]) -> pa.RecordBatch:
        rows = np.concatenate(parts)
        rows = rows[np.lexsort((rows["lo"], rows["rid"], rows["c"], rows["g"]))]
        new = np.concatenate([[True], (rows["g"][1:] != rows["g"][:-1]) | (rows["c"][1:] != rows["c"][:-1])])
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(rows)))
        heads = rows[first]
        heads["n"] = n
        mine = rows[np.repeat(n, n) > 1]
        marks = np.zeros(len(mine), MARK)
        for k in MARK.names:
            marks[k] = mine[k]
        a = dict(_blocks((heads["g"] % np.uint64(shards)).astype(np.int32), [heads]))
        b = dict(_blocks((mix(marks["rid"].view(np.uint64)) % np.uint64(shards)).astype(np.int32), [marks]))
        keys = sorted({*a, *b})
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([a.get(k, [b""])[0] for k in keys], pa.binary()), pa.array([b.get(k, [b""])[0] for k in keys], pa.binary())], ["shard", "runs", "marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in slices(batches, limit=1 << 19):
            pieces, rid, base = [], [], []
            for r, at, t in zip(np.asarray(ids_of(b, "rid")).tolist(), ids_of(b, "start").to_pylist(), texts_of(b)):
                for s in range(0, max(1, len(t) - least + 1), SEGMENT):
                    pieces.append(t[s : s + SEGMENT + least - 1])
                    rid.append(r)
                    base.append(at + s)
            for lot in _lots(pieces):
                found = runs_of(pieces[lot], least)
                if found is None:
                    continue
                piece, core, content, lo, hi = found
                rows = np.zeros(len(lo), RUN)
                at = np.array(base[lot], np.int64)[piece]
                rows["g"], rows["c"], rows["rid"] = core, content, np.array(rid[lot], np.int64)[piece]
                rows["lo"], rows["hi"], rows["n"] = lo + at, hi + at, 1
                parts.append(rows)
                held += len(rows)
                if held >= flush:
                    yield emit(parts)
                    parts, held = [], 0
        if parts:
            yield emit(parts)

    return run


def _match_runs(hot: int):
    """Of each core's runs: marks (kind 0) of those whose content repeats; and where contents differ, one context of each: kind 1 if it
    comes once, 2 if it is marked already; 3 and 4 are the same for groups of more than `hot` contents."""

    def run(table: pa.Table) -> pa.Table:
        relax()
        rows = np.frombuffer(b"".join(table.column("runs").to_pylist()), RUN)
        marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), MARK)
        rows = rows[np.lexsort((rows["lo"], rows["rid"], rows["c"], rows["g"]))]
        if not len(rows):
            first, n, heads, share = (np.zeros(0, np.int64),) * 2 + (rows, np.zeros(0, bool))
        else:
            g_new = np.concatenate([[True], rows["g"][1:] != rows["g"][:-1]])
            first = np.flatnonzero(g_new | np.concatenate([[True], rows["c"][1:] != rows["c"][:-1]]))
            total = np.add.reduceat(rows["n"].astype(np.int64), first)
            n, heads = total, rows[first]
            again = np.repeat(total, np.diff(np.append(first, len(rows)))) > 1
            share = again & (rows["n"] == 1)  # the others were marked by their task
        out = [(np.zeros(len(marks), np.int8), np.zeros(len(marks), np.int64), marks), (np.zeros(int(share.sum()), np.int8), np.zeros(int(share.sum()), np.int64), rows[share])]
        if len(heads):
            group = np.cumsum(np.concatenate([[True], heads["g"][1:] != heads["g"][:-1]])) - 1
            contents, once = np.bincount(group), np.bincount(group, weights=n == 1)
            need = ((contents > 1) & (once > 0))[group]
            kind = (np.where(n == 1, 1, 2) + np.where(contents[group] > hot, 2, 0)).astype(np.int8)
            out.append((kind[need], heads["g"][need].view(np.int64), heads[need]))
        cat = lambda k: np.concatenate([x[2][k] for x in out]).astype(np.int64)
        return pa.table({"kind": pa.array(np.concatenate([x[0] for x in out])), "g": pa.array(np.concatenate([x[1] for x in out])), "rid": pa.array(cat("rid")), "lo": pa.array(cat("lo")), "hi": pa.array(cat("hi"))})

    return run


class RunIndex:
    """Run-length Burrows-Wheeler index of some byte strings, with positions sampled at both ends of runs."""

    def __init__(self, texts: list[bytes]):
        self.text = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(sizes) - sizes
        self.left = np.repeat(self.starts + sizes, sizes) - np.arange(len(self.text))  # bytes to the end of the own string
        order = self._sorted()
        before = self.text[order - 1].astype(np.int16)
        before[np.isin(order, self.starts)] = -1
        edge = np.concatenate([[True], (before[1:] != before[:-1]) | (before[1:] < 0), [True]])
        run = np.flatnonzero(edge)
        self.heads = before[run[:-1]]  # the compressed transform: one symbol and length for each run
        self.lengths = np.diff(run)
        self.first, self.last = order[run[:-1]], order[run[1:] - 1]

    def _sorted(self) -> np.ndarray:
        """Suffix order by prefix doubling; equal suffixes at string ends stay in the order of their strings."""
        n = len(self.text)
        padded = np.concatenate([self.text.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)])
        key = np.zeros(n, np.uint64)
        for k in range(7):
            key = (key << np.uint64(9)) | np.where(self.left > k, padded[k : k + n], np.uint64(0))
        order = np.argsort(key)
        rank = np.empty(n, np.int64)
        s = key[order]
        new = np.concatenate([[True], s[1:] != s[:-1]])
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        size, h = np.bincount(rank, minlength=n), 7
        open_ = np.flatnonzero((size[rank] > 1) & (self.left > h))
        while len(open_):
            r = rank[open_]
            # `left > h` holds for all of them: those of their group that have ended sort before, and aren't here
            key = (r.astype(np.uint64) << np.uint64(32)) | rank[open_ + h].astype(np.uint64)
            o = np.argsort(key)
            s, r = key[o], r[o]
            old = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            count = np.diff(np.append(old, len(r)))
            group_first = np.repeat(old, count)
            new = np.concatenate([[True], s[1:] != s[:-1]])
            new_first = np.flatnonzero(new)[np.cumsum(new) - 1]
            ended = np.repeat(size[r[old]] - count, count)
            value = r + ended + new_first - group_first
            rank[open_[o]] = value
            moved = np.flatnonzero(new)
            size[r[old]] -= count  # what is left under the old rank are the ended ones
            size[value[moved]] += np.diff(np.append(moved, len(s)))
            h *= 2
            open_ = open_[(size[rank[open_]] > 1) & (self.left[open_] > h)]
        return np.argsort((rank.astype(np.uint64) << np.uint64(32)) | np.arange(n, dtype=np.uint64))

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of suffixes."""
        most = np.minimum(self.left[a], self.left[b])
        out = np.zeros(len(a), np.int64)
        on = np.arange(len(a))
        while len(on):
            at = out[on]
            same = np.zeros(len(on), np.int64)
            going = np.ones(len(on), bool)
            for k in range(16):
                going &= at + k < most[on]
                i, j = np.minimum(a[on] + at + k, len(self.text) - 1), np.minimum(b[on] + at + k, len(self.text) - 1)
                going &= self.text[i] == self.text[j]
                same += going
            out[on] += same
            on = on[going]
        return out

    def matching_statistics(self) -> np.ndarray:
        """For each position the longest prefix of its suffix that starts at another position too."""
        n = len(self.text)
        best = np.zeros(n, np.int64)
        above = np.zeros(len(self.first), np.int64)
        above[1:] = self._common(self.last[:-1], self.first[1:])
        for sample, value in ((self.first, above), (self.last, np.append(above[1:], 0))):
            at, got = np.zeros(n, np.int64), np.zeros(n, np.int64)
            at[sample], got[sample] = sample, value
            at = np.maximum.accumulate(at)  # the last sampled position up to here
            best = np.maximum(best, got[at] - (np.arange(n) - at))
        return best


def _stretches(on: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], on.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


def _mark_contexts(least: int, batch_bytes: int = 1 << 18):
    """Marks of contexts (sorted by group) from one index for each batch of whole groups.  A batch has at most `batch_bytes`, or one group, whose contexts are at
    most `hot` of less than twice `least` bytes each.  Small batches stay in the processor's caches, and an index of them takes some 30 MB."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        texts = [r[4] for r in rows]
        index = RunIndex(texts)
        ms = index.matching_statistics()
        out = []
        for (_, kind, rid, lo, text), s in zip(rows, index.starts.tolist()):
            if kind == 1:
                out += [(rid, lo + a, lo + b) for a, b in _stretches(ms[s : s + len(text) - least + 1] >= least)]
        cols = list(zip(*out)) if out else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["rid", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group, size, last = [], [], 0, None
        for b in eased(batches):
            for row in zip(*[c.to_pylist() for c in b.columns]):  # g, kind, rid, lo, context
                if row[0] != last:
                    held, group, last = held + group, [], row[0]
                group.append(row)
                size += len(row[4])
                if size > batch_bytes and held:  # the groups before this one are whole
                    yield solve(held)
                    held, size = [], sum(len(r[4]) for r in group)
        if held or group:
            yield solve(held + group)

    return run


def _window_hashes(least: int):
    """For contexts of very large groups: a hash of every window, to be counted by value."""

    def run(batches):
        for b in batches:
            for g, kind, rid, lo, text in zip(*[c.to_pylist() for c in b.columns]):
                n = len(text) - least + 1
                view = memoryview(text)
                yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_64_intdigest(view[i : i + least]) - (1 << 63) for i in range(n)], pa.int64()), pa.array([kind] * n, pa.int32()), pa.array([rid] * n, pa.int64()), pa.array(range(lo, lo + n), pa.int64())], ["w", "kind", "rid", "lo"])

    return run


def repeated_windows(texts: DataFrame, least: int, hot: int = 512) -> DataFrame:
    """(rid, lo, hi): windows lo to hi of a row start a string of `least` bytes that starts elsewhere too.

    texts: rid, start, text; stretches of rows, each with its first byte's place in the row, or whole rows with start 0.  What is compared are the stretches.
    """
    shards = shards_for(texts.sparkSession)
    blocks = texts.select("rid", "start", "text").mapInArrow(_find_runs(least, shards), "shard int, runs binary, marks binary")
    found = stage(blocks.groupBy("shard").applyInArrow(_match_runs(hot), "kind tinyint, g bigint, rid bigint, lo bigint, hi bigint"), "runs")
    asked = found.where(F.col("kind") > 0).groupBy("rid").agg(F.collect_list(F.struct("g", F.col("kind").cast("int").alias("kind"), "lo", "hi")).alias("asked"))  # bounded by the text's length

    def cut(batches):
        for b in slices(batches, limit=1 << 19):
            out = []
            for rid, start, text, asked in zip(ids_of(b, "rid").to_pylist(), ids_of(b, "start").to_pylist(), texts_of(b), ids_of(b, "asked").to_pylist()):
                out += [(x["g"], x["kind"], rid, x["lo"], text[x["lo"] - start : x["hi"] - start + least]) for x in asked if start <= x["lo"] and x["hi"] + least <= start + len(text)]
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["g", "kind", "rid", "lo", "context"])

    schema = "g bigint, kind int, rid bigint, lo bigint, context binary"
    contexts = stage(texts.select("rid", "start", "text").join(asked, "rid").mapInArrow(cut, schema), "contexts")
    contexts = contexts.dropDuplicates(["g", "rid", "lo"])  # rows that are equal in id and text
    usual = contexts.where(F.col("kind") <= 2).repartition(shards, "g").sortWithinPartitions("g", "rid", "lo")
    marks = usual.mapInArrow(_mark_contexts(least), "rid bigint, lo bigint, hi bigint")
    each = contexts.where(F.col("kind") > 2).mapInArrow(_window_hashes(least), "w bigint, kind int, rid bigint, lo bigint")
    twice = each.groupBy("w").count().where(F.col("count") > 1).select("w")
    large = each.where(F.col("kind") == 3).join(twice, "w").select("rid", "lo", F.col("lo").alias("hi"))
    return found.where(F.col("kind") == 0).select("rid", "lo", "hi").unionByName(marks).unionByName(large)


def _covered(size: int, lo: np.ndarray, hi: np.ndarray, least: int) -> np.ndarray:
    """Which of a text's bytes lie in the strings that windows lo to hi start."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, lo, 1)
    np.add.at(edge, hi + least, -1)
    return np.cumsum(edge[:-1]) > 0


def _marks_of(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each row's (lo, hi)."""
    arr = ids_of(batch, column)
    ends = np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(arr), 0), dtype=np.int64))
    flat = arr.flatten()
    lo, hi = (np.asarray(flat.field(k), dtype=np.int64) for k in ("lo", "hi"))
    for s, e in zip([0, *ends.tolist()], ends.tolist()):
        yield lo[s:e], hi[s:e]


def _long_stretches(passage: int, least: int):
    """The stretches of marked windows of `passage` bytes that have room for one of `least`: a string of `least` bytes that repeats lies inside one."""

    def run(batches):
        for b in slices(batches):
            rows = []
            for rid, text, (lo, hi) in zip(ids_of(b, "rid").to_pylist(), texts_of(b), _marks_of(b, "near")):
                edge = np.zeros(len(text) + 2, np.int32)
                np.add.at(edge, lo, 1)
                np.add.at(edge, hi + 1, -1)
                rows += [(rid, s, text[s : e + passage]) for s, e in _stretches(np.cumsum(edge) > 0) if e + passage - s >= least]
            rid, start, text = zip(*rows) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(start, pa.int64()), pa.array(text, pa.binary())], ["rid", "start", "text"])

    return run


def remove_repeats(docs: DataFrame, least: int = 400, keep: list[str] | None = None, passage: int | None = None) -> DataFrame:
    """All rows with OWN added; `keep` names the input columns that pass through (all, if not given).

    n_bytes: UTF-8 bytes of the text.  n_removed: bytes in a string of `least` bytes that also starts anywhere else, in the same
    or another row; strings never reach over a text's end.  spans: maximal removed runs as [start, end).  kept: the other
    bytes.  clean_text: the same as text, without the parts of characters that lost other parts.  n_passage: if `passage` is given, bytes in a
    string of `passage` bytes (fewer than `least`) that also starts anywhere else; nothing is removed for it.

    Null text counts as empty.  Two rows with equal id and text are two places, and remove each other if they are long enough; so are rows of null doc_id.  An
    empty table gives an empty table; input columns with a result's name are replaced.  Texts longer than SEGMENT are read in parts that overlap
    by `least` - 1 bytes, so no string is lost; a task holds the longest text.  `least` and `passage` are at least twice the gram of 32 bytes.
    """
    if min(least, passage or least) < 2 * GRAM or passage and passage >= least:
        raise ValueError(f"least and passage are {2 * GRAM} or more, and passage is below least")
    keyed = docs.withColumn("rid", row_key())
    whole = keyed.select("rid", F.lit(0).cast("bigint").alias("start"), "text")
    grouped = lambda x, name: x.groupBy("rid").agg(F.collect_set(F.struct("lo", "hi")).alias(name))
    if passage:
        near = stage(grouped(repeated_windows(whole, passage), "near"), "marks")
        stretches = stage(keyed.select("rid", "text").join(near, "rid").mapInArrow(_long_stretches(passage, least), "rid bigint, start bigint, text binary"), "stretches")
        marks = near.join(grouped(repeated_windows(stretches, least), "far"), "rid", "left")
    else:
        marks = grouped(repeated_windows(whole, least), "far")

    def make():
        def f(b: pa.RecordBatch) -> list[pa.Array]:
            out, n_passage = [], []
            for text, (lo, hi) in zip(texts_of(b), _marks_of(b, "far")):
                gone = _covered(len(text), lo, hi, least)
                spans = _stretches(gone)
                rest = np.frombuffer(text, np.uint8)[~gone].tobytes() if spans else text
                out.append((len(text), int(gone.sum()), len(spans), [{"start": s, "end": e + 1} for s, e in spans], rest, rest.decode("utf-8", "ignore")))
            if passage:
                n_passage = [pa.array([int(_covered(len(text), lo, hi, passage).sum()) for text, (lo, hi) in zip(texts_of(b), _marks_of(b, "near"))], pa.int64())]
            n, r, s, x, k, t = zip(*out)
            return [pa.array(n, pa.int64()), pa.array(r, pa.int64()), pa.array(s, pa.int64()), pa.array(x, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(k, pa.binary()), pa.array(t, pa.string()), *n_passage]

        return f

    names = ["n_bytes", "n_removed", "n_spans", "spans", "kept", "clean_text", *["n_passage"] * bool(passage)]
    carry = carried(docs, names) if keep is None else keep
    return map_rows(keyed.join(marks, "rid", "left"), make, OWN + ", n_passage bigint" * bool(passage), keep=carry, read=["text", *["near"] * bool(passage), "far"])
