"""Near-duplicate groups by a signature-coordinate inverted join.

A document is its set of distinct word shingles, and `coords` min-hashes of it.  Documents with equal sets are one class.
Each class is posted under every (coordinate, value); two classes are candidates if at least `matches` coordinates agree.
That join runs in two exchanges.  The first counts each list.  A class all but `matches` of whose coordinates are alone has
no candidate and leaves; of the others only the prefix stays: the coords - matches + 1 rarest postings, of which two
candidates must share one, so the longest lists (passages that many documents hold) are skipped.  The second exchange walks the
lists that are left, counting agreeing coordinates and skipping pairs that are joined already.  What is found are groups of
candidates; inside them every link that could join two parts is confirmed on the full sets.

With 64 coordinates of which 36 must agree, a pair of Jaccard similarity 0.8 is missed with probability below 1e-5, and a
component only if all its links at that place are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import WordHash, carried, eased, ids_of, likely, map_rows, mix, odd_numbers, ranges, shards_for, stage, texts_of
from fieldspark.llm.components import components

OWN = ["n_shingles", "component_id", "kept"]
MULTIPLIERS = odd_numbers(64, 11)


def shingles(words: list[bytes], size: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all `size`-word shingles; of the whole sequence if it is shorter; empty without words."""
    if not words:
        return np.empty(0, np.uint64)
    a = hashes.of(words)
    if len(a) < size:
        h = np.array([len(a)], np.uint64)
        for x in a:
            h = mix(h * MULTIPLIERS[0] + x)
        return h
    h = a[: len(a) - size + 1] * MULTIPLIERS[0]
    for k in range(1, size):
        h = h + a[k : len(a) - size + 1 + k] * MULTIPLIERS[k]
    return np.unique(mix(h))


def signature(s: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the least product of the set with each factor."""
    out = np.full(len(factors), ~np.uint64(0))
    for k in range(0, len(s), 4096):
        out = np.minimum(out, (s[None, k : k + 4096] * factors[:, None]).min(axis=1))
    return (out >> np.uint64(32)).astype(np.uint32)


class Forest:
    """Union-find over 0..n-1 whose roots are the least members."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        while True:
            nxt = self.up[self.up]
            if np.array_equal(nxt, self.up):
                return nxt
            self.up = nxt


def _blocks(shard: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """Rows dealt to shards: for each shard its number and each column's bytes."""
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else []
    for s, e in zip(edges[:-1], edges[1:]):
        yield int(shard[s]), [c[order[s:e]].tobytes() for c in columns]


def _joined(table: pa.Table, column: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), dtype)


def _post(classes: DataFrame, coords: int, shards: int) -> DataFrame:
    """Blocks of (coordinate-value key, class), dealt by key."""

    def run(batches):
        for b in eased(batches):
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(ids_of(b, "sig").to_pylist()), "<u4").reshape(-1, coords)
            keys = mix((np.arange(coords, dtype=np.uint64)[None, :] << np.uint64(32)) | sig.astype(np.uint64)).ravel()
            reps = np.repeat(np.asarray(ids_of(b, "rep"), dtype=np.int64), coords)
            rows = list(_blocks((keys % np.uint64(shards)).astype(np.int32), [keys, reps]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1][0] for r in rows], pa.binary()), pa.array([r[1][1] for r in rows], pa.binary())], ["shard", "keys", "reps"])

    return classes.select("rep", "sig").mapInArrow(run, "shard int, keys binary, reps binary")


def _shared(table: pa.Table) -> pa.Table:
    """Postings in lists of two classes or more, with the list's length."""
    keys, reps = _joined(table, "keys", np.uint64), _joined(table, "reps", np.int64)
    order = np.lexsort((reps, keys))
    keys, reps = keys[order], reps[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    n = np.diff(np.append(first, len(keys)))
    n = np.repeat(n, n)
    on = n > 1
    return pa.table({"rep": pa.array(reps[on]), "freq": pa.array(n[on]), "key": pa.array(keys[on].view(np.int64))})


def _walk_lists(coords: int, matches: int):
    """Joins the classes of each list that agree in enough coordinates; gives (class, least class joined with it)."""

    def run(table: pa.Table) -> pa.Table:
        key, rep = _joined(table, "keys", np.uint64), _joined(table, "reps", np.int64)
        sig = np.frombuffer(b"".join(table.column("sigs").to_pylist()), np.uint8).reshape(-1, coords)
        own, first, node = np.unique(rep, return_index=True, return_inverse=True)
        sig = sig[first]  # by node
        order = np.lexsort((node, key))
        key, node = key[order], node[order]
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) if len(key) else np.zeros(1, int)
        forest = Forest(len(own))
        for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
            left = np.unique(node[s:e])
            if len(left) < 2:
                continue
            while len(left) > 1:
                roots = np.array([forest.root(i) for i in left.tolist()])
                if (roots == roots[0]).all():
                    break
                part = [roots == roots[0]]  # the members joined already are one part: its members are tried in turn
                todo, rest = left[part[0]].tolist(), left[~part[0]]
                while todo and len(rest):
                    x = todo.pop()
                    near = (sig[rest] == sig[x]).sum(1) >= matches
                    for y in rest[near].tolist():
                        forest.join(x, y)
                    todo += rest[near].tolist()
                    rest = rest[~near]
                left = rest
        root = forest.roots()
        on = root != np.arange(len(own))
        return pa.table({"a": pa.array(own[on]), "b": pa.array(own[root[on]])})

    return run


def _confirm(numerator: int, denominator: int):
    """Exact components of the links inside one group of sets; gives (class, least class of its component)."""

    def run(table: pa.Table) -> pa.Table:
        ids = np.asarray(table.column("rep"), dtype=np.int64)
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        sets = [np.frombuffer(x, np.uint64) for x in table.column("set").take(pa.array(order)).to_pylist()]
        n = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), n)
        value, term = np.unique(np.concatenate(sets), return_inverse=True)
        by = np.argsort(term, kind="stable")
        posting = owner[by]
        df = np.bincount(term, minlength=len(value))
        start = np.cumsum(df) - df
        at = np.concatenate([[0], np.cumsum(n)])
        forest, open_ = Forest(len(sets)), np.ones(len(sets), bool)
        for i in np.flatnonzero(ids[1:] == ids[:-1]).tolist():
            forest.join(i, i + 1)  # versions of one document
        # first the most central set, then every set outside the largest part: links within that part can't change it
        central = np.add.reduceat(df[term], at[:-1]) / n
        x = int(np.argmax(central))
        while True:
            own = term[at[x] : at[x + 1]]
            both = np.bincount(posting[ranges(start[own], df[own])], minlength=len(sets))
            for y in np.flatnonzero(denominator * both >= numerator * (n + n[x] - both)).tolist():
                forest.join(x, y)
            open_[x] = False
            root = forest.roots()
            size = np.bincount(root, minlength=len(sets))
            todo = np.flatnonzero(open_ & (root != np.argmax(size)))
            if not len(todo):
                break
            x = int(todo[np.argmax(central[todo])])
        on = root != np.arange(len(sets))
        return pa.table({"a": pa.array(ids[on]), "b": pa.array(ids[root[on]])})

    return run


def near_duplicates(docs: DataFrame, size: int = 5, numerator: int = 80, denominator: int = 100, coords: int = 64, matches: int = 36, block: int = 4096, keep: list[str] | None = None) -> DataFrame:
    """All rows with n_shingles, component_id and kept added; `keep` names the input columns that pass through (all, if not given).

    Words are runs without white space, A-Z in lower case; a document's set has its distinct `size`-word shingles, or its whole
    sequence if that is shorter.  Two documents are linked if denominator * intersection >= numerator * union.  component_id is
    the least doc_id reachable; kept marks that document itself.  Null or empty text, or one without words: an empty set, linked with nothing.
    Rows of one doc_id count as one document's versions.  A null doc_id joins its equals' component, but names none: without
    another id, component_id is null and the row is kept.  Texts of any length
    are read as a whole.  Input columns with a result's name are replaced; an empty table gives an empty table.

    Groups of candidates and lists beyond `block` members are dealt to tasks as pairs of blocks, so no task holds an unbounded group.
    """
    spark = docs.sparkSession
    shards, factors, prefix = shards_for(spark), odd_numbers(coords, 23), coords - matches + 1

    def sets(signed: bool = True):
        hashes = WordHash()

        def f(b: pa.RecordBatch) -> list[pa.Array]:
            n, k1, k2, sig = [], [], [], []
            for t in texts_of(b):
                s = shingles(t.lower().split(), size, hashes)
                n.append(len(s))
                digest = xxhash.xxh3_128_digest(s.tobytes())
                k1.append(int.from_bytes(digest[:8], "little", signed=True) if len(s) else None)
                k2.append(int.from_bytes(digest[8:], "little", signed=True) if len(s) else None)
                if signed:
                    sig.append(signature(s, factors).tobytes() if len(s) else None)
            return [pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64())] + [pa.array(sig, pa.binary())] * signed

        return f

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = stage(map_rows(source, sets, "n bigint, k1 bigint, k2 bigint, sig binary", keep=["doc_id"]), "sets")
    first = F.min(F.struct("doc_id", "sig"))
    classes = stage(made.where(F.col("n") > 0).groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"), first["sig"].alias("sig")), "classes")
    named = classes.where(F.col("rep").isNotNull())

    shared = _post(named, coords, shards).groupBy("shard").applyInArrow(_shared, "rep bigint, freq bigint, key bigint")
    lists = shared.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("freq", "key"))).alias("p")).where(F.size("p") >= matches)  # at most `coords` each
    lists = lists.select("rep", F.slice("p", F.lit(1), F.size("p") - F.lit(coords - prefix)).alias("p"))

    def deal(batches):
        for b in eased(batches):
            if not b.num_rows:
                continue
            p = ids_of(b, "p")
            n = np.asarray(pc.list_value_length(p), dtype=np.int64)
            flat = p.flatten()
            keys = np.asarray(flat.field("key"), dtype=np.int64).view(np.uint64)
            freq = np.asarray(flat.field("freq"), dtype=np.int64)
            rep = np.repeat(np.asarray(ids_of(b, "rep"), dtype=np.int64), n)
            sig = np.frombuffer(b"".join(ids_of(b, "sig").to_pylist()), "<u4").reshape(-1, coords).astype(np.uint8)
            sig = np.repeat(sig, n, axis=0)
            # a list longer than a block: one part for each pair of its blocks
            parts = -(-freq // block)
            mine = (mix(rep.view(np.uint64)) % parts.astype(np.uint64)).astype(np.int64)
            other = ranges(np.zeros(len(parts), np.int64), parts)
            again = np.repeat(np.arange(len(parts)), parts)
            low, high = np.minimum(mine[again], other).astype(np.uint64), np.maximum(mine[again], other).astype(np.uint64)
            sub = np.where(parts[again] > 1, mix(keys[again] + mix((low << np.uint64(32)) | high)), keys[again])
            rows = list(_blocks((sub % np.uint64(shards)).astype(np.int32), [sub, rep[again], sig[again]]))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[1][k] for r in rows], pa.binary()) for k in range(3)]], ["shard", "keys", "reps", "sigs"])

    dealt = lists.join(named.select("rep", "sig"), "rep").select("rep", "p", "sig").mapInArrow(deal, "shard int, keys binary, reps binary, sigs binary")
    found = dealt.groupBy("shard").applyInArrow(_walk_lists(coords, matches), "a bigint, b bigint")
    groups = components(found, "candidates")

    members = stage(groups.unionByName(groups.select(F.col("component").alias("id"), "component").distinct()), "members")
    sizes = members.groupBy("component").agg(F.count("*").alias("m"))
    placed = members.join(sizes, "component").withColumn("parts", F.ceil(F.col("m") / block).cast("int"))
    mine = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    placed = placed.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    placed = placed.select("id", "component", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def whole():
        hashes = WordHash()

        def f(b: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([shingles(t.lower().split(), size, hashes).tobytes() for t in texts_of(b)], pa.binary())]

        return f

    few = likely(source.where(F.col("doc_id").isNotNull()), "doc_id", members.select("id"))
    texts = few.join(placed, few["doc_id"] == placed["id"]).select(F.col("id").alias("rep"), "component", "i", "j", "text")
    full = map_rows(texts, whole, "set binary", keep=["rep", "component", "i", "j"], read=["text"]).where(F.octet_length("set") > 0)
    links = full.groupBy("component", "i", "j").applyInArrow(_confirm(numerator, denominator), "a bigint, b bigint")
    final = components(links, "confirmed")

    classed = classes.join(final, classes["rep"] == final["id"], "left").select("k1", "k2", F.coalesce("component", "rep").alias("__component"))
    carry = carried(docs, OWN) if keep is None else keep
    if carry == ["doc_id"]:
        base = made.select("doc_id", "n", "k1", "k2")
    else:  # beside columns that pass through, the keys are computed again
        base = map_rows(docs, lambda: sets(signed=False), "n bigint, k1 bigint, k2 bigint", keep=carry)
    some, none = base.where(F.col("n") > 0).join(classed, ["k1", "k2"]), base.where(F.col("n") == 0).withColumn("__component", F.col("doc_id").cast("bigint"))
    out = some.select(*carry, "n", "__component").unionByName(none.select(*carry, "n", "__component"))
    kept = F.coalesce(F.col("doc_id") == F.col("__component"), F.col("__component").isNull())
    return out.select(*carry, F.col("n").alias("n_shingles"), F.col("__component").alias("component_id"), kept.alias("kept"))
