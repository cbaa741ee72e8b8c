"""Sharding by histogram sort, in DataFrame operations only.

The order is (hash of the text, doc_id), so equal texts lie together.  Splitters between shards are found as in histogram
sort: each round counts the exact bytes below evenly spaced probes inside every interval that still holds an open splitter,
closes the splitters for which a probe comes within the tolerance, and narrows the others to one interval between probes.
Rounds read a staged table of keys and sizes, never texts.  Rows then move once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import carried, stage

TOP = -(1 << 63)
OWN = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]


def _unsigned(c: Column) -> Column:
    """A long's order as an order of bits: the sign bit flipped."""
    return c.bitwiseXOR(F.lit(TOP))


def _shard_of(cuts: list[tuple[int, int]], key: Column, doc: Column) -> Column:
    """The number of splitters at or below a row, by binary search; a splitter is the first (key, doc_id) of a shard."""

    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        k, d = cuts[mid]
        below = key < F.lit(k) if d == TOP else (key < F.lit(k)) | ((key == F.lit(k)) & (doc < F.lit(d)))
        return F.when(below, search(lo, mid)).otherwise(search(mid + 1, hi))

    return search(0, len(cuts))


def splitters(keyed: DataFrame, n_shards: int, tolerance: float = 0.005, bits: int = 12) -> list[tuple[int, int]]:
    """The first (key, doc_id) of shards 1, 2, ... over columns __key, __doc, size.

    A round has 2**bits probes per open interval and at most (n_shards - 1) intervals, so what reaches the driver is bounded
    by n_shards * 2**bits counts whatever the input's size.  At most 128 / bits rounds run, for two 64-bit parts of the key.
    """
    total = keyed.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [((1 << 63) - 1, (1 << 63) - 1)] * (n_shards - 1)
    slack = tolerance * total / n_shards
    cuts: list[tuple[int, int] | None] = [None] * (n_shards - 1)
    # open intervals: (whole key or None, prefix, bits of the prefix) -> (bytes below it, splitters inside)
    level: dict[tuple[int | None, int, int], tuple[int, list[int]]] = {(None, 0, 0): (0, list(range(n_shards - 1)))}
    while level:
        found: dict[tuple[int | None, int, int], list] = {k: [] for k in level}
        for hot in (False, True):  # intervals of keys, and intervals of doc_id within one key
            open_ = [k for k in level if (k[0] is not None) == hot]
            for used in sorted({k[2] for k in open_}):
                own = [k for k in open_ if k[2] == used]
                now = min(64, used + bits)
                part = _unsigned(F.col("__doc" if hot else "__key"))
                rows = keyed
                if hot:
                    rows = rows.where(F.col("__key").isin([k[0] for k in own]))
                if used:
                    rows = rows.where(F.shiftrightunsigned(part, 64 - used).isin([k[1] for k in own]))
                group = [F.shiftrightunsigned(part, 64 - now).alias("p")] + ([F.col("__key").alias("k")] if hot else [])
                counts = rows.groupBy(*group).agg(F.sum("size").alias("b"), F.min("__key").alias("k0"), F.max("__key").alias("k1"), F.min("__doc").alias("d0"), F.max("__doc").alias("d1"))
                for r in counts.collect():
                    key = (r["k"] if hot else None, (r["p"] % (1 << 64)) >> (now - used) if used else 0, used)
                    if key in found:
                        found[key].append(((r["p"] % (1 << 64)), r["b"], r["k0"], r["k1"], r["d0"], r["d1"], now))
        nxt: dict[tuple[int | None, int, int], tuple[int, list[int]]] = {}
        for at, (below, inside) in level.items():
            probes = sorted(found[at])
            for s in inside:
                target, run = total * (s + 1) / n_shards, below
                for i, (p, b, k0, k1, d0, d1, now) in enumerate(probes):
                    if run + b < target and i + 1 < len(probes):
                        run += b
                        continue
                    single = k0 == k1 and d0 == d1
                    start = (k0, TOP if at[0] is None else d0)
                    if target - run <= slack or (single and target - run <= b / 2):
                        cuts[s] = start
                    elif run + b - target <= slack or single:
                        after = probes[i + 1] if i + 1 < len(probes) else None
                        if after:
                            cuts[s] = (after[2], TOP if at[0] is None else after[4])
                        elif at[0] is not None:
                            cuts[s] = (k1, d1 + 1)
                        else:
                            cuts[s] = (k1 + 1, TOP) if k1 < (1 << 63) - 1 else (k1, (1 << 63) - 1)
                    elif k0 == k1 and at[0] is None:
                        nxt.setdefault((k0, 0, 0), (run, []))[1].append(s)
                    else:
                        nxt.setdefault((at[0], p, now), (run, []))[1].append(s)
                    break
        level = nxt
    return sorted(c if c is not None else (TOP, TOP) for c in cuts)


def histogram_shards(docs: DataFrame, n_shards: int = 40, tolerance: float = 0.005, overhead: int = 16, fine_bits: int = 14, piece_rows: int = 512) -> DataFrame:
    """All rows with size, text_crc32, law ('bytes'), shard, slot and grown_shard (null) added.

    size is the text's UTF-8 bytes plus `overhead`; sizes of shards differ from their mean by at most the tolerance (a part of
    a shard's mean) and one document on each side.  Equal texts stay in one shard unless a splitter has to fall inside a group.
    slot counts from 0 without gaps within a shard, in order of the key's leading bits.  Null text: no bytes, crc32 of the empty text.  Null doc_id
    sorts as the least id.  Repeated rows each get a slot.  An empty table gives an empty table.  Other columns pass through;
    input columns with a result's name are replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(*[c for c in carried(docs, OWN)], (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("__key"), F.coalesce(F.col("doc_id").cast("long"), F.lit(TOP)).alias("__doc"))
    narrow = stage(keyed.select("__key", "__doc", "size"), "keys")
    cuts = splitters(narrow, n_shards, tolerance)
    place = _shard_of(cuts, F.col("__key"), F.col("__doc"))
    # Fine parts of a shard, and pieces of large ones (equal texts have one key): a bounded number of both, each counted
    # beforehand, so that no task ranks a whole shard or a whole group.
    fine = F.shiftrightunsigned(_unsigned(F.col("__key")), 64 - fine_bits)
    cells = narrow.withColumns({"shard": place, "__fine": fine})
    least = max(piece_rows, narrow.count() >> fine_bits)
    sizes = cells.groupBy("shard", "__fine").agg(F.count("*").alias("__m"))  # at most 2**fine_bits + n_shards rows
    pieces = sizes.select("shard", "__fine", F.ceil(F.col("__m") / F.lit(least)).cast("int").alias("__pieces"))
    piece = F.pmod(F.xxhash64("__doc"), F.col("__pieces")).cast("int")
    cells = cells.join(F.broadcast(pieces), ["shard", "__fine"]).withColumn("__piece", piece)
    counts = cells.groupBy("shard", "__fine", "__piece").agg(F.count("*").alias("__n"))  # at most 2**fine_bits more
    before = Window.partitionBy("shard").orderBy("__fine", "__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__fine", "__piece", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("shard", "__fine", "__piece").orderBy("__key", "__doc"))
    placed = keyed.withColumns({"shard": place, "__fine": fine}).join(F.broadcast(pieces), ["shard", "__fine"]).withColumn("__piece", piece)
    placed = placed.join(F.broadcast(offsets), ["shard", "__fine", "__piece"])
    out = placed.withColumns({"slot": F.col("__before") + rank - 1, "law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
    return out.select(*carried(docs, OWN), *OWN)
