"""Alignment of streams of messages by time.

The joins of two streams put the two streams into one, dealt to buckets as wide as the tolerance; a right message also goes to the neighbouring buckets
from which it can be reached.  In each bucket the messages are read once in order of time, and the last right message passed so far is each left
message's partner: work and memory follow the number of messages, however many lie within one tolerance.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def _bucket(micros: Column, width: int) -> Column:
    return F.floor(micros / F.lit(width))


def _both(left: DataFrame, right: DataFrame, width: int, by: list[str], reach: tuple[int, ...]) -> DataFrame:
    """One stream: side (0 is right), t, id, bucket."""
    a = left.select(*by, F.lit(1).alias("__side"), "t", "id", _bucket(F.col("t"), width).alias("__b"))
    b = right.select(*by, F.lit(0).alias("__side"), "t", "id", F.explode(F.array(*[_bucket(F.col("t"), width) + k for k in reach])).alias("__b"))
    return a.unionByName(b)


def _passed(by: list[str], *order: Column) -> Column:
    """The last right message (t, id) up to this one, in the given order."""
    w = Window.partitionBy(*by, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(F.when(F.col("__side") == 0, F.struct("t", "id")), ignorenulls=True).over(w)


def nearest(left: DataFrame, right: DataFrame, tolerance_us: int, by: list[str] | None = None) -> DataFrame:
    """Each left message (id, t in microseconds) with the nearest right one within the tolerance: id, right_id, dt_us.

    The smaller right id wins among equally near ones.  Left messages without a partner are left out, and so are messages without a time.
    """
    by = by or []
    t, side, own = F.col("t"), F.col("__side"), F.col("id")
    both = _both(left, right, tolerance_us, by, (-1, 0, 1)).where(t.isNotNull())
    both = both.withColumn("__before", _passed(by, t.asc(), side.asc(), own.desc())).withColumn("__after", _passed(by, t.desc(), side.asc(), own.desc()))
    dt = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(t - F.col(f"{c}.t")).alias("dt_us"), F.col(f"{c}.id").alias("right_id")))
    chosen = both.where(side == 1).select("id", F.least(dt("__before"), dt("__after")).alias("m")).where(F.col("m.dt_us") <= tolerance_us)
    return chosen.select("id", "m.right_id", "m.dt_us")


def latest(left: DataFrame, right: DataFrame, tolerance_us: int, by: list[str] | None = None) -> DataFrame:
    """Each left message with the last right one at or before it, within the tolerance; the greater id wins among equal times."""
    by = by or []
    t, side, own = F.col("t"), F.col("__side"), F.col("id")
    both = _both(left, right, tolerance_us, by, (0, 1)).where(t.isNotNull()).withColumn("__before", _passed(by, t.asc(), side.asc(), own.asc()))
    chosen = both.where(side == 1).select("id", F.col("__before.id").alias("right_id"), (t - F.col("__before.t")).alias("dt_us"))
    return chosen.where(F.col("dt_us") <= tolerance_us)


class Chain:
    """Chooses sets that share no message from possible ones, which come in order of their first message: (first key, last key, spread, members).

    The first set that begins after the one chosen last opens a window up to its own last message; of the sets that begin in the window the one with
    the least spread is chosen, of equal ones the earliest.
    """

    def __init__(self, after: tuple | None = None):
        self.after, self.held = after, []

    def next(self) -> tuple:
        end = self.held[0][1]
        best = min((s for s in self.held if s[0] <= end), key=lambda s: (s[2], s[0]))
        self.after, self.held = best[1], [s for s in self.held if s[0] > best[1]]
        return best

    def feed(self, found: tuple) -> Iterator[tuple]:
        if self.after is None or found[0] > self.after:
            self.held.append(found)
            while self.held and found[0] > self.held[0][1]:
                yield self.next()


def merged(streams: dict[str, DataFrame], by: list[str]) -> DataFrame:
    """All streams' messages as one table: k (the stream's number), t, id; messages without a time or id are left out."""
    parts = [df.select(*by, F.lit(k).alias("k"), F.col("t").cast("bigint").alias("t"), F.col("id").cast("bigint").alias("id")) for k, df in enumerate(streams.values())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where(F.col("t").isNotNull() & F.col("id").isNotNull())


def possible_sets(streams: dict[str, DataFrame], tolerance_us: int, by: list[str]) -> DataFrame:
    """For each message the set of it and the next message of every other stream, if it spreads over the tolerance at most: k, t, id, last (t, k, id), spread, members.

    Messages are dealt to buckets as wide as the tolerance, and to the bucket before, so each bucket knows all that its messages can reach.
    """
    width = max(1, tolerance_us)
    dealt = merged(streams, by).withColumn("__x", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("__b", _bucket(F.col("t"), width) - F.col("__x"))
    w = Window.partitionBy(*by, "__b").orderBy(F.desc("t"), F.desc("k"), F.desc("id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    key = F.struct("t", "k", "id")
    after = dealt.withColumns({f"__m{k}": F.last(F.when(F.col("k") == k, key), ignorenulls=True).over(w) for k in range(len(streams))}).where(F.col("__x") == 0)
    members = [F.col(f"__m{k}") for k in range(len(streams))]
    whole = F.lit(True)
    for m in members:
        whole = whole & m.isNotNull()
    found = after.where(whole).withColumn("last", F.greatest(*members) if len(members) > 1 else members[0])
    found = found.withColumn("spread", F.col("last.t") - F.col("t")).where(F.col("spread") <= tolerance_us)
    return found.select(*by, "k", "t", "id", F.col("last.t").alias("lt"), F.col("last.k").alias("lk"), F.col("last.id").alias("lid"), "spread", F.array(*[m["id"] for m in members]).alias("members"))


def together(streams: dict[str, DataFrame], tolerance_us: int, by: list[str] | None = None) -> DataFrame:
    """Sets of one message of each stream (id, t in microseconds) that lie within the tolerance: the columns of `by`, `<name>_id` of each stream, spread_us.

    Sets share no message and don't overlap in time; which ones are chosen is said at Chain.  Times of equal order go by the streams' order, then by id.  What
    sets are possible is found bucket by bucket; the choice depends on the one before, so the possible sets of each `by` are read in order by one task, which
    holds those within one tolerance.  Messages without a time or id are left out; null keys are one key; a stream without messages gives no set.
    """
    by = by or []
    sets = possible_sets(streams, tolerance_us, by)
    out = StructType([*[sets.schema[c] for c in by], *StructType.fromDDL(", ".join([*[f"`{n}_id` bigint" for n in streams], "spread_us bigint"])).fields])
    arrow = to_arrow_schema(out, prefers_large_types=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, chain, rows = None, Chain(), []
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            for i, name in enumerate(cols[0]):
                if name != now:
                    while chain.held:
                        rows.append(chain.next())
                    now, chain = name, Chain()
                k, t, n, lt, lk, lid, spread, members = (c[i] for c in cols[1 + len(by) :])
                rows += chain.feed(((t, k, n), (lt, lk, lid), spread, (*[c[i] for c in cols[1 : 1 + len(by)]], *members, spread)))
            yield from _made(rows)
            rows = []
        while chain.held:
            rows.append(chain.next())
        yield from _made(rows)

    def _made(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*[r[3] for r in rows]), arrow)], schema=arrow)

    named = sets.select(F.to_json(F.struct(*by), {"ignoreNullFields": "false"}).alias("__key") if by else F.lit("").alias("__key"), *sets.columns)
    return named.repartition("__key").sortWithinPartitions("__key", "t", "k", "id").mapInArrow(run, out)
