"""Streams whose results depend on the messages before: sets of several streams, silences, queues and order.

Each keeps, for a key, the messages that the watermark hasn't passed, and decides only what no later message can change, so the results are those of the batch
twins whatever the triggers were.  Messages behind the watermark are dropped.  Event-time timers wake keys without new messages.

A trigger may bring a key any number of messages: they are held as NumPy columns, in the state as their bytes, and gone through once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from fieldspark.operators import attitude

BLOCK = 1 << 20  # messages whose possible sets are in memory at once, and the rows of one frame of orientations (a 64th)
SPAN = 64  # slots of a topic that one key has


def _arrived(batches: Iterator[pd.DataFrame], state: GroupState, columns: dict[str, str]) -> tuple[list[np.ndarray], int]:
    """The new messages that aren't late, an array for each column, and the watermark in microseconds: all messages before it have come.

    A watermark is a whole number of milliseconds, and the messages of that very millisecond may be on either side of it.
    """
    now = state.getCurrentWatermarkMs() * 1000
    parts: list[list[np.ndarray]] = [[np.empty(0, kind)] for kind in columns.values()]
    for p in batches:
        fresh = (p["t"] >= now) | (p["seen"] == 0) if "seen" in columns else p["t"] >= now
        for own, (c, kind) in zip(parts, columns.items()):
            own.append(p[c][fresh].astype(kind).to_numpy())
    return [np.concatenate(own) for own in parts], now


def _held(state: GroupState, columns: dict[str, str]) -> list[np.ndarray]:
    """The columns that the end of the state has as bytes."""
    cells = state.get[-len(columns) :] if state.exists else [b""] * len(columns)
    return [np.frombuffer(bytes(c), kind) for c, kind in zip(cells, columns.values())]


def _wake(state: GroupState, at_us: int) -> None:
    """A timer at the first watermark beyond `at_us`."""
    state.setTimeoutTimestamp(max(at_us // 1000 + 1, state.getCurrentWatermarkMs() + 1))


def _grouped(stream: DataFrame, by: list[str], step, out: str | StructType, kept: str) -> DataFrame:
    return stream.groupBy(*by).applyInPandasWithState(step, out, kept, "append", GroupStateTimeout.EventTimeTimeout)


def _sets(t: np.ndarray, k: np.ndarray, ids: np.ndarray, n: int, tolerance_us: int, now: int) -> tuple[np.ndarray, int, int, int | None]:
    """What Chain chooses from sorted messages, as far as none from `now` on can change it: ids and spread of each set, the number of messages that no later set
    needs, that of the last set's last message (-1: no set) and the time at which the first set that is still open ends (None: there is none).

    The set that begins with a message has the next one of every stream.  So a set that begins later doesn't end sooner, windows don't overlap, and each is looked at once.
    """
    size = len(t)
    at = np.arange(size)
    following = np.stack([np.minimum.accumulate(np.where(k == j, at, size)[::-1])[::-1] for j in range(n)])
    end = following.max(axis=0)
    first = np.flatnonzero(end < size)
    first = first[(t[end[first]] - t[first] <= tolerance_us) & (t[first] + tolerance_us < now)]
    end = end[first]
    spread, beyond = t[end] - t[first], np.searchsorted(first, end, side="right")
    chosen, i, closed = [], 0, int(np.searchsorted(t[end] + tolerance_us, now))
    while i < closed:
        chosen.append(i + int(spread[i : beyond[i]].argmin()))
        i = int(beyond[chosen[-1]])
    last = int(end[chosen[-1]]) if chosen else -1
    open_ = i < len(first)
    passed = max(last + 1, int(np.searchsorted(t, min(now - tolerance_us, t[first[i]]) if open_ else now - tolerance_us)))
    return np.column_stack([*ids[following[:, first[chosen]]], spread[chosen]]), passed, last, int(t[end[i]]) if open_ else None


def together(streams: dict[str, DataFrame], tolerance_us: int, lateness: str, by: list[str] | None = None, stamp: str = "stamp") -> DataFrame:
    """sync.together() of streams with id and stamp: `<name>_id` of each, spread_us.

    A set comes once the watermark has passed its window's end by the tolerance.  The state holds the messages of about two tolerances and the lateness.
    """
    by, names = by or ["__all"], list(streams)
    parts = [df.select(*[F.lit(0).alias(c) if c == "__all" else F.col(c) for c in by], F.col(stamp).alias("__at"), F.unix_micros(stamp).alias("t"), F.lit(k).alias("k"), F.col("id").cast("bigint").alias("id")) for k, df in enumerate(streams.values())]
    all_ = parts[0]
    for p in parts[1:]:
        all_ = all_.unionByName(p)
    all_ = all_.where(F.col("id").isNotNull()).withWatermark("__at", lateness)
    out = StructType([*[all_.schema[c] for c in by], *StructType.fromDDL(", ".join([*[f"`{n}_id` bigint" for n in names], "spread_us bigint"])).fields])

    columns = {"t": "int64", "k": "int32", "id": "int64"}

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new, now = _arrived(batches, state, columns)
        after = tuple(state.get[0]) if state.exists else ()
        t, k, ids = (np.concatenate(c) for c in zip(_held(state, columns), new))
        order = np.lexsort((ids, k, t))
        t, k, ids = t[order], k[order], ids[order]
        own = np.ones(len(t), bool)
        own[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1]) | (ids[1:] != ids[:-1])
        if after:
            own &= (t > after[0]) | (t == after[0]) & ((k > after[1]) | (k == after[1]) & (ids > after[2]))
        t, k, ids = t[own], k[own], ids[own]
        low, high, known, open_ = 0, 0, int(np.searchsorted(t, now)), None
        while high < known:  # a part of the messages is like a watermark that has come to the next one
            high = min(known, high + max(BLOCK, high - low))
            rows, passed, last, open_ = _sets(t[low:high], k[low:high], ids[low:high], len(names), tolerance_us, now if high == known else int(t[high]))
            after = (int(t[low + last]), int(k[low + last]), int(ids[low + last])) if last >= 0 else after
            low += passed
            yield pd.DataFrame({**dict(zip(by, key)), **dict(zip(out.names[len(by) :], rows.T))}, index=range(len(rows)))
        if low == len(t) and (not after or after[0] < now):
            state.remove()
        else:
            state.update((list(after), *[c[low:].tobytes() for c in (t, k, ids)]))
            _wake(state, (open_ if open_ is not None else int(t[low]) + tolerance_us if low < len(t) else now) + tolerance_us)

    got = _grouped(all_, by, step, out, "last array<bigint>, ts binary, ks binary, ids binary")
    return got.drop("__all")


def absences(stream: DataFrame, quiet_us: int, lateness: str, expected: DataFrame | None = None, topic: str = "topic", stamp: str = "stamp") -> DataFrame:
    """rates.absences() of a stream: `absent` comes when the watermark has passed the silence, `back` when it has passed the message that ends it.

    `expected` is a stream of topics with the stamps from which they are waited for, and starts a topic's timer without a message of its own; it is read at the stream's
    start, and its stamps don't move the watermark.  Messages of one `quiet_us` have no silence between them: of each the first and last are held.
    """
    both = stream.select(topic, stamp, F.lit(1).alias("seen"))
    if expected is not None:
        both = both.unionByName(expected.select(topic, stamp, F.lit(0).alias("seen")))
    at = F.when(F.col("seen") == 1, F.col(stamp)).otherwise(F.timestamp_micros(F.lit(1000)))  # the least that isn't behind a stream's first watermark
    both = both.where(F.col(stamp).isNotNull()).select(topic, at.alias("__at"), F.unix_micros(stamp).alias("t"), "seen").withWatermark("__at", lateness)
    out = StructType([both.schema[topic], *StructType.fromDDL("kind string, at_us bigint").fields])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (new, heard), now = _arrived(batches, state, {"t": "int64", "seen": "int32"})
        last, absent, came, waits = None, False, np.empty(0, "int64"), new[heard == 0].tolist()
        if state.exists:
            last, absent, ts, seen = state.get
            held = np.array(ts, "int64"), np.array(seen, "int32")
            came, waits = held[0][held[1] == 1], waits + held[0][held[1] == 0].tolist()
        came = np.sort(np.concatenate([came, new[heard == 1]]))
        apart = np.diff(came // max(1, quiet_us)) > 0
        came = came[np.append(True, apart) | np.append(apart, True)] if len(came) else came
        held, passed, rows = sorted([(t, 1) for t in came.tolist()] + [(w, 0) for w in sorted(waits)[:1] if last is None]), 0, []
        for t, seen in held:
            if t >= now:
                break
            passed += 1
            if last is None:
                last = t
            elif seen:
                if t - last > quiet_us and not absent:
                    rows.append((*key, "absent", last))
                    absent = True
                if absent:
                    rows.append((*key, "back", t))
                last, absent = t, False
        held = held[passed:]
        if last is not None and not absent and last + quiet_us < now:
            rows.append((*key, "absent", last))
            absent = True
        state.update((last, absent, [m[0] for m in held], [m[1] for m in held]))
        ends = [m[0] for m in held[:1]] + ([last + quiet_us] if last is not None and not absent else [])
        if ends:
            _wake(state, min(ends))
        yield pd.DataFrame(rows, columns=out.names)

    return _grouped(both, [topic], step, out, "last bigint, absent boolean, ts array<bigint>, seen array<int>")


def keep_last(stream: DataFrame, depth: int, period_us: int, lateness: str, topic: str = "topic", stamp: str = "stamp", order: str = "msg_id") -> DataFrame:
    """rates.keep_last() of a stream: a slot's row comes when the watermark has passed it.  The state holds `depth` messages of each slot that is open.

    A topic's slots are dealt to keys by spans of time, so that many tasks share a topic.
    """
    rows_in = stream.where(F.col(stamp).isNotNull()).withWatermark(stamp, lateness).select(topic, stamp, F.unix_micros(stamp).alias("t"), F.col(order).cast("bigint").alias("id"))
    rows_in = rows_in.withColumn("__span", F.floor(F.col("t") / F.lit(period_us * SPAN)))
    out = StructType([rows_in.schema[topic], *StructType.fromDDL("slot bigint, n bigint, dropped bigint, ids array<bigint>").fields])
    columns = {"t": "int64", "id": "int64"}

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        open_: dict[int, int] = dict(zip(*state.get[:2])) if state.exists else {}
        t, ids = _held(state, columns)
        for p in batches:
            (more, more_ids), _ = _arrived(iter([p]), state, columns)
            for s, n in zip(*[c.tolist() for c in np.unique(more // period_us, return_counts=True)]):
                open_[s] = open_.get(s, 0) + n
            t, ids = np.append(t, more), np.append(ids, more_ids)
            order = np.lexsort((ids, t))
            t, ids = t[order], ids[order]
            slot = t // period_us
            own = np.searchsorted(slot, slot, side="right") - np.arange(len(t)) <= depth  # the slot's last ones
            t, ids = t[own], ids[own]
        now = state.getCurrentWatermarkMs() * 1000
        slot, rows = t // period_us, []
        for s in sorted(open_):
            if (s + 1) * period_us <= now:
                n = open_.pop(s)
                rows.append((key[0], s, n, max(0, n - depth), ids[slot == s].tolist()))
        if open_:
            own = slot >= min(open_)
            state.update((list(open_), list(open_.values()), t[own].tobytes(), ids[own].tobytes()))
            _wake(state, (min(open_) + 1) * period_us)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(rows, columns=out.names)

    return _grouped(rows_in, [topic, "__span"], step, out, "slots array<bigint>, ns array<bigint>, ts binary, ids binary")


def in_order(stream: DataFrame, lateness: str, by: list[str], stamp: str = "stamp", order: str = "msg_id") -> DataFrame:
    """The stream's rows in order of stamp and id for each key: a row waits until the watermark has passed it, and none is dropped but late ones."""
    names = stream.columns
    held_in = stream.where(F.col(stamp).isNotNull()).withWatermark(stamp, lateness).select(*by, stamp, F.unix_micros(stamp).alias("t"), F.col(order).cast("bigint").alias("__id"), F.to_json(F.struct(*names), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("row"))
    out = StructType([*[held_in.schema[c] for c in by], *StructType.fromDDL("place bigint, row string").fields])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new, now = _arrived(batches, state, {"t": "int64", "__id": "int64", "row": "object"})
        place, held = 0, []
        if state.exists:
            place, ts, ids, texts = state.get
            held = list(zip(ts, ids, texts))
        held = sorted(held + list(zip(*[c.tolist() for c in new])))
        ready = [m for m in held if m[0] < now]
        held = held[len(ready) :]
        rows = [(*key, place + i, m[2]) for i, m in enumerate(ready)]
        state.update((place + len(ready), *[list(c) for c in (zip(*held) if held else ([], [], []))]))
        if held:
            _wake(state, held[0][0])
        yield pd.DataFrame(rows, columns=out.names)

    got = _grouped(held_in, by, step, out, "place bigint, ts array<bigint>, ids array<bigint>, texts array<string>")
    return got.select("place", F.from_json("row", stream.schema, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("r")).select("place", "r.*")


def orientation(stream: DataFrame, gain: float, lateness: str, restart_us: int | None = None, device: str = "device", stamp: str = "stamp", order: str = "id") -> DataFrame:
    """attitude.orientation() of a stream: device, stamp, id and the quaternion, each row once the watermark has passed it.

    The state holds a device's last orientation and the samples that wait; samples without a stamp are dropped.
    """
    columns = {"t": "int64", "id": "int64", **dict.fromkeys(attitude.SAMPLE, "float64")}  # NaN also for null: either corrects nothing
    rows_in = stream.where(F.col(stamp).isNotNull()).withWatermark(stamp, lateness)
    rows_in = rows_in.select(device, stamp, F.unix_micros(stamp).alias("t"), F.col(order).cast("bigint").alias("id"), *[F.col(c).cast("double").alias(c) for c in attitude.SAMPLE])
    out = StructType([rows_in.schema[device], *StructType.fromDDL(", ".join(["t bigint", "id bigint", *[f"{c} double" for c in attitude.QUATERNION]])).fields])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new, now = _arrived(batches, state, columns)
        last, q = state.get[:2] if state.exists else (None, [])
        q = tuple(q) or None
        held = [np.concatenate(c) for c in zip(_held(state, columns), new)]
        order = np.lexsort((held[1], held[0]))
        held = [c[order] for c in held]
        ready = int(np.searchsorted(held[0], now))
        for at in range(0, ready, BLOCK >> 6):
            rows = []
            for t, i, *sample in zip(*[c[at : min(ready, at + (BLOCK >> 6))].tolist() for c in held]):
                if last is None or (restart_us and t - last > restart_us):
                    last, q = t, None
                q = attitude.step(q, (t - last) / 1e6, tuple(sample), gain)
                last = t
                rows.append((*key, t, i, *q))
            yield pd.DataFrame(rows, columns=out.names)
        state.update((last, list(q or ()), *[c[ready:].tobytes() for c in held]))
        if ready < len(order):
            _wake(state, int(held[0][ready]))

    got = _grouped(rows_in, [device], step, out, "last bigint, q array<double>, " + ", ".join(f"`{c}` binary" for c in columns))
    return got.select(device, F.timestamp_micros("t").alias(stamp), F.col("id").alias(order), *attitude.QUATERNION)
