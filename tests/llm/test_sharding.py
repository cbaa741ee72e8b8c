import zlib
from collections import defaultdict

import cases
import pytest

from fieldspark.llm import sharding


def _check(rows, got, n, most):
    assert sorted((g["doc_id"] is None, g["doc_id"] or 0, g["size"], g["text_crc32"]) for g in got) == sorted((r[0] is None, r[0] or 0, len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    size, slots = defaultdict(int), defaultdict(list)
    for g in got:
        size[g["shard"]] += g["size"]
        slots[g["shard"]].append(g["slot"])
        assert g["law"] == "bytes" and g["grown_shard"] is None and 0 <= g["shard"] < n
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(size.values()) / n
    assert all(abs(size[k] - mean) <= 0.02 * mean + most for k in range(n))


@pytest.mark.parametrize("n", [1, 7])
def test_sizes_and_slots(spark, n):
    rows = cases.documents()
    docs = cases.frame(spark, rows)
    got = sharding.histogram_shards(docs, n_shards=n)
    assert set(docs.columns) <= set(got.columns)
    _check(rows, got.collect(), n, 2 * max(len((r[1] or "").encode()) for r in rows))


def test_a_hot_group_is_split(spark):
    rows = [(i, "the same text", *[None] * 9) for i in range(3000)] + [(5000 + i, f"other {i}", *[None] * 9) for i in range(1000)]
    _check(rows, sharding.histogram_shards(cases.frame(spark, rows), n_shards=40).collect(), 40, 60)


def test_equal_texts_stay_together_where_they_fit(spark):
    rows = [(i, f"text {i // 3}", *[None] * 9) for i in range(6000)]
    got = sharding.histogram_shards(cases.frame(spark, rows), n_shards=8).collect()
    shards = defaultdict(set)
    for g in got:
        shards[g["text_crc32"]].add(g["shard"])
    assert sum(len(s) > 1 for s in shards.values()) <= 7


def test_empty(spark):
    assert sharding.histogram_shards(cases.frame(spark, []), n_shards=4).collect() == []
