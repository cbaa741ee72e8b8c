import math
import re
from collections import Counter

import cases
import pytest

from fieldspark.llm import lexical_search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    total, n = sum(x[2] for x in own), len(own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, size in own:
            m = 10 + 90 * size * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return out


def key(r):
    return [(x is None, x or 0) for x in r]


@pytest.mark.parametrize("row_bytes,block_bytes", [(1 << 21, 1 << 22), (900, 200)])
def test_equals_brute_force(spark, row_bytes, block_bytes):
    rows = cases.documents()
    items = [(i, r[1]) for i, r in enumerate(rows) if i % 10 == 0 and i < 100] + [*cases.items(rows), (5, "Three small words"), (5, "three")]
    index = lexical_search.build(cases.frame(spark, rows), row_bytes=row_bytes)
    assert index.n_docs == sum(bool(terms(r[1])) for r in rows)
    got = lexical_search.search(index, spark.createDataFrame(items, "item_id bigint, text string"), k=4, block_bytes=block_bytes)
    want = brute([(r[0], r[1]) for r in rows], items, 4)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_ties_at_the_last_place(spark):
    """Equal texts score alike: the least ids win, and none is lost to rounded bounds."""
    docs = spark.createDataFrame([(i, "alpha beta") for i in range(40, 0, -1)] + [(100, "alpha alpha gamma delta")], "doc_id bigint, text string")
    index = lexical_search.build(docs, row_bytes=64)
    got = lexical_search.search(index, spark.createDataFrame([(1, "beta"), (2, "nothing")], "item_id bigint, text string"), k=3).collect()
    assert sorted((r["item_id"], r["rank"], r["doc_id"]) for r in got) == [(1, 1, 1), (1, 2, 2), (1, 3, 3)]


def test_bounds_hold(spark):
    """Both levels agree: the exact score lies within the bounds, and the gap is at most a step a term."""
    import numpy as np

    rows = [(r[0], r[1]) for r in cases.documents()]
    row = lexical_search._row([i for i, _ in rows], [(t or "").encode() for _, t in rows], 120, 15000)
    q = lexical_search.Queries([(rows[0][1]).encode()])
    q.weight = np.arange(1, len(q.terms) + 1)
    at = lexical_search.Row(row, q)
    p = at.postings(q.own[0])
    high, low = at.bounds(p)
    exact = at.exact(p, np.arange(at.n))
    assert (low <= exact).all() and (exact <= high).all() and (exact > 0).any()
    assert (high - low <= lexical_search.STEP * q.weight.sum()).all()


def test_empty(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, "word")], "item_id bigint, text string")
    assert lexical_search.search(lexical_search.build(cases.frame(spark, [])), some).collect() == []
    assert lexical_search.search(lexical_search.build(cases.frame(spark)), none).collect() == []
