import random

import brute
import cases
import pytest

from fieldspark.llm import components, near_dedup


@pytest.mark.parametrize(("size", "block"), [(4, 4096), (5, 6)])
def test_groups_against_brute_force(spark, size, block):
    rows = cases.documents()
    got = near_dedup.near_duplicates(cases.frame(spark, rows), size=size, block=block)
    assert set(cases.frame(spark, rows).columns) - {"kept"} <= set(got.columns)
    key = lambda x: tuple((v is None, v or 0) for v in x)
    out = [(g["doc_id"], g["n_shingles"], g["component_id"]) for g in got.collect()]
    want = [(i, n, c if n else i) for i, n, c in brute.near([(r[0], r[1]) for r in rows], size)]
    assert sorted(out, key=key) == sorted(want, key=key)
    assert all(g["kept"] == (g["doc_id"] == g["component_id"] or g["component_id"] is None) for g in got.collect())


def test_empty_table(spark):
    assert near_dedup.near_duplicates(cases.frame(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    r = random.Random(4)
    ids = list(range(200))
    r.shuffle(ids)
    edges = [(ids[k], ids[k + 1]) for k in range(60)] + [(ids[80], ids[k]) for k in range(81, 120)] + [(ids[130], ids[130]), (None, ids[1])]
    got = {x["id"]: x["component"] for x in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    chain, star = ids[:61], ids[80:120]
    for part in (chain, star):
        assert {i: got[i] for i in part if i != min(part)} == {i: min(part) for i in part if i != min(part)}
    assert len(got) == len(chain) + len(star) - 2
