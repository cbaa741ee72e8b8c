"""The pipeline's stages on a small table, each against brute force on its own input."""

import brute
import cases
import corpus_pipeline
import pytest

from fieldspark.llm.common import stage

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], DATA), name))
    return [[r.asDict() for r in t.collect()] for t in out], [t.columns for t in out]


def test_columns(tables):
    assert all(c == tables[1][0] for c in tables[1][:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "passages", "decontaminate", "packing"]


def test_near_duplicates(tables):
    before, after = tables[0][1], tables[0][2]
    want = {i for i, n, c in brute.near([(r["doc_id"], r["text"]) for r in before], 5) if i == c or not n}
    assert {r["doc_id"] for r in after} == want


def test_passages(tables):
    before, after = tables[0][2], tables[0][3]
    gone = brute.repeats([r["text"] for r in before], corpus_pipeline.PASSAGE_BYTES)
    want = {r["doc_id"]: bytes(b for b, g in zip(d, x) if not g).decode("utf-8", "ignore") for r, (d, x) in zip(before, gone)}
    assert {r["doc_id"]: r["text"] for r in after} == {i: t for i, t in want.items() if t.strip()}
    assert all(r["n_chars"] == len(r["text"]) for r in after)


def test_benchmark(spark, tables):
    before, after = tables[0][3], tables[0][4]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.contamination([r["text"] for r in before], items)
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r, (n, h, _) in zip(before, hits) if h <= 0.5 * n}
    clean = {r["doc_id"]: r["text"] for r, (_, h, _) in zip(before, hits) if not h}
    assert all(r["text"] == clean[r["doc_id"]] for r in after if r["doc_id"] in clean)


def test_packing(tables):
    docs, pieces = tables[0][4], tables[0][5]
    assert {p["doc_id"] for p in pieces} == {d["doc_id"] for d in docs}
    tokens = {p["doc_id"]: p["doc_tokens"] for p in pieces}
    assert sum(p["length"] for p in pieces) == sum(tokens.values())


def test_awkward_rows_pass_through(spark):
    docs = cases.frame(spark)
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, DATA), "case")
    assert docs.count() > 0
    docs = cases.frame(spark, [])
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, DATA), "none")
    assert docs.count() == 0
