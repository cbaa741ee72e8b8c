import brute
import cases
import pytest

from fieldspark.llm import decontaminate


@pytest.mark.parametrize(("keep", "block"), [(slice(None), 8 << 20), (slice(0, 2), 8 << 20), (slice(None), 40)])
def test_hits_against_brute_force(spark, keep, block):
    rows = cases.documents()
    items = cases.items(rows)[keep]
    got = decontaminate.decontaminate(cases.frame(spark, rows), spark.createDataFrame(items, "item_id bigint, text string"), block_bytes=block).collect()
    want = brute.contamination([r[1] for r in rows], items)
    assert sorted((g["doc_id"] is None, g["doc_id"] or 0, int(g["n_words"]), g["n_hit"], g["item_ids"]) for g in got) == sorted((r[0] is None, r[0] or 0, *w) for r, w in zip(rows, want))
    assert any(w[1] for w in want)


def test_spans_are_removed(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = spark.createDataFrame([(1, f"Before, {item.upper().replace(' ', ', ')}! After."), (2, "nothing"), (3, item)], "doc_id bigint, text string")
    got = {g["doc_id"]: g for g in decontaminate.decontaminate(docs, spark.createDataFrame([(1, item)], "item_id bigint, text string"), coverage=0.9).collect()}
    assert got[1]["clean_text"] == "Before, ! After." and got[1]["spans"][0].asDict() == {"start": 1, "end": 13} and not got[1]["dropped"]
    assert got[2]["clean_text"] == "nothing" and got[3]["dropped"] and got[3]["longest"] == 12


def test_empty_tables(spark):
    items = spark.createDataFrame(cases.items(cases.documents()), "item_id bigint, text string")
    assert decontaminate.decontaminate(cases.frame(spark, []), items).collect() == []
    got = decontaminate.decontaminate(cases.frame(spark), spark.createDataFrame([], "item_id bigint, text string")).collect()
    assert got and all(g["n_hit"] == 0 and g["item_ids"] == [] for g in got)
