import brute
import cases

from fieldspark.llm import quality_rules


def test_counts_and_verdicts(spark):
    rows = cases.documents()
    docs = cases.frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(60)] + [(None, 1, 0), (61, None, None)], "doc_id bigint, quality int, toxic int")
    got = quality_rules.quality_rules(docs, quality_rules.trusted_ids(labels), buckets=256)
    assert set(docs.columns) <= set(got.columns)
    want = sorted((r[0] is None, r[0] or 0, *brute.rules(r[1])) for r in rows)
    out = got.collect()
    assert sorted((g["doc_id"] is None, g["doc_id"] or 0, *[g[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]) for g in out) == want
    for g in out:
        assert g["base_failed"] == (g["n_words"] < 50 or 100 * g["n_repeat_words"] > 50 * g["n_words"])
        assert (g["llr"] is None) == (g["n_words"] == 0)
        assert g["kept"] == (not g["base_failed"] and g["llr"] >= -0.05)


def test_ratio_is_the_mean_weight(spark):
    docs = spark.createDataFrame([(1, "good words here"), (2, "bad stuff")], "doc_id bigint, text string")
    trusted = spark.createDataFrame([(1,)], "doc_id bigint")
    got = {g["doc_id"]: g["llr"] for g in quality_rules.quality_rules(docs, trusted, buckets=1 << 12).collect()}
    assert got[1] > 0 > got[2]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality_rules.quality_rules(cases.frame(spark, []), quality_rules.trusted_ids(none), buckets=64).collect() == []


def test_main_path_is_native(spark):
    docs = cases.frame(spark)
    plan = quality_rules.quality_rules(docs, spark.createDataFrame([(1,)], "doc_id bigint"), buckets=64)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
