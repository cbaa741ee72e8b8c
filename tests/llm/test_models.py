"""Language identification and the quality classifier on held-out rows of the driver's tables, and on awkward ones."""

import random

import cases
from pyspark.sql import functions as F

from fieldspark.llm import language_id, quality_model
from fieldspark.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = QUERIES["op7_nearest_centroid"](spark, DATA).join(docs, "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97
    assert got.where("score < 0 or score > 1").isEmpty()


def test_language_of_awkward_texts(spark):
    rows = cases.documents()
    docs = cases.frame(spark, rows)
    model = language_id.fit(docs)
    got = language_id.identify(docs, model).collect()
    assert len(got) == len(rows)
    for g in got:
        letters = any(ch.isalpha() for ch in g["text"] or "")
        assert (g["lang_pred"] == "und") == (not letters) and g["lang_pred"] in ("und", "en", "fr")
        assert letters or (g["rejected"] and g["score"] == 0)
    assert language_id.fit(docs.where("false")) is None
    assert {g["lang_pred"] for g in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.identify(docs.where("false"), model).collect() == []


def test_far_text_is_rejected(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    far = spark.createDataFrame([(1, "日本語の文章はとても遠い。" * 5)], "doc_id bigint, text string")
    assert language_id.identify(far, model).first()["rejected"]
    assert language_id.identify(docs, model).where("rejected").count() <= 0.01 * docs.count()


def test_long_far_texts_are_rejected(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    r = random.Random(5)
    letters = " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(4000))
    italian = "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura, che la diritta via era smarrita. Ahi quanto a dir qual era è cosa dura questa selva selvaggia e aspra e forte che nel pensier rinova la paura! "
    got = language_id.identify(spark.createDataFrame([(1, letters), (2, italian * 8)], "doc_id bigint, text string"), model).collect()
    assert all(g["rejected"] for g in got), got


def test_every_language_is_learnt_whatever_repeats(spark):
    r = random.Random(6)
    word = lambda a: "".join(r.choice(a) for _ in range(5))
    alphabets = {f"l{k:03d}": [chr(0x4E00 + 40 * k + i) for i in range(30)] for k in range(230)}
    rows = [(7 * k + j, " ".join(word(a) for _ in range(40)), lang) for k, (lang, a) in enumerate(alphabets.items()) for j in range(3)]
    rows += [(5, rows[0][1], "l000")] * 900
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs, per_lang=50, most_rows=1000, least_rows=3)
    assert model.langs == sorted(alphabets)
    assert language_id.identify(docs, model).where("lang <> lang_pred").count() == 0


def test_quality_on_held_out_labels(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = QUERIES["op8_co_training"](spark, DATA).join(labels, "doc_id").where("held_out")
    r = got.agg(F.avg(((F.col("quality") == 1) == F.col("kept")).cast("double")), F.avg(F.when(F.col("quality") == 1, F.col("kept").cast("double")))).first()
    assert r[0] > 0.93 and r[1] > 0.95


def test_quality_of_awkward_rows(spark):
    rows = cases.documents()
    docs = cases.frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(None, 1), (81, None)], "doc_id bigint, quality int")
    model = quality_model.fit(docs, labels)
    got = quality_model.classify(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= g["score"] <= 1 for g in got)
    none = quality_model.fit(docs, labels.where("quality = 1"))
    assert none is None and all(g["kept"] for g in quality_model.classify(docs, none).collect())
    assert quality_model.classify(docs.where("false"), model).collect() == [] and quality_model.fit(docs.where("false"), labels) is None
