"""Quality rules in DataFrame operations only: counts by rule, then a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed word n-grams (orders 1 and 2) are counted: one over trusted documents, one over the raw corpus.
A document's score is the mean over its n-grams of log p_trusted - log p_raw; a fixed threshold on it decides every document.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import carried

SPACE = r"[\x20\x09-\x0D]+"
OWN = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]


def _words(docs: DataFrame, keep: list[Column]) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(*keep, text.alias("__t"), F.array_remove(F.split(text, SPACE), "").alias("__w"))


def _runs(words: Column, n: int) -> Column:
    """64-bit hashes of all n-word windows, in order; empty with fewer words."""
    starts = F.sequence(F.lit(0), F.size(words) - F.lit(n))
    return F.when(F.size(words) >= n, F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(n)]))).otherwise(F.array().cast("array<bigint>"))


def _buckets(words: Column, buckets: int) -> Column:
    ones = F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(buckets - 1)).cast("int"))
    twos = F.transform(_runs(words, 2), lambda h: h.bitwiseAND(F.lit(buckets - 1)).cast("int"))
    return F.concat(ones, twos)


def _ordered(hashes: Column) -> Column:
    """(hash, place) of all windows, equal hashes next to each other."""
    return F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))


def _repeated(ordered: Column) -> Column:
    """The places, ascending, of windows whose hash comes twice or more; `ordered` must be a plain column: it is read for each element."""
    same = lambda a, b: F.get(ordered, a)["h"] == F.get(ordered, b)["h"]
    hit = F.filter(ordered, lambda x, k: ((k > 0) & same(k - 1, k)) | ((k + 1 < F.size(ordered)) & same(k, k + 1)))
    return F.sort_array(F.transform(hit, lambda x: x["i"]))


def ngram_weights(docs: DataFrame, trusted: DataFrame, buckets: int, alpha: float) -> list[float]:
    """log p_trusted - log p_raw of each hash bucket, with add-alpha smoothing; `buckets` rows of counts reach the driver, whatever the input."""
    mark = docs.select("doc_id", "text").join(F.broadcast(trusted.select("doc_id", F.lit(1).alias("__trusted"))), "doc_id", "left")
    grams = _words(mark, [F.col("__trusted")]).select("__trusted", F.explode(_buckets(F.col("__w"), buckets)).alias("b"))
    raw, good = [0] * buckets, [0] * buckets
    for r in grams.groupBy("b").agg(F.count("*").alias("raw"), F.count("__trusted").alias("good")).collect():
        raw[r["b"]], good[r["b"]] = r["raw"], r["good"]
    all_raw, all_good = sum(raw) + alpha * buckets, sum(good) + alpha * buckets
    return [math.log((g + alpha) / all_good) - math.log((r + alpha) / all_raw) for g, r in zip(good, raw)]


def trusted_ids(labels: DataFrame, most: int = 20_000) -> DataFrame:
    """doc_ids of at most `most` documents labelled as good, chosen by a hash of the id: the bound on what is broadcast."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def quality_rules(docs: DataFrame, trusted: DataFrame, buckets: int = 1 << 13, alpha: float = 1.0, threshold: float = -0.05, least_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """All rows with the counts of OWN, llr (null without words) and kept added.

    Words are runs without white space.  base_failed: fewer than `least_words` words, or more than `most_repeated` percent of
    them in repeated three-word windows.  kept: not base_failed and llr >= threshold.  Null or empty text has no words and fails
    the base rules.  Repeated rows are judged alike, each by itself; an empty table gives an empty table.  `trusted` must be
    bounded (see trusted_ids): it is broadcast; without trusted rows all weights are near 0.  Other columns pass through; input columns with
    a result's name are replaced.  Memory: an array of the longest text's words and hashes in one task.
    """
    table = F.lit(np.array(ngram_weights(docs, trusted, buckets, alpha)))
    keep = [F.col(c) for c in carried(docs, OWN)]
    base = _words(docs, keep)
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    w, n = F.col("__w"), F.size("__w").cast("long")
    some = base.select(*keep, n.alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"), F.regexp_count("__t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), lines.alias("__lines"), _runs(w, 3).alias("__h"), _buckets(w, buckets).alias("__b"))
    more = some.withColumn("__twice", F.size(F.array_distinct("__h")) < F.size("__h"))
    more = more.withColumn("__s", F.when(F.col("__twice"), _ordered(F.col("__h")))).drop("__h")
    more = more.withColumn("__at", F.when(F.col("__twice"), _repeated(F.col("__s"))).otherwise(F.array().cast("array<int>")))
    at = F.col("__at")
    covered = F.aggregate(at, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")), lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")))["n"]
    llr = F.when(F.size("__b") > 0, F.aggregate("__b", F.lit(0.0), lambda a, b: a + F.get(table, b)) / F.size("__b"))
    out = more.select(*keep, "n_words", "word_chars", "n_symbols", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"), covered.alias("n_repeat_words"), llr.alias("llr"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold)).select(*carried(docs, OWN), *OWN)
