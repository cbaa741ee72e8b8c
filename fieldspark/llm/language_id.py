"""Language identification by nearest centroid.

A text is a normalised TF-IDF vector of hashed letter bigrams and trigrams.  Each language has several centroids, clustered
from a bounded sample of its labelled texts; the nearest centroid by cosine names the language, and a text too far from it is rejected.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import map_rows, stage, texts_of

OWN = "lang_pred string, score double, rejected boolean"
DIM = 4096


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


class Profile:
    """Counts of hashed n-grams of a text's letters; runs of other characters count as one space."""

    def __init__(self):
        self.letter = _letters()

    def count(self, text: bytes) -> np.ndarray | None:
        """DIM counts; None if the text has no letter."""
        a = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
        ok = self.letter[a]
        if not ok.any():
            return None
        a = np.where(ok, a, 32)
        a = a[ok | np.concatenate([[True], ok[:-1]])]
        a = np.concatenate([[32], a, [32]]).astype(np.uint32)
        two = a[:-1] * np.uint32(0x9E3779B1) + a[1:] * np.uint32(0x85EBCA77)
        three = two[:-1] + a[2:] * np.uint32(0xC2B2AE3D)
        mixed = np.concatenate([two ^ (two >> np.uint32(15)), (three ^ (three >> np.uint32(15))) + np.uint32(1)]) * np.uint32(0x27D4EB2F)
        return np.bincount(mixed >> np.uint32(20), minlength=DIM).astype(np.uint32)


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts.astype(np.float32)) * idf
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; starts from rows far from each other, so it needs no chance."""
    k = min(k, len(v))
    start = [int(np.argmax(v @ v.mean(0)))]
    near = v @ v[start[0]]
    while len(start) < k:
        start.append(int(np.argmin(near)))
        near = np.maximum(near, v @ v[start[-1]])
    c = v[start]
    for _ in range(rounds):
        own = np.argmax(v @ c.T, axis=1)
        c = np.stack([v[own == j].sum(0) if (own == j).any() else c[j] for j in range(k)])
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


LENGTHS = 24


def length_class(grams: np.ndarray) -> np.ndarray:
    """Doublings of the number of n-grams: the cosine grows with a text's length, and so does the least one that is accepted."""
    return np.minimum(np.log2(np.maximum(grams, 1)).astype(np.int64), LENGTHS - 1)


def floors(cosine: np.ndarray, size: np.ndarray, slack: float, enough: int = 20) -> np.ndarray:
    """The least cosine accepted in each class of lengths: `slack` of the lowest hundredth of the sample's texts of that class.

    Longer classes ask for no less than shorter ones; a class of fewer than `enough` texts asks for what the next shorter one does, and the shortest for nothing more
    than `slack` of the lowest hundredth of all.
    """
    out, now = np.zeros(LENGTHS), slack * np.quantile(cosine, 0.01)
    for k in range(LENGTHS):
        own = cosine[size == k]
        if len(own) >= enough:
            now = max(now, slack * np.quantile(own, 0.01))
        out[k] = now
    return out


class Model:
    def __init__(self, langs: list[str], centroids: np.ndarray, owner: np.ndarray, idf: np.ndarray, floor: np.ndarray):
        self.langs, self.centroids, self.owner, self.idf, self.floor = langs, centroids, owner, idf, floor


def fit(docs: DataFrame, per_lang: int = 600, most_rows: int = 12_000, least_rows: int = 20, clusters: int = 4, slack: float = 0.5) -> Model | None:
    """A model from the rows of docs (doc_id, text, lang); null langs and texts without letters teach nothing, and repeated rows once.

    The sample: of every language `per_lang` documents, or if that is more than `most_rows` in all, as many fewer, but `least_rows` of each; chosen by a hash of id and
    text, each read as a whole.  No language is left out.  The driver holds 8 KB for each of them.  See floors() for `slack`.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text", F.xxhash64(F.lit("sample"), "doc_id", "text").alias("__order"))
    counts = stage(known.groupBy("lang").agg(F.approx_count_distinct("__order").alias("__n")), "langs")  # repeated rows count once
    n_langs = counts.count()
    if not n_langs:
        return None
    wanted = max(least_rows, min(per_lang, most_rows // n_langs))
    # a hash lets some four times as many through, and the least hashes of these are the sample
    known = known.join(F.broadcast(counts) if n_langs <= 100_000 else counts, "lang")
    few = known.where(F.pmod("__order", F.lit(1 << 30)) < F.least(F.lit(1.0), 4.0 * wanted / F.col("__n")) * (1 << 30)).dropDuplicates(["lang", "__order"])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("__order", "doc_id"))
    sample = few.withColumn("__rank", rank).where(F.col("__rank") <= wanted).select("doc_id", "lang", "text")

    def make():
        profile = Profile()

        def f(b: pa.RecordBatch) -> list[pa.Array]:
            got = [profile.count(t) for t in texts_of(b)]
            return [pa.array([None if g is None else np.minimum(g, 65535).astype("<u2").tobytes() for g in got], pa.binary())]

        return f

    rows = map_rows(sample, make, "grams binary", keep=["doc_id", "lang"]).where(F.col("grams").isNotNull()).toArrow().to_pylist()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["lang"], r["doc_id"] or 0, r["grams"]))
    grams = np.stack([np.frombuffer(r["grams"], "<u2") for r in rows])
    idf = (np.log((1 + len(grams)) / (1 + (grams > 0).sum(0))) + 1).astype(np.float32)
    v = unit(grams, idf)
    labels = np.array([r["lang"] for r in rows])
    langs = sorted(set(labels.tolist()))
    parts = [_cluster(v[labels == x], clusters) for x in langs]
    size = length_class(grams.sum(1, dtype=np.int64))
    floor = np.stack([floors((v[labels == x] @ c.T).max(1), size[labels == x], slack) for x, c in zip(langs, parts)])
    return Model(langs, np.concatenate(parts), np.repeat(np.arange(len(langs)), [len(c) for c in parts]), idf, floor)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows with lang_pred, score (cosine to the nearest centroid, 0 to 1) and rejected added; only the text is read.

    Null text and text without a letter: `und`, score 0, rejected.  Other texts get the nearest centroid's language, the first by
    name among equal ones; they are rejected if the cosine is below that language's floor for texts of that length.  Texts of any length are read as a whole.  Without a model every text is `und`.
    Repeated rows are judged alike; an empty table gives an empty table; input columns with a result's name are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # clusters times DIM numbers for each language

    def make():
        profile, m = Profile(), sent.value

        def f(b: pa.RecordBatch) -> list[pa.Array]:
            lang, score, away = [], [], []
            got = [profile.count(t) if m else None for t in texts_of(b)]
            at = [i for i, g in enumerate(got) if g is not None]
            lang, score, away = ["und"] * len(got), [0.0] * len(got), [True] * len(got)
            for k in range(0, len(at), 512):
                part = at[k : k + 512]
                grams = np.stack([got[i] for i in part])
                cos = unit(grams, m.idf) @ m.centroids.T
                best, size = cos.argmax(1), length_class(grams.sum(1, dtype=np.int64))
                for i, j, c, z in zip(part, best.tolist(), cos.max(1).tolist(), size.tolist()):
                    who = int(m.owner[j])
                    lang[i], score[i], away[i] = m.langs[who], min(1.0, max(0.0, c)), c < m.floor[who, z]
            return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(away, pa.bool_())]

        return f

    return map_rows(docs, make, OWN)
