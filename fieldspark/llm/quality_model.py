"""Quality classification by co-training.

Two logistic models see different views of a document: its text's content, and its page's metadata (source, language and the recorded number of
characters), nothing of which is read from the text.  In each round both score all unlabelled documents of the table, and each gives those that it is surest of to
the other as labelled.  Both are then calibrated on labelled rows that they have not seen, and a small logistic model over the two calibrated
views, fitted on further such rows, scores every document.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldspark.llm.common import carried, crc_of_id, ids_of, map_rows, stage, texts_of

OWN = "p_text double, p_meta double, score double, kept boolean"
TEXT, SOURCES, LANGS, SIZES = 1024, 64, 16, 24
META = SOURCES + LANGS + SIZES + 1
SURE = 5.0


def text_view(text: bytes) -> np.ndarray:
    """Hashed character trigrams of the raw text (as shares, square roots) and a few shares of its words, lines and marks."""
    a = np.frombuffer(text, np.uint8).astype(np.uint32)
    out = np.zeros(TEXT + 10, np.float32)
    if len(a) >= 3:
        h = (a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA77) + a[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
        out[:TEXT] = np.sqrt(np.bincount(h >> np.uint32(22), minlength=TEXT) / (len(a) - 2))
    words = text.split()
    if words:
        out[TEXT] = len(set(words)) / len(words)
        out[TEXT + 1] = ((a >= 65) & (a <= 90)).mean()
        out[TEXT + 2] = min(1.0, len(text) / len(words) / 20)
        out[TEXT + 3] = np.log1p(len(words)) / 10
    lines = [x for x in text.split(b"\n") if x.strip()]
    if lines:
        out[TEXT + 4] = np.log1p(len(lines)) / 8
        out[TEXT + 5] = np.log1p(len(text) / len(lines)) / 10
        out[TEXT + 6] = len(set(lines)) / len(lines)
        out[TEXT + 7] = sum(x.rstrip()[-1:] in b".?!" for x in lines) / len(lines)
        out[TEXT + 8] = min(1.0, 10 * (1 - len(text.translate(None, b"#*$%&|<>!")) / len(text)))
        out[TEXT + 9] = np.log1p(len(text)) / 12
    return out


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(META, np.float32)
    for value, base, n in ((source, 0, SOURCES), (lang, SOURCES, LANGS)):
        if value is not None:
            out[base + zlib.crc32(value.encode()) % n] = 1
    if n_chars is not None:
        size = np.log2(max(1, n_chars))
        out[SOURCES + LANGS + min(int(size), SIZES - 1)] = 1  # by doublings, as middling lengths may be the best ones
        out[-1] = size / SIZES
    return out


class Logistic:
    """Logistic regression with L2, by full-batch Adam from zero: the same input gives the same weights."""

    def __init__(self, x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 250, rate: float = 0.1, balanced: bool = True):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-2
        z = np.hstack([(x - self.mean) / self.scale, np.ones((len(x), 1), np.float32)])
        share = (0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())) if balanced else (1 / len(y), 1 / len(y))
        weight = np.where(y > 0, *share).astype(np.float32)
        w, m, v = np.zeros(z.shape[1], np.float32), 0.0, 0.0
        for t in range(1, steps + 1):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            g = z.T @ ((p - y) * weight) + l2 * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        self.w = w

    @classmethod
    def known(cls, w: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> Logistic:
        out = cls.__new__(cls)
        out.w, out.mean, out.scale = w, mean, scale
        return out

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1], -30, 30)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


class Model:
    def __init__(self, text: Logistic, meta: Logistic, calibrate: tuple[tuple[float, float], tuple[float, float]], combine: Logistic):
        self.text, self.meta, self.calibrate, self.combine = text, meta, calibrate, combine

    def score(self, t: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        views = [a * z + b for (a, b), z in zip(self.calibrate, (self.text.logit(t), self.meta.logit(m)))]
        return _sigmoid(views[0]), _sigmoid(views[1]), _sigmoid(self.combine.logit(np.stack(views, 1).astype(np.float32)))


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make logits probabilities: one feature, no class weights."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(np.clip(a * z + b, -30, 30))
        g = np.array([((p - y) * z).mean() + 1e-3 * (a - 1), (p - y).mean()])
        s = p * (1 - p)
        h = np.array([[(s * z * z).mean() + 1e-3, (s * z).mean()], [(s * z).mean(), s.mean() + 1e-6]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    return max(a, 1e-3), b


READ = ["doc_id", "text", "source", "lang", "n_chars"]


def _columns(docs: DataFrame) -> DataFrame:
    """What both views read; without a column n_chars that part of the metadata is unknown."""
    return docs.select(*READ[:-1], (F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")).alias("n_chars"))


def _both(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    t = [text_view(x) for x in texts_of(b)]
    m = [meta_view(*x) for x in zip(*[ids_of(b, c).to_pylist() for c in ("source", "lang", "n_chars")])]
    return np.stack(t), np.stack(m)


def _rows(docs: DataFrame, keep: list[str]) -> list[dict]:
    """Both views of a bounded number of rows, at the driver."""

    def make():
        def f(b: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([x.tobytes() for x in view], pa.binary()) for view in _both(b)]

        return f

    rows = map_rows(docs, make, "t binary, m binary", keep=["doc_id", *keep], read=READ).toArrow().to_pylist()
    return sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["t"]))


def _surest(free: DataFrame, models: list[Logistic], calibrate: list[tuple[float, float]], good: float, give: int) -> DataFrame:
    """The rows that each view (__by) is surest of, with their label __y: of all free documents at most `give`, in the labelled rows' proportion.

    Sure is a calibrated probability of 0.9 or more for the label, and odds at least SURE times those of any row.  Each row is scored once, and of the scores only the
    greatest and least are read again; rows that are equal in all columns are one.
    """
    sent = free.sparkSession.sparkContext.broadcast([(x.w, x.mean, x.scale) for x in models])

    def make():
        views = [Logistic.known(*x) for x in sent.value]

        def f(b: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array((p * x.logit(v) + q).astype(float)) for x, v, (p, q) in zip(views, _both(b), calibrate)]

        return f

    free = free.withColumn("__h", F.xxhash64(*READ))
    scored = stage(map_rows(free, make, "z0 double, z1 double", keep=["__h"], read=READ), "surest").groupBy("__h").agg(F.first("z0").alias("z0"), F.first("z1").alias("z1"))
    usual, least = float(np.log(good / (1 - good))), float(np.log(9))
    z1, z0 = float(max(least, usual + np.log(SURE))), float(min(-least, usual - np.log(SURE)))
    picks = []
    for z in ("z0", "z1"):
        for y, n, by, sure in ((1, round(give * good), F.desc(z), F.col(z) >= z1), (0, round(give * (1 - good)), F.asc(z), F.col(z) <= z0)):
            picks.append(scored.where(sure).orderBy(by, "__h").limit(max(1, n)).select("__h", F.lit(y).alias("__y"), F.lit(z).alias("__by")))
    few = reduce(DataFrame.unionByName, picks)  # some more than twice `give`
    return free.join(F.broadcast(few), "__h").dropDuplicates(["__h", "__by"]).drop("__h")


def fit(docs: DataFrame, labels: DataFrame, labelled: int = 4000, rounds: int = 2, share: float = 0.1) -> Model | None:
    """A model from labels (doc_id, quality 0 or 1) of docs; null labels and ids teach nothing.

    The bound: `labelled` labelled documents, those with the least hashes of their ids, each read as a whole (of several rows of one id, one).  Three fifths of them
    teach the views, one fifth calibrates each view, and one fifth the combination of both.  In each of `rounds` each view scores all unlabelled documents, whatever their number, and
    hands over those that it is surest of, as many as `share` of the rows that teach.  None if a class has no example in each part.
    """
    docs = _columns(docs)
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("__y"))
    chosen = known.orderBy(F.xxhash64(F.lit("label"), "doc_id"), "doc_id").limit(labelled)
    mark = docs.join(F.broadcast(chosen), "doc_id", "left")  # at most `labelled` ids
    version = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "source", "lang"))
    rows = _rows(mark.where(F.col("__y").isNotNull()).withColumn("__v", version).where(F.col("__v") == 1).drop("__v"), ["__y"])
    if not rows:
        return None
    t, m = (np.stack([np.frombuffer(r[k], np.float32) for r in rows]) for k in ("t", "m"))
    y = np.array([r["__y"] for r in rows], np.float32)
    fold = np.array([zlib.crc32(f"fold{r['doc_id']}".encode()) % 5 for r in rows])
    train, calibrates, combines = np.flatnonzero(fold > 1), np.flatnonzero(fold == 0), np.flatnonzero(fold == 1)
    if any(len(set(y[part].tolist())) < 2 for part in (train, calibrates, combines)):
        return None
    own = [(v[train], y[train]) for v in (t, m)]
    models = [Logistic(*x) for x in own]
    good = float(y[train].mean())
    free, given = mark.where(F.col("__y").isNull()).drop("__y"), [set(), set()]
    for _ in range(rounds):
        calibrate = [_platt(x.logit(v[calibrates]), y[calibrates]) for x, v in zip(models, (t, m))]
        rows = _rows(_surest(free, models, calibrate, good, round(share * len(train))), ["__y", "__by"])
        for a in (0, 1):  # view a learns what the other gave, once
            new = [r for r in rows if r["__by"] == f"z{1 - a}" and r["t"] + r["m"] not in given[a]]
            given[a] |= {r["t"] + r["m"] for r in new}
            if new:
                x = np.stack([np.frombuffer(r["tm"[a]], np.float32) for r in new])
                own[a] = np.concatenate([own[a][0], x]), np.concatenate([own[a][1], np.array([r["__y"] for r in new], np.float32)])
        models = [Logistic(*x) for x in own]
    calibrate = tuple(_platt(x.logit(v[calibrates]), y[calibrates]) for x, v in zip(models, (t, m)))
    both = np.stack([a * x.logit(v[combines]) + b for (a, b), x, v in zip(calibrate, models, (t, m))], 1).astype(np.float32)
    return Model(models[0], models[1], calibrate, Logistic(both, y[combines], l2=1e-3, balanced=False))


def classify(docs: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """All rows with p_text, p_meta (calibrated views), score (both) and kept (score >= threshold) added.

    Null text counts as empty and texts of any length are read as a whole; null source, lang or n_chars set no metadata bit.  Without a model all scores are null and all rows kept.
    Repeated rows are scored alike; an empty table gives an empty table; input columns with a result's name are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # two weight vectors of fixed length

    def make():
        m = sent.value

        def f(b: pa.RecordBatch) -> list[pa.Array]:
            if m is None:
                return [*[pa.nulls(b.num_rows, pa.float64())] * 3, pa.array([True] * b.num_rows)]
            p, q, s = (x.astype(float) for x in m.score(*_both(b)))
            return [pa.array(p), pa.array(q), pa.array(s), pa.array(s >= threshold)]

        return f

    if "n_chars" not in docs.columns:
        return map_rows(docs.withColumn("n_chars", F.lit(None).cast("bigint")), make, OWN, keep=carried(docs, [x.split()[0] for x in OWN.split(", ")]), read=READ)
    return map_rows(docs, make, OWN, read=READ)


def held_out(n: int = 5, which: int = 4):
    return crc_of_id() % n == which
