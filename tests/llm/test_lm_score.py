import math
import zlib
from collections import Counter

import brute
import cases
import numpy as np

from fieldspark.llm import lm_score


def test_scores_against_brute_force(spark):
    rows = cases.documents()
    got = lm_score.score(cases.frame(spark, rows), batch_bytes=20_000).collect()
    want = brute.lm_base([(r[0], r[1]) for r in rows], lambda c: c % 7 != 2)
    key = lambda i, n, known, base: (i is None, i or 0, n, known, round(base, 6))
    assert sorted(key(g["doc_id"], g["n_tokens"], g["n_known"], g["base_score"]) for g in got) == sorted(key(r[0], n, k, b) for r, (n, k, _, b) in zip(rows, want))
    assert {g["train_tokens"] for g in got} == {want[0][2]}
    assert all(g["score"] < 0 and math.isfinite(g["score"]) for g in got)
    held = [g for g in got if g["held_out"]]
    assert held and sum(g["score"] for g in held) > sum(g["base_score"] for g in held)


def test_scores_are_the_mixture_and_sum_to_one(spark, monkeypatch):
    """With given weights: each text's score by plain counting, and all continuations of each context, the unknown word included."""
    r = np.random.default_rng(8)
    weights = r.dirichlet([1, 1, 1], lm_score.BUCKETS)
    weights[0] = [0, 0.7, 0.3]
    monkeypatch.setattr(lm_score, "learn_weights", lambda cells, n: weights)
    rows = [(i, " ".join(r.choice(list("abcdefgh"), r.integers(0, 30)))) for i in range(60)]
    got = {g["doc_id"]: g for g in lm_score.score(spark.createDataFrame(rows, "doc_id bigint, text string"), batch_bytes=200).collect()}
    tokens = {i: [*t.split(), None] for i, t in rows}
    train = [t for i, t in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    one = Counter(x for t in train for x in t)
    two = Counter(x for t in train for x in zip([None, *t], t))
    total = sum(one.values())

    def p(word, before):
        c = one[before]
        w = weights[min(int(math.log2(c)) + 1, lm_score.BUCKETS - 1) if c else 0]
        return w[0] * (two[before, word] / c if c else 0) + w[1] * one[word] / total + w[2] / (len(one) + 1)

    for i, t in tokens.items():
        assert math.isclose(got[i]["score"], sum(math.log10(p(x, y)) for y, x in zip([None, *t], t)), rel_tol=1e-9)
    for before in [*one, "unknown"]:
        assert math.isclose(sum(p(x, before) for x in [*one, "unknown"]), 1) or not one[before]  # the uniform part has a place for the unknown word


def test_rounded_ratios_cost_little(spark):
    """Weights learned on rounded ratios against expectation-maximisation on the exact ones: the likelihood of the held-back tokens."""
    r = np.random.default_rng(9)
    ratio = np.exp2(r.normal([6, 4], [4, 3], (4000, 2)))
    ratio[r.random((4000, 2)) < [0.3, 0.05]] = 0
    exact = np.concatenate([ratio, np.ones((4000, 1))], 1)
    w = np.full(3, 1 / 3)
    for _ in range(60):
        share = exact * w
        w = (share / share.sum(1, keepdims=True)).mean(0)
    rounded = np.where(ratio > 0, np.rint(lm_score.STEP * np.log2(np.maximum(ratio, 1e-300))).astype(np.int64) + 201, 0)
    cell, n = np.unique((3 << 20) | (rounded[:, 0] << 10) | rounded[:, 1], return_counts=True)
    got = lm_score.learn_weights(cell, n.astype(float))[3]
    loss = lambda x: -np.log2(exact @ x).mean()
    assert 0 <= loss(got) - loss(w) < 1e-3 and np.abs(got - w).max() < 0.02


def test_weights_are_mixtures_and_follow_the_likelihood():
    bucket = np.array([3, 3, 0])
    good = 201 + 8 * lm_score.STEP
    cells = (bucket << 20) | (np.array([good, 0, 0]) << 10) | np.array([201, good, good])
    w = lm_score.learn_weights(cells, np.array([90.0, 10.0, 5.0]))
    assert np.allclose(w.sum(1), 1) and w[0, 0] == 0 and w[3, 0] > w[3, 1] > 0


def test_empty_and_untrained(spark):
    assert lm_score.score(cases.frame(spark, [])).collect() == []
    only = spark.createDataFrame([(5, "x y"), (5, None)], "doc_id bigint, text string")
    got = lm_score.score(only, trains=lambda c: False).collect()
    assert {(g["held_out"], g["n_tokens"], g["n_known"], g["train_tokens"]) for g in got} == {(True, 3, 0, 0), (True, 1, 0, 0)}
