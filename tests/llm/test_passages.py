from collections import Counter

import brute
import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldspark.llm import passages


@pytest.mark.parametrize(("least", "segment", "hot"), [(100, 1 << 22, 8192), (400, 1500, 8192), (100, 1 << 22, 1)])
def test_removed_bytes_against_brute_force(spark, monkeypatch, least, segment, hot):
    rows = cases.documents()
    monkeypatch.setattr(passages, "SEGMENT", segment)
    default = passages.repeated_windows
    monkeypatch.setattr(passages, "repeated_windows", lambda texts, n: default(texts, n, hot=hot))
    got = passages.remove_repeats(cases.frame(spark, rows), least=least).withColumn("sha", F.sha2("kept", 256)).collect()
    want = [(r[0], *brute.repeat_digest(*x)) for r, x in zip(rows, brute.repeats([r[1] for r in rows], least))]
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((g["doc_id"], g["n_bytes"], g["n_removed"], g["n_spans"], g["sha"]) for g in got), key=key) == sorted(want, key=key)
    assert any(w[2] for w in want)


@pytest.mark.parametrize("hot", [512, 1])
def test_shorter_passages_are_told_and_change_nothing(spark, monkeypatch, hot):
    rows = cases.documents()
    default = passages.repeated_windows
    monkeypatch.setattr(passages, "repeated_windows", lambda texts, n: default(texts, n, hot=hot))
    got = passages.remove_repeats(cases.frame(spark, rows), least=400, passage=150).withColumn("sha", F.sha2("kept", 256)).collect()
    texts = [r[1] for r in rows]
    want = [(r[0], *brute.repeat_digest(*x), sum(y[1])) for r, x, y in zip(rows, brute.repeats(texts, 400), brute.repeats(texts, 150))]
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((g["doc_id"], g["n_bytes"], g["n_removed"], g["n_spans"], g["sha"], g["n_passage"]) for g in got), key=key) == sorted(want, key=key)
    assert any(w[2] < w[5] for w in want)


def test_a_group_of_many_contexts_is_a_batch_of_its_own():
    r = np.random.default_rng(6)
    core = r.integers(97, 123, 150).astype(np.uint8).tobytes()
    context = lambda: r.integers(97, 99, 6).astype(np.uint8).tobytes() + core
    rows = [(g, 1, 100 * g + k, 0, context()) for g, n in ((1, 3), (2, 40), (3, 2), (4, 30)) for k in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], ["g", "kind", "rid", "lo", "context"])

    def marked(size):
        out = pa.Table.from_batches(list(passages._mark_contexts(150, size)(iter([batch.slice(0, 20), batch.slice(20)]))))
        return sorted((x["rid"], i) for x in out.to_pylist() for i in range(x["lo"], x["hi"] + 1))

    windows = [(g, rid, i, text[i : i + 150]) for g, _, rid, _, text in rows for i in range(7)]
    seen = Counter(w for g, _, _, w in windows)
    want = sorted((rid, i) for g, rid, i, w in windows if sum(n for x, n in seen.items() if x == w) > 1)
    by_group = Counter((g, w) for g, _, _, w in windows)
    assert marked(1 << 20) == want
    assert {m for m in want if m in set(marked(500))} == {(rid, i) for g, rid, i, w in windows if by_group[g, w] > 1}


def test_runs_of_a_text_longer_than_an_anchors_place(monkeypatch):
    r = np.random.default_rng(5)
    part = lambda n: r.integers(97, 123, n).astype(np.uint8).tobytes().decode()
    passage = part(700)
    batch = pa.RecordBatch.from_pydict({"rid": pa.array([1, 2], pa.int64()), "start": pa.array([0, 0], pa.int64()), "text": [part(500) + passage + part(9000) + passage + part(3000), passage]})
    monkeypatch.setattr(passages, "SEGMENT", 1500)

    def found():
        blocks = [b for out in passages._find_runs(100, 1)(iter([batch])) for b in out.column("runs").to_pylist()]
        return np.frombuffer(b"".join(blocks), passages.RUN)

    want = found()
    monkeypatch.setattr(passages, "PLACE", np.uint64((1 << 12) - 1))
    assert (want["n"] == 3).any() and found().tolist() == want.tolist()


def test_matching_statistics_against_brute_force():
    r = np.random.default_rng(3)
    texts = [bytes(r.integers(97, 99, n).astype(np.uint8)) for n in (1, 30, 45, 45, 7)]
    texts += [texts[1], texts[2][:20], b"", b"aaaaaaaaaaaa"]
    texts = [t for t in texts if t]
    index = passages.RunIndex(texts)
    suffixes = [t[i:] for t in texts for i in range(len(t))]

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    want = [max(common(a, b) for k, b in enumerate(suffixes) if k != i) for i, a in enumerate(suffixes)]
    assert index.matching_statistics().tolist() == want
    assert index.lengths.sum() == len(suffixes) and len(index.heads) <= len(suffixes)


def test_characters_are_not_broken(spark):
    text = "é" * 90 + "x" + "é" * 90
    got = passages.remove_repeats(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), least=100).first()
    assert set(got["clean_text"]) <= {"é", "x"} and got["n_bytes"] == 361


def test_empty(spark):
    assert passages.remove_repeats(cases.frame(spark, []), least=100).collect() == []
