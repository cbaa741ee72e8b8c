import math
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import cases
import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.dataset as ds
import pyarrow.parquet as pq
import pytest

from fieldspark.llm import packing, token_store
from fieldspark.llm.queries import tokenizer_path
from fieldspark.llm.tokens import Encoder

HARD = ["Hello, World!! it's Don'T <|endoftext|> a<|startoftext|>b", "  lead trail ", "ÀÉ naïve ŒUVRE ﬁ ½ ²x 3.14 100%", "İstanbul ΑΣ Σ \x1c x\x0by\x0cz \x85q", "“quoted” — dash… #tag's 'll 've", "x'S I'LL a''s", "\U0001f600 ok 日本語", "ß× a×b ÷ µm ª K Å", "<|<|> <| |>", "!" * 50 + "x", "A.B.C. (paren) [x]_y ''", ""]


def plain(tokenizer, text, end):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def test_ids_equal_the_librarys():
    e = Encoder(tokenizer_path(), limit=40)
    texts = HARD + [r[1] or "" for r in cases.documents()]
    for part in (texts[:30], texts[30:], texts[:30]):
        ids, n = e.encode([t.encode() for t in part], 9)
        for got, t in zip(np.split(ids, np.cumsum(n)[:-1]), part):
            assert got.tolist() == plain(e.tokenizer, t, 9).tolist(), t


def test_words_are_merged_together_as_the_library_does(monkeypatch):
    """Before, the library's model was called for each new word by itself, which was half of the time of encoding."""
    r = np.random.default_rng(9)
    words = ["".join(r.choice(list(letters), n)) for letters, most in (("abcdeinrthßéü", 32), ("!?.,-#", 12)) for n in r.integers(0, most + 1, 3000)]
    words += [x * n for x in ("a", "ha", "!", "é") for n in range(1, 16)] + [""]
    e = Encoder(tokenizer_path())
    flat, lengths = e._tokenized(words)
    long = ["x" * 33, "é" * 40, "th" * 500]
    with_long = e._tokenized(words[:9] + long + words[9:])
    asked, tokenized = [], Encoder._tokenized
    monkeypatch.setattr(Encoder, "_tokenized", lambda self, strings: asked.extend(strings) or tokenized(self, strings))
    short = [w for w in words if len(w.encode()) <= 32]
    got, n = e._parts(short)
    assert not asked and got.tolist() == e._tokenized(short)[0] and n.tolist() == e._tokenized(short)[1]
    got, n = e._parts(words)
    assert got.tolist() == flat and n.tolist() == lengths
    asked.clear()
    got, n = e._parts(words[:9] + long + words[9:])
    assert set(asked) == {w for w in words + long if len(w.encode()) > 32}
    assert got.tolist() == with_long[0] and n.tolist() == with_long[1]
    for few in ([], [""], ["", ""], long[:1], long):
        got, n = e._parts(few)
        assert [list(got), list(n)] == list(map(list, e._tokenized(few)))


@pytest.mark.parametrize("n", [0, 1, 5, 1000])
def test_perfect_hash_is_minimal(n):
    keys = token_store.key_hashes(pa.array(range(n), pa.int64()))
    h = token_store.PerfectHash.build(keys)
    assert sorted(h.find(keys).tolist()) == list(range(n))


def test_store_round_trip_and_keyed_access(spark):
    rows = cases.documents()
    docs = cases.frame(spark, rows)
    store = token_store.write_tokens(docs, tokenizer_path(), end_id=1, n_shards=5)
    e = Encoder(tokenizer_path())
    got = store.lookup(docs.select("doc_id")).collect()
    key = lambda i: (i is not None, i or 0)
    assert sorted((key(g["doc_id"]), zlib.crc32(g["ids"])) for g in got) == sorted((key(r[0]), zlib.crc32(plain(e.tokenizer, r[1], 1).tobytes())) for r in rows)
    at = 0
    for g in sorted(got, key=lambda g: g["start"]):
        assert g["start"] == at
        at += len(g["ids"]) // 4
    order = [key(g["doc_id"]) for g in sorted(got, key=lambda g: g["start"])]
    assert order == sorted(order)
    some = store.lookup(spark.createDataFrame([(7,), (7,), (99999,), (-5,)], "doc_id bigint")).collect()
    assert [g["doc_id"] for g in some] == [7]


def test_store_of_nothing(spark):
    store = token_store.write_tokens(cases.frame(spark, []), tokenizer_path(), end_id=1)
    assert store.lookup(spark.createDataFrame([(1,)], "doc_id bigint")).collect() == []


def test_packing_covers_every_id_once(spark):
    rows = cases.documents()
    got = packing.pack(cases.frame(spark, rows), tokenizer_path(), end_id=2, window=512, index_tokens=3000).collect()
    e = Encoder(tokenizer_path())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for g in got:
        assert len(g["ids"]) == 4 * g["length"]
        pieces[g["doc_id"]].append((g["start"], g["length"], bytes(g["ids"])))
        sequences[g["sequence_id"]].append((g["offset"], g["length"]))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at == 512 or at & (at - 1) == 0
    want = defaultdict(list)
    for r in rows:
        want[r[0]].append(plain(e.tokenizer, r[1], 2).tobytes())
    assert set(pieces) == set(want)
    for i, texts in want.items():
        if len(texts) == 1:
            assert b"".join(p for _, _, p in sorted(pieces[i])) == texts[0]
        assert sum(n for _, n, _ in pieces[i]) * 4 == sum(map(len, texts))


def test_neighbours_share_words():
    r = np.random.default_rng(0)
    topics = [r.integers(k * 1000, k * 1000 + 60, (8, 100)) for k in range(4)]
    docs = [{"id": 10 * k + j, "ids": row.astype(np.uint32), "at": 0} for j in range(8) for k, row in enumerate(t[j] for t in topics)]
    windows = [[d["id"] // 10 for d, _, _ in parts] for parts, _ in packing._fill(docs, 400, 32, True, packing.Words())]
    assert all(len(set(w)) == 1 for w in windows)


@pytest.mark.parametrize(("most", "cells"), [(10, 1 << 18), (3, 1)])
def test_a_query_reaches_every_shard(tmp_path, most, cells):
    r = np.random.default_rng(1)
    docs = [np.append(r.zipf(1.3, r.integers(1, 90)) % 500, 2).astype(np.uint32) for _ in range(200)]
    words = packing.Words()
    corpus = packing.Corpus.of(docs, words, common=1.0)
    coded = pa.RecordBatch.from_pydict({"k": pa.array(range(200), pa.int64()), "coded": [d.astype("<u2").tobytes() for d in docs], "n": pa.array([len(d) for d in docs], pa.int64())})
    shards = list(packing._index(SimpleNamespace(value=corpus), words, 700, 8)(iter([coded])))
    assert len(shards) > 5
    half = len(shards) // 2
    paths = [str(tmp_path / f"part-{k}.parquet") for k in range(2)]
    for path, own in zip(paths, (shards[:half], shards[half:])):
        pq.write_table(pa.Table.from_batches(own), path, row_group_size=2)
    queries = pa.Table.from_batches([q for b in shards for q in packing._queries(iter([pa.RecordBatch.from_arrays(b.columns[:1] + b.columns[2:4], ["k", "n_query", "query"])]))]).to_pylist()
    unused = r.random(200) < 0.7
    sent = SimpleNamespace(value=(np.packbits(unused, bitorder="little"), np.array([len(q["query"]) // 4 for q in queries]), np.frombuffer(b"".join(q["query"] for q in queries), "<u4")))
    found = pa.Table.from_batches([b for path in paths for b in packing._search("file:///", SimpleNamespace(value=corpus), sent, most, 3, cells)(iter([pa.record_batch({"path": [path]})]))])
    rankings = {}
    for part in range(3):
        got = packing._merge(most)(found.filter(pa.compute.equal(found.column("part"), part))).to_pylist()[0]
        for s, d in zip(np.frombuffer(got["seeds"], "<i8").tolist(), np.frombuffer(got["docs"], "<i8").tolist()):
            rankings.setdefault(queries[s]["k"], []).append(d)
    index = packing.Index(docs, 8, words, corpus)
    assert set(rankings) == set(range(200))
    for k, got in rankings.items():
        score = np.where(unused, index.scores(k), 0)
        want = np.sort(score)[::-1][:most]
        assert unused[got].all() and len(set(got)) == len(got) == (want > 0).sum()
        assert np.allclose(score[got], want[: len(got)], rtol=1e-5)


def test_scores_are_bm25():
    r = np.random.default_rng(4)
    docs = [r.integers(0, 40, r.integers(1, 30)).astype(np.uint32) for _ in range(50)]
    index = packing.Index(docs, 5, packing.Words())
    n, mean = len(docs), sum(map(len, docs)) / len(docs)
    df = {t: sum(t in d for d in docs) for t in range(40)}
    idf = {t: math.log(1 + (n - f + 0.5) / (f + 0.5)) for t, f in df.items() if 1 < f <= 0.25 * n}

    def weight(t, d):
        tf = int((d == t).sum())
        return idf.get(t, 0) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))

    for k, seed in enumerate(docs):
        weights = sorted((weight(t, seed) for t in set(seed.tolist())), reverse=True)
        got = index.scores(k)
        query = [t for t in set(seed.tolist()) if weight(t, seed) > 0 and weight(t, seed) > (weights[5] if len(weights) > 5 else 0)]
        if len(query) == min(5, sum(w > 0 for w in weights)):  # no tie at the query's end
            assert np.allclose(got, [sum(weight(t, d) for t in query) for d in docs], rtol=1e-5)


def test_terms_are_words():
    e = Encoder(tokenizer_path())
    words = packing.Words.of(e.tokenizer.get_vocab())
    texts = ["abrelontis mikundar, abrelontis!", "mikundar kopal", "", "xx abrelontis"]
    flat, n = e.encode([t.encode() for t in texts], 2)
    term, doc, tf = words.pairs(np.split(flat, np.cumsum(n)[:-1]))
    count = {(d, t): c for t, d, c in zip(term.tolist(), doc.tolist(), tf.tolist())}
    (twice,) = [t for (d, t), c in count.items() if c == 2]
    assert (3, twice) in count and (1, twice) not in count
    assert [sum(c for (d, _), c in count.items() if d == k) for k in range(4)] == [6, 3, 1, 3]


def test_windows_hold_one_topic_however_the_index_is_cut(spark):
    r = np.random.default_rng(2)
    words = ["".join(r.choice(list("abdegiklmnoprstu"), 6)) for _ in range(960)]
    rows = [(i, " ".join(r.choice(words[60 * (i % 16) : 60 * (i % 16) + 60], 60))) for i in range(320)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), tokenizer_path(), end_id=2, window=512, index_tokens=3000).collect()
    topics = defaultdict(set)
    for g in got:
        topics[g["sequence_id"]].add(g["doc_id"] % 16)
    assert sum(len(t) == 1 for t in topics.values()) > 0.6 * len(topics), sum(len(t) == 1 for t in topics.values()) / len(topics)


def test_pack_of_nothing(spark):
    assert packing.pack(cases.frame(spark, []), tokenizer_path(), end_id=2).collect() == []


def test_later_rounds_read_what_is_left(spark, monkeypatch):
    """When half of an index is packed, the rest is an index of its own: before, each round read all documents' postings."""
    r = np.random.default_rng(6)
    words = ["".join(r.choice(list("abdegiklmnoprstu"), 6)) for _ in range(960)]
    rows = [(i, " ".join(r.choice(words[60 * (i % 16) : 60 * (i % 16) + 60], 60))) for i in range(400)]
    rounds, search, seeds = [], packing._search, packing.Packer.seeds

    def watched_seeds(self, most):
        rounds.append([set(np.flatnonzero(self.left).tolist()), set()])
        return seeds(self, most)

    def watched_search(root, *rest):
        read = ds.dataset(root.removeprefix("file://"), format="parquet").to_table(columns=["k"]).column("k").to_pylist()
        rounds[-1][1].update(k for part in read for k in np.frombuffer(part, "<i8").tolist())
        return search(root, *rest)

    monkeypatch.setattr(packing.Packer, "seeds", watched_seeds)
    monkeypatch.setattr(packing, "_search", watched_search)
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string"), tokenizer_path(), end_id=2, window=512, index_tokens=3000).collect()
    assert len(rounds) > 1 and len(rounds[-1][1]) < 200
    for left, read in rounds:
        assert left <= read and len(read) < 2 * len(left) + 1
    whole = Counter()
    for g in got:
        whole[g["doc_id"]] += g["length"] - g["doc_tokens"] * (g["start"] == 0)
    assert set(whole) == set(range(400)) and not any(whole.values())


def test_an_index_of_what_is_left_finds_the_same(tmp_path):
    r = np.random.default_rng(7)
    docs = [np.append(r.zipf(1.3, r.integers(1, 90)) % 500, 2).astype(np.uint32) for _ in range(200)]
    words = packing.Words()
    corpus = SimpleNamespace(value=packing.Corpus.of(docs, words, common=1.0))
    coded = pa.RecordBatch.from_pydict({"k": pa.array(range(200), pa.int64()), "coded": [d.astype("<u2").tobytes() for d in docs], "n": pa.array([len(d) for d in docs], pa.int64())})
    shards = list(packing._index(corpus, words, 700, 8)(iter([coded])))
    live = r.random(200) < 0.4
    paths = [str(tmp_path / f"{name}.parquet") for name in ("whole", "left")]
    pq.write_table(pa.Table.from_batches(shards), paths[0])
    given = lambda path: iter([pa.record_batch({"path": [path]})])
    left = list(packing._remaining("file:///", SimpleNamespace(value=np.packbits(live, bitorder="little")), 700)(given(paths[0])))
    assert len(left) < len(shards) and sorted(k for b in left for k in np.frombuffer(b.column("k")[0].as_py(), "<i8").tolist()) == np.flatnonzero(live).tolist()
    pq.write_table(pa.Table.from_batches(left), paths[1])
    terms = np.unique(words.pairs(docs)[0]).astype("<u4")
    queries = [r.choice(terms, 8, replace=False) for _ in range(50)]
    found = []
    for path in paths:
        best = {}
        sent = SimpleNamespace(value=(np.packbits(live, bitorder="little"), np.full(50, 8), np.concatenate(queries)))
        for b in packing._search("file:///", corpus, sent, 200, 1)(given(path)):
            seed, score, doc = (np.frombuffer(b.column(c)[0].as_py(), t) for c, t in (("seeds", "<i8"), ("scores", "<f4"), ("docs", "<i8")))
            best |= {(s, d): x for s, d, x in zip(seed.tolist(), doc.tolist(), score.tolist())}
        found.append(best)
    assert len(found[0]) > 500 and found[0].keys() == found[1].keys()
    assert all(math.isclose(x, found[1][key], rel_tol=1e-5) for key, x in found[0].items())


def test_equal_scores_are_in_the_order_of_documents():
    r = np.random.default_rng(8)
    best = packing.Best(5, 40)
    seed, doc = np.repeat(np.arange(5), 200), np.concatenate([r.permutation(1000)[:200] for _ in range(5)])
    score = r.integers(1, 9, 1000).astype(np.float32)
    best.add(seed, score, doc)
    got = list(zip(*(x.tolist() for x in best.rows())))
    want = sorted(zip(seed.tolist(), (-score).tolist(), doc.tolist()))
    assert got == [(s, -x, d) for k in range(5) for s, x, d in [w for w in want if w[0] == k][:40]]
