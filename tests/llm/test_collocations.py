import re
from collections import Counter

import cases

from fieldspark.llm import collocations


def brute(rows, least, most, cover=80):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    out = {}
    for (lang, w), a in f.items():
        if len(w) > 1 and a >= least:
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            out[lang, w] = (score, a, f[lang, w[:k]], f[lang, w[k:]])
    gone = {(lang, w[i : i + k]) for (lang, w), x in out.items() for k in range(2, len(w)) for i in range(len(w) - k + 1) if 100 * x[1] >= cover * out.get((lang, w[i : i + k]), (0, 1e9))[1]}
    rows = []
    for lang in n:
        own = sorted(((-x[0], -x[1], " ".join(w).encode(), x) for (g, w), x in out.items() if g == lang and (g, w) not in gone), key=lambda r: r[:3])
        rows += [(lang, r + 1, p.decode(), x[1], x[2], x[3], n[lang], x[0]) for r, (_, _, p, x) in enumerate(own[:most])]
    return sorted(rows)


def ours(docs, least, most):
    return sorted(tuple(r) for r in collocations.collocations(docs, least=least, most=most).collect())


def test_equals_brute_force(spark):
    rows = cases.documents()
    rows += [(200 + i, f"New York city, new york CITY\tnew york! the\x0bthe the the the", "en" if i % 2 else None, "s", 1, 1, "q", True, "r", "x", "y") for i in range(9)]
    got = ours(cases.frame(spark, rows), 5, 60)
    assert got == brute([(r[1], r[2]) for r in rows], 5, 60)
    assert any(r[2] == "new york city" for r in got)


def test_ranges_shards_and_merges(spark, monkeypatch):
    """Splitters inside long runs of one prefix, many small shards, and sums in between don't change anything."""
    rows = [(i, " ".join(f"a b c{(i * j) % 7}" if j % 3 else "a a a a" for j in range(40)), "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    want = brute([r[1:] for r in rows], 3, 1000)
    for name, value in (("SHARD_BYTES", 700), ("RANGE_BYTES", 300), ("HELD", 40)):
        monkeypatch.setattr(collocations, name, value)
    assert ours(docs, 3, 1000) == want
    words = collocations.count_tries(docs, 3).where("size(words) = 1").collect()
    assert {r["words"][0]: r["f"] for r in words}["a"] == sum(r[1].split(" ").count("a") for r in rows)


def test_windows_and_runs_round_trip():
    numbers = collocations._numbers()
    ids = collocations._ids(b"B a, b  a\tc b", numbers)
    words, cols = collocations._sorted_words(numbers, collocations._windows(ids))
    cols, counts = collocations._counted(cols)
    row = collocations._coded(0, "en", words, cols, counts)
    names, back, n = collocations._decoded(row)
    text = lambda names, cols: [[names[c[i] - 1] for c in cols if c[i]] for i in range(len(n))]
    assert text(names, back) == text(words, cols) == [[b"a"], [b"a", b"c", b"b"], [b"b"], [b"b", b"a"], [b"b", b"a", b"c", b"b"], [b"c", b"b"]]
    assert n.tolist() == counts.tolist() == [1] * 6
    assert collocations._cuts(words, cols, [(b"a", b"b"), (b"b",), (b"b", b"a", b"c"), (b"zz",)]).tolist() == [1, 2, 4, 6]


def test_large_vocabularies_take_ranks():
    """With too many words for one number of 62 bits a window, pairs are ranked first; the order is the same."""
    import numpy as np

    r = np.random.default_rng(1)
    cols = [r.integers(0, 1 << 20, 500) for _ in range(4)]
    cols = [np.concatenate([c, c[:50]]) for c in cols]
    got, n = collocations._counted(cols)
    assert list(zip(*[c.tolist() for c in got])) == sorted(set(zip(*[c.tolist() for c in cols]))) and n.sum() == 550


def test_empty(spark):
    assert ours(cases.frame(spark, []), 2, 10) == []
    assert ours(spark.createDataFrame([(1, None, None), (2, "", "en"), (3, " ., \n", "en")], "doc_id int, text string, lang string"), 1, 10) == []
