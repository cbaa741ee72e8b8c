import itertools
import re

import pytest
from pyspark.sql import functions as F

from fieldspark.llm import queries, url_filters

URLS = [
    "http://Blog.Spam.example.com/FR/1?a=1&b#x", "https://example.org/en/12", "https://x.example.org/en/2", "https://example.org/es/", "https://example.org/es", "ftp://org", "http://org/", "http://notexample.org/en/1",
    "http://a.com/de/1", "http://a.net/de/1", "http://com?x=/de/", "http://a.com/de#y", "no scheme/here", "", None, "http://", "://h/p", "http://u:80/p://q", "http://a.com/fr/é/x\ny?q", "HTTP://A.COM/de/",
    "http://example.org/en/1", "x" * 30000 + "://long.com/fr/" + "y/" * 20000, "http://a..com/p?&&=z",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule(host, path, rules):
    fit = [(len(h + p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[2:] if fit else None


def test_listed_rules_win(spark):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(URLS)] + [(0, URLS[0], "x", "y")], "page_id int, url string, rule string, HOST string")
    got = url_filters.judge(pages, url_filters.Rules([], {}), queries.LISTS, default="keep").collect()
    assert len(got) == len(URLS) + 1
    for r in got:
        host, path = parts(URLS[r["page_id"]])
        found = rule(host, path, queries.LISTS)
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, found and found[0], found[1] if found else "keep")


def labelled():
    rows = []
    for i in range(200):
        spam = i % 4 == 0
        host = f"{'cheap' if spam else 'news'}.site{i % 5}.example"
        rows.append((f"http://{host}/{'buy' if spam and i % 8 else 'read'}/{i}?ref={i}", spam != (i % 40 == 0)))
    return [*rows, *rows[:30], (None, True), ("http://no.label/x", None)]


def brute(rows, confidence, lift, least):
    """All itemsets by trying every combination of a URL's tokens."""
    one = {u: b for u, b in rows if u and b is not None}
    sets = []
    for u, bad in one.items():
        host, path = parts(u)
        t = {f"h={x}" for x in host.split(".")} | {"p=" + ("0" if w.isdigit() else w) for w in re.findall("[a-z0-9]+", path)} | {"q=ref"}
        sets.append((t, "block" if bad else "allow"))
    n, out = len(sets), {}
    for t, _ in sets:
        for k in range(1, len(t) + 1):
            for c in itertools.combinations(sorted(t), k):
                for v in ("block", "allow"):
                    if (c, v) not in out:
                        has = [x for s, x in sets if set(c) <= s]
                        a, share = has.count(v), sum(x == v for _, x in sets) / n
                        out[c, v] = (a / len(has), a) if a >= least and a / len(has) >= confidence and a / len(has) / share >= lift else None
    out = {k: x for k, x in out.items() if x}
    return {k: x for k, x in out.items() if not any(out.get((p, k[1]), (-1,))[0] >= x[0] for j in range(1, len(k[0])) for p in itertools.combinations(k[0], j))}


def test_mined_rules_equal_brute_force(spark):
    rows = labelled()
    got = url_filters.mine(spark.createDataFrame(rows, "url string, bad boolean"), confidence=0.7, lift=1.2, least=8)
    want = brute(rows, 0.7, 1.2, 8)
    assert {(t, v): (round(c, 9), n) for t, v, c, n in got.rules} == {k: (round(c, 9), n) for k, (c, n) in want.items()}
    assert ("h=cheap",) in {t for t, v, *_ in got.rules if v == "block"}
    pages = spark.createDataFrame([(1, "http://cheap.site9.test/about"), (2, "http://news.site1.example/read/5"), (3, "http://cheap.com/fr/9"), (4, None)], "page_id int, url string")
    out = {r["page_id"]: r for r in url_filters.judge(pages, got, queries.LISTS).collect()}
    assert [out[i]["verdict"] for i in (1, 2, 3, 4)] == ["block", "allow", "allow", "allow"]
    assert out[1]["mined"] == ["h=cheap"] and out[3]["rule"] == "com/fr/" and out[4]["mined"] is None


def test_matches_are_those_of_all_rules(spark):
    """What the index finds is the surest of all rules that fit."""
    rows = labelled()
    rules = url_filters.mine(spark.createDataFrame(rows, "url string, bad boolean"), confidence=0.5, lift=1.0, least=5)
    urls = spark.createDataFrame([(u,) for u, _ in rows], "url string")
    for r in urls.select(url_filters.tokens_of(F.col("url")).alias("t"), url_filters.matched(url_filters.tokens_of(F.col("url")), rules).alias("m")).collect():
        fit = [(c, n, v, list(t)) for t, v, c, n in rules.rules if set(t) <= set(r["t"])]
        assert (tuple(r["m"]) if r["m"] else None) == (max(fit) if fit else None)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("http://a.b/c", True)]])
def test_few_labels(spark, rows):
    rules = url_filters.mine(spark.createDataFrame(rows, "url string, bad boolean"))
    none = spark.createDataFrame([], "page_id int, url string")
    assert rules.rules == [] and url_filters.judge(none, rules, queries.LISTS).collect() == []


def test_main_path_is_native(spark):
    rules = url_filters.mine(spark.createDataFrame(labelled(), "url string, bad boolean"))
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id int, url string")
    plan = url_filters.judge(pages, rules, queries.LISTS)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))
