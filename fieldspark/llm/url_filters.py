"""URL filters: listed rules by host and path, and association rules mined from labelled URLs by FP-growth.

Only built-in functions and Spark's own FP-growth run here.  The mined rules are an inverted index in the plan: an array of buckets by hash of
a token, each rule posted under its rarest token, so a URL looks up its own tokens and then checks the few rules that it finds.
Judging is row by row: nothing is shuffled, whatever hosts or URLs repeat.
"""

from __future__ import annotations

import itertools
import json
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldspark.llm.common import carried, stage

OWN = ["host", "path", "rule", "verdict", "mined", "confidence"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULE = "tokens array<string>, verdict string, confidence double, support bigint"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """The URL's distinct tokens: host labels (h=), words of the path (p=) and names of the query's parameters (q=); a run of digits is p=0.

    Only A-Z is lower-cased.  A URL without `://`, or null, has none.
    """
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    low = lambda c: F.translate(c, UPPER, LOWER)
    tagged = lambda words, tag: F.transform(words, lambda w: F.concat(F.lit(tag), w))
    words = F.regexp_extract_all(low(path_of(url)), F.lit(r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"), F.lit(1))
    words = F.transform(words, lambda w: F.when(w.rlike(r"^[0-9]+$"), F.lit("0")).otherwise(w))
    keys = F.transform(F.filter(F.split(low(query), "&"), lambda p: p != ""), lambda p: F.substring_index(p, "=", 1))
    return F.array_distinct(F.concat(tagged(F.filter(F.split(host_of(url), r"\."), lambda x: x != ""), "h="), tagged(words, "p="), tagged(keys, "q=")))


def listed(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """A struct of rule and verdict of the longest rule (verdict, host, path) that fits, or null; of equally long ones the longer host's, then the first.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1]))):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, found) if out is None else out.when(fits, found)
    return F.lit(None).cast("struct<rule:string,verdict:string>") if out is None else out


@dataclass
class Rules:
    """Mined rules: (tokens, verdict, confidence, support), and the labelled URLs that have each token, for posting."""

    rules: list[tuple[tuple[str, ...], str, float, int]]
    rows: dict[str, int]

    def index(self, buckets: int = 1024) -> tuple[Column, int]:
        """The inverted index as a constant: buckets by hash of a rule's rarest token."""
        spark_hash = {t: None for r in self.rules for t in r[0]}
        posted: list[list[dict]] = [[] for _ in range(buckets)]
        if spark_hash:
            from pyspark.sql import SparkSession

            spark = SparkSession.getActiveSession()
            places = spark.createDataFrame([(t,) for t in spark_hash], "t string").select("t", F.pmod(F.xxhash64("t"), F.lit(buckets)).alias("b"))
            spark_hash = {r["t"]: r["b"] for r in places.collect()}  # tokens of at most `most_rules` rules
        for tokens, verdict, confidence, support in self.rules:
            rarest = min(tokens, key=lambda t: (self.rows.get(t, 0), t))
            posted[spark_hash[rarest]].append({"tokens": list(tokens), "verdict": verdict, "confidence": confidence, "support": support})
        return F.from_json(F.lit(json.dumps(posted)), f"array<array<struct<{', '.join(c.replace(' ', ':', 1) for c in RULE.split(', '))}>>>"), buckets


def _transactions(urls: DataFrame, most_rows: int, least: int, most_tokens: int) -> tuple[DataFrame, DataFrame]:
    """Labelled URLs as sets of items, and the tokens' rows.  A URL counts once, with the label that most of its rows have (good if equal)."""
    one = urls.where(F.col("url").isNotNull() & F.col("bad").isNotNull()).groupBy("url").agg((F.avg(F.col("bad").cast("double")) > 0.5).alias("bad"))
    one = stage(one, "urls")
    n = one.count()
    share = min(1.0, most_rows / n) if n else 1.0
    one = one.where(F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(share * (1 << 30)))
    each = stage(one.select("url", "bad", F.explode(tokens_of(F.col("url"))).alias("t")), "tokens")
    base = each.select("url", "bad").distinct().agg(F.avg(F.col("bad").cast("double")).alias("base"))
    rows = each.groupBy("t").agg(F.count("*").alias("n"), F.avg(F.col("bad").cast("double")).alias("p")).where(F.col("n") >= least)
    told = rows.join(F.broadcast(base)).select("t", "n", F.abs(F.col("p") - F.col("base")).alias("told"))  # base is one row
    best = F.slice(F.sort_array(F.collect_list(F.struct("told", "t")), asc=False), 1, most_tokens)
    items = each.join(told, "t").groupBy("url").agg(F.first("bad").alias("bad"), best.alias("best"))
    verdict = F.when(F.col("bad"), "=block").otherwise("=allow")
    return stage(items.select(F.concat(F.col("best.t"), F.array(verdict)).alias("items")), "items"), stage(told.select("t", "n"), "rows")


def mine(urls: DataFrame, confidence: float = 0.6, lift: float = 1.1, least: int = 20, most_rows: int = 200_000, most_tokens: int = 12, most_rules: int = 4096) -> Rules:
    """Rules `tokens -> verdict` of labelled URLs (url, bad boolean): FP-growth's association rules with a verdict as consequent.

    A rule needs `least` distinct URLs that have its tokens and its verdict, the confidence, and the lift over the verdict's share; it goes if fewer of its
    tokens give the same verdict as surely.  Fitting takes at most about `most_rows` distinct URLs, chosen by hash, each with the `most_tokens` of its tokens whose share of
    bad URLs differs most from all URLs'; at most `most_rules` rules stay, the surest.  Rows without a URL or label are left out; repeated rows of a URL count
    once; without labelled URLs there are no rules.
    """
    items, rows = _transactions(urls.select("url", "bad"), most_rows, least, most_tokens)
    n = items.count()
    if not n:
        return Rules([], {})
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(least, 1) / n), minConfidence=confidence).fit(items)
    verdict = F.col("consequent")[0]
    found = model.associationRules.where(verdict.isin("=block", "=allow") & (F.col("lift") >= lift))
    found = found.select(F.array_sort("antecedent").alias("tokens"), F.substring(verdict, 2, 9).alias("verdict"), "confidence", F.round(F.col("support") * n).cast("bigint").alias("support"))
    found = found.orderBy(F.desc("confidence"), F.size("tokens"), F.desc("support"), "tokens", "verdict").limit(most_rules).collect()
    sure: dict[tuple, float] = {}
    kept = []
    for r in sorted(found, key=lambda r: (len(r["tokens"]), r["tokens"], r["verdict"])):
        parts = (p for k in range(1, len(r["tokens"])) for p in itertools.combinations(r["tokens"], k))
        if all(sure.get((p, r["verdict"]), -1.0) < r["confidence"] for p in parts):
            sure[tuple(r["tokens"]), r["verdict"]] = r["confidence"]
            kept.append((tuple(r["tokens"]), r["verdict"], r["confidence"], r["support"]))
    used = {t for r in kept for t in r[0]}
    return Rules(kept, {r["t"]: r["n"] for r in rows.where(F.col("t").isin(sorted(used))).collect()} if used else {})


def matched(tokens: Column, rules: Rules) -> Column:
    """The surest mined rule whose tokens the URL has, or null: of equally sure ones the one with more support, then the block, then the greater tokens."""
    index, buckets = rules.index()
    found = F.flatten(F.transform(tokens, lambda t: F.get(index, F.pmod(F.xxhash64(t), F.lit(buckets)).cast("int"))))
    fits = F.filter(found, lambda r: F.size(F.array_except(r["tokens"], tokens)) == 0)
    return F.array_max(F.transform(fits, lambda r: F.struct(r["confidence"].alias("confidence"), r["support"].alias("support"), r["verdict"].alias("verdict"), r["tokens"].alias("tokens"))))


def judge(pages: DataFrame, rules: Rules, lists: list[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """All rows with OWN added: host and path, the listed rule that fits (host and path, else null), the verdict, the mined rule's tokens and its confidence.

    A listed rule decides; else the surest mined rule; else `default`.  A null URL, or one without `://`, has an empty host and path and no tokens.  URLs are
    taken whole, repeated rows are each judged, an empty table gives an empty one, and input columns with a result's name are replaced.
    """
    keep = carried(pages, OWN)
    url = F.col("url")
    out = pages.withColumns({"__host": host_of(url), "__path": path_of(url), "__tokens": tokens_of(url)})
    out = out.withColumns({"__list": listed(F.col("__host"), F.col("__path"), lists), "__mined": matched(F.col("__tokens"), rules) if rules.rules else F.lit(None).cast("struct<confidence:double,support:bigint,verdict:string,tokens:array<string>>")})
    verdict = F.coalesce("__list.verdict", "__mined.verdict", F.lit(default))
    return out.select(*keep, F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__list.rule").alias("rule"), verdict.alias("verdict"), F.col("__mined.tokens").alias("mined"), F.col("__mined.confidence").alias("confidence"))
