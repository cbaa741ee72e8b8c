"""The queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldspark.llm import collocations, decontaminate, language_id, lexical_search, lm_score, near_dedup, packing, passages, quality_model, quality_rules, sharding, token_store, url_filters
from fieldspark.llm.common import crc_of_id, ready


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_table(spark, sf_dir, "documents"))


def op2_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the sets of this query have four-word shingles
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), size=4, keep=["doc_id"]).select("doc_id", "n_shingles", "component_id", "kept")


def op3_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = quality_rules.quality_rules(docs, quality_rules.trusted_ids(_table(spark, sf_dir, "labels")))
    return out.select("doc_id", *quality_rules.OWN)


def op4_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)
    digest = F.sha2(F.concat_ws(",", "item_ids"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.histogram_shards(_table(spark, sf_dir, "documents"), n_shards=40)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_perfect_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    store = token_store.write_tokens(docs, tokenizer_path(), end_id=1)
    found = store.lookup(docs.select("doc_id"))
    return found.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op7_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = crc_of_id() % 3 == 1
    model = language_id.fit(docs.where(~held).select("doc_id", "text", "lang"))
    return language_id.identify(docs.select("doc_id", "text"), model).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")


def op8_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = quality_model.held_out()
    model = quality_model.fit(docs, _table(spark, sf_dir, "labels").where(~held))
    return quality_model.classify(docs, model).select("doc_id", held.alias("held_out"), "p_text", "p_meta", "score", "kept")


def op9_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 240 bytes are just under 50 words: n_passage tells where passages repeat that are shorter than the 400 bytes that go
    out = passages.remove_repeats(_table(spark, sf_dir, "documents"), least=400, keep=["doc_id"], passage=240)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passage")


def op10_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2, window=4096)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = collocations.collocations(_table(spark, sf_dir, "documents"), least=30, most=2000)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical_search.build(_table(spark, sf_dir, "documents"))
    return lexical_search.search(index, _table(spark, sf_dir, "benchmark"), k=10).select("item_id", "rank", "doc_id", "score")


#: The lists that come before mined rules.
LISTS = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op13_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a page's address ends with the number of its document, whose label is the page's
    pages = _table(spark, sf_dir, "pages")
    number = F.regexp_extract(url_filters.path_of(F.col("url")), r"^/[^/]*/([0-9]{1,18})(?:[./]|$)", 1)
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad"))
    named = pages.select("url", F.when(number != "", number).cast("bigint").alias("doc_id"))
    rules = url_filters.mine(named.join(labels, "doc_id"))
    return url_filters.judge(pages.select("page_id", "url"), rules, LISTS).select("page_id", "host", "path", "rule", "verdict")


QUERIES = {
    "op1_deleted_interpolation": op1_deleted_interpolation,
    "op2_signature_join": op2_signature_join,
    "op3_ngram_ratio": op3_ngram_ratio,
    "op4_suffix_automaton": op4_suffix_automaton,
    "op5_histogram_sort": op5_histogram_sort,
    "op6_perfect_hash": op6_perfect_hash,
    "op7_nearest_centroid": op7_nearest_centroid,
    "op8_co_training": op8_co_training,
    "op9_run_length_index": op9_run_length_index,
    "op10_retrieval_packing": op10_retrieval_packing,
    "op11_collocations": op11_collocations,
    "op12_lexical_search": op12_lexical_search,
    "op13_association_rules": op13_association_rules,
}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op2_signature_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM w),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
 l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
 r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, doc_id = c.component_id AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY 1) c USING (doc_id)""",
    "op4_suffix_automaton": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
 i AS (SELECT item_id::VARCHAR AS item, w, least(10, len(w)) AS k FROM (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
 g AS (SELECT DISTINCT item, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS t FROM i),
 dg AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS p, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS t FROM d, (SELECT DISTINCT k FROM g)),
 h AS (SELECT doc_id, p, dg.k, item FROM dg JOIN g ON dg.t = g.t AND dg.k = g.k),
 c AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM h) GROUP BY 1),
 m AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM h GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN m USING (doc_id)""",
    # bytes as pairs of hexadecimal digits; windows by the place of their first byte
    "op9_run_length_index": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
 w AS (SELECT doc_id, k, p, hash(substr(h, 2 * p + 1, 2 * k)) AS s FROM (SELECT doc_id, h, k, unnest(range(n - k + 1)) AS p FROM d, (VALUES (400), (240)) AS v(k) WHERE n >= k)),
 r AS (SELECT doc_id, k, p FROM w JOIN (SELECT k, s FROM w GROUP BY k, s HAVING count(*) > 1) USING (k, s)),
 f AS (SELECT doc_id, k, p, p - coalesce(lag(p) OVER o, -1000000) AS gap FROM r WINDOW o AS (PARTITION BY doc_id, k ORDER BY p)),
 g AS (SELECT doc_id, k, p, sum(CASE WHEN gap > k THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, k ORDER BY p) AS span FROM f),
 x AS (SELECT doc_id, k, span, min(p) AS s, max(p) + k AS e FROM g GROUP BY 1, 2, 3),
 c AS (SELECT doc_id, CAST(sum(e - s) FILTER (k = 400) AS BIGINT) AS gone, count(*) FILTER (k = 400) AS spans, CAST(sum(e - s) FILTER (k = 240) AS BIGINT) AS passage FROM x GROUP BY 1),
 b AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC) = 1 AS last FROM x WHERE k = 400),
 t AS (SELECT doc_id, string_agg(substr(h, 2 * before + 1, 2 * (s - before)) || CASE WHEN last THEN substr(h, 2 * e + 1) ELSE '' END, '' ORDER BY s) AS kept FROM b JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, n AS n_bytes, coalesce(gone, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256, coalesce(passage, 0) AS n_passage
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)""",
    "op11_collocations": rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
 w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
 g AS (SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS ws FROM w, (VALUES (1), (2), (3), (4)) AS v(k) WHERE len(w) >= k),
 f AS (SELECT lang, ws, array_to_string(ws, ' ') AS phrase, len(ws) AS k, count(*) AS f FROM g GROUP BY 1, 2),
 c AS (SELECT lang, ws, phrase, k, f AS a FROM f WHERE k > 1 AND f >= 30),
 x AS (SELECT lang, phrase, a, j, array_to_string(ws[:j], ' ') AS lp, array_to_string(ws[j + 1:], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
 s AS (SELECT x.lang, x.phrase, x.a, j, fl.f AS l, fr.f AS r, ((2000000::HUGEINT * x.a) // (fl.f + fr.f))::BIGINT AS score FROM x JOIN f fl ON fl.lang = x.lang AND fl.phrase = lp JOIN f fr ON fr.lang = x.lang AND fr.phrase = rp),
 b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
 o AS (SELECT lang, array_to_string(ws[i:i + n - 1], ' ') AS phrase, max(a) AS longer FROM (SELECT *, unnest(range(1, k - n + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS n FROM c)) GROUP BY 1, 2),
 n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM b LEFT JOIN o USING (lang, phrase) JOIN n USING (lang) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a QUALIFY rank <= 2000""",
    "op12_lexical_search": rf"""
WITH t AS (SELECT doc_id, unnest(w) AS term, len(w) AS n FROM (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents)),
 p AS (SELECT doc_id, term, n, count(*) AS tf FROM t GROUP BY 1, 2, 3),
 z AS (SELECT count(*)::HUGEINT AS nd, sum(n)::HUGEINT AS l FROM (SELECT DISTINCT doc_id, n FROM p)),
 q AS (SELECT item_id, unnest(list_distinct(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark),
 d AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, z WHERE term IN (SELECT term FROM q) GROUP BY term, nd),
 s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))))::BIGINT AS score FROM q JOIN d USING (term) JOIN p USING (term), z GROUP BY 1, 2)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score FROM s WHERE score > 0 QUALIFY rank <= 10""",
}
