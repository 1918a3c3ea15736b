"""One query per corpus operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.llm import bpe, decontam, embdedup, hardneg, langid, lexsearch, linededup, lmscore, neardup, pii, sharding, toxicity, urls
from demandcast.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def load():
    """All queries and SQL twins of the subpackage and of the pipeline."""
    oracles = dict(ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**QUERIES, "pipeline": corpus_pipeline.run}, oracles


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels of the held-out third teach nothing."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~langid.held_out(F.col("doc_id"), 3, 1)))
    marked = docs.select("doc_id", "text", langid.held_out(F.col("doc_id"), 3, 1).alias("held_out"))
    return toxicity.score(marked, model, keep=["doc_id", "held_out"])


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the bytes they decode to, per document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path(RANKS), pattern=public_tokenizers.PATTERN, keep=["doc_id"],
                      ids_sha="ids_sha256", decoded_sha="decoded_sha256")


def _sql_shingles(text: str) -> str:
    """Distinct five-word shingles of a text, the whole sequence where it has fewer words."""
    words = f"list_filter(regexp_split_to_array(coalesce(translate({text}, '{urls.UPPER}', '{urls.LOWER}'), ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
    return (f"list_transform([{words}], lambda w: CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] "
            "ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END)[1]")


#: Links on full sets, then the smallest document that links lead to.
NEAR_SQL = f"""WITH RECURSIVE sets AS MATERIALIZED (SELECT doc_id, {_sql_shingles('text')} AS s FROM documents WHERE doc_id IS NOT NULL),
each_ AS MATERIALIZED (SELECT doc_id, hash(unnest(s)) AS h FROM sets), many AS (SELECT h FROM each_ GROUP BY h HAVING count(*) > 1),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM (SELECT * FROM each_ JOIN many USING (h)) a JOIN (SELECT * FROM each_ JOIN many USING (h)) b
 ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT x, y FROM shared JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)),
reach AS (SELECT x AS doc, y AS other FROM links UNION SELECT reach.doc, links.y FROM reach JOIN links ON reach.other = links.x)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(sets.doc_id, coalesce(m.least_, sets.doc_id)) AS component_id,
 sets.doc_id <= coalesce(m.least_, sets.doc_id) AS kept FROM sets LEFT JOIN (SELECT doc, min(other) AS least_ FROM reach GROUP BY doc) m ON m.doc = sets.doc_id"""


@query("op3_minhash_near_dedup", NEAR_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents by an LSH forest."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


COSINE_SQL = """WITH RECURSIVE vectors AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
 WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
units AS MATERIALIZED (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM vectors WHERE list_inner_product(e, e) > 0),
links AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM units a JOIN units b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
 AND list_inner_product(a.e, b.e) >= 0.9 * a.n * b.n),
reach AS (SELECT x AS v, y AS other FROM links UNION SELECT reach.v, links.y FROM reach JOIN links ON reach.other = links.x),
least_ AS (SELECT v, min(other) AS m FROM reach GROUP BY v), counted AS (SELECT x, count(*) AS k FROM links GROUP BY x)
SELECT vec_id, coalesce(k, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN least_ ON v = vec_id LEFT JOIN counted ON x = vec_id"""


@query("op4_embedding_near_dedup", COSINE_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direct links and components of all embeddings at cosine 0.9."""
    return embdedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op5_fuzzy_line_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document with the first line of its component."""
    return linededup.line_components(table(spark, sf_dir, "documents"))


@query("op6_personal_data")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    return pii.summary(table(spark, sf_dir, "documents"))


#: Words as the operator cuts them, numbered, and the bigrams with the word before.
LM_SQL = """WITH docs AS (SELECT row_number() OVER () AS d, doc_id, list_filter(regexp_split_to_array(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
 'abcdefghijklmnopqrstuvwxyz'), ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
tokens AS (SELECT d, doc_id, unnest(w) AS w, unnest(list_prepend(NULL, w[1:len(w) - 1])) AS v FROM docs WHERE len(w) > 0),
one AS (SELECT w, count(*) AS n FROM tokens GROUP BY w), two AS (SELECT v, w, count(*) AS n FROM tokens WHERE v IS NOT NULL GROUP BY v, w),
total AS (SELECT count(*) AS n FROM tokens),
scored AS (SELECT t.doc_id, CASE WHEN t.v IS NULL THEN ln(one.n / total.n) ELSE ln(two.n / before.n) END AS s
 FROM tokens t CROSS JOIN total JOIN one ON one.w = t.w LEFT JOIN two ON two.v = t.v AND two.w = t.w LEFT JOIN one before ON before.w = t.v)
SELECT docs.doc_id, sum(len(docs.w))::BIGINT AS n_words, round(coalesce(any_value(x.s), 0.0), 5) + 0.0 AS log_score,
 round(any_value(x.s) / nullif(sum(len(docs.w)), 0), 5) + 0.0 AS mean_score
FROM docs LEFT JOIN (SELECT doc_id, sum(s) AS s FROM scored GROUP BY doc_id) x ON x.doc_id = docs.doc_id WHERE docs.doc_id IS NOT NULL GROUP BY docs.doc_id"""


@query("op7_lm_scoring", LM_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the counts of all of them."""
    scored = lmscore.score(table(spark, sf_dir, "documents"))
    return scored.withColumns({c: F.round(c, 5) + F.lit(0.0) for c in ("log_score", "mean_score")})


#: The same with runs of three words; the second word of a text is scored by the bigram.
LM_SQL_THREE = """WITH docs AS (SELECT row_number() OVER () AS d, doc_id, list_filter(regexp_split_to_array(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
 'abcdefghijklmnopqrstuvwxyz'), ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
tokens AS (SELECT d, doc_id, w, lag(w) OVER run AS v, lag(w, 2) OVER run AS u
 FROM (SELECT d, doc_id, unnest(w) AS w, unnest(range(len(w))) AS i FROM docs) WINDOW run AS (PARTITION BY d ORDER BY i)),
one AS (SELECT w, count(*) AS n FROM tokens GROUP BY w), two AS (SELECT v, w, count(*) AS n FROM tokens WHERE v IS NOT NULL GROUP BY v, w),
three AS (SELECT u, v, w, count(*) AS n FROM tokens WHERE u IS NOT NULL GROUP BY u, v, w), total AS (SELECT count(*) AS n FROM tokens),
scored AS (SELECT t.doc_id, CASE WHEN t.v IS NULL THEN ln(one.n / total.n) WHEN t.u IS NULL THEN ln(two.n / v.n) ELSE ln(three.n / stem.n) END AS s
 FROM tokens t CROSS JOIN total JOIN one ON one.w = t.w LEFT JOIN one v ON v.w = t.v LEFT JOIN two ON two.v = t.v AND two.w = t.w
 LEFT JOIN two stem ON stem.v = t.u AND stem.w = t.v LEFT JOIN three ON three.u = t.u AND three.v = t.v AND three.w = t.w)
SELECT docs.doc_id, sum(len(docs.w))::BIGINT AS n_words, round(coalesce(any_value(x.s), 0.0), 5) + 0.0 AS log_score,
 round(any_value(x.s) / nullif(sum(len(docs.w)), 0), 5) + 0.0 AS mean_score
FROM docs LEFT JOIN (SELECT doc_id, sum(s) AS s FROM scored GROUP BY doc_id) x ON x.doc_id = docs.doc_id WHERE docs.doc_id IS NOT NULL GROUP BY docs.doc_id"""


@query("op7_lm_scoring_trigrams", LM_SQL_THREE)
def op7_trigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff score of every document under the counts of runs of up to three words of all of them."""
    scored = lmscore.score(table(spark, sf_dir, "documents"), order=3)
    return scored.withColumns({c: F.round(c, 5) + F.lit(0.0) for c in ("log_score", "mean_score")})


CONTAINED_SQL = f"""WITH items AS MATERIALIZED (SELECT item_id, {_sql_shingles('text')} AS s FROM benchmark WHERE text IS NOT NULL),
parts AS (SELECT item_id, len(s) AS n, hash(unnest(s)) AS h FROM items),
docs AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, {_sql_shingles('text')} AS s FROM documents WHERE doc_id IS NOT NULL),
own AS (SELECT d, doc_id, hash(unnest(s)) AS h FROM docs),
found AS (SELECT doc_id, d, item_id, n, count(*) AS k FROM own JOIN parts USING (h) GROUP BY ALL)
SELECT doc_id, item_id, CAST(arg_max(n, k / n) AS INTEGER) AS n_item, CAST(arg_max(k, k / n) AS INTEGER) AS n_shared, max(k / n) AS containment
FROM found WHERE k / n >= 0.8 - 1e-12 GROUP BY doc_id, item_id"""


@query("op8_decontamination", CONTAINED_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document, test item) pairs with at least four fifths of the item's shingles in the document."""
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows of the held-out quarter teach nothing."""
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"), 4, 2)
    model = langid.train(docs.where(~out))
    return langid.identify(docs.select("doc_id", "text", out.alias("held_out")), model, keep=["doc_id", "held_out"])


URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def _sql_rest(url: str) -> str:
    return f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END"


def _sql_host(url: str) -> str:
    return f"translate(regexp_extract({_sql_rest(url)}, '^([^/?#]*)', 1), '{urls.UPPER}', '{urls.LOWER}')"


def _sql_path(url: str) -> str:
    return f"regexp_extract({_sql_rest(url)}, '^[^/?#]*([^?#]*)', 1)"


def _sql_node(url: str) -> str:
    return (f"CASE WHEN instr({url}, '://') > 0 THEN {_sql_host(url)} || {_sql_path(url)} || "
            f"regexp_extract({_sql_rest(url)}, '^[^?#]*(\\?[^#]*)', 1) END")


def _sql_pattern(pattern: str) -> str:
    return pattern.replace("'", "''")


def _sql_resolve(t: str, url: str) -> str:
    scheme = f"regexp_extract({url}, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)"
    base = f"{scheme} || '://' || {_sql_host(url)}"
    folder = f"regexp_extract({_sql_path(url)}, '^(.*/)', 1)"
    return (f"CASE WHEN coalesce({t}, '') = '' THEN NULL WHEN regexp_matches({t}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {t} "
            f"WHEN starts_with({t}, '//') THEN {scheme} || ':' || {t} WHEN starts_with({t}, '/') THEN {base} || {t} "
            f"ELSE {base} || CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || {t} END")


def _sql_rules(source: str) -> str:
    """Longest fitting rule of each row of ``source`` with columns (k, host, path)."""
    return f"""SELECT s.k, arg_max(r.rule, (length(r.rule), r.action = 'allow', r.rule)) AS rule,
 arg_max(r.action, (length(r.rule), r.action = 'allow', r.rule)) AS action
 FROM {source} s JOIN rules r ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host))
 AND starts_with(s.path, r.rule_path) GROUP BY s.k"""


URL_SQL = f"""WITH RECURSIVE rules(action, rule_host, rule_path, rule) AS (VALUES {", ".join(
    f"('{a}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}', '{r}')" for a, r in URL_RULES)}),
base AS (SELECT page_id, row_number() OVER () AS k, coalesce({_sql_host('url')}, '') AS host,
 coalesce({_sql_path('url')}, '') AS path, {_sql_node('url')} AS node FROM pages),
own AS ({_sql_rules('base')}),
tags AS (SELECT url, regexp_extract(regexp_extract(html, '{_sql_pattern(urls.CANONICAL_TAG)}', 0), '{_sql_pattern(urls.HREF)}', 1) AS c,
 regexp_extract(regexp_extract(html, '{_sql_pattern(urls.REFRESH_TAG)}', 0), '{_sql_pattern(urls.REFRESH_URL)}', 1) AS r
 FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
targets AS (SELECT url, replace(t, '&amp;', '&') AS t FROM (SELECT url, unnest([c, r]) AS t FROM tags)),
links AS (SELECT url AS a, {_sql_resolve('t', 'url')} AS b FROM targets),
ends AS (SELECT {_sql_node('u')} AS k, {_sql_host('u')} AS host, {_sql_path('u')} AS path
 FROM (SELECT a AS u FROM links WHERE b IS NOT NULL UNION SELECT b FROM links WHERE b IS NOT NULL)),
edges AS (SELECT DISTINCT s, d FROM (SELECT {_sql_node('a')} AS s, {_sql_node('b')} AS d FROM links WHERE b IS NOT NULL
 UNION ALL SELECT {_sql_node('b')}, {_sql_node('a')} FROM links WHERE b IS NOT NULL) WHERE s <> d),
reach AS (SELECT DISTINCT s AS n, s AS m FROM edges UNION SELECT reach.n, edges.d FROM reach JOIN edges ON reach.m = edges.s),
decided AS ({_sql_rules('(SELECT DISTINCT * FROM ends WHERE k IS NOT NULL)')}),
spread AS (SELECT reach.n, min(decided.action) AS action FROM reach JOIN decided ON decided.k = reach.m GROUP BY reach.n)
SELECT base.page_id, base.host, base.path, own.rule, coalesce(own.action, spread.action, 'allow') AS verdict
FROM base LEFT JOIN own ON own.k = base.k LEFT JOIN spread ON spread.n = base.node"""


@query("op10_url_filters", URL_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return urls.judge(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


TERMS = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def _sql_terms(text: str) -> str:
    return f"regexp_extract_all(translate({text}, '{urls.UPPER}', '{urls.LOWER}'), '{TERMS}')"


SEARCH_SQL = f"""WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_sql_terms('text')} AS terms FROM documents WHERE text IS NOT NULL),
totals AS (SELECT count(*) AS n_docs, sum(len(terms)) AS length FROM docs WHERE len(terms) > 0),
counted AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM docs) GROUP BY d, term),
asked AS (SELECT DISTINCT item_id, unnest({_sql_terms('text')}) AS term FROM benchmark WHERE text IS NOT NULL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
 FROM counted CROSS JOIN totals GROUP BY term, n_docs),
scores AS (SELECT a.item_id, c.d, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(docs.terms) * n_docs)::BIGINT // length::BIGINT))))::BIGINT AS score
 FROM asked a JOIN counted c USING (term) JOIN weights USING (term) JOIN docs USING (d) CROSS JOIN totals GROUP BY a.item_id, c.d),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
 FROM scores JOIN docs USING (d) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50"""


@query("op11_lexical_search", SEARCH_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every test item."""
    return lexsearch.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 in SQL: a table by the reversed polynomial, then one step a byte of the hex digits.
SHARD_SQL = """WITH RECURSIVE steps(b, c, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL
 SELECT b, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crcs AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
docs AS (SELECT doc_id, coalesce(text, '') AS text, octet_length(encode(coalesce(text, ''))) + 1 AS size, md5(coalesce(text, '')) AS digest,
 row_number() OVER () AS n, string_split(lower(hex(encode(coalesce(text, '')))), '') AS digits FROM documents),
crc AS (SELECT n, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(digits) // 2),
 lambda i: (instr('0123456789abcdef', digits[2 * i + 1]) - 1) * 16 + instr('0123456789abcdef', digits[2 * i + 2]) - 1)),
 lambda a, x: xor(a >> 8, t[xor(a & 255, x) + 1])), 4294967295) AS crc FROM docs, crcs),
ordered AS (SELECT *, sum(size) OVER (ORDER BY substr(digest, 1, 15), doc_id NULLS FIRST, n) AS ends, sum(size) OVER () AS total FROM docs),
placed AS (SELECT *, least(15, ((2 * ends - size) * 16)::BIGINT // (2 * total)::BIGINT)::INT AS shard FROM ordered)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'bytes' AS law, shard,
 row_number() OVER (PARTITION BY shard ORDER BY ends) - 1 AS slot, NULL::INT AS grown_shard FROM placed JOIN crc USING (n)"""


@query("op12_sampled_splitters", SHARD_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under equal bytes."""
    return sharding.assign(table(spark, sf_dir, "documents"), shards=16)


NEGATIVES_SQL = """WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor, a.label AS own, v.vec_id AS id, v.label, list_inner_product(a.q, v.q)::BIGINT AS score
 FROM v a JOIN v ON a.vec_id % 50 = 0 AND len(a.q) = len(v.q)),
positives AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor, own ORDER BY score DESC, id) AS r FROM scored
 WHERE own = label AND id <> anchor) WHERE r <= 5),
negatives AS (SELECT p.anchor AS anchor_id, p.id AS positive_id, row_number() OVER (PARTITION BY p.anchor, p.own, p.r ORDER BY s.score DESC, s.id) AS rank,
 s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
 FROM positives p JOIN scored s ON s.anchor = p.anchor AND s.own = p.own AND s.label <> s.own
 AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT * FROM negatives WHERE rank <= 3"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives between half and 95 % of each positive's score, for the anchors among the embeddings."""
    vectors = table(spark, sf_dir, "embeddings")
    turned = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hardneg.mine(turned, lambda key: key % 50 == 0)
