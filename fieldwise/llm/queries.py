"""The queries of this package: one ``opN_<name>`` an operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_semantics
from . import bpe, jaccard, langid, nearest, pii, ranked, repetition, spaced, substring, toxicity, turns, urlfilter, warc
from .common import documents

#: The vocabulary file of operator 3; a parameter, never copied here.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

#: Operator 5's list: hosts with such a part are listed.
LISTED_TERMS = ("adult", "ads", "bets", "casino", "pills", "spam")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = langid.train(docs.filter(~langid.held_out()))
    return langid.identify(docs.withColumn("held_out", langid.held_out()), model, ("doc_id", "held_out"))


def faulty_copy(pages: DataFrame) -> DataFrame:
    """A replica as a bad transfer leaves it: it lost one host's pages and garbled some others."""
    garbled = F.col("url").endswith(".html") & F.col("html").contains("<br>")
    lost = F.coalesce(F.col("url").contains("://free-bets."), F.lit(False))
    return pages.filter(~lost).withColumn("html", F.when(garbled, F.regexp_replace("html", "<br>", "")).otherwise(F.col("html")))


def op2_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged records of a replica of ``pages``, which a bad transfer left."""
    pages = documents(spark, sf_dir, "pages")
    return warc.audit(pages, faulty_copy(pages))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), WORD_BPE)


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(documents(spark, sf_dir))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list holds the corpus's hosts with a label part of ``LISTED_TERMS``."""
    return urlfilter.judge(documents(spark, sf_dir, "pages"), F.col("host").rlike(f"(^|[.-])({'|'.join(LISTED_TERMS)})([.-]|$)"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.digests(documents(spark, sf_dir))


def op7_quality_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(documents(spark, sf_dir)).drop("longest_repeat")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.report(docs, pii.train(docs))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = toxicity.train(docs.filter(~toxicity.held_out()), documents(spark, sf_dir, "labels"))
    return toxicity.score(docs.withColumn("held_out", toxicity.held_out()), model, ("doc_id", "held_out"))


def op10_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item that overlap: their widest overlap."""
    found = spaced.overlaps(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))
    best = F.max(F.struct("n_words", "n_same", -F.col("first_word"), -F.col("item_word")))
    rows = found.groupBy(F.col("doc").alias("doc_id"), F.col("item").alias("item_id")).agg(best.alias("b"))
    return rows.select("doc_id", "item_id", "b.n_words", "b.n_same", (-F.col("b.col3")).alias("first_word"), (-F.col("b.col4")).alias("item_word"))


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.report(turns.damaged(documents(spark, sf_dir, "conversations")))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def _semantic(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(ensure_semantics(spark), sf_dir)

    build.__name__ = fn.__name__
    return build


QUERIES = {
    f.__name__: _semantic(f)
    for f in (
        op1_language_id,
        op2_warc_fixity,
        op3_bpe,
        op4_ngram_jaccard,
        op5_url_filter,
        op6_substring_dedup,
        op7_quality_repetition,
        op8_pii,
        op9_toxicity,
        op10_spaced_seeds,
        op11_turn_repair,
        op12_ranked_search,
        op13_nearest,
    )
}

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP2_SQL = r"""
WITH sides AS (
  SELECT 0 AS side, page_id, url, html FROM pages
  UNION ALL
  SELECT 1, page_id, url,
         CASE WHEN url LIKE '%.html' AND html LIKE '%<br>%' THEN replace(html, '<br>', '') ELSE html END
  FROM pages WHERE NOT coalesce(contains(url, '://free-bets.'), false)
), rec AS (
  SELECT side, page_id,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
         || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
         || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
         || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
         || chr(13) || chr(10) || chr(13) || chr(10) AS r
  FROM sides
), h AS (SELECT side, page_id, sha256(r) AS sha, strlen(r) AS n FROM rec),
a AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY page_id // 4096 ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off
  FROM h WHERE side = 0
)
SELECT a.page_id, 'part-' || (a.page_id // 4096) AS warc_file,
       CASE WHEN b.sha IS NULL THEN 'missing' ELSE 'altered' END AS status,
       a.off::BIGINT AS "offset", a.n::BIGINT AS length, a.sha AS primary_sha256, b.sha AS replica_sha256
FROM a LEFT JOIN (SELECT * FROM h WHERE side = 1) b USING (page_id)
WHERE a.sha IS DISTINCT FROM b.sha
"""

OP4_SQL = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM w)
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
same AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT a, b FROM same JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)
), reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION
  SELECT r.node, l.b FROM reach r JOIN link l ON l.a = r.seen
)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.seen)::BIGINT AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach r ON r.node = d.doc_id GROUP BY 1
"""

OP5_SQL = rf"""
WITH u AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(rule, rhost, rpath, verdict) AS (
  VALUES {", ".join(f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in urlfilter.RULES)}
), fit AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM u JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY 1
)
SELECT u.page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[.-])({"|".join(LISTED_TERMS)})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fit USING (page_id)
"""

OP6_SQL = rf"""
WITH w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
src AS (SELECT h, min(doc_id) AS m FROM win GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM (SELECT doc_id, i, unnest(range(0, 50)) AS k FROM win JOIN src USING (h) WHERE m < doc_id)),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM w),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS t, count(gone.p) AS n_removed
  FROM words LEFT JOIN gone USING (doc_id, p) GROUP BY 1
)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP7_SQL = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, length(unnest(w)) AS c FROM w),
win AS (
  SELECT doc_id, k, i, hash(w[i:i + k - 1]) AS h
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (5), (8), (101)) s(k) WHERE len(w) >= k)
),
twice AS (SELECT doc_id, k, h FROM win GROUP BY ALL HAVING count(*) > 1),
cov AS (SELECT DISTINCT doc_id, k, i + unnest(range(0, k)) AS p FROM win JOIN twice USING (doc_id, k, h)),
m AS (
  SELECT doc_id, count(*) FILTER (k = 8) AS n8, coalesce(sum(c) FILTER (k = 5), 0) AS c5, count(*) FILTER (k = 101) AS n101
  FROM cov JOIN words USING (doc_id, p) GROUP BY 1
),
lines AS (
  SELECT doc_id, len(l) - len(list_distinct(l)) AS n_dup_lines
  FROM (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM w)
),
base AS (
  SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
         coalesce(n8, 0)::BIGINT AS n_repeat_words, coalesce(c5, 0)::BIGINT AS c5, coalesce(n101, 0) AS n101
  FROM w JOIN lines USING (doc_id) LEFT JOIN m USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND c5 <= 0.4 * word_chars AND n101 = 0 AS kept, c5 AS covered_chars
FROM base
"""

_TERMS = (
    r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

OP12_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS t FROM documents),
s AS (SELECT count(*) AS big_n, sum(len(t))::BIGINT AS big_l FROM d WHERE len(t) > 0),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (
  SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, s GROUP BY term, big_n
),
i AS (SELECT DISTINCT item, item_id, unnest(t) AS term FROM (SELECT row_number() OVER () AS item, item_id, {_TERMS} AS t FROM benchmark)),
scores AS (
  SELECT item, item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(t)::BIGINT * big_n) // big_l))))::BIGINT AS score
  FROM i JOIN w USING (term) JOIN p USING (term) JOIN d USING (r), s GROUP BY ALL
),
best AS (
  SELECT item, item_id, doc_id, score, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores JOIN d USING (r) WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM best WHERE rank <= 10
"""

#: All pairs of a query and a vector: what the index finds too up to ``nearest.LEAST_TAKEN`` vectors; beyond, its recall is measured.
OP13_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, e FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)
  WHERE len(e) = 64 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0
),
best AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM best WHERE rank <= 5
"""

#: Queries that SQL can express; the others are tested against brute force.
SQL: dict[str, str] = {
    "op2_warc_fixity": OP2_SQL,
    "op4_ngram_jaccard": OP4_SQL,
    "op5_url_filter": OP5_SQL,
    "op6_substring_dedup": OP6_SQL,
    "op7_quality_repetition": OP7_SQL,
    "op12_ranked_search": OP12_SQL,
    "op13_nearest": OP13_SQL,
}
