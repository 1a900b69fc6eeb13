"""The operators over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, decontam, langid, lm, mixing, phrases, pieces, pii, quality, simhash, substring, toxicity, vectors
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_simhash_near_dedup(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)


@query
def op8_benchmark_decontamination(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_language_id(spark, sf_dir):
    """Documents (``doc_id``) and web pages (``page_id``) in one model."""
    none = F.lit(None).cast("long")
    ids = ["doc_id", "page_id"]
    records = (langid.records_of_documents(table(spark, sf_dir, "documents").withColumn("page_id", none), ids)
               .union(langid.records_of_pages(table(spark, sf_dir, "pages").withColumn("doc_id", none), ids)))
    return langid.identify(records, langid.fit(records))


@query
def op2_pii(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


@query
def op1_sentencepiece(spark, sf_dir):
    """Ids of every document, and whether decoding them gives the text back."""
    return pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op3_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_quality(spark, sf_dir):
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_lm_scoring(spark, sf_dir):
    return lm.score(table(spark, sf_dir, "documents"))


@query
def op4_embedding_near_dedup(spark, sf_dir):
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_substring_dedup(spark, sf_dir):
    return substring.passages(table(spark, sf_dir, "documents"))


@query
def op11_tokenizer_alignment(spark, sf_dir):
    return alignment.digests(table(spark, sf_dir, "documents"))


@query
def op12_mixing(spark, sf_dir):
    return mixing.plan(table(spark, sf_dir, "documents"), weights=(5, 2, 1), most=3)


ORACLES["op12_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('12:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS tie FROM documents),
s AS (SELECT source, CAST(sum(size) AS HUGEINT) AS s, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM d GROUP BY source),
w AS (SELECT source, s, CAST(CASE place % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS HUGEINT) AS w FROM s),
steps AS (
  SELECT *, s / CAST(w AS DOUBLE) AS turn,
    sum(s) OVER () - 3 * coalesce(sum(s) OVER below, 0) AS rest, sum(w) OVER () - coalesce(sum(w) OVER below, 0) AS free
  FROM w WINDOW below AS (ORDER BY s / CAST(w AS DOUBLE), source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT CAST(arg_min(rest, turn) AS HUGEINT) AS rest, CAST(arg_min(free, turn) AS HUGEINT) AS free FROM steps WHERE 3 * s * free >= rest * w),
goal AS (
  SELECT source, s, 3 * s * free <= rest * w AS capped,
    CASE WHEN capped THEN CAST(3 * s AS DOUBLE) ELSE CAST(rest * w AS DOUBLE) / CAST(free AS DOUBLE) END AS target,
    CASE WHEN s = 0 THEN 0 WHEN capped THEN 3 ELSE rest * w END AS up, CASE WHEN s = 0 OR capped THEN 1 ELSE s * free END AS down,
    CAST('0x' || substr(md5('12:' || coalesce('=' || source, '')), 1, 6) AS HUGEINT) AS u
  FROM w, level),
walk AS (
  SELECT d.doc_id, d.size, g.s, g.target, g.up * 16777216 AS step, g.down * 16777216 AS one, g.u * g.down AS start,
    CAST(row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.tie) AS HUGEINT) AS k
  FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, target,
  CAST(((k * step + start) // one - ((k - 1) * step + start) // one) * size AS BIGINT) AS taken,
  CAST((k * step + start) // one - ((k - 1) * step + start) // one AS BIGINT) AS copies
FROM walk"""


@query
def op13_phrase_collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"), max_words=4, min_count=30, top=2000)


ORACLES["op13_phrase_collocations"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
list AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
size AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM list GROUP BY lang),
every AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM list, (SELECT unnest(range(1, 5)) AS k)),
f AS (SELECT lang, phrase, k, count(*) AS f FROM every GROUP BY ALL HAVING count(*) >= 30),
found AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS j FROM found),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.j, x.f AS l, y.f AS r, 2000000 * CAST(c.a AS HUGEINT) // (x.f + y.f) AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.j + 1:c.k], ' ')),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM found o WHERE o.lang = b.lang AND contains(' ' || o.phrase || ' ', ' ' || b.phrase || ' ') AND o.phrase <> b.phrase
      AND 100 * CAST(o.a AS HUGEINT) >= 80 * CAST(b.a AS HUGEINT)))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM kept JOIN size USING (lang) QUALIFY rank <= 2000"""


ORACLES["op4_embedding_near_dedup"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reached(u, r) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reached.u, links.v FROM reached JOIN links ON links.u = reached.r),
low AS (SELECT u, min(r) AS component_id FROM reached GROUP BY u)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE links.u = e.vec_id) AS n_links, low.component_id, e.vec_id = low.component_id AS kept
FROM embeddings e JOIN low ON low.u = e.vec_id"""
