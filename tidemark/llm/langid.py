"""Language identification by Bayesian evidence fusion.

log P(l | record) = text evidence + log P(declared language | l)
                    + log P(l | host), where the host's distribution is smoothed
towards its address suffix and that towards the whole corpus.

The text likelihoods are byte-trigram models, one per language, counted over
all records that declare a language. How far a declaration can be trusted, and the
host, suffix and corpus priors, are grouped sums of the text-only posteriors.
Only tables whose size does not depend on the corpus reach the driver: trigram
counts (``BUCKETS`` per language) and the declaration table; the host priors
stay a table that is joined.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _LOWER, packed, stage, text_buffer, unpacked, unstage

BUCKETS = 1 << 15
_BLOCK = 1 << 22
_EV = "_evidence"


@dataclass
class Model:
    langs: list[str]
    log_p: object           # broadcast: (languages, BUCKETS) log-likelihoods
    declared: dict          # declared language -> log P(declared | language), per language
    hosts: DataFrame        # host, log_prior array
    corpus: list[float]     # log prior of a host never seen


def code(declared: Column) -> Column:
    """Primary language subtag in lower case; NULL if there is none."""
    c = F.regexp_extract(F.lower(F.trim(declared)), r"^([a-z]{2,3})(?:[-_].*)?$", 1)
    return F.when(c != "", c)


def _trigrams(col):
    """Yields (trigram bucket, text index) block by block; no trigram crosses texts."""
    data, off = text_buffer(col)
    for a in range(0, max(0, len(data) - 2), _BLOCK):
        b = min(len(data), a + _BLOCK + 2)
        x = _LOWER[data[a:b]].astype(np.uint32)
        lo, hi = np.searchsorted(off, a, "right") - 1, np.searchsorted(off, b, "left")
        doc = np.repeat(np.arange(lo, hi), np.diff(np.clip(off[lo:hi + 1], a, b)))
        t = (x[:-2] << np.uint32(16) | x[1:-1] << np.uint32(8) | x[2:]) * np.uint32(2654435761) >> np.uint32(17)
        ok = doc[:-2] == doc[2:]
        yield t[ok], doc[:-2][ok]


def records_of_pages(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """row (the columns ``keep``, all by default), text, declared, host, suffix of web
    pages: tags, scripts and styles off, the ``html`` element's ``lang``, and the URL's
    host and last label."""
    html, url = F.col("html"), F.lower(F.col("url"))
    text = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " "), r"<[^<>]*>", " ")
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)
    return pages.select(packed(pages, keep), text.alias("_text"),
                        F.regexp_extract(html, r"(?i)<html\b[^<>]*?\blang\s*=\s*[\"']?([A-Za-z][A-Za-z_-]*)", 1).alias("_declared"),
                        host.alias("_host"), F.regexp_extract(host, r"\.([a-z][a-z0-9-]+)$", 1).alias("_suffix"))


def records_of_documents(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The same for plain documents: ``lang`` is the declaration, ``source`` the
    host; there is no address, so the suffix is empty."""
    return docs.select(packed(docs, keep), F.col("text").alias("_text"), F.col("lang").cast("string").alias("_declared"),
                       F.col("source").cast("string").alias("_host"), F.lit("").alias("_suffix"))


def _prepared(records: DataFrame) -> DataFrame:
    return records.withColumns({"_declared": code(F.col("_declared")), "_host": F.coalesce("_host", F.lit("")),
                                "_suffix": F.coalesce("_suffix", F.lit(""))})


def _count_trigrams(records: DataFrame, langs: list[str]) -> np.ndarray:
    at = {lang: i for i, lang in enumerate(langs)}

    def run(batches):
        total = np.zeros(len(langs) * BUCKETS, np.int64)
        for b in batches:
            lab = np.array([at.get(x, -1) for x in b.column(1).to_pylist()], np.int64)
            for t, d in _trigrams(b.column(0)):
                lang = lab[d]
                use = lang >= 0
                total += np.bincount(lang[use] * BUCKETS + t[use], minlength=len(total))
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], names=["k", "n"])

    counts = (records.select("_text", "_declared").mapInArrow(run, "k long, n long")
              .groupBy("k").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(len(langs) * BUCKETS)
    out[counts["k"].to_numpy(np.int64)] = counts["n"].to_numpy(float)
    return out.reshape(len(langs), BUCKETS)


def with_evidence(records: DataFrame, log_p, half_life: int = 100) -> DataFrame:
    """Adds the text evidence per language: mean trigram log-likelihood times
    n / (1 + n / half_life), as neighbouring trigrams are not independent; the
    best language has zero. Empty for a text without trigrams."""
    schema = T.StructType([*records.schema.fields, T.StructField(_EV, T.ArrayType(T.DoubleType()))])
    at = records.columns.index("_text")

    def run(batches):
        lp = log_p.value
        for b in batches:
            ll, n = np.zeros((len(lp), b.num_rows)), np.zeros(b.num_rows)
            for t, d in _trigrams(b.column(at)):
                n += np.bincount(d, minlength=b.num_rows)
                for i in range(len(lp)):
                    ll[i] += np.bincount(d, weights=lp[i][t], minlength=b.num_rows)
            ev = ll / np.maximum(n, 1) * (n / (1 + n / half_life))
            ev = (ev - ev.max(axis=0)).T if len(lp) else ev.T
            sizes = np.where(n > 0, len(lp), 0)
            col = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)),
                                           pa.array(ev[n > 0].ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns, col], names=[*b.schema.names, _EV])

    return records.mapInArrow(run, schema)


def _softmax(logs: Column) -> Column:
    """Of an array whose largest element is subtracted first."""
    e = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def fit(records: DataFrame, min_share: float = 0.001, kappa: float = 20.0, alpha: float = 0.05) -> Model:
    """``records`` has _text, _declared, _host, _suffix. Languages are those that at
    least ``min_share`` of the declaring records name (so at most 1 / min_share)."""
    rec = _prepared(records).select("_text", "_declared", "_host", "_suffix")
    names = rec.where("_declared is not null").groupBy("_declared").count().toPandas()
    total = int(names["count"].sum()) if len(names) else 0
    langs = sorted(names["_declared"][names["count"] >= max(1, min_share * total)]) if total else []
    spark = records.sparkSession
    n = _count_trigrams(rec, langs) + alpha if langs else np.zeros((0, BUCKETS))
    log_p = spark.sparkContext.broadcast(np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32))
    if not langs:
        return Model([], log_p, {}, spark.createDataFrame([], "_host string, _prior array<double>"), [])
    ev = stage(with_evidence(rec, log_p).drop("_text"), "evidence")
    post = ev.where(F.size(_EV) > 0).withColumn("_p", _softmax(F.col(_EV)))
    sums = [F.sum(F.col("_p")[i]).alias(f"s{i}") for i in range(len(langs))]
    known = F.when(F.col("_declared").isin(langs), F.col("_declared"))      # others count as none
    rows = post.groupBy(known.alias("d")).agg(*sums).collect()
    table = np.zeros((len(langs) + 1, len(langs)))
    for r in rows:
        table[langs.index(r.d) if r.d is not None else -1] = [r[f"s{i}"] for i in range(len(langs))]
    corpus = (table.sum(axis=0) + 1) / (table.sum() + len(langs))
    trust = (table + 0.5) / (table.sum(axis=0) + 0.5 * len(table))
    declared = {d: np.log(trust[i]).tolist() for i, d in enumerate([*langs, None])}
    vec = F.array(*[F.col(f"s{i}") for i in range(len(langs))])
    hosts = post.groupBy("_host", "_suffix").agg(*sums).select("_host", "_suffix", vec.alias("h"))
    suffixes = post.groupBy("_suffix").agg(*sums).select("_suffix", vec.alias("s"))

    def smooth(counts: Column, prior: Column) -> Column:
        n = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.zip_with(counts, prior, lambda c, p: (c + kappa * p) / (n + kappa))

    base = F.array(*[F.lit(float(x)) for x in corpus])
    suffixes = suffixes.select("_suffix", smooth(F.col("s"), base).alias("s"))
    hosts = (hosts.join(suffixes, "_suffix").select("_host", smooth(F.col("h"), F.col("s")).alias("p"))
             .select("_host", F.transform("p", lambda x: F.log(x)).alias("_prior")))
    # an address has one suffix; a bare name used under several gets their mean
    hosts = hosts.select("_host", *[F.col("_prior")[i].alias(f"s{i}") for i in range(len(langs))]).groupBy("_host") \
        .agg(*[F.avg(f"s{i}").alias(f"s{i}") for i in range(len(langs))]).select("_host", vec.alias("_prior"))
    hosts = stage(hosts, "hosts")
    unstage(ev)
    return Model(langs, log_p, declared, hosts, np.log(corpus).tolist())


def identify(records: DataFrame, model: Model, min_confidence: float = 0.5) -> DataFrame:
    """The columns of ``row`` (but those of these names) plus ``language`` (NULL if no
    text and no language), ``text_language``, ``confidence`` and ``kept``.

    A record is kept if its text has a trigram and the fused posterior of the best
    language is at least ``min_confidence``. NULL or empty text: not kept. NULL or
    unknown declaration, host or suffix: that evidence is the general one. Ties go
    to the first language in order. Extra columns pass through; an empty table gives
    an empty one; without any declaration nothing can be learnt and nothing is kept."""
    added = ("language", "text_language", "confidence", "kept")
    cols = unpacked([c for c in records.schema["row"].dataType.names if c not in added])
    rec = _prepared(records)
    if not model.langs:
        return rec.select(*cols, F.lit(None).cast("string").alias("language"),
                          F.lit(None).cast("string").alias("text_language"), F.lit(0.0).alias("confidence"),
                          F.lit(False).alias("kept"))
    names = F.array(*[F.lit(x) for x in model.langs])
    as_array = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    told = as_array(model.declared[None])
    for lang in model.langs:
        told = F.when(F.col("_declared") == lang, as_array(model.declared[lang])).otherwise(told)
    out = with_evidence(rec, model.log_p).join(model.hosts, "_host", "left")
    out = out.withColumn("_prior", F.coalesce("_prior", as_array(model.corpus)))
    has = F.size(_EV) > 0
    ev = F.when(has, F.col(_EV)).otherwise(as_array([0.0] * len(model.langs)))
    both = F.zip_with(F.zip_with(ev, told, lambda a, b: a + b), F.col("_prior"), lambda a, b: a + b)
    out = out.withColumn("_post", _softmax(both)).withColumn("confidence", F.array_max("_post"))
    best = lambda c: F.get(names, (F.array_position(c, F.array_max(c)) - 1).cast("int"))
    return out.select(*cols, best(F.col("_post")).alias("language"), F.when(has, best(F.col(_EV))).alias("text_language"),
                      "confidence", (has & (F.col("confidence") >= min_confidence)).alias("kept"))
