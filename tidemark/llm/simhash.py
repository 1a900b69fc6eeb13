"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints at distance at most 2r have a word at distance at most r
from both. So every distinct fingerprint emits all words within ``r`` of itself,
the words are shuffled, and the fingerprints meeting at one word are linked to
the smallest of them; the collected pairs are made distinct and verified. All
members of a word's bucket lie within r of it, so they are pairwise near and the
links to the smallest keep every component without emitting all pairs. A
bucket holds distinct fingerprints of one ball: for r = 1 at most 65, whatever the
number of copies.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ascii_words, col, packed, stage, unpacked
from .components import components

SEED = 42
_SLICE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """SimHash of the text's word shingles (repeats count) as a signed 64-bit
    integer; fewer words than a shingle: the whole sequence; none: zero."""
    words = ascii_words(text)
    if not words:
        return 0
    k = min(shingle_words, len(words))
    joined = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    h64 = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, _SLICE):
        hi = min(n, lo + _SLICE)
        hashes = np.array([h64(joined[a:b], SEED) for a, b in zip(starts[lo:hi], ends[lo + k - 1:hi + k - 1])],
                          dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int32)
    fp = np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0]
    return int(fp.astype(np.int64))


def with_fingerprints(docs: DataFrame, text_col: str = "text", shingle_words: int = 3,
                      out: str = "fp") -> DataFrame:
    """``docs`` plus the fingerprint column ``out`` (replaced if it is there)."""
    base = docs.drop(out)
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.LongType())])
    at = base.columns.index(text_col)

    def run(batches):
        for b in batches:
            fps = pa.array([fingerprint(t.as_py(), shingle_words) for t in b.column(at)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, fps], names=[*b.schema.names, out])

    return base.mapInArrow(run, schema)


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Distinct verified pairs ``(u, v, bits)``, v < u, of the distinct values of
    ``fps.fp`` that connect all fingerprints within ``max_bits``. The ball has
    radius ceil(max_bits / 2)."""
    r = (max_bits + 1) // 2
    flips = [0, *(sum(1 << b for b in c) for k in range(1, r + 1) for c in combinations(range(64), k))]
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in flips])
    balls = (fps.select("fp").where("fp is not null").distinct()
             .select("fp", F.explode(masks).alias("mask"))
             .select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("word")))
    met = balls.groupBy("word").agg(F.min("fp").alias("v"), F.max("fp").alias("w"),
                                    F.collect_list("fp").alias("fps")).where("v <> w")
    pairs = met.select("v", F.explode("fps").alias("u")).where("u <> v").distinct()
    pairs = pairs.withColumn("bits", F.bit_count(F.col("u").bitwiseXOR(F.col("v"))))
    if max_bits % 2 == 0:
        return pairs.where(F.col("bits") <= max_bits)
    # odd: members of a bucket may be one bit too far apart, so pairs are taken singly
    a = met.select("word", F.explode("fps").alias("v"), "fps")
    pairs = a.select("v", F.explode("fps").alias("u")).where("u > v").distinct()
    pairs = pairs.withColumn("bits", F.bit_count(F.col("u").bitwiseXOR(F.col("v"))))
    return pairs.where(F.col("bits") <= max_bits)


def fingerprint_roots(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(node, root) for each fingerprint that has a link."""
    return components(links(fps, max_bits))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id reachable over links of at most
    ``max_bits`` differing bits.

    NULL and empty texts have fingerprint zero and link like any other; rows with
    a NULL id take part and get their group's smallest id (NULL if it has none);
    repeated ids give one row each; other columns are ignored; an empty table
    gives an empty one."""
    one = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    fps = stage(with_fingerprints(one, "text", shingle_words).drop("text"), "simhash")
    roots = stage(fingerprint_roots(fps, max_bits), "roots")
    low = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    per_fp = (low.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    per_root = per_fp.groupBy("root").agg(F.min("low").alias("component_id"))
    per_fp = stage(per_fp.join(per_root, "root").select("fp", "component_id"), "classes")
    return fps.join(per_fp, "fp").select(F.col("doc_id").alias(id_col),
                                         F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """``docs`` with one row of every near-duplicate group: the smallest id (a
    NULL id counts as largest; equal ids: the smallest row hash). Copies meet in
    a grouped minimum that is combined before the shuffle."""
    cols = docs.columns
    fped = with_fingerprints(docs.select(packed(docs), col(text_col).alias("text")), "text", shingle_words).drop("text")
    fps = stage(with_fingerprints(docs.select(col(text_col).alias("text")), "text", shingle_words).select("fp").distinct(), "simhash")
    roots = stage(fingerprint_roots(fps, max_bits), "roots").withColumnRenamed("node", "fp")
    id_ = F.col("row").getField(id_col)
    order = F.struct(id_.isNull(), id_, F.xxhash64("row"))
    kept = (fped.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root"))
            .agg(F.min_by("row", order).alias("row")))
    return kept.select(*unpacked(cols))
