"""Small helpers shared by the operators: staged tables, Arrow text buffers,
table access, the training folds."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, prunes columns. The write's own
    shuffle files go when it ends (nothing else reads them)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def unstage(df: DataFrame | None) -> None:
    """Delete a staged table that nothing reads any more."""
    path = getattr(df, "_staged", None)
    if path:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def col(name: str) -> Column:
    """The column of exactly this name (dots and backticks in it are plain text)."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, names: list[str] | None = None) -> Column:
    """The columns as one struct ``row``, so that names an operator uses inside can't
    clash with them; a struct without fields gets a constant one."""
    names = df.columns if names is None else names
    return F.struct(*([col(c) for c in names] or [F.lit(0).alias("_")])).alias("row")


def unpacked(names: list[str]) -> list[Column]:
    return [F.col("row").getField(c).alias(c) for c in names]


def fold(id_col: str, k: int) -> Column:
    """crc32 of the id's text modulo ``k``; a NULL id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))) % k


def text_buffer(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offsets of length n+1); a NULL is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], np.int64)[col.offset:col.offset + len(col) + 1]
    if bufs[2] is None or len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased, as UTF-8.
    (``bytes`` methods know ASCII letters and ASCII white space only.)"""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = np.uint64(0x9E3779B97F4A7C15)      # odd, so it has an inverse modulo 2**64
_PINV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix64(h: np.ndarray) -> np.ndarray:
    """Avalanche a uint64 array (the public splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    if n:
        out[0] = 1
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


class Words:
    """Word hashes of a whole batch of texts, found without a Python loop.

    ``hash`` has a 64-bit hash per word (A-Z lower-cased, words as in
    :func:`ascii_words`), ``doc`` the text's index, ``first`` the offset of each
    text's first word (length n+1). A word's hash is its polynomial in the byte
    values, read off one prefix sum over the batch and divided by the power at
    its start, then mixed with its length."""

    BLOCK = 1 << 22

    def __init__(self, data: np.ndarray, off: np.ndarray):
        low = _LOWER[data]
        word = ~_SPACE[low]
        n = len(low)
        edge = np.empty(n + 1, bool)
        edge[0] = n > 0 and word[0]
        if n:
            edge[1:n] = word[1:] != word[:-1]
            edge[n] = False
        # a text's end also ends its word
        cut = off[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        cut = np.unique(cut)
        joined = cut[word[cut] & word[cut - 1]] if n else cut
        starts = np.flatnonzero(edge[:n] & word) if n else np.empty(0, np.int64)
        ends = np.flatnonzero(edge[:n] & ~word) if n else np.empty(0, np.int64)
        if n and word[-1]:
            ends = np.append(ends, n)
        if len(joined):
            starts = np.sort(np.append(starts, joined))
            ends = np.sort(np.append(ends, joined))
        self.start, self.end = starts, ends
        self.hash = self._hashes(low, starts, ends)
        self.first = np.searchsorted(starts, off)
        self.doc = np.repeat(np.arange(len(off) - 1), np.diff(self.first))

    @classmethod
    def _hashes(cls, low, starts, ends):
        """Block by block, so that a batch needs a fixed amount of scratch memory."""
        out = np.empty(len(starts), np.uint64)
        lo = 0
        while lo < len(starts):
            hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + cls.BLOCK, "right")))
            a, b = starts[lo], ends[hi - 1]
            pw = _powers(_P, int(b - a))
            acc = np.zeros(int(b - a) + 1, np.uint64)
            np.cumsum((low[a:b].astype(np.uint64) + np.uint64(1)) * pw, out=acc[1:])
            inv = _powers(_PINV, int(b - a))
            s, e = starts[lo:hi] - a, ends[lo:hi] - a
            out[lo:hi] = mix64((acc[e] - acc[s]) * inv[s] + (e - s).astype(np.uint64))
            lo = hi
        return out
