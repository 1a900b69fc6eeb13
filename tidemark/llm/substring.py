"""Repeated passages by content-defined chunking.

A gear rolling hash over the bytes of a text (A-Z as they are, white space as it is)
puts a chunk border wherever its top bits are zero, so borders depend on the last
``WINDOW`` bytes only and move along with insertions before them. A unit is a run of
chunks of at least ``unit_bytes``, begun at every chunk; its digest is a 64-bit polynomial
hash of its bytes, mixed with its length. Digests found in more than one document are
duplicates; overlapping duplicate units of a document join into passages, and passages of at
least ``passage_bytes`` are reported.

A digest's occurrences are summed before the shuffle (smallest and largest document), and
the units are joined back to the repeated digests only, so a passage that a third of
all documents share is never gathered.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _P, _PINV, _powers, col, mix64, stage, text_buffer

WINDOW = 16             # bytes the rolling hash sees
_BLOCK = 1 << 22
_GEAR = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte: h = 2 h + gear[byte] modulo 2**16, worked out by
    doubling the window instead of byte by byte."""
    h = _GEAR[data]
    w = 1
    while w < WINDOW:
        h[w:] += h[:-w] << np.uint16(w)
        w *= 2
    return h


def borders(data: np.ndarray, bits: int, least: int, most: int) -> np.ndarray:
    """Chunk starts of one text, and its length: after a byte whose hash has ``bits``
    top bits zero, at least ``least`` and at most ``most`` bytes after the last one."""
    n = len(data)
    hits = np.flatnonzero(gear(data) < np.uint16(1 << (16 - bits))) + 1
    out, last = [0], 0
    for b in hits.tolist():
        while b - last > most:
            last += most
            out.append(last)
        if b - last >= least:
            out.append(b)
            last = b
    while n - last > most:
        last += most
        out.append(last)
    if out[-1] != n:
        out.append(n)
    return np.array(out)


def units(data: np.ndarray, bits: int, least: int, most: int, unit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, digest) of the units of one text; none for a text under ``unit`` bytes."""
    if len(data) < unit:
        z = np.empty(0, np.int64)
        return z, z, z.astype(np.uint64)
    cut = borders(data, bits, least, most)
    end = np.searchsorted(cut, cut + unit)
    ok = end < len(cut)
    start, end = cut[ok], cut[end[ok]]
    digest = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):          # blocks of the prefix sum bound the scratch memory
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + _BLOCK, "right")))
        a, b = int(start[lo]), int(end[hi - 1])
        acc = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * _powers(_P, b - a), out=acc[1:])
        s, e = start[lo:hi] - a, end[lo:hi] - a
        digest[lo:hi] = mix64((acc[e] - acc[s]) * _powers(_PINV, b - a)[s] + (e - s).astype(np.uint64))
        lo = hi
    return start, end, digest


def passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 4, least: int = 16, most: int = 128,
             unit_bytes: int = 64, passage_bytes: int = 128) -> DataFrame:
    """One row per repeated passage of a document: id, ``start_byte`` and ``end_byte`` (in
    UTF-8), ``n_units``, ``first_doc_id`` (the smallest id that holds one of its units)
    and ``kept`` (the document itself is the smallest holder of all of them).

    Repeats within one document alone are not reported. NULL and empty texts have no
    units; rows with a NULL id are left out of the comparison (they could not be told
    apart); rows that repeat an id count as one document and their passages are joined;
    other columns are ignored; an empty table gives an empty result."""
    src = docs.select(col(id_col).cast("long").alias("id"), col(text_col).alias("text")).where("id is not null and text is not null")

    def run(batches):
        for b in batches:
            data, off = text_buffer(b.column(1))
            ids = b.column(0).to_numpy()
            parts = []
            for i in range(b.num_rows):
                s, e, d = units(data[off[i]:off[i + 1]], bits, least, most, unit_bytes)
                if len(s):
                    parts.append((np.full(len(s), ids[i]), s, e, d.view(np.int64)))
                if i + 1 == b.num_rows or sum(len(p[1]) for p in parts) > 200_000:
                    if parts:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts)], names=["id", "s", "e", "d"])
                    parts = []

    found = src.mapInArrow(run, "id long, s long, e long, d long")
    repeated = (found.groupBy("d").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select("d", "first"))
    repeated = stage(repeated, "repeated")
    hits = found.join(repeated, "d").select("id", "s", "e", "first")
    per = hits.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("s", "e", "first"))).alias("u"))

    def join_up(batches):
        for b in batches:
            rows = []
            for i, u in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                runs: list[list] = []
                for x in u:
                    if runs and x["s"] <= runs[-1][1]:
                        r = runs[-1]
                        r[1], r[2], r[3], r[4] = max(r[1], x["e"]), r[2] + 1, min(r[3], x["first"]), r[4] and x["first"] == i
                    else:
                        runs.append([x["s"], x["e"], 1, x["first"], x["first"] == i])
                rows += [(i, *r) for r in runs if r[1] - r[0] >= passage_bytes]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows)], names=["id", "s", "e", "n", "first", "kept"])

    out = per.mapInArrow(join_up, "id long, s long, e long, n long, first long, kept boolean")
    return out.select(F.col("id").alias(id_col), F.col("s").alias("start_byte"), F.col("e").alias("end_byte"),
                      F.col("n").alias("n_units"), F.col("first").alias(f"first_{id_col}"), "kept")
