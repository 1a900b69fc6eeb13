"""Benchmark decontamination: SimHash over item-sized windows, a multi-index of
Hamming blocks, then exact weighted-shingle similarity.

The benchmark is the stated query set: it goes to the workers in slices of a
checked size (``slice_bytes`` of text each), whatever its length; the documents
are scanned in one narrow pass per slice and nothing is shuffled. A window that
shares no shingle with any item has similarity zero, so windows are laid only
where a document shingle occurs in the benchmark (an exact filter): for each
such meeting the item-sized window in which the shingle has the item's place. Each
window's 64-bit SimHash is looked up in four 16-bit blocks: two fingerprints within
``radius`` bits agree in some block up to ``radius // 4`` bits, so probing every block
value that near finds all items within the radius. Those are verified by weighted
Jaccard over the multisets of five-word shingles.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, col, mix64, stage, text_buffer

BLOCKS, BITS = 4, 16
_MUL = np.uint64(0xD6E8FEB86659FD93)
RESULT = "item_id long, start_word long, n_words long, similarity double"


def shingle_hashes(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, valid) for each word position: the ``k`` words from there on, valid
    if they lie in one text."""
    n = len(words.hash) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, bool)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc *= _MUL
        acc += words.hash[j:j + n]
    return mix64(acc), words.doc[:n] == words.doc[k - 1:]


def _simhash(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted SimHash of each row of ``hashes`` (w, m)."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(*hashes.shape, 8), axis=-1, bitorder="little")
    on = np.einsum("wmb,wm->wb", bits.astype(np.float32), weights.astype(np.float32))
    return np.packbits(on * 2 > weights.sum(axis=1)[:, None], axis=-1, bitorder="little").view("<u8")[:, 0]


class Index:
    """Items of one slice: shingle postings, weights, fingerprints and their blocks."""

    SEEN = 22       # log2 of the table that tells most foreign shingles at once

    def __init__(self, items: list[tuple[int, str]], df: dict[int, int], n_items: int, shingle: int,
                 threshold: float, radius: int):
        self.k, self.threshold, self.radius, self.elsewhere = shingle, threshold, radius, None
        by_text: dict[tuple, list[int]] = {}
        texts = [t for _, t in items]
        data, off = text_buffer(pa.array(texts, pa.large_string()))
        w = Words(data, off)
        h, ok = shingle_hashes(w, shingle)
        for i, (item, _) in enumerate(items):
            a, b = w.first[i], w.first[i + 1]
            if b - a >= shingle:
                by_text.setdefault(tuple(h[a:b - shingle + 1].tolist()), []).append(item)
        self.ids = [sorted(v) for v in by_text.values()]
        self.items = [np.array(x, np.uint64) for x in by_text]
        self.size = np.array([len(x) + shingle - 1 for x in self.items], np.int64)
        alls = np.concatenate(self.items) if self.items else np.empty(0, np.uint64)
        owner = np.repeat(np.arange(len(self.items)), [len(x) for x in self.items])
        place = np.concatenate([np.arange(len(x)) for x in self.items]) if self.items else np.empty(0, np.int64)
        order = np.argsort(alls, kind="stable")
        self.keys, self.at = np.unique(alls[order], return_index=True)
        self.at = np.append(self.at, len(alls))
        self.owner, self.place = owner[order], place[order]
        self.seen = np.zeros(1 << self.SEEN, bool)
        self.seen[self.keys & np.uint64((1 << self.SEEN) - 1)] = True
        # rarer shingles weigh more; one outside the benchmark counts as of one item
        self.top = float(np.log1p(n_items))
        self.weight = np.array([np.log1p(n_items / df[int(x)]) for x in self.keys]) if len(self.keys) else np.empty(0)
        self.counts, fps = [], []
        for x in self.items:
            u, c = np.unique(x, return_counts=True)
            self.counts.append((u, c * self.weigh(u)))
            fps.append(_simhash(x[None, :], self.weigh(x)[None, :])[0])
        self.fps = np.array(fps, np.uint64)
        self.masks = np.array([sum(1 << b for b in c) for n in range(radius // BLOCKS + 1)
                               for c in combinations(range(BITS), n)], np.uint64)
        self.blocks = []
        for b in range(BLOCKS):
            v = (self.fps >> np.uint64(BITS * b)) & np.uint64((1 << BITS) - 1)
            o = np.argsort(v, kind="stable")
            self.blocks.append((o, np.searchsorted(v[o], np.arange((1 << BITS) + 1, dtype=np.uint64))))

    def weigh(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), self.top)
        for keys, weight in ((self.keys, self.weight), *([self.elsewhere] if self.elsewhere else [])):
            if len(keys):
                i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                out = np.where(keys[i] == h, weight[i], out)
        return out

    def near(self, fp: np.uint64) -> np.ndarray:
        """All items within the radius of ``fp``, by the blocks."""
        found = []
        for b, (order, starts) in enumerate(self.blocks):
            v = ((fp >> np.uint64(BITS * b)) & np.uint64((1 << BITS) - 1)) ^ self.masks
            lo, hi = starts[v], starts[v + np.uint64(1)]
            found += [order[x:y] for x, y in zip(lo[lo < hi], hi[lo < hi])]
        if not found:
            return np.empty(0, np.int64)
        c = np.unique(np.concatenate(found))
        bits = np.unpackbits((self.fps[c] ^ fp).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
        return c[bits <= self.radius]

    def similarity(self, window: np.ndarray, item: int) -> float:
        """Weighted Jaccard of the two multisets of shingles."""
        u, c = np.unique(window, return_counts=True)
        wu = c * self.weigh(u)
        iu, iw = self.counts[item]
        _, a, b = np.intersect1d(u, iu, assume_unique=True, return_indices=True)
        low = np.minimum(wu[a], iw[b]).sum()
        return float(low / (wu.sum() + iw.sum() - low))

    def search(self, col, elsewhere: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int, int, int, float]]:
        """(text, item, first word, words, similarity) for every item that a text
        holds, with the best window (the first of equals). ``elsewhere``: shingles of the
        texts that other slices hold, ascending, and their weights."""
        self.elsewhere = elsewhere if elsewhere is not None and len(elsewhere[0]) else None
        w = Words(*text_buffer(col))
        h, ok = shingle_hashes(w, self.k)
        if not len(h) or not len(self.keys):
            return []
        pos = np.flatnonzero(self.seen[h & np.uint64((1 << self.SEEN) - 1)] & ok)
        i = np.minimum(np.searchsorted(self.keys, h[pos]), len(self.keys) - 1)
        hit = self.keys[i] == h[pos]
        pos, i = pos[hit], i[hit]
        n = self.at[i + 1] - self.at[i]
        slot = np.repeat(self.at[i] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else n
        pos = np.repeat(pos, n)
        item = self.owner[slot]
        doc = w.doc[pos]
        a, b = w.first[doc], w.first[doc + 1]
        size = np.minimum(self.size[item], b - a)
        start = np.clip(pos - self.place[slot], a, b - size)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for d, s, m in np.unique(np.stack([doc, start, size], axis=1), axis=0).tolist() if len(pos) else []:
            win = h[s:s + m - self.k + 1]
            fp = _simhash(win[None, :], self.weigh(win)[None, :])[0]
            for c in self.near(fp).tolist():
                sim = self.similarity(win, c)
                if sim >= self.threshold and sim > best.get((d, c), (0, 0, 0))[0]:
                    best[d, c] = (sim, s - int(w.first[d]), m)
        return [(d, item_id, s, m, sim) for (d, c), (sim, s, m) in sorted(best.items()) for item_id in self.ids[c]]


def _items(benchmark: DataFrame) -> DataFrame:
    return benchmark.select("item_id", "text").where("item_id is not null and text is not null")


def _item_shingles(items: DataFrame, k: int) -> DataFrame:
    """``h``: each item's distinct shingles."""
    def run(batches):
        for b in batches:
            w = Words(*text_buffer(b.column(0)))
            h, ok = shingle_hashes(w, k)
            pairs = np.unique(np.stack([w.doc[:len(h)][ok].astype(np.uint64), h[ok]], axis=1), axis=0) if len(h) else np.empty((0, 2), np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 1].view(np.int64) if len(pairs) else np.empty(0, np.int64))], names=["h"])
    return items.select("text").mapInArrow(run, "h long")


class Slices:
    """The benchmark cut into slices of about ``slice_bytes`` of text (one longer item makes
    a slice of its own). Shingle counts and the number of items are those of the whole
    benchmark, so no weight depends on the cut."""

    def __init__(self, benchmark: DataFrame, shingle: int, slice_bytes: int):
        self.items, self.k = _items(benchmark), shingle
        size = self.items.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
        self.n_items, self.n = max(1, size.n), max(1, -(-(size.bytes or 0) // slice_bytes))
        self.counts = stage(_item_shingles(self.items, shingle).groupBy("h").agg(F.count("*").alias("n")), "shingles")

    def indexes(self, threshold: float, radius: int):
        """One broadcast index after another."""
        sc = self.items.sparkSession.sparkContext
        for s in range(self.n):
            part = self.items if self.n == 1 else self.items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(self.n)) == s)
            rows = [(r.item_id, r.text) for r in part.collect()]
            counts = self.counts
            if self.n > 1:
                counts = counts.join(_item_shingles(part, self.k).distinct(), "h")
            t = counts.toArrow()
            df = dict(zip(t.column("h").to_numpy().view(np.uint64).tolist(), t.column("n").to_pylist()))
            yield sc.broadcast(Index(rows, df, self.n_items, self.k, threshold, radius))

    def with_weights(self, docs: DataFrame, at: int) -> DataFrame:
        """``docs`` with ``_benchmark_shingles``, bytes of the (hash, items) pairs of a text's shingles that
        several items of the benchmark have (one item's weigh as foreign ones): a slice's
        index lacks those of the other slices. Narrow, a broadcast slice of the table after another."""
        schema = T.StructType([*docs.schema.fields, T.StructField("_benchmark_shingles", T.BinaryType())])
        docs = docs.withColumn("_benchmark_shingles", F.lit(b""))
        several = self.counts.where("n > 1")
        for s in range(self.n):
            t = several.where(F.pmod("h", F.lit(self.n)) == s).orderBy(F.col("h") < 0, "h").toArrow()      # as unsigned numbers
            table = docs.sparkSession.sparkContext.broadcast((t.column("h").to_numpy().view(np.uint64), t.column("n").to_numpy()))
            docs = docs.mapInArrow(self._add(table, at), schema)
        return docs

    def _add(self, table, at: int):
        k = self.k

        def run(batches):
            keys, counts = table.value
            for b in batches:
                found = b.column(b.num_columns - 1).to_pylist()
                w = Words(*text_buffer(b.column(at)))
                h, ok = shingle_hashes(w, k)
                if len(h) and len(keys):
                    i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    hit = np.flatnonzero(ok & (keys[i] == h))
                    i, doc = i[hit], w.doc[hit]
                    cut = np.flatnonzero(np.diff(doc)) + 1
                    for d, one in zip(doc[np.append(0, cut)] if len(doc) else [], np.split(i, cut)):
                        one = np.unique(one)
                        found[d] += np.stack([keys[one], counts[one].astype(np.uint64)], axis=1).tobytes()
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.binary())], names=b.schema.names)
        return run

    def elsewhere(self):
        """From a batch's ``_benchmark_shingles`` (None: nothing lies elsewhere) to what ``Index.search`` takes."""
        n_items = self.n_items

        def table(col):
            if col is None:
                return None
            pairs = np.frombuffer(b"".join(col.to_pylist()), np.uint64).reshape(-1, 2)
            keys, first = np.unique(pairs[:, 0], return_index=True)
            return keys, np.log1p(n_items / pairs[first, 1].astype(float))
        return table


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shingle: int = 5, threshold: float = 0.8, radius: int = 15, slice_bytes: int = 32 << 20) -> DataFrame:
    """One row per document row and benchmark item found in it: id, item_id, the
    best window's first word and length, its similarity (>= ``threshold``).

    NULL and empty texts, texts and items under ``shingle`` words, and items with
    a NULL id or text match nothing; equal items are reported each; a document with
    a NULL id is reported with it; other columns are ignored; empty tables give an
    empty result."""
    src = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    slices = Slices(benchmark, shingle, slice_bytes)
    several, elsewhere = slices.n > 1, slices.elsewhere()
    src = slices.with_weights(src, 1) if several else src
    schema = T.StructType([T.StructField(id_col, src.schema["_id"].dataType), *T._parse_datatype_string(RESULT).fields])
    out = None
    for index in slices.indexes(threshold, radius):
        def run(batches, index=index):
            for b in batches:
                found = index.value.search(b.column(1), elsewhere(b.column(2) if several else None))
                if found:
                    d, item, s, m, sim = zip(*found)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(d, pa.int64())), pa.array(item, pa.int64()),
                                                      pa.array(s, pa.int64()), pa.array(m, pa.int64()),
                                                      pa.array(sim, pa.float64())], names=schema.names)
        part = src.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", shingle: int = 5,
                  threshold: float = 0.8, radius: int = 15, slice_bytes: int = 32 << 20) -> DataFrame:
    """``docs`` without the rows that :func:`leaks` reports; nothing is shuffled."""
    at, names = docs.columns.index(text_col), docs.columns
    slices = Slices(benchmark, shingle, slice_bytes)
    several, elsewhere = slices.n > 1, slices.elsewhere()
    docs = slices.with_weights(docs, at) if several else docs
    for index in slices.indexes(threshold, radius):
        def run(batches, index=index):
            for b in batches:
                bad = {x[0] for x in index.value.search(b.column(at), elsewhere(b.column(b.num_columns - 1) if several else None))}
                yield b.filter(pa.array([i not in bad for i in range(b.num_rows)], pa.bool_())) if bad else b
        docs = docs.mapInArrow(run, docs.schema)
    return docs.select(*[col(c) for c in names])
