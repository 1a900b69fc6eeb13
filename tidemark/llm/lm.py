"""Language-model scores from a log-frequency Bloom filter (Talbot & Osborne).

Documents become chunks: the distinct words of up to ``CHUNK_BYTES`` of text and the
texts as indices into them. Each chunk sends its distinct words and word pairs, with
their training counts, to the buckets of their hashes, once: a bucket sums the counts,
builds its part of the filter and answers each chunk's words with their exact
counts.

Every counted n-gram is put into the filter under levels 1..q, q = 1 + floor(log2
count). A count is read back by probing levels until one is missing. A bucket's part is
sized by its own entries, so the rate of false positives is the same for any input and
any bucket. A count c takes at most c entries, which bounds the filter by the number of
tokens before it is built: within ``broadcast_bits`` it is broadcast and probed by the
chunks; otherwise the bucket that built a part probes it for the chunks that sent it
n-grams, and levels go back. Both give the same levels.

A word's probability is its quantised count over the sum of all words' quantised
counts (smoothed); a pair's is the lower end of its level over the exact count of its
first word, so the shares after a word do not add up to more than 1. Words are keyed by
mixed 64-bit hashes (two of 5 million words collide with probability under 1e-6), pairs
by 48 bits of one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, col, fold, mix64, stage, text_buffer, unstage

CHUNK_BYTES = 8 << 20
BUCKET_KEYS = 1 << 21       # n-grams that chunks send to one bucket
KEY_BYTES = 6               # of a pair's key
_MUL = np.uint64(0xD6E8FEB86659FD93)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
BOS = np.uint64(0x243F6A8885A308D3)     # stands before the first word
END = np.uint64(0x13198A2E03707344)     # the end token


def _pack(x: np.ndarray) -> bytes:
    return len(x).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(x).tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def _unpack(data: bytes, dtype: str) -> np.ndarray:
    dtype = np.dtype(dtype)
    if not data:
        return np.empty(0, dtype)
    size = int.from_bytes(data[:8], "little") * dtype.itemsize
    return np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True), dtype)


def chunk_documents(docs: DataFrame, id_col: str, text_col: str, folds: int, held_fold: int) -> DataFrame:
    src = docs.select(col(id_col).alias("id"), (fold(id_col, folds) == held_fold).alias("held"), col(text_col).alias("text"))
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(src.schema["id"].dataType)),
                           *T._parse_datatype_string("held array<boolean>, sizes array<int>, words binary, seq binary").fields])

    def run(batches):
        pid, n = TaskContext.get().partitionId(), 0
        for b in batches:
            off = text_buffer(b.column(2))[1]
            lo = 0
            while lo < b.num_rows:      # at least one text, at most CHUNK_BYTES
                hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK_BYTES, "right")) - 1)
                part, lo = b.slice(lo, hi - lo), hi
                w = Words(*text_buffer(part.column(2)))
                uniq, idx, cnt = np.unique(w.hash, return_inverse=True, return_counts=True)
                order = np.argsort(-cnt, kind="stable")         # frequent words get small indices
                place = np.empty(len(order), np.uint32)
                place[order] = np.arange(len(order), dtype=np.uint32)
                seq = place[idx] if len(idx) else np.empty(0, np.uint32)
                n += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([pid << 32 | n], pa.int64()), pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0)),
                     pa.array([part.column(1).to_pylist()], pa.list_(pa.bool_())), pa.array([np.diff(w.first).astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([uniq[order].astype("<u8").tobytes()], pa.binary()), pa.array([_pack(seq.astype("<u4"))], pa.binary())],
                    names=schema.names)

    return stage(src.mapInArrow(run, schema), "chunks")


@dataclass
class Stream:
    """The tokens of a chunk's documents: word (or END), the one before (or BOS), document."""
    words: np.ndarray
    idx: np.ndarray     # index into words; len(words) for END
    word: np.ndarray
    before: np.ndarray
    doc: np.ndarray

    @classmethod
    def of(cls, table: pa.Table | pa.RecordBatch, i: int) -> Stream:
        words = np.frombuffer(table.column("words")[i].as_py(), "<u8")
        sizes = np.array(table.column("sizes")[i].as_py(), np.int64)
        n, d = int(sizes.sum()), len(sizes)
        doc = np.repeat(np.arange(d), sizes + 1)
        idx = np.full(n + d, len(words), np.int64)
        ends = np.cumsum(sizes + 1) - 1
        at = np.ones(n + d, bool)
        at[ends] = False
        idx[at] = _unpack(table.column("seq")[i].as_py(), "<u4")
        word = np.append(words, END)[idx]
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[ends[:-1] + 1] = BOS
        if d:
            before[0] = BOS
        return cls(words, idx, word, before, doc)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the words, of the distinct pairs, and each token's pair in them."""
        pairs, at = np.unique(pair_key(self.before, self.word), return_inverse=True)
        return word_key(self.words), pairs, at


def word_key(word: np.ndarray) -> np.ndarray:
    return mix64(word + _GOLD)


def pair_key(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(before * _MUL + word) >> np.uint64(64 - 8 * KEY_BYTES)


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of the keys by bucket, and where each bucket begins in it."""
    b = (mix64(keys) % np.uint64(buckets)).astype(np.int64)
    return np.argsort(b, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(b, minlength=buckets))))


def level_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 count), exactly; 0 of 0."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def quantised(q: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the middle of its range (0 if absent)."""
    return np.where(q > 0, (np.exp2(q - 1.0) + np.exp2(q) - 1) / 2, 0.0)


def least(q: np.ndarray) -> np.ndarray:
    """The smallest count of a level."""
    return np.where(q > 0, np.exp2(q - 1.0), 0.0)


class Bits:
    """A log-frequency Bloom filter: one bucket's part."""

    def __init__(self, size: int, hashes: int, top: int, data: np.ndarray):
        self.size, self.hashes, self.top, self.data = size, hashes, top, data

    @classmethod
    def build(cls, keys: np.ndarray, levels: np.ndarray, false_rate: float) -> Bits:
        """An absent entry is found with probability ``false_rate`` a level."""
        per_entry = math.ceil(-math.log(false_rate) / math.log(2) ** 2)
        size = max(64, int(levels.sum()) * per_entry)
        self = cls(size, max(1, round(math.log(2) * per_entry)), int(levels.max(initial=0)), None)
        on = np.zeros(-(-size // 8) * 8, bool)
        for j in range(1, self.top + 1):
            h = self._hash(keys[levels >= j], j)
            for i in range(self.hashes):
                on[self._place(h, i)] = True
        self.data = np.packbits(on, bitorder="little")
        return self

    @staticmethod
    def _hash(keys: np.ndarray, level: int) -> np.ndarray:
        return mix64(keys + np.uint64(level * int(_GOLD) % (1 << 64)))

    def _place(self, h: np.ndarray, i: int) -> np.ndarray:
        # the i-th of a line of hashes, its upper half scaled to the size
        x = mix64(h + np.uint64(i * int(_MUL) % (1 << 64))) >> np.uint64(32)
        return ((x * np.uint64(self.size)) >> np.uint64(32)).astype(np.int64)

    def level(self, keys: np.ndarray) -> np.ndarray:
        """Number of the first levels found in a row, ``top`` at most."""
        out = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        for j in range(1, self.top + 1):
            if not len(left):
                break
            h = self._hash(keys[left], j)
            for i in range(self.hashes):        # an entry leaves at its first missing probe
                p = self._place(h, i)
                on = (self.data[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
                left, h = left[on], h[on]
            out[left] = j
        return out


class Filter:
    """All parts, by bucket."""

    def __init__(self, parts: list[Bits]):
        self.parts = parts

    def level(self, keys: np.ndarray) -> np.ndarray:
        order, starts = by_bucket(keys, len(self.parts))
        out = np.zeros(len(keys), np.int64)
        for b in np.flatnonzero(np.diff(starts)):
            mine = order[starts[b]:starts[b + 1]]
            out[mine] = self.parts[b].level(keys[mine])
        return out


SENT = "bucket long, chunk long, w binary, w_n binary, p binary, p_n binary"
ANSWER = "asker long, bucket long, counts binary, w_q binary, p_q binary, bits binary, size long, hashes int, top int, v long, mass double, n long"


def _sent(chunks: DataFrame, buckets: int) -> DataFrame:
    """Each chunk's distinct words and pairs with their training counts, by bucket."""
    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                s = Stream.of(b, i)
                use = ~np.array(b.column("held")[i].as_py(), bool)[s.doc]
                words, pairs, at = s.keys()
                w_n = np.bincount(s.idx[use], minlength=len(words) + 1)[:len(words)]
                p_n = np.bincount(at[use], minlength=len(pairs))
                (wo, ws), (po, ps) = by_bucket(words, buckets), by_bucket(pairs, buckets)
                words, w_n, pairs, p_n = words[wo].astype("<u8"), w_n[wo], pairs[po].astype("<u8"), p_n[po]
                short = pairs.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
                some = np.flatnonzero(np.diff(ws) + np.diff(ps))
                for lo in range(0, len(some), 256):
                    part = some[lo:lo + 256].tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part, pa.int64()), pa.array([b.column("chunk")[i].as_py()] * len(part), pa.int64()),
                         pa.array([words[ws[k]:ws[k + 1]].tobytes() for k in part], pa.binary()),
                         pa.array([_pack(w_n[ws[k]:ws[k + 1]].astype("<u4")) for k in part], pa.binary()),
                         pa.array([short[ps[k]:ps[k + 1]].tobytes() for k in part], pa.binary()),
                         pa.array([_pack(p_n[ps[k]:ps[k + 1]].astype("<u4")) for k in part], pa.binary())],
                        names=["bucket", "chunk", "w", "w_n", "p", "p_n"])
    return chunks.select("chunk", "held", "sizes", "words", "seq").mapInArrow(run, SENT)


def _summed(keys: np.ndarray, n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their counts, and each key's place among them."""
    uniq, at = np.unique(keys, return_inverse=True)
    return uniq, np.bincount(at, weights=np.concatenate(n) if n else None, minlength=len(uniq)).astype(np.int64), at


def answers(chunks: DataFrame, buckets: int, false_rate: float, probe: bool) -> DataFrame:
    """Per bucket a row with its part of the filter (``asker`` NULL), and for each chunk
    that sent it n-grams the exact counts of the words and, if ``probe``, the levels of words
    and pairs. A bucket's n-grams are at most about ``BUCKET_KEYS``."""
    def one(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        rows = range(t.num_rows)
        get = lambda c: [t.column(c)[i].as_py() for i in rows]
        words = [np.frombuffer(x, "<u8") for x in get("w")]
        pairs = []
        for x in get("p"):
            wide = np.zeros((len(x) // KEY_BYTES, 8), np.uint8)
            wide[:, :KEY_BYTES] = np.frombuffer(x, np.uint8).reshape(-1, KEY_BYTES)
            pairs.append(wide.view("<u8").ravel())
        w, w_n, w_at = _summed(np.concatenate(words), [_unpack(x, "<u4") for x in get("w_n")])
        p, p_n, p_at = _summed(np.concatenate(pairs), [_unpack(x, "<u4") for x in get("p_n")])
        w_q, p_q = level_of(w_n), level_of(p_n)
        bits = Bits.build(np.concatenate((w, p)), np.concatenate((w_q, p_q)), false_rate)
        back = lambda values, at, sizes, kind: [_pack(x.astype(kind)) for x in np.split(values[at], np.cumsum(sizes)[:-1])]
        w_size, p_size = [len(x) for x in words], [len(x) for x in pairs]
        none = [None] * t.num_rows
        return pa.table([
            pa.array([*get("chunk"), None], pa.int64()), pa.array([key[0].as_py()] * (t.num_rows + 1), pa.int64()),
            pa.array([*back(w_n, w_at, w_size, "<u8"), None], pa.binary()),
            pa.array([*(back(bits.level(w), w_at, w_size, "u1") if probe else none), None], pa.binary()),
            pa.array([*(back(bits.level(p), p_at, p_size, "u1") if probe else none), None], pa.binary()),
            pa.array([*none, bits.data.tobytes()], pa.binary()), pa.array([*none, bits.size], pa.int64()), pa.array([*none, bits.hashes], pa.int32()),
            pa.array([*none, bits.top], pa.int32()), pa.array([*none, int((w_n > 0).sum())], pa.int64()),
            pa.array([*none, float(quantised(w_q).sum())], pa.float64()), pa.array([*none, int(w_n.sum())], pa.int64())],
            names=[x.split()[0] for x in ANSWER.split(", ")])

    return stage(_sent(chunks, buckets).groupBy("bucket").applyInArrow(one, ANSWER), "answers")


def collect_filter(answered: DataFrame, buckets: int) -> Filter:
    """The parts on the driver; only for a filter whose size is bounded."""
    parts = [Bits(64, 1, 0, np.zeros(8, np.uint8))] * buckets
    for r in answered.where("asker is null").select("bucket", "size", "hashes", "top", "bits").toLocalIterator():
        parts[r.bucket] = Bits(r.size, r.hashes, r.top, np.frombuffer(r.bits, np.uint8))
    return Filter(parts)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, held_fold: int = 1,
          pair_weight: float = 0.4, false_rate: float = 0.01, broadcast_bits: int = 1 << 29, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """One row per document row: id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.

    ``base_score`` uses exact word counts of the documents whose fold is not ``held_fold``.
    ``score`` is the log10 probability of the text (with its end) under an interpolated
    bigram model whose counts are read from the filter: words and pairs, also those
    seen once, weigh ``1 - pair_weight`` and ``pair_weight``. ``false_rate`` is the
    filter's rate of false positives per level; ``broadcast_bits`` and ``bucket_keys``
    decide only how it is probed and into how many parts it is cut.

    NULL text counts as empty (one token, the end); a NULL id falls into the fold of
    the text ``null``; ids of any type; repeated ids give a row each; other columns are
    ignored; an empty table gives an empty result; without training documents every count
    is zero."""
    chunks = chunk_documents(docs, id_col, text_col, folds, held_fold)
    one = lambda held: F.when(held, 0).otherwise(1)
    totals = chunks.select(
        F.sum(F.aggregate(F.zip_with("held", "sizes", lambda h, s: one(h) * (s + 1)), F.lit(0).cast("long"), lambda a, x: a + x)).alias("train"),
        F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, s: a + s + 1)).alias("all"),
        F.sum(F.aggregate("held", F.lit(0).cast("long"), lambda a, h: a + one(h))).alias("n_train")).first()
    train, tokens, n_train = (int(x or 0) for x in totals)
    buckets = max(1, -(-2 * tokens // bucket_keys))
    # a count of c has at most c levels, so words and pairs have at most 2 * train entries
    small = 2 * train * math.ceil(-math.log(false_rate) / math.log(2) ** 2) <= broadcast_bits
    answered = answers(chunks, buckets, false_rate, not small)
    v, mass, n = answered.where("asker is null").agg(F.sum("v"), F.sum("mass"), F.sum("n")).first()
    v, mass, n = int(v or 0) + (n_train > 0), float(mass or 0) + n_train, int(n or 0) + n_train
    lm = docs.sparkSession.sparkContext.broadcast(collect_filter(answered, buckets) if small else None)
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), *T._parse_datatype_string(
        "held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double").fields])

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        right = right.sort_by("bucket")
        joined = lambda c, kind: np.concatenate([_unpack(x, kind) for x in right.column(c).to_pylist()] or [np.empty(0, kind)])
        for i in range(left.num_rows):
            s = Stream.of(left, i)
            words, pairs, at = s.keys()
            d = len(left.column("ids")[i])
            wo, po = by_bucket(words, buckets)[0], by_bucket(pairs, buckets)[0]
            exact = np.zeros(len(words) + 1, np.int64)
            exact[wo] = joined("counts", "<u8")
            exact[-1] = n_train
            base = np.log10((exact + 0.5) / (n + 0.5 * (v + 1)))
            if small:
                w_q, p_q = lm.value.level(words), lm.value.level(pairs)
            else:
                w_q, p_q = np.empty(len(words), np.int64), np.empty(len(pairs), np.int64)
                w_q[wo], p_q[po] = joined("w_q", "u1"), joined("p_q", "u1")
            single = (np.append(quantised(w_q), float(n_train)) + 0.5) / (mass + 0.5 * (v + 1))
            context = np.empty(len(s.idx), np.int64)
            context[1:] = exact[s.idx[:-1]]
            context[s.before == BOS] = n_train
            share = np.minimum(1.0, least(p_q)[at] / np.maximum(context, 1))
            prob = np.where(context > 0, pair_weight * share + (1 - pair_weight) * single[s.idx], single[s.idx])
            parts.append(pa.table([
                left.column("ids").combine_chunks()[i].values, pa.array(left.column("held")[i].as_py(), pa.bool_()),
                pa.array(np.bincount(s.doc, minlength=d).astype(np.int64)),
                pa.array(np.bincount(s.doc, weights=exact[s.idx] > 0, minlength=d).astype(np.int64)), pa.array(np.full(d, n, np.int64)),
                pa.array(np.bincount(s.doc, weights=base[s.idx], minlength=d)),
                pa.array(np.bincount(s.doc, weights=np.log10(prob), minlength=d))], names=out.names))
        return pa.concat_tables(parts)

    # documents without words ask nothing: their chunk meets no answers
    asked = answered.where("asker is not null").select("asker", "bucket", "counts", "w_q", "p_q")
    return chunks.groupBy("chunk").cogroup(asked.groupBy("asker")).applyInArrow(finish, out)
