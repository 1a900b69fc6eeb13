"""SentencePiece encoding and decoding as a max-plus scan.

A tokenisation is a path over the positions of the text. A step appends one piece
and weighs 0 if the piece may follow the last one and minus infinity if not: in
merge-rank (BPE) vocabularies a sequence is the encoding of its text exactly when
every two neighbours are the encoding of theirs, so the best path is the one path
of weight 0 and equals what repeated merging gives. Because the weight of a step
depends on the last piece only, a boundary state (the piece across or up to a cut,
and by how much it reaches over) is all that one chunk must know of another.

Giant documents are split into chunks of fixed length. Each chunk, on its own,
yields the max-plus matrix from its left to its right boundary states; the small
matrices of a document are combined associatively, which fixes the state at each cut;
then each chunk is backtraced independently. Ordinary documents are one chunk
each. Within a chunk, places that no piece crosses (before a word, around a line
feed) cut the path into words whose pieces are remembered.

The vocabulary is read on the driver and broadcast (32,000 short strings).
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, packed, stage, unpacked

SPACE = "▁"
NEG = float("-inf")
DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


class Vocabulary:
    """Pieces of a SentencePiece BPE model with byte fallback and no normalisation.

    ``tokens`` maps the text of an ordinary piece to its rank (0 merges first);
    a character that is no piece stands for itself and is written as bytes."""

    CACHE = 500_000

    def __init__(self, pieces: list[str], scores: list[float], types: list[int], dummy_prefix: bool):
        self.pieces, self.types, self.dummy_prefix = pieces, types, dummy_prefix
        ids = list(range(len(pieces)))
        self.ids = {p: i for i, p in zip(ids, pieces) if types[i] == 1}
        self.scores = {p: s for p, s, t in zip(pieces, scores, types) if t == 1}
        self.byte_ids = {int(p[3:5], 16): i for i, p in zip(ids, pieces) if types[i] == 6}
        self.max_len = max(map(len, self.ids), default=1)
        self.inner = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        lf = not any("\n" in b for b in self.inner)
        word = not any(b[1] == SPACE != b[0] for b in self.inner)
        s = SPACE if word else ""
        n = "\n" if lf else ""
        # words: what no piece crosses the edges of
        rest = f"[^{s}{n}]" if s or n else "(?s:.)"
        self.words = re.compile("|".join(filter(None, (n, s and f"{s}+{rest}*", f"{rest}+"))))
        # pieces that merging ever yields, and what they begin with
        self.tokens = {p for p in self.ids if self.merge(p) == [p]}
        self.starts = {p[:k]: p[:k] in self.tokens for p in self.tokens for k in range(2, len(p) + 1)}
        self.reset()

    def reset(self):
        self.pairs: dict[tuple[str | None, str], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.raw = [self._raw(i) for i in range(len(self.pieces))]

    def __getstate__(self):
        d = dict(self.__dict__)
        for k in ("pairs", "known", "raw"):
            d.pop(k)
        return d

    def __setstate__(self, d):
        self.__dict__.update(d)
        self.reset()

    @classmethod
    def load(cls, path: str = DEFAULT_MODEL) -> "Vocabulary":
        from sentencepiece import sentencepiece_model_pb2 as pb
        m = pb.ModelProto()
        with open(path, "rb") as f:
            m.ParseFromString(f.read())
        n = m.normalizer_spec
        types = [p.type for p in m.pieces]
        if (m.trainer_spec.model_type != 2 or n.precompiled_charsmap or n.remove_extra_whitespaces or not n.escape_whitespaces
                or not m.trainer_spec.byte_fallback or set(types) - {1, 2, 3, 6}):
            raise ValueError("only BPE models with byte fallback, identity normalisation and no user-defined pieces")
        return cls([p.piece for p in m.pieces], [p.score for p in m.pieces], types, n.add_dummy_prefix)

    # the weights of the lattice
    def merge(self, s: str) -> list[str]:
        """Repeated merging of the best-scored neighbours, leftmost of equals; for
        strings of at most two pieces."""
        parts, score = list(s), self.scores
        while len(parts) > 1:
            best, at = NEG, -1
            for i in range(len(parts) - 1):
                x = score.get(parts[i] + parts[i + 1], NEG)
                if x > best:
                    best, at = x, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def is_token(self, t: str) -> bool:
        return len(t) == 1 or t in self.tokens

    def follows(self, a: str | None, b: str) -> bool:
        """Weight of the step from piece ``a`` to ``b`` is 0 (not minus infinity)."""
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) > 2 * self.CACHE:
                self.pairs.clear()
            ok = self.pairs[a, b] = a is None or a[-1] + b[0] not in self.inner or self.merge(a + b) == [a, b]
        return ok

    # paths
    def reach(self, s: str, start: int, last: str | None, stop: int, limit: int) -> list[str | None]:
        """``out[j]``: the last piece of the path of weight 0 from position ``start``
        after piece ``last`` to position j (None: there is none). Pieces begin
        before ``stop`` and end up to ``limit``. The path to a position is unique."""
        out: list[str | None] = [None] * (limit + 1)
        for j in range(start + 1, limit + 1):
            for i in range(max(start, j - self.max_len), min(j, stop)):
                p = out[i] if i > start else last
                if i > start and p is None:
                    continue
                t = s[i:j]
                if (t in self.ids or j - i == 1) and self.follows(p, t) and self.is_token(t):
                    out[j] = t
                    break
        return out

    def path(self, out: list, start: int, end: int) -> list[str]:
        """Backtrace from ``end``."""
        got = []
        while end > start:
            got.append(out[end])
            end -= len(out[end])
        return got[::-1]

    def options(self, s: str, pos: int, end: int) -> list[str]:
        """Pieces that begin at ``pos``, the longest last."""
        out, k, starts = [s[pos]], pos + 2, self.starts
        while k <= end:
            p = s[pos:k]
            token = starts.get(p)
            if token is None:
                break
            if token:
                out.append(p)
            k += 1
        return out

    def best(self, s: str, end: int) -> list[str]:
        """The path of weight 0 from 0 to ``end``, searched depth first, longest piece
        first. Only one path leads to a position, so a position from which the end
        was not reached is not tried again."""
        path: list[str] = []
        trail: list[list[str]] = []
        dead: set[int] = set()
        pairs, options = self.pairs, self.options
        pos, last, opts = 0, None, options(s, 0, end)
        while True:
            while opts:
                t = opts.pop()
                q = pos + len(t)
                ok = pairs.get((last, t))
                if (self.follows(last, t) if ok is None else ok) and q not in dead:
                    path.append(t)
                    if q == end:
                        return path
                    trail.append(opts)
                    pos, last, opts = q, t, options(s, q, end)
                    break
            else:
                dead.add(pos)
                pos -= len(path.pop())
                last, opts = path[-1] if path else None, trail.pop()

    def to_ids(self, tokens) -> list[int]:
        try:
            return [self.ids[t] for t in tokens]
        except KeyError:        # a character that is no piece
            return [i for t in tokens for i in ([self.ids[t]] if t in self.ids else
                                                [self.byte_ids[b] for b in t.encode("utf-8", "surrogatepass")])]

    def word(self, w: str) -> tuple[int, ...]:
        """Pieces of a string that no piece crosses the edges of."""
        got = self.known.get(w)
        if got is None:
            if len(self.known) > self.CACHE:
                self.known.clear()
            got = (self.ids[w],) if w in self.tokens else tuple(self.to_ids(self.best(w, len(w))))
            if len(w) <= 64:
                self.known[w] = got
        return got

    def prepared(self, text: str) -> str:
        """White space escaped, with the leading space the model adds; '' stays ''."""
        return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE) if text else ""

    def encode(self, text: str | None) -> list[int]:
        known, ids = self.known, []
        for w in self.words.findall(self.prepared(text or "")):
            ids += known.get(w) or self.word(w)
        return ids

    def _raw(self, i: int) -> bytes:
        return {1: lambda p: p.replace(SPACE, " ").encode(), 2: lambda p: " ⁇ ".encode(),
                6: lambda p: bytes([int(p[3:5], 16)])}.get(self.types[i], lambda p: b"")(self.pieces[i])

    def decode(self, ids) -> str | None:
        """The text; bytes that are no UTF-8 become U+FFFD; an id out of range or
        NULL: None."""
        if ids is None or None in ids or ids and not 0 <= min(ids) <= max(ids) < len(self.raw):
            return None
        b = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if self.types[i] != 3), None)
        lead = self.dummy_prefix and first is not None and self.types[first] == 1 and b[:1] == b" "
        return b[lead:].decode("utf-8", "replace")

    # chunks
    def states(self, s: str, cut: int) -> list[tuple[int, str | None]]:
        """Boundary states at a cut: (reach beyond it, piece across or up to it)."""
        if cut == 0 or cut == len(s) or s[cut - 1:cut + 1] not in self.inner:
            return [(0, None)]
        return [(e - cut, s[i:e]) for e in range(cut, min(len(s), cut + self.max_len - 1) + 1)
                for i in range(max(0, e - self.max_len), cut) if (e - i == 1 or s[i:e] in self.ids) and self.is_token(s[i:e])]

    def edges(self, s: str, a: int, b: int) -> tuple[int, int] | None:
        """First and last place in [a, b] that no piece crosses."""
        free = lambda i: i == 0 or i == len(s) or s[i - 1:i + 1] not in self.inner
        first = next((i for i in range(a, b + 1) if free(i)), None)
        return None if first is None else (first, next(i for i in range(b, a - 1, -1) if free(i)))

    def transfer(self, s: str, a: int, b: int) -> np.ndarray:
        """Max-plus matrix of the chunk s[a:b]: from each state at ``a`` to each at ``b``."""
        ins, outs = self.states(s, a), self.states(s, b)
        m = np.full((len(ins), len(outs)), NEG, np.float32)
        limit = min(len(s), b + self.max_len - 1)
        edge = self.edges(s, a, b)

        def ends(start, last):
            """Weights of the states at ``b`` from position ``start``."""
            if start >= b:      # the piece across ``a`` ends at ``b`` or beyond
                return [0.0 if (start - b, last) == x or (x[1] is None and start == b) else NEG for x in outs]
            r = self.reach(s, start, last, b, limit)
            return [0.0 if (r[b] is not None if t is None else b + o <= limit and r[b + o] == t) else NEG for o, t in outs]

        if edge is None:
            for i, (o, t) in enumerate(ins):
                m[i] = ends(a + o, t)
            return m
        first, last = edge
        tail = ends(last, None)
        for i, (o, t) in enumerate(ins):
            if a + o == first or a + o < first and self.reach(s, a + o, t, first, first)[first] is not None:
                m[i] = tail
        return m

    def backtrace(self, s: str, a: int, b: int, into: int, out: int) -> list[int]:
        """Ids of the pieces that begin in the chunk, between the two states."""
        (o, t), (e, _) = self.states(s, a)[into], self.states(s, b)[out]
        start, end = a + o, b + e
        if start >= end:
            return []
        edge = self.edges(s, a, b)
        if edge is None:
            return self.to_ids(self.path(self.reach(s, start, t, b, end), start, end))
        first, last = edge
        ids = self.to_ids(self.path(self.reach(s, start, t, first, first), start, first)) if start < first else []
        for w in self.words.findall(s[first:last]):
            ids += self.word(w)
        return ids + (self.to_ids(self.path(self.reach(s, last, None, b, end), last, end)) if end > last else [])


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product; associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def cut_states(matrices: list[np.ndarray]) -> list[int]:
    """State at each cut on the best path through the chunks (first of equals)."""
    best, back = np.zeros((1, 1), np.float32), []
    for m in matrices:
        back.append((best[0][:, None] + m).argmax(axis=0))
        best = combine(best, m)
    at = [int(best[0].argmax())]
    for b in back[::-1]:
        at.append(int(b[at[-1]]))
    return at[::-1]


def _ids_array(rows: list) -> pa.Array:
    flat = np.fromiter(chain.from_iterable(rows), np.int32, sum(map(len, rows)))
    off = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat))


IDS = T.ArrayType(T.IntegerType())
_SLICE = 256        # rows worked on at once, so that ids of a batch are not all held as Python objects


def encode(docs: DataFrame, text_col: str = "text", vocabulary: Vocabulary | None = None, model: str = DEFAULT_MODEL,
           giant_chars: int = 65_536, chunk_chars: int = 16_384, ids_col: str = "ids") -> DataFrame:
    """``docs`` without the text, plus ``ids_col``, ``n_tokens`` and ``round_trip``
    (decoding gives the text back; U+2581, which the model reads as a space, does not
    come back). Columns of these names are replaced.

    NULL text counts as empty: no pieces, round trip true. NULL and repeated
    keys pass through (giant rows are told apart by a key of their own); other columns
    pass through; an empty table gives an empty one. Documents over ``giant_chars``
    characters go through the chunk scan; the result does not depend on it."""
    v = vocabulary or Vocabulary.load(model)
    if chunk_chars < v.max_len:
        raise ValueError("chunks are shorter than a piece")
    spark = docs.sparkSession
    vb = spark.sparkContext.broadcast(v)
    keep = [c for c in docs.columns if c not in (text_col, ids_col, "n_tokens", "round_trip")]
    src = docs.select(packed(docs, keep), col(text_col).alias("_text"))
    fields = [T.StructField("row", src.schema["row"].dataType)]
    added = [T.StructField("ids", IDS), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())]
    schema = T.StructType([*fields, *added])
    giant = F.length("_text") > giant_chars

    def whole(batches):
        voc = vb.value
        for big in batches:
            for lo in range(0, big.num_rows, _SLICE):
                b = big.slice(lo, _SLICE)
                texts = [t or "" for t in b.column(1).to_pylist()]
                rows = [voc.encode(t) for t in texts]
                ok = [voc.decode(r) == t for r, t in zip(rows, texts)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], _ids_array(rows), pa.array([len(r) for r in rows], pa.int64()),
                                                  pa.array(ok, pa.bool_())], names=schema.names)

    small = src.where(~F.coalesce(giant, F.lit(False))).mapInArrow(whole, schema)

    # giant documents: (key, number of the chunk, its text with context, place of the chunk in it)
    chunk_type = "_key string, _k long, _s string, _a long, _b long, _odd boolean"
    chunk_schema = T.StructType([*fields, *T._parse_datatype_string(chunk_type).fields])

    def split(batches):
        voc, pid, n = vb.value, TaskContext.get().partitionId(), 0
        for b in batches:
            for i in range(b.num_rows):
                text, n = b.column(1)[i].as_py(), n + 1
                s, odd = voc.prepared(text), SPACE in text
                for k, a in enumerate(range(0, len(s), chunk_chars)):
                    lo, hi = max(0, a - voc.max_len), min(len(s), a + chunk_chars)
                    end = min(len(s), hi + voc.max_len)
                    row = b.column(0).slice(i, 1) if k == 0 else pa.nulls(1, b.column(0).type)
                    yield pa.RecordBatch.from_arrays(
                        [row, pa.array([f"{pid}-{n}"]), pa.array([k]), pa.array([s[lo:end]]), pa.array([a - lo]), pa.array([hi - lo]), pa.array([odd])],
                        names=chunk_schema.names)

    chunks = stage(src.where(giant).mapInArrow(split, chunk_schema).repartition("_key", "_k"), "chunks")

    def transfers(batches):
        voc = vb.value
        for b in batches:
            ms = [voc.transfer(s, x, y) for s, x, y in zip(*(b.column(c).to_pylist() for c in ("_s", "_a", "_b")))]
            yield pa.RecordBatch.from_arrays([b.column("_key"), b.column("_k"), pa.array([m.shape[1] for m in ms]),
                                              pa.array([m.ravel() for m in ms], pa.list_(pa.float32()))], names=["_key", "_k", "outs", "m"])

    matrices = chunks.select("_key", "_k", "_s", "_a", "_b").mapInArrow(transfers, "_key string, _k long, outs long, m array<float>")

    def scan(table: pa.Table) -> pa.Table:
        t = table.sort_by("_k")
        ms = [np.array(m, np.float32).reshape(-1, n) for m, n in zip(t.column("m").to_pylist(), t.column("outs").to_pylist())]
        at = cut_states(ms)
        return pa.table({"_key": t.column("_key"), "_k": t.column("_k"), "_in": pa.array(at[:-1], pa.int64()), "_out": pa.array(at[1:], pa.int64())})

    cuts = matrices.groupBy("_key").applyInArrow(scan, "_key string, _k long, _in long, _out long")

    def trace(batches):
        voc = vb.value
        for b in batches:
            rows, ok = [], []
            for s, x, y, i, o in zip(*(b.column(c).to_pylist() for c in ("_s", "_a", "_b", "_in", "_out"))):
                ids = voc.backtrace(s, x, y, i, o)
                own = s[x + voc.states(s, x)[i][0]:y + voc.states(s, y)[o][0]]
                rows.append(ids)
                ok.append(b"".join([voc.raw[t] for t in ids]) == own.replace(SPACE, " ").encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b.column("_key"), b.column("_k"), _ids_array(rows), pa.array(ok, pa.bool_())],
                                             names=["_key", "_k", "ids", "ok"])

    traced = (chunks.select("_key", "_k", "_s", "_a", "_b").join(cuts, ["_key", "_k"])
              .mapInArrow(trace, "_key string, _k long, ids array<int>, ok boolean"))
    whole_ids = (traced.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_k", "ids"))).alias("parts"), F.min("ok").alias("round_trip"))
                 .select("_key", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), "round_trip"))
    big = chunks.where("_k = 0").select("row", "_key", "_odd").join(whole_ids, "_key")
    out = small.union(big.select("row", "ids", F.size("ids").cast("long").alias("n_tokens"),
                                 (F.col("round_trip") & ~F.col("_odd")).alias("round_trip")))
    return out.select(*unpacked(keep), F.col("ids").alias(ids_col), "n_tokens", "round_trip")


def decode(df: DataFrame, ids_col: str = "ids", vocabulary: Vocabulary | None = None, model: str = DEFAULT_MODEL,
           out: str = "text") -> DataFrame:
    """``df`` plus ``out``, the text of the pieces (replaced if it is there); NULL ids, a
    NULL id among them or one out of range: NULL; no ids: the empty text."""
    base = df.drop(out)
    vb = df.sparkSession.sparkContext.broadcast(vocabulary or Vocabulary.load(model))
    at = base.columns.index(ids_col)

    def run(batches):
        for b in batches:
            texts = pa.array([vb.value.decode(x) for x in b.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, texts], names=[*b.schema.names, out])

    return base.mapInArrow(run, T.StructType([*base.schema.fields, T.StructField(out, T.StringType())]))
