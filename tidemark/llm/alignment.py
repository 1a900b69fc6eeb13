"""Alignment of the tokens of two tokenizers over the same text.

A is a byte-level BPE (``tokenizers`` JSON), B a piece model (``sentencepiece``); A
reads space + text, B the text (it adds that space). Per batch, ``pandas.merge_asof``
keyed by document finds, for each token start, the other side's token that covers it;
the union of both directions is every overlapping pair. Pairs that end at the same byte
are links, and those ends cut both sides into groups.

Both tokenizers run on distinct units only: a text is cut before each single space
between two characters that are not white space. A's pre-tokens begin there and none
of B's pieces holds a space after another character (checked when it is loaded),
so the units' tokens are the text's tokens.

Linked tokens end at the same byte of the same text, so one is a suffix of the other:
the number of linked id pairs has a bound set by the two vocabularies
(:meth:`Pair.pair_bound`, under a million here) whatever the corpus. That is what makes
the table of pair counts small enough to broadcast.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import col, packed, stage, unpacked

BYTE_MODEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WINDOW = 1 << 18            # units aligned at once; a longer document takes several windows
SLICE_CHARS = 1 << 20       # characters cut into units at once
CACHE_UNITS = 1 << 19       # units remembered by a task
BLOCK = 1 << 12             # new units that are encoded together
CACHE_CHARS = 1 << 26
_CUT = re.compile(r"(?<=\S) (?=\S)")
_MARK = "▁"


def _byte_letters() -> dict[str, int]:
    """Byte-level BPE's letter of each byte: printable Latin-1 bytes stand for themselves,
    the others for the letters from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@dataclass
class Pair:
    """The two tokenizers as file contents, so that workers need no file."""

    a_json: str
    b_proto: bytes

    @classmethod
    def load(cls, a_path: str = BYTE_MODEL, b_path: str = PIECE_MODEL) -> Pair:
        pair = cls(Path(a_path).read_text(encoding="utf-8"), Path(b_path).read_bytes())
        if any(_MARK in p.lstrip(_MARK) for p in pair._pieces()):
            raise ValueError("pieces with an inner space can't be cut at spaces")
        return pair

    def _b(self):
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_proto=self.b_proto)

    def _pieces(self) -> list[str]:
        b = self._b()
        return [b.id_to_piece(i) for i in range(b.get_piece_size())]

    def a_bytes(self) -> list[bytes]:
        spec, letters = json.loads(self.a_json), _byte_letters()
        vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        out = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            out[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        return out

    def b_bytes(self) -> list[bytes]:
        b = self._b()
        return [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace(_MARK, " ").encode()
                for i, p in enumerate(self._pieces())]

    def pair_bound(self) -> int:
        """How many pairs of an A and a B id exist of which one's bytes end with the other's."""
        a, b = self.a_bytes(), self.b_bytes()
        ends_a, ends_b = pd.Series(a).value_counts().to_dict(), pd.Series(b).value_counts().to_dict()
        count = lambda words, ends, first: sum(ends.get(w[k:], 0) for w in words for k in range(first, len(w)))
        return count(a, ends_b, 0) + count(b, ends_a, 1)


class Encoder:
    """Tokens of units, remembered; one per task."""

    def __init__(self, pair: Pair):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(pair.a_json)
        self.a.encode_special_tokens = True
        self.b = pair._b()
        self.bytes = pair.a_bytes(), pair.b_bytes()
        self.lens = [np.array([len(x) for x in side], np.int64) for side in self.bytes]
        self.clear()

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.chars = 0
        self.bad: set[int] = set()      # units whose tokens do not spell them
        self.ids = [[np.empty(0, np.int32)], [np.empty(0, np.int32)]]
        self.sizes = [[np.empty(0, np.int64)], [np.empty(0, np.int64)]]

    def units(self, text: str) -> np.ndarray:
        """Numbers of the units of a stretch of text (which begins and ends at cuts)."""
        parts = _CUT.split(text)
        at = self.at
        new = [p for p in dict.fromkeys(parts) if p not in at]
        for lo in range(0, len(new), BLOCK):
            self._learn(new[lo:lo + BLOCK])
        return np.fromiter(map(at.__getitem__, parts), np.int64, len(parts))

    def _learn(self, new: list[str]) -> None:
        """Tokens of new units, read off one text that holds them all; one by one if the
        tokens of some do not spell them."""
        text = " ".join(new)
        sides = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text)
        raw = (" " + text).encode("utf-8", "surrogatepass")
        if any(b"".join(map(table.__getitem__, ids)) != raw for table, ids in zip(self.bytes, sides)):
            if len(new) > 1:
                for p in new:
                    self._learn([p])
                return
            self.bad.add(len(self.at))
            sides = [], []
        ends = np.cumsum([len(p.encode("utf-8", "surrogatepass")) + 1 for p in new]) if not text.isascii() else np.cumsum([len(p) + 1 for p in new])
        for k, ids in enumerate(sides):
            ids = np.array(ids, np.int32)
            # a unit's tokens are those up to its last byte
            upto = np.searchsorted(np.cumsum(self.lens[k][ids]), ends, "right")
            self.ids[k].append(ids)
            self.sizes[k].append(np.diff(np.concatenate(([0], upto))))
        first = len(self.at)
        self.at.update(zip(new, range(first, first + len(new))))
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.at) > CACHE_UNITS or self.chars > CACHE_CHARS

    def valid(self, units: np.ndarray) -> bool:
        return not self.bad or self.bad.isdisjoint(units.tolist())

    def tokens(self, units: np.ndarray, docs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per side (ids, document, end byte) of the units one after another."""
        out = []
        for k, lens in enumerate(self.lens):
            self.ids[k], self.sizes[k] = [np.concatenate(self.ids[k])], [np.concatenate(self.sizes[k])]
            flat, size = self.ids[k][0], self.sizes[k][0]
            first = np.cumsum(size) - size
            n = size[units]
            before = np.cumsum(n) - n
            ids = flat[np.repeat(first[units] - before, n) + np.arange(int(n.sum()))]
            out.append((ids, np.repeat(docs, n), np.cumsum(lens[ids])))
        return out


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (in A, in B) of all overlapping tokens. Starts ascend over the whole
    batch, documents one after another; each side covers its document's bytes without gaps."""
    a = pd.DataFrame({"doc": doc_a, "start": start_a, "a": np.arange(len(doc_a))})
    b = pd.DataFrame({"doc": doc_b, "start": start_b, "b": np.arange(len(doc_b))})
    a_in_b = pd.merge_asof(a, b, on="start", by="doc")
    b_in_a = pd.merge_asof(b, a, on="start", by="doc")
    # tokens that start together are found from both sides; the union holds them once
    again = start_a[b_in_a["a"].to_numpy()] == start_b
    return (np.concatenate((a_in_b["a"].to_numpy(), b_in_a["a"].to_numpy()[~again])),
            np.concatenate((a_in_b["b"].to_numpy(), b_in_a["b"].to_numpy()[~again])))


@dataclass
class Aligned:
    """One window: documents (``rows``: their numbers, ``last``: nothing of it follows)
    with both sides' tokens, all overlaps and the links among them, in order."""

    rows: list[int]
    last: list[bool]
    ids: tuple[np.ndarray, np.ndarray]
    docs: tuple[np.ndarray, np.ndarray]         # index into rows, per token
    over: tuple[np.ndarray, np.ndarray]
    link: tuple[np.ndarray, np.ndarray]

    def counts(self, docs: np.ndarray) -> np.ndarray:
        return np.bincount(docs, minlength=len(self.rows))


def _align(enc: Encoder, rows: list[int], last: list[bool], units: list[np.ndarray]) -> Aligned:
    docs = np.repeat(np.arange(len(rows)), [len(u) for u in units])
    (a, doc_a, end_a), (b, doc_b, end_b) = enc.tokens(np.concatenate(units), docs)
    over = overlaps(doc_a, end_a - enc.lens[0][a], doc_b, end_b - enc.lens[1][b])
    same = end_a[over[0]] == end_b[over[1]]
    partner = np.full(len(a), -1)
    partner[over[0][same]] = over[1][same]
    link_a = np.flatnonzero(partner >= 0)
    return Aligned(rows, last, (a, b), (doc_a, doc_b), over, (link_a, partner[link_a]))


def _slices(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > SLICE_CHARS:
        cut = _CUT.search(text, at + SLICE_CHARS)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def windows(enc: Encoder, texts: Iterator[tuple[int, str | None]], window: int = WINDOW) -> Iterator[tuple[list[int], Aligned | None]]:
    """(documents without tokens, aligned window or None) until all texts are through.
    A document of more than a window is a window per stretch."""
    rows, units, held, none = [], [], 0, []
    for row, text in texts:
        if enc.full() and not rows:
            enc.clear()
        parts = [enc.units(s) for s in _slices(text)] if text else []
        if not parts or not all(enc.valid(u) for u in parts):
            none.append(row)
            continue
        own = parts[0] if len(parts) == 1 else np.concatenate(parts)
        if len(own) > window:
            for lo in range(0, len(own), window):
                yield none, _align(enc, [row], [lo + window >= len(own)], [own[lo:lo + window]])
                none = []
            continue
        rows.append(row)
        units.append(own)
        held += len(own)
        if held >= window or enc.full():
            yield none, _align(enc, rows, [True] * len(rows), units)
            rows, units, held, none = [], [], 0, []
    if rows or none:
        yield none, _align(enc, rows, [True] * len(rows), units) if rows else None


def _digits(n: int) -> np.ndarray:
    """Decimal digits of 0..n-1 as bytes, right-aligned after zero bytes."""
    width = len(str(max(n - 1, 0)))
    out, left = np.zeros((n, width), np.uint8), np.arange(n)
    for k in range(width - 1, -1, -1):
        out[:, k] = np.where((left > 0) | (k == width - 1), left % 10 + 48, 0)
        left = left // 10
    return out


def _spelled(w: Aligned, digits: tuple[np.ndarray, np.ndarray]) -> tuple[bytes, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3;`` of the window's groups, and where each document's part ends."""
    (a, b), (last_a, last_b) = w.ids, w.link
    group = lambda last, n: np.repeat(np.arange(len(last)), np.diff(np.concatenate(([-1], last)))) if n else np.empty(0, np.int64)
    ga, gb = group(last_a, len(a)), group(last_b, len(b))
    pos_a = np.arange(len(a)) + np.concatenate(([0], last_b + 1))[ga]
    pos_b = np.arange(len(b)) + (last_a + 1)[gb]
    width = max(d.shape[1] for d in digits)
    cells = np.zeros((len(a) + len(b), width + 1), np.uint8)
    for pos, ids, d, last, end in ((pos_a, a, digits[0], last_a, ord("|")), (pos_b, b, digits[1], last_b, ord(";"))):
        cells[pos, width - d.shape[1]:width] = d[ids]
        sep = np.full(len(ids), ord(","), np.uint8)
        sep[last] = end
        cells[pos, width] = sep
    used = cells != 0
    sizes = used.sum(axis=1)
    ends = np.cumsum(sizes)
    stop = np.cumsum(w.counts(w.docs[0]) + w.counts(w.docs[1]))
    return cells[used].tobytes(), np.concatenate(([0], np.concatenate(([0], ends))[stop]))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    off = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values.astype(np.int32)))


def _source(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    return docs.select(packed(docs, keep), F.monotonically_increasing_id().alias("_n"), col(text_col).alias("_text"))


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, str | None]]:
    text = batch.column(2)
    return ((i, text[i].as_py()) for i in range(batch.num_rows))


def align(docs: DataFrame, text_col: str = "text", pair: Pair | None = None, window: int = WINDOW) -> DataFrame:
    """The other columns of ``docs`` and, per document, ``part`` (0, 1, ... for a
    document of more than ``window`` units), ``a`` and ``b`` (token ids), ``over_a`` and
    ``over_b`` (positions in them of every overlapping pair), ``last_a`` and ``last_b``
    (positions of the tokens that end together: the last ones of each group). Columns of
    these names are replaced.

    NULL and empty texts, and texts whose tokens do not spell space + text, have empty
    lists; rows with NULL or repeated ids are separate documents; an empty table gives
    an empty one."""
    names = ["part", "a", "b", "over_a", "over_b", "last_a", "last_b"]
    keep = [c for c in docs.columns if c != text_col and c not in names]
    src = _source(docs, keep, text_col)
    bc = docs.sparkSession.sparkContext.broadcast(pair or Pair.load())
    lists = [T.StructField(n, T.ArrayType(T.IntegerType())) for n in names[1:]]
    schema = T.StructType([T.StructField("row", src.schema["row"].dataType), T.StructField("part", T.IntegerType()), *lists])

    def run(batches):
        enc = Encoder(bc.value)
        for batch in batches:
            parts: dict[int, int] = {}
            for none, w in windows(enc, _texts(batch), window):
                if none:
                    empty = _lists(np.empty(0), np.zeros(len(none)))
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(none)), pa.array([0] * len(none), pa.int32()), *[empty] * 6],
                                                     names=schema.names)
                if w is None:
                    continue
                doc_a, doc_b = w.docs
                first = [np.concatenate(([0], np.cumsum(w.counts(d))))[:-1] for d in w.docs]
                order = np.argsort(doc_a[w.over[0]], kind="stable")
                oa, ob = w.over[0][order], w.over[1][order]
                la, lb = w.link
                cols = [_lists(w.ids[0], w.counts(doc_a)), _lists(w.ids[1], w.counts(doc_b)),
                        _lists(oa - first[0][doc_a[oa]], w.counts(doc_a[oa])), _lists(ob - first[1][doc_b[ob]], w.counts(doc_a[oa])),
                        _lists(la - first[0][doc_a[la]], w.counts(doc_a[la])), _lists(lb - first[1][doc_b[lb]], w.counts(doc_a[la]))]
                at = [parts.get(r, 0) for r in w.rows]
                parts.update((r, p + 1) for r, p in zip(w.rows, at))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(w.rows)), pa.array(at, pa.int32()), *cols], names=schema.names)

    return src.mapInArrow(run, schema).select(*unpacked(keep), *names)


_DIGEST = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pair: Pair | None = None, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` of its alignment (see :func:`align` for NULL, empty and repeated rows).

    A link is a pair of tokens that end together; its count is how often the corpus links
    its two ids; ``n_best`` are links whose count is the highest of their B id;
    ``groups_sha256`` is the digest of the groups ``a1,a2|b1;a3|b2,b3``, '' without tokens."""
    spark = docs.sparkSession
    pair = pair or Pair.load()
    n_b = len(pair.b_bytes())
    key = np.dtype("<u4") if len(pair.a_bytes()) * n_b < 1 << 32 else np.dtype("<u8")
    bc = spark.sparkContext.broadcast(pair)
    src = docs.select(col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_n"), col(text_col).alias("_text"))
    head = [T.StructField("doc_id", src.schema["_id"].dataType), T.StructField("_n", T.LongType()), T.StructField("_whole", T.BooleanType())]
    schema = T.StructType([*head, *T._parse_datatype_string(_DIGEST).fields])

    def rows(batch, at, whole, stats, shas, links):
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(at, pa.int64())), batch.column(1).take(pa.array(at, pa.int64())), pa.array(whole, pa.bool_()),
             *[pa.array(s, pa.int64()) for s in stats], pa.array(shas, pa.string()), pa.array(links, pa.binary())], names=schema.names)

    def run(batches):
        enc = Encoder(bc.value)
        digits = tuple(_digits(len(x)) for x in enc.bytes)
        for batch in batches:
            open_hash = None        # of a document whose windows are not through
            for none, w in windows(enc, _texts(batch), window):
                if none:
                    zero = [0] * len(none)
                    yield rows(batch, none, [True] * len(none), [zero] * 4, [""] * len(none), [b""] * len(none))
                if w is None:
                    continue
                text, ends = _spelled(w, digits)
                (a, b), (la, lb) = w.ids, w.link
                links = (a[la].astype(np.uint64) * np.uint64(n_b) + b[lb].astype(np.uint64)).astype(key)
                n_links = w.counts(w.docs[0][la])
                bounds = np.concatenate(([0], np.cumsum(n_links)))
                shas, whole, view = [], [], memoryview(text)
                for i, end in enumerate(w.last):
                    started, h = open_hash is not None, open_hash or hashlib.sha256()
                    h.update(view[ends[i]:ends[i + 1] - bool(end)])        # without the last group's mark
                    shas.append(h.hexdigest() if end else None)
                    whole.append(end and not started)
                    open_hash = None if end else h
                yield rows(batch, w.rows, whole, [w.counts(w.docs[0]), w.counts(w.docs[1]), n_links, n_links], shas,
                           [links[bounds[i]:bounds[i + 1]].tobytes() for i in range(len(w.rows))])

    staged = stage(src.mapInArrow(run, schema), "aligned")

    def tally(batches):
        for batch in batches:
            k, n = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), key), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(n.astype(np.int64))], names=["pair", "n"])

    counted = staged.select("links").mapInArrow(tally, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # one row per linked pair of ids: at most Pair.pair_bound(), whatever the corpus
    table = counted.orderBy("pair").toArrow()
    pairs, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
    most = np.zeros(n_b, np.int64)
    np.maximum.at(most, pairs % n_b, n)
    known = spark.sparkContext.broadcast((pairs.astype(key), n, n == most[pairs % n_b]))

    at = staged.columns.index("links")

    def look_up(batches):
        pairs, n, best = known.value
        for batch in batches:
            raw = batch.column(at)
            size = np.array([len(x) for x in raw.to_pylist()], np.int64) // key.itemsize
            k = np.searchsorted(pairs, np.frombuffer(b"".join(raw.to_pylist()), key))
            ends = np.concatenate(([0], np.cumsum(size)))
            sums = [np.concatenate(([0], np.cumsum(v[k].astype(np.int64)))) for v in (best, n)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], *[pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums]],
                                             names=[*batch.schema.names[:at], "n_best", "count_sum"])

    found = staged.mapInArrow(look_up, T.StructType([*schema.fields[:-1], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())]))
    sums = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    out = ["doc_id", *sums, "groups_sha256"]
    # stretches of one long document are summed; all other documents are done
    long = (found.where("not _whole").groupBy("_n")
            .agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in sums], F.max("groups_sha256").alias("groups_sha256")))
    return found.where("_whole").select(*out).union(long.select(*out))
