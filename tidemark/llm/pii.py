"""Personal data: candidate generators, boosted trees, calibrated thresholds.

Columns and SQL functions only. Strict patterns with validators give the base
spans. Looser generators propose further, overlapping candidates (numbers grouped
in any way and, where numbers stand side by side, each part of such a run that has the
digits of a kind; addresses with spelled-out signs); every candidate gets format and
context features, and gradient-boosted trees, trained here on all candidates that the
validators accept or reject, score them. A threshold per kind, calibrated on all
candidates by trees that have not seen them, selects the spans to add; base spans always stay.

The trees are turned into one SQL expression, so scoring is a narrow projection
over each row's own candidates: no shuffle, and a document's spans stay in its row.
Patterns use possessive repeats and start only where a run starts (or where the last
match ended), so matching is linear in the text and needs no deep stack.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, packed, stage, unstage

KINDS = ("email", "ip", "card", "phone")
_RUN = r"(?:(?<![%s])|\G)"
PATTERNS = {
    "email": _RUN % "A-Za-z0-9._%+-" + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _RUN % "0-9" + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": _RUN % "0-9" + r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# what a text must hold for the pattern to be tried
_NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
# high-recall generators; the kind of a number follows from its form
LOOSE_EMAIL = (_RUN % "A-Za-z0-9._%+-" + r"[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
               r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++")
LOOSE_NUMBER = r"(?<![A-Za-z0-9_+(])\+?\(?[0-9](?:[\x20()./-]{0,2}+[0-9])++"
BEFORE, AFTER = 24, 8       # code points of context on either side
CUES = r"(?i)mail|phone|tel|call|fax|mobil|card|visa|credit|\bip\b|address|contact|host|server"
_SPAN = "struct<s:int,e:int,k:int>"
_PLACED = "array<struct<s:int,e:int,m:string,b:string,a:string>>"
FEATURES = ("n_chars", "n_digits", "n_groups", "longest", "dots", "hyphens", "spaces", "plus", "parens", "ats",
            "letters", "distinct", "luhn", "octets", "cue", "word_before", "equals_before", "word_after")


_BLOCK = 128


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once (a lambda's body would repeat it)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _cut(arr: Column, lo: Column, n: Column | int) -> Column:
    """``n`` elements from the 0-based ``lo`` (fewer at the end, at least one); element by
    element, as ``slice`` costs the length of its array."""
    return F.transform(F.sequence(lo, F.least(lo + n, F.size(arr)) - 1), lambda i: F.get(arr, i))


def _blocks(name: str) -> Column:
    """The array column cut into blocks, so that walks over long arrays append to
    short ones. (Named several times, so the optimizer keeps the column computed.)"""
    arr, n = F.col(name), F.size(name)
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(_BLOCK))
    return F.transform(F.filter(starts, lambda i: i < n), lambda i: _cut(arr, i, _BLOCK))


def _walk(blocks: Column, item: str, step) -> Column:
    """Array of (pos, out) per block: ``step(pos, x)`` gives the next position and
    the items (an array of type ``item``) that element ``x`` adds."""
    def inner(start: Column, block: Column) -> Column:
        def add(a: Column, x: Column) -> Column:
            pos, more = step(a["pos"], x)
            return F.struct(pos.alias("pos"), F.concat(a["out"], more).alias("out"))
        return F.aggregate(block, F.struct(start.alias("pos"), F.array().cast(f"array<{item}>").alias("out")), add)

    # positions first: an aggregate copies its state at every step, so the state holds
    # a number per block and not the items
    def at(acc: Column, block: Column) -> Column:
        end = F.aggregate(block, acc["pos"], lambda pos, x: step(pos, x)[0])
        return F.struct(end.alias("pos"), F.concat(acc["starts"], F.array(acc["pos"])).alias("starts"))

    zero = F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("starts"))
    return _let(F.aggregate(blocks, zero, at)["starts"], lambda starts: F.transform(blocks, lambda b, i: inner(F.get(starts, i), b)))


def _found(text: Column, pattern: str, needs: str | None) -> Column:
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return hits if needs is None else F.when(F.contains(text, F.lit(needs)), hits).otherwise(F.array().cast("array<string>"))


def _located(df: DataFrame, text: str, pattern: str, out: str, needs: str | None = None) -> DataFrame:
    """Adds ``out``: array of (s, e, m, b, a), the matches with their places in code
    points and the text before and after, up to the neighbouring match. The pieces
    between the matches give places and context."""
    df = df.withColumn("_m", _found(F.col(text), pattern, needs))
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split(F.col(text), pattern, -1)).otherwise(F.array().cast("array<string>")))
    z = F.zip_with(F.slice("_p", 1, F.size("_m")), "_m", lambda p, m: F.struct(
        F.length(p).alias("g"), m.alias("m"), F.right(p, F.lit(BEFORE)).alias("b")))
    z = F.zip_with(z, F.slice("_p", 2, F.size("_m")), lambda x, p: F.struct(
        x["g"].alias("g"), x["m"].alias("m"), x["b"].alias("b"), F.left(p, F.lit(AFTER)).alias("a")))

    def step(pos: Column, x: Column):
        s = pos + x["g"]
        e = s + F.length(x["m"])
        return e, F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m"), x["b"].alias("b"), x["a"].alias("a")))

    df = df.withColumn("_z", z).withColumn("_z", _blocks("_z"))
    walked = _walk(F.col("_z"), "struct<s:int,e:int,m:string,b:string,a:string>", step)
    return df.withColumn(out, F.flatten(F.transform(walked, lambda w: w["out"]))).drop("_m", "_p", "_z")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    """Luhn sum of a digit string ends in zero; every second digit from the right doubles."""
    n = F.length(d)
    digit = lambda i: F.substr(d, n - i, F.lit(1)).cast("int")
    twice = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
    total = _sum(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i % 2 == 1, twice(digit(i))).otherwise(digit(i))))
    return (n > 0) & (total % 10 == 0)


def _small(part: Column) -> Column:
    """The digit string's value is at most 255."""
    p = F.regexp_replace(part, "^0+", "")
    return (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255"))


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), _small)
    if kind == "card":
        d = _digits(m)
        return F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    return F.lit(True)


def with_base(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_base``: array of (k, s, e) of the strict spans, by kind as listed, then start."""
    for k, kind in enumerate(KINDS):
        df = _located(df, text, PATTERNS[kind], f"_{kind}", _NEEDS[kind])
        ok = F.filter(f"_{kind}", lambda x: _valid(kind, x["m"]))
        df = df.withColumn(f"_{kind}", F.transform(ok, lambda x: F.struct(F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"))))
    return df.withColumn("_base", F.concat(*[F.col(f"_{k}") for k in KINDS])).drop(*[f"_{k}" for k in KINDS])


def _inside(x: Column) -> Column:
    """(s, e, m, b, a) of the parts of a run of numbers, from the start of one group of digits
    to the end of another, that have 9 to 19 digits or are four dotted groups; not the
    run itself. Each group starts at most 19 of them, so there are linearly many."""
    def places(pieces: Column, size) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(pieces), F.lit(_BLOCK)), lambda i: i < F.size(pieces))
        walked = _walk(F.transform(starts, lambda i: _cut(pieces, i, _BLOCK)), "int", lambda pos, p: (pos + size(p), F.array(pos)))
        return F.flatten(F.transform(walked, lambda w: w["out"]))

    def parts(g: Column) -> Column:
        """Groups see a window of their neighbours (a slice costs the length of its array)."""
        def near(lo: Column) -> Column:
            first = F.greatest(lo - BEFORE, F.lit(0))
            last = F.least(lo + _BLOCK, F.size(g)) - 1
            return _let(_cut(g, first, BEFORE + _BLOCK + 19 + AFTER), lambda w: F.flatten(
                F.transform(F.sequence(lo - first, last - first), lambda i: from_group(w, i, first + i, F.size(g)))))
        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(g) - 1, F.lit(_BLOCK)), near))

    def from_group(g: Column, i: Column, at: Column, n_groups: Column) -> Column:
        """The parts that start at ``g[i]``, number ``at`` of ``n_groups``."""
        text = lambda lo, n: F.array_join(F.transform(F.slice(g, lo, n), lambda y: y["p"]), "")

        def of(w: Column) -> Column:
            own = F.when(at == 0, w["p"]).otherwise(F.regexp_extract(w["p"], r"\(?[0-9]++$", 0))
            start = x["s"] + w["o"] + F.length(w["p"]) - F.length(own)
            before = F.right(F.concat(x["b"], text(F.greatest(i - BEFORE, F.lit(0)) + 1, F.least(i, F.lit(BEFORE))),
                                      F.left(w["p"], F.length(w["p"]) - F.length(own))), F.lit(BEFORE))

            def fits(n: Column) -> Column:
                last = F.get(g, i + n - 1)
                digits = last["c"] + last["d"] - w["c"]
                return (digits.between(9, 19) | (n == 4)) & (n < n_groups)
            ends = F.filter(F.sequence(F.lit(1), F.least(F.lit(19), n_groups - at)), fits)
            return _let(F.struct(own.alias("own"), start.alias("s"), before.alias("b")), lambda h: F.transform(ends, lambda n: _let(
                F.concat(h["own"], text(i + 2, n - 1)), lambda m: F.struct(
                    h["s"].alias("s"), (h["s"] + F.length(m)).alias("e"), m.alias("m"), h["b"].alias("b"),
                    F.left(F.concat(text(i + n + 1, F.lit(AFTER)), x["a"]), F.lit(AFTER)).alias("a")))))
        return _let(F.get(g, i), of)

    digits = lambda p: F.length(_digits(p))
    groups = lambda ps: F.zip_with(F.zip_with(ps, places(ps, F.length), lambda p, o: F.struct(p.alias("p"), o.alias("o"))),
                                   places(ps, digits), lambda y, c: F.struct(y["p"].alias("p"), y["o"].alias("o"), c.alias("c"), digits(y["p"]).alias("d")))
    pieces = F.regexp_extract_all(x["m"], F.lit("[^0-9]*+[0-9]++"), F.lit(0))
    return _let(pieces, lambda ps: _let(groups(ps), parts))


def _features(m: Column, before: Column, after: Column) -> dict[str, Column]:
    d = _digits(m)
    groups = F.filter(F.split(m, "[^0-9]+"), lambda g: g != "")
    count = lambda chars: F.length(m) - F.length(F.translate(m, chars, ""))
    out = {
        "n_chars": F.length(m), "n_digits": F.length(d), "n_groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "dots": count("."), "hyphens": count("-"), "spaces": count(" "), "plus": count("+"), "parens": count("()"), "ats": count("@"),
        "letters": F.length(F.regexp_replace(m, "[^A-Za-z]", "")),
        "distinct": F.size(F.array_distinct(F.split(d, ""))),
        "luhn": F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(False),
        "octets": F.size(F.filter(groups, _small)), "cue": F.regexp_like(before, F.lit(CUES)),
        "word_before": F.regexp_like(before, F.lit(r"[\p{L}0-9_]\z")), "equals_before": F.regexp_like(before, F.lit(r"[=:\"']\s*\z")),
        "word_after": F.regexp_like(after, F.lit(r"\A[\p{L}0-9_]")),
    }
    return {k: out[k].cast("double") for k in FEATURES}


def _after(spans: Column, pos: Column, field: str) -> Column:
    """Index of the first of the disjoint, ascending ``spans`` whose ``field`` (s or e) lies
    beyond ``pos``, by halving. (``spans`` must be a column that is there already.)"""
    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        beyond = F.get(spans, mid)[field] > pos
        return (F.when(acc["lo"] >= acc["hi"], acc).when(beyond, F.struct(acc["lo"].alias("lo"), mid.alias("hi")))
                .otherwise(F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))))
    halvings = F.sequence(F.lit(0), F.length(F.bin(F.size(spans).cast("long"))))
    return F.aggregate(halvings, F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), step)["lo"]


def _met(spans: Column, s: Column, e: Column) -> Column:
    """Whether one of the disjoint, ascending ``spans`` overlaps [s, e)."""
    return (F.size(spans) > 0) & F.coalesce(F.get(spans, _after(spans, s, "e"))["s"] < e, F.lit(False))


def _near(spans: Column, s: Column, e: Column) -> Column:
    """Those of the disjoint, ascending ``spans`` that overlap [s, e)."""
    none = F.array().cast(f"array<{_SPAN.replace('s:int,e:int,k:int', 'k:int,s:int,e:int')}>")
    place = F.struct(_after(spans, s, "e").alias("lo"), _after(spans, e - 1, "s").alias("hi"))
    return F.when(F.size(spans) == 0, none).otherwise(_let(place, lambda p: F.when(p["lo"] >= p["hi"], none).otherwise(
        F.transform(F.sequence(p["lo"], p["hi"] - 1), lambda i: F.get(spans, i)))))


def _union(df: DataFrame, spans: Column, out: str) -> DataFrame:
    """Adds ``out``: the text that ``spans`` cover, as disjoint, ascending intervals."""
    df = df.withColumn("_o", F.array_sort(F.transform(spans, lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e")))))
    # an interval begins where no span before reaches; _walk carries how far they reach
    step = lambda pos, b: (F.greatest(pos, b["e"]), F.array(F.struct(b["s"].alias("s"), b["e"].alias("e"), (b["s"] >= pos).alias("k"))))
    df = df.withColumn("_o", F.flatten(F.transform(_walk(_blocks("_o"), "struct<s:int,e:int,k:boolean>", step), lambda w: w["out"])))
    heads = F.filter(F.transform("_o", lambda b, i: F.struct(b["s"].alias("s"), b["k"].alias("k"), i.alias("i"))), lambda b: b["k"])
    df = df.withColumn("_h", heads)
    # up to the next head the spans' ends only grow past it in the last of kinds, so the highest end closes it
    last = lambda h, j: F.coalesce(F.get("_h", j + 1)["i"], F.size("_o")) - 1
    top = lambda lo, hi: F.array_max(F.transform(F.sequence(lo, hi), lambda i: F.get("_o", i)["e"]))
    return df.withColumn(out, F.transform("_h", lambda h, j: F.struct(h["s"].alias("s"), top(h["i"], last(h, j)).alias("e")))).drop("_o", "_h")


def with_candidates(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_cand``: an array for each loose address and each run of numbers, of (k, s, e, y, f)
    for each proposal in it: the whole (of up to 19 digits) and the parts of a run that the
    validator of their kind lets pass. ``y`` is the validators' word: 1 if a base span of the
    kind covers nearly the same text (for a part: the same), 0 if a strict form failed,
    NULL where they say nothing; ``f`` the features."""
    df = _located(df, text, LOOSE_EMAIL, "_c0")
    df = _located(df, text, LOOSE_NUMBER, "_c1")
    # the base spans of each kind are disjoint and ascend: candidates look up their own
    for k in range(len(KINDS)):
        df = df.withColumn(f"_k{k}", F.filter("_base", lambda b: b["k"] == k))

    def kind(m: Column) -> Column:
        n = F.length(_digits(m))
        return (F.when(F.regexp_like(m, F.lit(r"^[0-9]+(?:\.[0-9]+){3}$")), 1)
                .when((n >= 13) & ~F.regexp_like(m, F.lit(r"[()+]|^00")), 2).otherwise(3))

    def row(x: Column, k: Column, part: bool = False) -> Column:
        s, e, m = x["s"], x["e"], x["m"]
        same = lambda b: (F.least(b["e"], e) - F.greatest(b["s"], s)
                          >= 0.8 * (F.greatest(b["e"], e) - F.least(b["s"], s)))
        n = F.length(_digits(m))
        plain = F.regexp_like(m, F.lit(r"^[0-9]+(?:\.[0-9]+){0,2}$"))
        strict = (F.when(k == 1, True).when(k == 2, ~F.regexp_like(m, F.lit("[()./+]")))
                  .when(k == 3, (n < 7) | plain | F.startswith(m, F.lit("+"))).otherwise(False))
        near = reduce(lambda rest, j: F.when(k == j, _near(F.col(f"_k{j}"), s, e)).otherwise(rest), (1, 2, 3), _near(F.col("_k0"), s, e))
        y = lambda near: F.when(F.exists(near, same), 1).when(strict, 0)
        if part:        # base spans nearly the same as a part say nothing about it
            exact = lambda b: (b["s"] == s) & (b["e"] == e)
            y = lambda near: F.when(F.exists(near, exact), 1).when(~F.exists(near, same) & (k == 3) & plain, 0)
        y = _let(near, y)
        f = F.struct(*[v.alias(name) for name, v in _features(m, x["b"], x["a"]).items()])
        return F.struct(k.alias("k"), s.alias("s"), e.alias("e"), y.alias("y"), f.alias("f"))

    def may_be(x: Column) -> Column:
        m = x["m"]
        k = kind(m)
        chain = F.regexp_like(x["b"], F.lit(r"[0-9]\.\z")) | F.regexp_like(x["a"], F.lit(r"\A\.[0-9]"))     # more than four dotted groups
        return F.when(k == 1, _valid("ip", m) & ~chain).when(k == 2, _valid("card", m)).otherwise(_valid("phone", m))

    def run(x: Column) -> Column:
        several = F.regexp_like(x["m"], F.lit("[0-9][^0-9]")) & (F.length(_digits(x["m"])) > 9)
        whole = F.filter(F.array(x), lambda w: F.length(_digits(w["m"])) <= 19)
        parts = F.when(several, F.filter(_inside(x), may_be)).otherwise(F.array().cast(_PLACED))
        return F.concat(F.transform(whole, lambda w: row(w, kind(w["m"]))), F.transform(parts, lambda w: row(w, kind(w["m"]), part=True)))

    return df.withColumn("_cand", F.concat(F.transform("_c0", lambda x: F.array(row(x, F.lit(0)))), F.transform("_c1", run))).drop(
        "_c0", "_c1", *[f"_k{k}" for k in range(len(KINDS))])


@dataclass
class Model:
    """Boosted trees as nested tuples (feature, threshold, left, right) or a leaf
    value, their weights, and each kind's log-odds threshold (a kind without one
    gets no added spans)."""
    trees: list = field(default_factory=list)
    weights: list = field(default_factory=list)
    cut: dict = field(default_factory=dict)

    def margin(self, f) -> Column:
        """``f(name)`` gives a feature's column."""
        def tree(t):
            if isinstance(t, float):
                return F.lit(t)
            i, cut, left, right = t
            return F.when(f(FEATURES[i]) <= cut, tree(left)).otherwise(tree(right))
        return reduce(lambda a, b: a + b, [w * tree(t) for t, w in zip(self.trees, self.weights)])


def _tree(node) -> float | tuple:
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild()))


def _boosted(rows: DataFrame, rounds: int, depth: int, seed: int) -> Model | None:
    """Trees over ``rows`` (features, y, n: how many candidates a row stands for); the classes
    weigh the same in sum. None if a class is missing."""
    count = {r.y: (r.n, r.rows) for r in rows.groupBy("y").agg(F.sum("n").alias("n"), F.count("*").alias("rows")).collect()}
    if set(count) != {0, 1}:
        return None
    total = sum(n for n, _ in count.values())
    weight = reduce(lambda rest, y: F.when(F.col("y") == y, F.col("n") * (total / (2.0 * count[y][0]))).otherwise(rest), (0, 1), F.lit(0.0))
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(rows.withColumn("_w", weight))
    # so many bins that thresholds are proposed from all rows (MLlib looks at bins squared of them)
    bins = max(32, math.isqrt(sum(k for _, k in count.values())) + 1)
    gbt = GBTClassifier(labelCol="y", featuresCol="x", weightCol="_w", maxIter=rounds, maxDepth=depth, maxBins=bins, seed=seed,
                        checkpointInterval=-1).fit(vec)
    return Model([_tree(t._java_obj.rootNode()) for t in gbt.trees], [float(w) for w in gbt.treeWeights])


def fit(cands: DataFrame, rounds: int = 10, depth: int = 3, precision: float = 0.98, seed: int = 7) -> Model:
    """Boosts ``depth``-deep trees on all candidates that the validators judge. Those with the
    same features are one row with their number as weight, so the rows are as many as
    there are forms of candidates. Thresholds: every candidate is scored by trees that have
    not seen it (two halves by hash), and per kind the lowest log-odds is taken at which
    the spans above (1 / (1 - precision) at least) reach ``precision``. No candidate of one class: no model, nothing is added."""
    one = cands.select(F.explode(F.flatten("_cand")).alias("c")).where("c.y is not null").select("c.y", "c.k", "c.s", "c.f")
    half = F.pmod(F.xxhash64("f", "s"), F.lit(2)).alias("half")
    rows = stage(one.select("y", "k", half, "f.*").groupBy("y", "k", "half", *FEATURES).agg(F.count("*").alias("n")), "pii-train")
    model = _boosted(rows, rounds, depth, seed)
    if model is None:
        unstage(rows)
        return Model()
    by_kind: dict[int, dict] = {}
    for h in (0, 1):
        other = _boosted(rows.where(F.col("half") != h), rounds, depth, seed) or model
        held = rows.where(F.col("half") == h).select("k", "y", "n", F.round(other.margin(F.col), 3).alias("m"))
        for r in held.groupBy("k", "m").agg(F.sum(F.col("y") * F.col("n")).alias("good"), F.sum("n").alias("n")).collect():
            seen = by_kind.setdefault(r.k, {})
            good, n = seen.get(r.m, (0, 0))
            seen[r.m] = (good + r.good, n + r.n)
    for k, seen in by_kind.items():
        good = n = 0
        for m, (g, c) in sorted(seen.items(), reverse=True):
            good, n = good + g, n + c
            if m > 0 and n * (1 - precision) >= 1 and good >= precision * n:      # fewer tell nothing of such a precision
                model.cut[k] = m
    unstage(rows)
    return model


def with_spans(df: DataFrame, model: Model) -> DataFrame:
    """Adds ``_added``: candidates over their kind's threshold that overlap no base
    span (an address proposal also wins over a number inside it), and of those that
    overlap in one run the best scored, then the longest; drops ``_cand``."""
    none = F.array().cast("array<struct<k:int,s:int,e:int>>")
    if not model.cut:
        return df.withColumn("_added", none).drop("_cand")
    def cut(c):
        out = F.lit(None).cast("double")
        for k, m in model.cut.items():
            out = F.when(c["k"] == k, F.lit(m)).otherwise(out)
        return out

    meets = lambda c: lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])
    df = _union(df, F.col("_base"), "_cover")
    scored = F.transform("_cand", lambda r: F.transform(r, lambda c: F.struct(
        (-F.round(model.margin(lambda n: c["f"][n]), 3)).alias("m"), (c["s"] - c["e"]).alias("n"), c["s"].alias("s"), c["e"].alias("e"), c["k"].alias("k"))))
    df = df.withColumn("_good", F.transform(scored, lambda r: F.filter(r, lambda c: (-c["m"] >= cut(c)) & ~_met(F.col("_cover"), c["s"], c["e"]))))
    df = df.withColumn("_good", F.filter("_good", lambda r: F.size(r) > 0))
    mail = F.filter(F.flatten("_good"), lambda c: c["k"] == 0)
    free = lambda c: (F.size("_mail") == 0) | (c["k"] == 0) | ~_met(F.col("_mail"), c["s"], c["e"])

    def pick(r: Column) -> Column:
        """Greedily by score (the order of the structs), a block of starts after another."""
        item = "struct<m:double,n:int,s:int,e:int,k:int>"
        by_start = F.array_sort(r, lambda a, b: a["s"] - b["s"])
        starts = F.sequence(F.lit(0), F.size(r) - 1, F.lit(_BLOCK))

        def best(acc: Column, block: Column) -> Column:
            ranked = F.array_sort(F.filter(block, lambda c: c["s"] >= acc["pos"]))
            kept = F.aggregate(ranked, F.array().cast(f"array<{item}>"),
                               lambda a, c: F.when(F.exists(a, meets(c)), a).otherwise(F.concat(a, F.array(c))))
            return _let(kept, lambda x: F.struct(F.coalesce(F.array_max(F.transform(x, lambda c: c["e"])), acc["pos"]).alias("pos"),
                                                 F.concat(acc["out"], x).alias("out")))
        blocks = _let(by_start, lambda a: F.transform(starts, lambda i: _cut(a, i, _BLOCK)))
        zero = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{item}>").alias("out"))
        return F.when(F.size(r) < 2, r).otherwise(F.aggregate(blocks, zero, best)["out"])

    df = df.withColumn("_mail", mail).withColumn("_good", F.transform("_good", lambda r: F.filter(r, free)))
    picked = F.flatten(F.transform("_good", pick))
    return df.withColumn("_added", F.transform(picked, lambda c: F.struct(c["k"].alias("k"), c["s"].alias("s"), c["e"].alias("e")))).drop(
        "_cand", "_good", "_mail", "_cover")


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **fit_options) -> DataFrame:
    """One row per input row: id, base counts per kind, ``base_sha256``, ``spans``
    (all spans as kind:start:end, by kind, then start, then end) and ``n_added``.

    NULL text counts as empty; NULL and repeated ids pass through; other columns
    are ignored; an empty table gives an empty result."""
    src = docs.select(col(id_col).alias("_id"), F.coalesce(col(text_col), F.lit("")).alias("_text"))
    rows = stage(with_candidates(with_base(src, "_text"), "_text").drop("_text"), "pii")
    model = fit(rows.where(F.size("_cand") > 0), **fit_options)
    out = with_spans(rows, model)
    is_kind = lambda k: lambda x: x["k"] == k
    counts = [F.size(F.filter("_base", is_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return out.select(F.col("_id").alias(id_col), *counts, F.sha2(_joined(F.col("_base")), 256).alias("base_sha256"),
                      _joined(F.array_sort(F.concat("_base", "_added"))).alias("spans"), F.size("_added").cast("long").alias("n_added"))


def redact(docs: DataFrame, text_col: str = "text", n_chars_col: str | None = "n_chars", **fit_options) -> DataFrame:
    """``docs`` with each span replaced by its kind in angle brackets (of spans that
    overlap, what lies beyond the earlier one goes too, without a second name), and
    ``n_chars_col``, if it is there, set to the new length. NULL text stays NULL."""
    cols = docs.columns
    src = docs.select(packed(docs), F.coalesce(col(text_col), F.lit("")).alias("_text"))
    rows = stage(with_candidates(with_base(src, "_text"), "_text").drop("_text"), "pii")
    df = with_spans(rows, fit(rows.where(F.size("_cand") > 0), **fit_options))
    old = F.col("row").getField(text_col)
    df = df.withColumn("_text", F.coalesce(old, F.lit("")))
    by_start = lambda a, b: (F.when(a["s"] != b["s"], a["s"] - b["s"]).when(a["e"] != b["e"], b["e"] - a["e"]).otherwise(a["k"] - b["k"]))
    df = df.withColumn("_all", F.array_sort(F.concat("_base", "_added"), by_start))
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def step(pos: Column, x: Column):
        cut = F.struct(pos.alias("s"), x["s"].alias("e"), x["k"].alias("k"))
        return F.greatest(pos, x["e"]), F.when(x["s"] >= pos, F.array(cut)).otherwise(F.array().cast(f"array<{_SPAN}>"))

    def cut_out(cuts: Column) -> Column:
        """The texts of one block's cuts; the block's own text is taken once."""
        lo = F.get(cuts, F.lit(0))["s"]
        own = F.substr("_text", lo + 1, F.element_at(cuts, -1)["e"] - lo)
        return _let(own, lambda t: F.array_join(F.transform(cuts, lambda c: F.concat(
            F.substr(t, c["s"] - lo + 1, c["e"] - c["s"]), F.get(names, c["k"]))), ""))

    df = df.withColumn("_walked", _walk(_blocks("_all"), _SPAN, step))
    parts = F.transform(F.filter(F.transform("_walked", lambda w: w["out"]), lambda o: F.size(o) > 0), cut_out)
    end = F.try_element_at("_walked", F.lit(-1))["pos"]
    new = F.concat(F.array_join(parts, ""), F.substr("_text", end + 1, F.length("_text")))
    hit = F.size("_all") > 0
    df = df.withColumn("_new", F.when(hit, new).otherwise(old))
    out = {c: F.col("row").getField(c) for c in cols} | {text_col: F.col("_new")}
    if n_chars_col in cols:
        out[n_chars_col] = F.when(hit, F.length("_new").cast(dict(docs.dtypes)[n_chars_col])).otherwise(out[n_chars_col])
    return df.select(*[out[c].alias(c) for c in cols])
