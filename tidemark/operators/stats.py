"""Descriptive statistics as single aggregate passes.

Each statistic is a partial aggregate (map-side combine), so a table of any
size reduces to one small row per column before anything is shuffled.
Whole-column quantiles are exact without gathering the column
(``exact_quantiles``: sketch bracket, count, sort only the bracket); grouped
quantiles use ``percentile`` per group (linear interpolation, as pandas and
DuckDB's ``quantile_cont``). ``accuracy`` switches either to
``percentile_approx``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import pandas_kurt, pandas_skew

# The column sets the reference's notebook and dashboard use.
DESCRIBE_COLUMNS = ["price", "market_cap", "volume_24h", "percent_change_24h"]
SKEW_COLUMNS = ["price", "market_cap", "volume_24h"]
CORR_COLUMNS = ["price", "market_cap", "volume_24h", "percent_change_24h", "circulating_supply"]


def quantiles(c: str, probs: Sequence[float], accuracy: int | None = None) -> Column:
    """Array of quantiles of ``c`` (exact by default)."""
    arr = F.array(*[F.lit(float(p)) for p in probs])
    if accuracy is None:
        return F.percentile(F.col(c), arr)
    return F.percentile_approx(F.col(c), arr, accuracy)


def median(c: str, accuracy: int | None = None) -> Column:
    if accuracy is None:
        return F.percentile(F.col(c), F.lit(0.5))
    return F.percentile_approx(F.col(c), F.lit(0.5), accuracy)


def _long(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One aggregate row of per-column structs → one output row per column."""
    return df.agg(F.array(*structs).alias("_s")).select(F.inline("_s"))


def describe(df: DataFrame, cols: Sequence[str] = DESCRIBE_COLUMNS,
             accuracy: int | None = None) -> DataFrame:
    """count, mean, std (n-1), min, q25, q50, q75, max per column, nulls skipped."""
    structs = []
    qt = quantile_table(df, {c: (0.25, 0.5, 0.75) for c in cols}, accuracy)
    for c in cols:
        q = [qt[(c, p)] for p in (0.25, 0.5, 0.75)]
        structs.append(F.struct(
            F.lit(c).alias("column_name"), F.count(c).alias("count"), F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"), F.min(c).cast("double").alias("min"),
            q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), F.max(c).cast("double").alias("max")))
    return _long(df, structs)


def skew_kurtosis(df: DataFrame, cols: Sequence[str] = SKEW_COLUMNS) -> DataFrame:
    """pandas' bias-corrected skew and excess kurtosis per column.

    Spark's ``skewness``/``kurtosis`` are the population moments g1, g2; the
    sample versions are G1 = g1 sqrt(n(n-1))/(n-2) and
    G2 = (n-1)/((n-2)(n-3)) ((n+1) g2 + 6)."""
    structs = []
    for c in cols:
        n = F.count(c).cast("double")
        structs.append(F.struct(F.lit(c).alias("column_name"),
                                pandas_skew(F.skewness(c), n).alias("skew"),
                                pandas_kurt(F.kurtosis(c), n).alias("kurt")))
    return _long(df, structs)


def _corr(a: str, b: str) -> Column:
    """``corr`` that is NULL, not an error, where a side has no variance."""
    spread = [F.stddev_pop(F.when(F.col(y).isNotNull(), F.col(x))) for x, y in ((a, b), (b, a))]
    return F.try_divide(F.covar_pop(a, b), spread[0] * spread[1])


def correlation_matrix(df: DataFrame, cols: Sequence[str] = CORR_COLUMNS) -> DataFrame:
    """Pearson correlation of every ordered pair, pairwise complete.

    Rows where either side is NULL are skipped and a constant side gives NULL, like
    pandas ``.corr()``.
    Long form ``(col_a, col_b, corr)``; one aggregate pass for all pairs."""
    structs = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), _corr(a, b).alias("corr"))
               for a in cols for b in cols]
    return _long(df, structs)


def median_and_quartiles(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """q1, median, q3 per column (D14), long form."""
    structs = []
    qt = quantile_table(df, {c: (0.25, 0.5, 0.75) for c in cols}, accuracy)
    for c in cols:
        q = [qt[(c, p)] for p in (0.25, 0.5, 0.75)]
        structs.append(F.struct(F.lit(c).alias("column_name"), q[0].alias("q1"),
                                q[1].alias("median"), q[2].alias("q3")))
    return _long(df, structs)


def missing_report(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: null count and percent of rows (2 decimals, half-even), most first.

    NaN counts as missing, as in pandas."""
    cols = list(cols or df.columns)
    structs = []
    total = F.count(F.lit(1))
    for c in cols:
        isnull = F.col(c).isNull()
        dtype = dict(df.dtypes)[c]
        if dtype in ("double", "float"):
            isnull = isnull | F.isnan(F.col(c))
        n_missing = F.count_if(isnull)
        structs.append(F.struct(F.lit(c).alias("column_name"), n_missing.alias("missing_count"),
                                F.bround(F.try_divide(n_missing * 100.0, total), 2).alias("missing_pct")))
    return _long(df, structs).orderBy(F.desc("missing_count"), "column_name")


SMALL_EXACT = 200_000      # values that one ``percentile`` buffer may hold


FINISH_ROWS = 2_000        # rows inside a bracket that one task may sort
SKETCH = 10_000


def _select(df: DataFrame, val: dict[str, Column], ranks: dict[str, Sequence[int]], n: dict[str, int],
            finish: int = FINISH_ROWS) -> dict[tuple[str, int], float]:
    """Exact values at 0-based ranks of several columns at once (``n``: their value counts).

    Each target keeps an open bracket (lo, hi) around its rank. A round is two passes over
    ``df`` for all targets together: a sketch inside every bracket proposes three splitters
    around the rank, and the rows below and up to each splitter are counted. A rank among a
    splitter's copies is answered; otherwise the bracket moves between splitters, which leaves
    their copies out, so repeated values shrink it too. A bracket of up to ``finish`` rows is
    sorted by one aggregate. Only counts and single values reach the driver."""
    state = {(c, k): [None, None, 0, n[c]] for c in ranks for k in set(ranks[c])}     # lo, hi, rows below, rows inside
    found: dict[tuple[str, int], float] = {}
    while state:
        keys = sorted(state)
        inside = {}
        for c, k in keys:
            lo, hi = state[c, k][:2]
            v = val[c]
            ok = v.isNotNull() & ~F.isnan(v)
            if lo is not None:
                ok = ok & (v > F.lit(lo))
            if hi is not None:
                ok = ok & (v < F.lit(hi))
            inside[c, k] = F.when(ok, v)
        small = [t for t in keys if state[t][3] <= finish]
        large = [t for t in keys if state[t][3] > finish]
        aggs = [F.element_at(F.array_sort(F.collect_list(inside[t])), t[1] - state[t][2] + 1).alias(f"v{i}") for i, t in enumerate(small)]
        eps = 4.0 / SKETCH
        for i, t in enumerate(large):
            at = (t[1] - state[t][2] + 0.5) / state[t][3]
            ps = [max(0.0, at - eps), at, min(1.0, at + eps)]
            aggs.append(F.percentile_approx(inside[t], F.array(*[F.lit(p) for p in ps]), SKETCH).alias(f"s{i}"))
        row = df.agg(*aggs).head()
        for i, t in enumerate(small):
            found[t] = float(row[f"v{i}"])
            del state[t]
        if not large:
            continue
        cuts = {t: sorted(set(row[f"s{i}"])) for i, t in enumerate(large)}
        counts = df.agg(*[x for i, t in enumerate(large) for j, v in enumerate(cuts[t]) for x in (
            F.count_if(inside[t] < F.lit(v)).alias(f"a{i}_{j}"), F.count_if(inside[t] <= F.lit(v)).alias(f"b{i}_{j}"))]).head()
        for i, t in enumerate(large):
            lo, hi, below, size = state[t]
            left, last = below, below + size      # rows before and up to the new bracket
            for j, v in enumerate(cuts[t]):
                under, upto = below + counts[f"a{i}_{j}"], below + counts[f"b{i}_{j}"]
                if under <= t[1] < upto:
                    found[t] = float(v)
                    del state[t]
                    break
                if upto <= t[1]:
                    lo, left = v, upto
                else:
                    hi, last = v, under
                    break
            if t in state:
                state[t] = [lo, hi, left, last - left]
    return found


def quantile_table(df: DataFrame, spec: dict[str, Sequence[float]], accuracy: int | None = None,
                   small: int = SMALL_EXACT) -> dict[tuple[str, float], Column]:
    """Whole-column quantiles for several columns at once, as literal Columns.

    Exact by default without gathering a big column: columns with at most
    ``small`` values take ``percentile`` in one shared pass; the larger ones' order statistics
    are selected together (``_select``) and interpolated exactly as ``percentile`` does.
    With ``accuracy`` the quantiles are ``percentile_approx`` (lazy)."""
    cols = list(spec)
    if not cols:
        return {}
    val = {c: F.col(c).cast("double") for c in cols}
    ok = {c: val[c].isNotNull() & ~F.isnan(val[c]) for c in cols}
    if accuracy is not None:
        out = {}
        for c in cols:
            q = df.agg(F.percentile_approx(F.when(ok[c], val[c]), F.array(*[F.lit(float(p)) for p in spec[c]]),
                                           accuracy).alias("q"))
            for i, p in enumerate(spec[c]):
                out[(c, p)] = q.select(F.col("q")[i]).scalar()
        return out
    first = df.agg(*[F.count(F.when(ok[c], F.lit(1))).alias(f"n_{k}") for k, c in enumerate(cols)]).head()
    out: dict[tuple[str, float], Column] = {}
    small_cols = [k for k, c in enumerate(cols) if first[f"n_{k}"] <= small]
    if small_cols:
        exact = df.agg(*[F.percentile(F.when(ok[cols[k]], val[cols[k]]),
                                      F.array(*[F.lit(float(p)) for p in spec[cols[k]]])).alias(f"q_{k}")
                         for k in small_cols]).head()
        for k in small_cols:
            for i, p in enumerate(spec[cols[k]]):
                v = exact[f"q_{k}"][i] if exact[f"q_{k}"] is not None else None
                out[(cols[k], p)] = F.lit(v).cast("double")
    big = [k for k in range(len(cols)) if k not in small_cols]
    if big:
        n = {cols[k]: first[f"n_{k}"] for k in big}
        pos = {(c, p): p * (n[c] - 1) for c in n for p in spec[c]}
        ranks = {c: [r for p in spec[c] for r in (math.floor(pos[c, p]), math.ceil(pos[c, p]))] for c in n}
        at = _select(df, val, ranks, n, min(small, FINISH_ROWS))
        for c, p in pos:
            k_lo, k_hi = math.floor(pos[c, p]), math.ceil(pos[c, p])
            a, z = at[c, k_lo], at[c, k_hi]
            v = a if k_lo == k_hi or a == z else (k_hi - pos[c, p]) * a + (pos[c, p] - k_lo) * z
            out[(c, p)] = F.lit(v).cast("double")
    return out


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float], small: int = SMALL_EXACT) -> list:
    """Exact whole-column quantiles as Python floats (see ``quantile_table``)."""
    table = quantile_table(df, {column: list(probs)}, small=small)
    row = df.sparkSession.range(1).select(*[table[(column, p)].alias(f"q{i}") for i, p in enumerate(probs)]).head()
    return [row[f"q{i}"] for i in range(len(probs))]


def global_quantiles(df: DataFrame, column: str, probs: Sequence[float],
                     accuracy: int | None = None) -> list[Column]:
    """Whole-column quantiles of one column as literal Columns."""
    t = quantile_table(df, {column: list(probs)}, accuracy)
    return [t[(column, p)] for p in probs]


def grouped_quantiles(df: DataFrame, group: str, spec: dict[str, Sequence[float]],
                      sketch: int = 100_000, small: int = 100_000, prefix: str = "_q",
                      check_sizes: bool = True) -> DataFrame:
    """Exact per-group quantiles without gathering a big group: one row per
    group with ``{prefix}_{column}_{i}`` for the i-th probability of each column.

    Lazy, two aggregates and a join. (1) Per group: the value count and a
    ``percentile_approx`` sketch bracket around each target rank. (2) Groups
    of at most ``small`` values take ``percentile`` (its buffer holds at most
    ``small`` values); larger groups count the values under each bracket and,
    per distinct value, those inside it (so repeated values take one entry), in
    partial aggregates that reduce a hot group map-side. The bracket is widened
    by the sketch error (n/sketch ranks) plus 2/small, which covers the two
    ranks between the sketch's rank convention and interpolation positions
    for any group above ``small``. Order statistics are interpolated as
    ``percentile`` does, so results equal it."""
    eps = 2.0 / sketch + 2.0 / small
    cols = list(spec)
    val = {c: F.col(c).cast("double") for c in cols}
    ok = {c: val[c].isNotNull() & ~F.isnan(val[c]) for c in cols}
    if check_sizes:
        # sizes first (a count per group): when no group is large, one plain
        # percentile aggregate is exact and holds at most ``small`` values per group
        largest = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).head()[0] or 0
        if largest <= small:
            plain = df.groupBy(group).agg(*[
                F.percentile(F.when(ok[c], val[c]), F.array(*[F.lit(float(p)) for p in spec[c]])).alias(f"_gp{k}")
                for k, c in enumerate(cols)])
            return plain.select(group, *[F.col(f"_gp{k}")[i].cast("double").alias(f"{prefix}_{c}_{i}")
                                         for k, c in enumerate(cols) for i in range(len(spec[c]))])
    aggs = []
    for k, c in enumerate(cols):
        ps = list(spec[c])
        aggs.append(F.count(F.when(ok[c], F.lit(1))).alias(f"_gn{k}"))
        aggs.append(F.percentile_approx(F.when(ok[c], val[c]),
                                        F.array(*[F.lit(max(0.0, p - eps)) for p in ps],
                                                *[F.lit(min(1.0, p + eps)) for p in ps]), sketch)
                    .alias(f"_gb{k}"))
    brackets = df.groupBy(group).agg(*aggs)
    x = df.select(group, *[F.when(ok[c], val[c]).alias(f"_gv{k}") for k, c in enumerate(cols)]).join(brackets, group)
    aggs2, outs, inside = [], [], []
    for k, c in enumerate(cols):
        ps = list(spec[c])
        m = len(ps)
        v = F.col(f"_gv{k}")
        big = F.col(f"_gn{k}") > small
        aggs2.append(F.percentile(F.when(~big, v), F.array(*[F.lit(float(p)) for p in ps])).alias(f"_gp{k}"))
        for i in range(m):
            lo, hi = F.col(f"_gb{k}")[i], F.col(f"_gb{k}")[m + i]
            aggs2.append(F.count_if(big & (v < lo)).alias(f"_gbel{k}_{i}"))
            inside.append(F.when(big & (v >= lo) & (v <= hi), F.struct(F.lit(f"{k}_{i}").alias("j"), v.alias("v"))))
        aggs2.append(F.first(f"_gn{k}").alias(f"_gn{k}"))
    names = [f"{k}_{i}" for k, c in enumerate(cols) for i in range(len(spec[c]))]
    counted = (x.select(group, F.explode(F.array(*inside)).alias("_e")).filter(F.col("_e").isNotNull())
               .groupBy(group, "_e").agg(F.count(F.lit(1)).alias("_c")))
    counted = counted.groupBy(group).agg(*[
        F.sort_array(F.collect_list(F.when(F.col("_e.j") == j, F.struct("_e.v", F.col("_c").alias("c"))))).alias(f"_gc{j}") for j in names])
    per = x.groupBy(group).agg(*aggs2).join(counted, group, "left")

    def at(cand, rank):
        """Value at the 0-based rank among counted values; NULL beyond them."""
        zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("double").alias("v"))
        return F.aggregate(cand, zero, lambda a, e: F.struct(
            (a["n"] + e["c"]).alias("n"), F.when(a["v"].isNull() & (a["n"] + e["c"] > rank), e["v"]).otherwise(a["v"]).alias("v")))["v"]
    for k, c in enumerate(cols):
        ps = list(spec[c])
        n = F.col(f"_gn{k}").cast("double")
        for i, p in enumerate(ps):
            pos = F.lit(float(p)) * (n - 1)
            k_lo, k_hi = F.floor(pos), F.ceil(pos)
            b = F.col(f"_gbel{k}_{i}")
            cand = F.col(f"_gc{k}_{i}")
            a = F.when(k_lo >= b, at(cand, k_lo - b))
            z = F.when(k_hi >= b, at(cand, k_hi - b))
            bracketed = F.when((k_lo == k_hi) | (a == z), a).otherwise((k_hi - pos) * a + (pos - k_lo) * z)
            q = (F.when(n == 0, F.lit(None)).when(n <= small, F.col(f"_gp{k}")[i]).otherwise(bracketed))
            outs.append(q.cast("double").alias(f"{prefix}_{c}_{i}"))
    return per.select(group, *outs)
