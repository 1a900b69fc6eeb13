"""Column expressions shared by the operators (all JVM-side, codegen-friendly).

Null policy: a pandas NaN is a Spark NULL. Ratios go through ``try_divide`` so
ANSI mode never raises, and a zero base gives NULL instead of +-inf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (never raises under ANSI)."""
    return F.try_divide(col(a), col(b))


def pct_change(cur, prev) -> Column:
    """cur / prev - 1; NULL for a zero or NULL base."""
    return safe_div(cur, prev) - F.lit(1.0)


def ratio_exceeds(cur, prev, threshold: float) -> Column:
    """``cur / prev - 1 > threshold`` with the reference's float rules:
    a zero base and a positive value is +inf, which exceeds any threshold;
    0/0 is NaN, which exceeds nothing. NULLs compare false."""
    r = pct_change(cur, prev) > F.lit(threshold)
    inf_case = (col(prev) == 0) & (col(cur) > 0)
    return F.coalesce(r | inf_case, F.lit(False))


def ratio_below(cur, prev, threshold: float) -> Column:
    """``cur / prev - 1 < threshold``; a zero base with a negative value is -inf."""
    r = pct_change(cur, prev) < F.lit(threshold)
    ninf_case = (col(prev) == 0) & (col(cur) < 0)
    return F.coalesce(r | ninf_case, F.lit(False))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast(T.DoubleType())).otherwise(c)


def inf_to_null(c) -> Column:
    c = col(c)
    return F.when(c.isin(float("inf"), float("-inf")), F.lit(None).cast(T.DoubleType())).otherwise(c)


def fix6(c) -> Column:
    """Cut a double to 6 decimals away from rounding ties.

    ``floor(x * 1e6 + 0.37) / 1e6``: both engines evaluate the same IEEE
    operations, so results are bit-equal even where half-way ties would make
    ``round`` differ between engines. Used only in check projections.
    """
    return F.floor(col(c) * F.lit(1e6) + F.lit(0.37)) / F.lit(1e6)


def fix6_sql(expr: str) -> str:
    return f"floor(({expr}) * 1e6 + 0.37) / 1e6"


def pandas_skew(g1: Column, n: Column) -> Column:
    """Bias-corrected skewness (pandas/DuckDB) from Spark's population g1."""
    return F.when(n > 2, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def pandas_kurt(g2: Column, n: Column) -> Column:
    """Bias-corrected excess kurtosis (pandas/DuckDB) from Spark's population g2."""
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def to_ntz(df: DataFrame) -> DataFrame:
    """Emit timestamps as timestamp_ntz (naive UTC), the oracle's type."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            out.append(F.col(f.name).cast(T.TimestampNTZType()).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def tz_aware(df: DataFrame, *cols: str) -> DataFrame:
    """timestamp_ntz inputs → session-zone timestamps (UTC), like pandas ``utc=True``."""
    return df.withColumns({c: F.col(c).cast(T.TimestampType()) for c in cols if c in df.columns})
