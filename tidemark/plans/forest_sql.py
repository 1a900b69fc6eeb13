"""Check SQL of the isolation forest: all rows of a group sink through each tree
together, one level per CTE; windows over (group, tree, node) take the extremes of the
sampled rows."""

from __future__ import annotations

from collections.abc import Sequence

from tidemark.operators.forest import MAX_SAMPLES, POOL_ROWS, PRIME, UNIT, leaf_units


def _mix(a: str, b: str) -> str:
    x = f"(({a} + {b} * 1000003) % {PRIME})"
    y = f"(({x} * {x} + 12345) % {PRIME} * 48271 % {PRIME})"
    return f"(({y} * {y} + {y} + 1) % {PRIME})"


def _draw(text: str) -> str:
    return f"(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % {PRIME})"


def forest_sql(src: str, cols: Sequence[str], key: str, group: str | None = None, min_rows: int = 1,
               contamination: float = 0.03, seed: int = 42, trees: int = 100, p: str = "fo") -> str:
    """CTEs (after a comma) ending in ``{p}(k, g, flagged)``. ``key`` is SQL text that
    tells a group's rows apart; ``group`` a timestamp column."""
    d = len(cols)
    g = group or "0"
    gt = f"CAST(epoch_us({group}) AS VARCHAR)" if group else "''"
    xs = ", ".join(f"coalesce(CAST({c} AS DOUBLE), quantile_cont({c}, 0.5) OVER (PARTITION BY {g})) AS x{i}" for i, c in enumerate(cols))
    depth = " + ".join(f"CAST(least({MAX_SAMPLES}, n) > {1 << k} AS INTEGER)" for k in range(MAX_SAMPLES.bit_length()))
    units = "[" + ", ".join(map(str, leaf_units())) + "]"
    x = ", ".join(f"x{i}" for i in range(d))
    out = f"""
, {p}_a AS (SELECT {key} AS k, {g} AS g, {gt} AS gt, {xs} FROM {src}),
{p}_b AS (SELECT *, {_draw(f"'{seed}|' || k")} AS rd, {_draw(f"'{seed}|' || gt")} AS gd, count(*) OVER (PARTITION BY g) AS n FROM {p}_a),
{p}_c AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY rd, k) > {POOL_ROWS} AS out FROM {p}_b WHERE n >= {max(1, min_rows)}),
{p}_d AS (SELECT k, g, {x}, {depth} AS depth, t, {_mix('gd', 't')} AS td,
  n <= {MAX_SAMPLES} OR row_number() OVER (PARTITION BY g, t ORDER BY out, {_mix('rd', 't')}, rd, k) <= {MAX_SAMPLES} AS ins
  FROM {p}_c, (SELECT unnest(range({trees})) AS t)),
{p}_l0 AS (SELECT *, CAST(1 AS BIGINT) AS node, CAST(NULL AS BIGINT) AS leaf FROM {p}_d)"""
    top = MAX_SAMPLES.bit_length() - 1
    for lv in range(top + 1):
        lo = ", ".join(f"min(x{i}) FILTER (ins) OVER w AS lo{i}, max(x{i}) FILTER (ins) OVER w AS hi{i}" for i in range(d))
        usable = f"list_filter([{', '.join(f'CASE WHEN hi{i} > lo{i} THEN {i} END' for i in range(d))}], lambda i: i IS NOT NULL)"
        pick = lambda what: "CASE f " + " ".join(f"WHEN {i} THEN {what}{i}" for i in range(d)) + " END"  # noqa: E731, B023
        out += f""",
{p}_s{lv} AS (SELECT *, {usable} AS can, {_mix('td', 'node')} AS r FROM
  (SELECT *, count(*) FILTER (ins) OVER w AS c, {lo} FROM {p}_l{lv} WINDOW w AS (PARTITION BY g, t, node))),
{p}_u{lv} AS (SELECT *, CASE WHEN leaf IS NOT NULL THEN leaf WHEN c <= 1 OR {lv} >= depth OR len(can) = 0
  THEN {lv} * {UNIT} + {units}[c + 1] END AS done, can[1 + r % greatest(len(can), 1)] AS f, ({_mix('r', '1')} + 0.5::DOUBLE) / {PRIME}::DOUBLE AS u FROM {p}_s{lv}),
{p}_l{lv + 1} AS (SELECT k, g, {x}, depth, t, td, ins, done AS leaf, CASE WHEN done IS NULL THEN 2 * node +
  CASE WHEN coalesce({pick('x')} < {pick('lo')} + ({pick('hi')} - {pick('lo')}) * u, false) THEN 0 ELSE 1 END ELSE node END AS node FROM {p}_u{lv})"""
    return out + f""",
{p}_p AS (SELECT k, g, CAST(sum(leaf) AS BIGINT) AS path FROM {p}_l{top + 1} GROUP BY k, g),
{p} AS (SELECT k, g, path < quantile_cont(path, {contamination}) OVER (PARTITION BY g) AS flagged FROM {p}_p)
"""
