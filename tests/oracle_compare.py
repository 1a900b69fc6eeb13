"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Comparison: same column names, same row count, same multiset of rows after
sorting columns by name (order-insensitive), values compared exactly. Types
are compared as families (integer width, double, text, date, timestamp,
boolean) and reported.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.fixtures import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~nan",)
        return ("f", repr(v + 0.0))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("f", repr(float(v))) if abs(v) < 2**53 else ("i", v)
    if hasattr(v, "isoformat"):
        return ("t", v.isoformat())
    if isinstance(v, (list, tuple)):
        return ("l", tuple(_norm(x) for x in v))
    if isinstance(v, dict):
        return ("d", tuple(sorted((k, _norm(x)) for k, x in v.items())))
    return ("s", str(v))


def spark_rows(df):
    cols = sorted(df.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    return cols, rows, {f.name: f.dataType.simpleString() for f in df.schema.fields}


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    types = {n: str(t) for n, t in zip(names, rel.types)}
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    rows = [tuple(_norm(r[i]) for i in idx) for r in data]
    return cols, rows, types


_FAMILY = {"int": "int32", "integer": "int32", "bigint": "int64", "smallint": "int16", "tinyint": "int8",
           "double": "double", "float": "float", "string": "text", "varchar": "text",
           "date": "date", "timestamp_ntz": "timestamp", "timestamp": "timestamp", "boolean": "bool"}


def family(t: str) -> str:
    t = t.lower()
    if t.startswith("varchar"):
        return "text"
    if t.startswith("decimal"):
        return "decimal"
    if t.startswith("array") or t.endswith("[]"):
        return "list"
    if t.startswith("struct"):
        return "struct"
    return _FAMILY.get(t, t)


def compare(spark, sf_dir: str, names=None, verbose=True):
    from tidemark.plans.registry import ORACLES, QUERIES, load_all
    load_all()
    con = duck(sf_dir)
    results = {}
    for name in (names or sorted(QUERIES)):
        t0 = time.time()
        rec = {"oracle": name in ORACLES}
        try:
            sc, sr, st = spark_rows(QUERIES[name](spark, sf_dir))
            rec["rows"] = len(sr)
            if name in ORACLES:
                dc, dr, dt = duck_rows(con, ORACLES[name])
                rec["oracle_rows"] = len(dr)
                rec["cols_match"] = sc == dc
                rec["types_match"] = rec["cols_match"] and all(family(st[c]) == family(dt[c]) for c in sc)
                if not rec["types_match"] and rec["cols_match"]:
                    rec["types"] = {c: (st[c], dt[c]) for c in sc if family(st[c]) != family(dt[c])}
                if not rec["cols_match"]:
                    rec["cols"] = (sc, dc)
                ss, ds = sorted(sr), sorted(dr)
                rec["values_match"] = rec["cols_match"] and ss == ds
                if rec["cols_match"] and not rec["values_match"]:
                    only_s = [r for r in ss if r not in set(ds)][:3]
                    only_d = [r for r in ds if r not in set(ss)][:3]
                    rec["diff"] = {"spark_only": only_s, "oracle_only": only_d}
        except Exception as e:  # report and continue
            rec["error"] = f"{type(e).__name__}: {str(e)[:400]}"
        rec["sec"] = round(time.time() - t0, 2)
        ok = "error" not in rec and (not rec["oracle"] or (rec.get("values_match") and rec.get("types_match")))
        rec["ok"] = bool(ok)
        results[name] = rec
        if verbose:
            print(("OK  " if ok else "FAIL"), name, {k: v for k, v in rec.items() if k not in ("ok",)}, flush=True)
    return results


if __name__ == "__main__":
    from tidemark.session import get_spark
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or None
    spark = get_spark("local[8]", shuffle_partitions=8)
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if not v["ok"]]
    print(f"{len(res) - len(bad)}/{len(res)} ok; failing: {bad}")
