"""Mixing by systematic sampling against a whole-number brute force."""

import hashlib
import random
import re
from fractions import Fraction

import pytest

from tidemark.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, weights=(5, 2, 1), most=3, seed=12):
    """{place of the row: (size, source size, target, copies)}; rows are (doc_id, text, source)."""
    size = [len(WORD.findall(t or "")) for _, t, _ in rows]
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    have = {n: sum(z for z, r in zip(size, rows) if r[2] == n) for n in names}
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    capped = set()
    while True:
        rest = sum(size) - sum(most * have[n] for n in capped)
        free = sum(weight[n] for n in names if n not in capped)
        over = {n for n in names if n not in capped and Fraction(rest * weight[n], free) >= most * have[n]}
        if not over:
            break
        capped |= over
    out = {}
    for n in names:
        target = Fraction(most * have[n]) if n in capped else Fraction(rest * weight[n], free)
        rate = target / have[n] if have[n] else Fraction(0)
        u = Fraction(int(hashlib.md5(f"{seed}:{'' if n is None else '=' + n}".encode()).hexdigest()[:6], 16), 1 << 24)
        tie = lambda i: hashlib.md5(f"{seed}:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest()
        mine = sorted((i for i, r in enumerate(rows) if r[2] == n), key=lambda i: (size[i], tie(i)))
        for k, i in enumerate(mine):
            copies = (u + rate * (k + 1)) // 1 - (u + rate * k) // 1
            out[i] = (size[i], have[n], float(target), copies)
    return out


def rows_of(n, seed):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        source = r.choices([None, "", "a", "B", "é", "\U0001f600", "z"], [1, 1, 30, 3, 3, 2, 1])[0]
        text = r.choices([None, "", " \n\t\x0b", "w " * r.randint(1, 40), "x y z " * r.randint(1, 5)], [1, 1, 1, 30, 5])[0]
        rows.append((r.choice([i, i, i, 7, None]), text, source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = rows_of(400, seed)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = sorted(map(tuple, mixing.plan(df).select("size", "source_size", "target", "copies", "taken", "doc_id").collect()), key=repr)
    want = sorted(((z, s, t, c, c * z, rows[i][0]) for i, (z, s, t, c) in brute(rows).items()), key=repr)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], rel=1e-12)


def test_targets_are_met_and_reruns_agree(spark):
    rows = rows_of(3000, 3)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.plan(df.repartition(3)).toPandas()
    again = mixing.plan(df.repartition(11)).toPandas()
    cols = ["doc_id", "size", "source_size", "target", "taken", "copies"]
    assert out[cols].sort_values(cols).reset_index(drop=True).equals(again[cols].sort_values(cols).reset_index(drop=True))
    assert (out.taken <= 3 * out["size"]).all()
    per = out.groupby(["source_size", "target"]).agg(taken=("taken", "sum"), top=("size", "max")).reset_index()
    assert ((per.taken - per.target).abs() <= per.top).all()
    assert per.target.sum() == pytest.approx(out["size"].sum())


def test_mixed_rows_repeat_whole_rows(spark):
    rows = [(i, "w " * 10, "a" if i else "b", i, "p") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies long, part string")
    got = mixing.mix(df).groupBy(*df.columns).count().collect()
    want = {i: c for i, (_, _, _, c) in brute([r[:3] for r in rows]).items() if c}
    assert {g["doc_id"]: g["count"] for g in got} == want
    assert all(g["copies"] == g["doc_id"] and g["part"] == "p" for g in got)


def test_empty_and_wordless_tables(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.plan(spark.createDataFrame([], schema)).count() == 0
    got = mixing.plan(spark.createDataFrame([(1, None, None), (2, " ", "a")], schema)).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
