"""Numbers that stand side by side: every item of a run is proposed and redacted."""

import random

from test_pii import luhn

from tidemark.llm import pii


def card(rng):
    d = "".join(str(rng.randint(1, 9)) for _ in range(15))
    return next(d + str(c) for c in range(10) if luhn(d + str(c)))


def phone(rng):
    return f"+{rng.randint(1, 99)} ({rng.randint(100, 999)}) {rng.randint(100, 999)}-{rng.randint(1000, 9999)}"


def texts():
    rng = random.Random(5)
    rows = []
    for i in range(600):
        bad = f"{rng.randint(1, 9)}.{rng.randint(0, 9)} and {rng.randint(100, 99999)} or {rng.randint(10**15, 10**16 - 1)}"
        rows.append((i, f"please call {phone(rng)} about version {bad} of it, paid with {card(rng)} today"))
    return rows


def test_neighbours_are_found(spark):
    runs = {1000: ("7536784127813050 4845168114407329 end", "<CARD> <CARD> end"),
            1001: ("from +1 (826) 555-4081 190.137.223.204 there", "from <PHONE> <IP> there")}
    df = spark.createDataFrame(texts() + [(i, a) for i, (a, _) in runs.items()], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(df).where("doc_id >= 1000").collect()}
    assert got == {i: b for i, (_, b) in runs.items()}


def test_parts_are_placed_and_linear(spark):
    rows = [(0, "é 7536784127813050 4845168114407329 x"), (1, "+" + "1 " * 3000), (2, "12 " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, _text string")
    got = {r.doc_id: [(c.k, c.s, c.e) for c in r.c] for r in pii.with_candidates(pii.with_base(df, "_text"), "_text")
           .selectExpr("doc_id", "flatten(_cand) c").collect()}
    assert got[0] == [(2, 2, 18), (2, 19, 35)]
    assert 0 < len(got[1]) <= 19 * 3000 and 0 < len(got[2]) <= 19 * 3000 and (3, 0, 18) in got[1]
    assert all(len("".join(x for x in rows[2][1][s:e] if x.isdigit())) in range(9, 20) for _, s, e in got[2])
