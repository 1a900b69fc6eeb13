"""Every registered query with an oracle equals its DuckDB SQL (sf0.001);
queries without one run and keep a stable schema."""

import pytest

from oracle_compare import compare
from tidemark.plans.registry import ORACLES, QUERIES, load_all

from paths import SF_SMALL

load_all()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert "error" not in res, res.get("error")
    if name in ORACLES:
        assert res["cols_match"], res.get("cols")
        assert res["types_match"], res.get("types")
        assert res["values_match"], res.get("diff")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0
    assert df.columns == e.entry(spark).columns
    assert set(e.oracle_sql()) <= set(e.queries())
