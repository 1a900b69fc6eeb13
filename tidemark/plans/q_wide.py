"""The checks of snapshots over ``wide_panel``, whose every snapshot has 60 rows, so that
limits, ties, ranks and models act: the same queries and SQL with that panel."""

from __future__ import annotations

from tidemark.fixtures import oracle_text, standing_for
from tidemark.plans.registry import CHECKS, ORACLES, query

NAMES = ["top_gainers", "top_losers", "top_n_gainers_20", "top_n_losers_20", "top_n_market_cap", "top3_market_cap", "rank_by_metric",
         "rank_change", "outperform_benchmark", "dominance_hierarchy", "chart_bubble", "chart_movers_bar", "standardize", "cluster_dbscan",
         "cluster_kmeans", "lof_anomaly", "iforest_anomaly_by_snapshot", "run_anomaly_pipeline", "kpis", "insights", "report_bundle",
         "report_tables", "run_pipeline_latest"]


def _wide(name: str) -> None:
    def run(spark, sf):
        with standing_for("panel", "wide_panel"):
            return CHECKS[name](spark, sf)
    run.__doc__ = f"{name} over full snapshots."
    sql = ORACLES.get(name)
    query(f"{name}_wide", sql.replace(oracle_text("panel"), oracle_text("wide_panel")) if sql else None)(run)


for _name in NAMES:
    _wide(_name)
