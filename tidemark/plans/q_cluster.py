"""Tier 4/6: standardization and the three clusterings."""

from __future__ import annotations

from tidemark.fixtures import panel
from tidemark.functions.exprs import fix6, fix6_sql
from tidemark.operators import cluster as CL
from tidemark.operators import features as FE
from tidemark.operators import snapshots as S
from tidemark.plans.q_features import feature_set_sql
from tidemark.plans.registry import query
from tidemark.fixtures import oracle_cte

FEATS = CL.CLUSTER_FEATURES


def _features(spark, sf):
    return FE.build_feature_set(panel(spark, sf))


def _std_sql(src: str, part: str) -> str:
    over = f"OVER (PARTITION BY {part})" if part else "OVER ()"
    med = ", ".join(f"quantile_cont({f}, 0.5) {over} AS m_{f}" for f in FEATS)
    fill = ", ".join(f"coalesce({f}, m_{f}) AS f_{f}" for f in FEATS)
    mom = ", ".join(f"avg(f_{f}) {over} AS mu_{f}, stddev_pop(f_{f}) {over} AS sd_{f}" for f in FEATS)
    z = ", ".join(f"(f_{f} - mu_{f}) / CASE WHEN sd_{f} = 0 THEN 1.0 ELSE sd_{f} END AS z_{f}" for f in FEATS)
    return (f", sm AS (SELECT *, {med} FROM {src}), sf AS (SELECT *, {fill} FROM sm),"
            f" smo AS (SELECT *, {mom} FROM sf), zf AS (SELECT *, {z} FROM smo)\n")


LT = ", lt AS (SELECT * FROM ms WHERE snapshot_time = (SELECT max(snapshot_time) FROM ms))\n"


@query("standardize", feature_set_sql("panel", oracle_cte("panel")) + LT + _std_sql("lt", "") +
       "SELECT symbol, " + ", ".join(f"{fix6_sql(f'z_{f}')} AS z_{f}" for f in FEATS) + " FROM zf")
def q_standardize(spark, sf):
    """K1: median fill and population z-scores of the seven cluster features, latest snapshot."""
    z = CL.standardize(S.latest_snapshot(_features(spark, sf)))
    return z.select("symbol", *[fix6(f"z_{f}").alias(f"z_{f}") for f in FEATS])


def _dbscan_sql() -> str:
    d = " + ".join(f"(a.z_{f} - b.z_{f}) * (a.z_{f} - b.z_{f})" for f in FEATS)
    return f"""
, e AS (SELECT a.snapshot_time, a.symbol AS a, b.symbol AS b FROM zf a JOIN zf b
        ON a.snapshot_time = b.snapshot_time WHERE sqrt({d}) <= 1.2),
core AS (SELECT snapshot_time, a AS p FROM e GROUP BY 1, 2 HAVING count(*) >= 4),
ce AS (SELECT e.* FROM e JOIN core c1 ON e.snapshot_time = c1.snapshot_time AND e.a = c1.p
       JOIN core c2 ON e.snapshot_time = c2.snapshot_time AND e.b = c2.p),
cc(snapshot_time, p, l) AS (SELECT snapshot_time, p, p FROM core
       UNION SELECT ce.snapshot_time, ce.b, cc.l FROM cc JOIN ce ON cc.snapshot_time = ce.snapshot_time AND cc.p = ce.a),
lab AS (SELECT snapshot_time, p, min(l) AS l FROM cc GROUP BY 1, 2),
bord AS (SELECT e.snapshot_time, e.a, min(lab.l) AS bl FROM e JOIN lab ON e.snapshot_time = lab.snapshot_time
         AND e.b = lab.p GROUP BY 1, 2),
comp AS (SELECT z.snapshot_time, z.symbol, coalesce(lab.l, bord.bl) AS root FROM zf z
         LEFT JOIN lab ON z.snapshot_time = lab.snapshot_time AND z.symbol = lab.p
         LEFT JOIN bord ON z.snapshot_time = bord.snapshot_time AND z.symbol = bord.a)
SELECT snapshot_time, symbol, CASE WHEN root IS NULL THEN -1
       ELSE CAST(dense_rank() OVER (PARTITION BY snapshot_time ORDER BY root) - 1 AS INTEGER) END AS dbscan_cluster
FROM comp"""


@query("cluster_dbscan", feature_set_sql("panel", oracle_cte("panel")).replace("WITH ", "WITH RECURSIVE ", 1)
       + _std_sql("ms", "snapshot_time") + _dbscan_sql())
def q_dbscan(spark, sf):
    """K4: DBSCAN (eps 1.2, 4 samples with self) per snapshot on standardized features."""
    out = CL.cluster_dbscan(_features(spark, sf), group="snapshot_time")
    return out.select("snapshot_time", "symbol", "dbscan_cluster")


@query("cluster_kmeans")
def q_kmeans(spark, sf):
    """K2: k-means (k=5, best of 10 seeds) on the latest snapshot (checked by properties)."""
    return CL.cluster_kmeans(S.latest_snapshot(_features(spark, sf))).select("symbol", "kmeans_cluster")


@query("cluster_hierarchical")
def q_ward(spark, sf):
    """K3: Ward into 5 clusters per snapshot (checked against a brute-force Ward in tests)."""
    out = CL.cluster_hierarchical(_features(spark, sf), group="snapshot_time")
    return out.select("snapshot_time", "symbol", "hierarchical_cluster")


@query("cluster_all")
def q_cluster_all(spark, sf):
    """K5: k-means, Ward and DBSCAN labels on the latest snapshot."""
    out = CL.cluster_all(S.latest_snapshot(_features(spark, sf)))
    return out.select("symbol", "kmeans_cluster", "hierarchical_cluster", "dbscan_cluster")
