"""The README's end-to-end flow composes: store → clean → features →
anomalies → reports, on rows derived from the driver's tables."""

import uuid

from pyspark.sql import functions as F

from paths import SF_SMALL
from tidemark.fixtures import panel
from tidemark.operators import anomaly, cleaning, features, reports, snapshots
from tidemark.schema import CONTRACT_COLUMNS
from tidemark.session import checkpoint_dir
from tidemark.sources import payloads, store


def test_readme_flow(spark):
    path = f"{checkpoint_dir(spark)}/flow-{uuid.uuid4().hex}"
    p = panel(spark, SF_SMALL)
    raw = payloads.encode_nested(p).select(F.col("snapshot_time").cast("string").alias("snapshot_time"), "payload")
    batch = payloads.schema_contract(payloads.decode_nested_quotes(raw))
    assert batch.columns == CONTRACT_COLUMNS
    inserted = store.upsert_ignore(batch, path)
    assert inserted == p.count()
    assert store.upsert_ignore(batch, path) == 0  # idempotent
    history = store.scan_store(spark, path)
    clean = cleaning.clean_pipeline(history)
    audit = {r["metric"]: r["value"] for r in cleaning.cleaning_audit(history).collect()}
    assert audit["duplicate_coin_snapshot_rows_removed"] == 0
    final = anomaly.run_anomaly_pipeline(features.build_feature_set(clean))
    latest = snapshots.latest_snapshot(final)
    kpis = {r["label"]: r["value"] for r in reports.compute_kpis(latest).collect()}
    assert kpis["Number of Coins"] == str(latest.count())
    summary = reports.run_summary(history, final, inserted).head()
    assert summary["rows_inserted"] == inserted and summary["total_rows_in_db"] == inserted
