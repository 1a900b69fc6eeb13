"""Headline-query benchmark.

Runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints one JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.
Each query is forced end to end through the ``noop`` sink (every row is
computed, nothing is collected to the driver). Session start-up is excluded.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "top_gainers",                # SQL library: scalar subquery + top-k
    "price_volatility_per_coin",  # grouped aggregate
    "outperform_benchmark",       # benchmark join
    "consistent_growers_20",      # lag + descending row number, chunked windows
    "rank_change",                # last-two-snapshots self join
    "describe",                   # one-pass descriptive statistics
    "clean_pipeline",             # typing, imputation, dedup, rules, outlier flags
    "cleaning_audit",             # audit counts
    "build_feature_set",          # 41 features: calendar, windows, cross-section
    "returns",                    # long lags/rolling on hourly bars
    "rolling_correlation",        # pivot + rolling corr
    "lof_anomaly",                # exact LOF per snapshot
    "run_anomaly_pipeline",       # M2
    "kpis",                       # report on the processed latest snapshot
    "dashboard_load",             # M4: clean → features → anomalies on the raw tape
    "decode_nested_quotes",       # JSON payload decode
]

TAPE = ("clean_pipeline", "cleaning_audit", "dashboard_load")     # these read every event


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]] or HEADLINE
    from tidemark.plans.registry import QUERIES, load_all
    from tidemark.session import get_spark
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=parts,
                      extra={"spark.sql.autoBroadcastJoinThreshold": str(32 << 20)})
    load_all()
    # warm-up, untimed: JIT and code generation for the fixtures' scans, joins
    # and windows (the first run of a plan shape costs seconds of JVM warm-up)
    from tidemark.fixtures import fixture
    for name in ("panel", "bars", "tape", "dirty_tape"):
        fixture(spark, sf_dir, name).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    rate = {n: round(events / times[n]) for n in TAPE if n in times}
    print(json.dumps({"metric": "headline_queries_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "tape_rows_per_sec": rate, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
