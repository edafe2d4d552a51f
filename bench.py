"""Benchmark: every registered query at one scale, one JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full (``noop`` sink: every row produced, nothing
collected); queries that write tables do so inside the timed call.  A
warm-up pass over all queries at the smallest scale runs first (JIT and
code generation warm, as for the published orientation timings), then each
query is timed ``BENCH_RUNS`` times (default 3) at the bench scale and the
median is reported.

A separate ``silver`` field times the production path: the typed silver
layer written once from the same transactions, then the transaction
analytics read it (filters pushed into Parquet, no re-parsing).  It does
not enter ``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerspark import operators as op  # noqa: E402
from ledgerspark.plans.registry import QUERIES, _txn, drop_scratch  # noqa: E402
from ledgerspark.plans.silver import read_silver, write_silver  # noqa: E402
from ledgerspark.session import build_session, fresh_path  # noqa: E402


SILVER_ANALYTICS = [
    "kpi_overall", "volume_daily", "volume_hourly", "pattern_channel", "pattern_txn_type",
    "pattern_branch_top15", "risk_high_value_cash", "risk_structuring", "risk_high_velocity",
    "txn_channel_distribution", "txn_branch_type_top15", "txn_hourly", "txn_data_quality",
    "risk_high_value_cash_channel",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:] if a in QUERIES]
    spark = build_session(
        master=f"local[{cpus}]",
        app_name="ledgerspark-bench",
        shuffle_partitions=cpus,
        extra={"spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, where: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, where).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - t0
        drop_scratch(spark)  # so that every run writes its own tables, and none stay
        return took

    names = only or list(QUERIES)
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    for n in names:
        run(n, warm_dir)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = {n: round(statistics.median(run(n, sf_dir) for _ in range(runs)), 3) for n in names}
    silver = {}
    if os.environ.get("BENCH_SILVER", "1") == "1" and not only:
        path = fresh_path(spark, "bench-silver")
        t0 = time.perf_counter()
        write_silver(_txn(spark, sf_dir), path)
        silver["write"] = round(time.perf_counter() - t0, 3)

        def on_silver(fn) -> float:
            t = time.perf_counter()
            fn(read_silver(spark, path)).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t

        fns = [getattr(op, n) for n in SILVER_ANALYTICS]
        for fn in fns:
            on_silver(fn)  # warm-up
        silver["queries"] = {
            fn.__name__: round(statistics.median(on_silver(fn) for _ in range(runs)), 3) for fn in fns
        }
        silver["total"] = round(sum(silver["queries"].values()), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
                "stat": "median",
                "silver": silver,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
