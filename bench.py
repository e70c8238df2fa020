"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fine_window_agg", "coarse_from_fine", "sliding_window_agg", "decode_encode_roundtrip",
    "decode_rejects", "uniques_estimate", "uniques_exact", "geo_bid_share", "geo_share_wide",
    "running_totals", "latest_n", "ingest_counter", "metric_envelope", "route_by_target",
    "storage_ratio", "stream_coarse_agg", "stream_watermark",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from adpulse.session import build_session
    from adpulse.plans import QUERIES

    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus)
    # warm-up: JVM, JIT and generated code of every query, on the smallest tables
    for name in names:
        QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    # events per second over the whole table (row count from the parquet footer)
    import pyarrow.parquet as pq
    n_events = pq.ParquetFile(f"{sf_dir}/events.parquet").metadata.num_rows
    rates = {k: round(n_events / times[k]) for k in ("fine_window_agg", "stream_coarse_agg", "stream_watermark") if k in times}
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None,
                      "cpus": cpus, "events": n_events, "events_per_sec": rates}))
    spark.stop()


if __name__ == "__main__":
    main()
