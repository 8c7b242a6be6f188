"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and fully executed into Spark's ``noop`` sink (every
row produced, nothing collected), once to warm up and then ``BENCH_RUNS``
times; the median is reported.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_weather",
    "weather_anomaly",
    "price_anomaly",
    "daily_price",
    "latest_price",
    "upsert_fact",
    "stream_daily_agg",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    from obsengine.plans import registry
    from obsengine.session import build_session, checkpoint_dir

    spark = build_session(
        f"local[{cpus}]",
        app="obsengine-bench",
        shuffle_partitions=int(cpus) * 2,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        checkpoint_dir(spark, tempfile.mkdtemp(prefix="bench-ckpt-"))
    registry.load_all()

    def run(name: str) -> tuple[float, int]:
        t0 = time.perf_counter()
        df = registry.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0, 0

    out: dict[str, float] = {}
    for name in names:
        run(name)  # warm-up
        times = [run(name)[0] for _ in range(runs)]
        out[name] = round(statistics.median(times), 3)

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "sum_median_query_seconds",
                "value": round(sum(out.values()), 3),
                "unit": "sec",
                "queries": out,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
