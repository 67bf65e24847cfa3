"""Benchmark the headline queries.

Runs every query registered with ``bench=True`` at ``$BENCH_SF_DIR``
(default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` (default 8); each
result is fully materialised through the ``noop`` sink (no driver collect).
Prints one JSON line: total seconds and per-query seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quillspark.plans.registry import load_all  # noqa: E402
from quillspark.session import checkpoint_dir, get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus, driver_memory="16g")
    checkpoint_dir(spark)
    reg = load_all()
    names = [n for n, q in reg.items() if q.bench]
    # JVM / reader warm-up, not timed.
    spark.read.parquet(f"{sf_dir}/conversations.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
