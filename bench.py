"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is fully computed (written to a no-op sink), not just counted, so
column pruning cannot skip the work.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "bronze_tier_sums_events",
    "bronze_customer_month",
    "bronze_customer",
    "silver_customer_month",
    "gold_master",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or None

    from voltchurn.session import get_spark

    spark = get_spark(f"local[{cpus}]", int(cpus), app_name="voltchurn-bench",
                      extra={})
    import registry

    todo = names or [n for n in HEADLINE if n in registry.QUERIES] + [
        n for n in getattr(registry, "BENCH_EXTRA", ()) if n in registry.QUERIES]
    # warm-up: JVM, code paths, file listing
    registry.QUERIES["bronze_tier_sums_events"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in todo:
        t0 = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
