"""Benchmark of the headline queries.

Runs each query on the shared tables at $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS] and prints one JSON line. Each query is executed to the
end with the ``noop`` sink (no driver collect); the reported time is the
median of $BENCH_RUNS warm runs after one warm-up run.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fraudmart.plans import catalog  # noqa: E402
from fraudmart.session import get_session  # noqa: E402

HEADLINE = ["fraud_passport", "fraud_contract", "fraud_city_hop", "city_hop_any_pair",
            "fraud_amount_guess", "fraud_report", "scd2_terminal_history", "ownership_chain"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="fraudmart-bench",
                        shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                        extra={"spark.driver.memory": "16g"})
    times = {}
    for name in names:
        q = catalog.QUERIES[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "spark": spark.version, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
