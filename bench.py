"""Benchmark: run every registered query over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is executed in full through the ``noop`` sink (nothing is collected
to the driver).  Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from factlake.plans import registry  # noqa: E402
from factlake.session import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    only = set(a for a in sys.argv[1:])
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = local_session(cpus=cpus, shuffle_partitions=max(8, 2 * int(cpus)), app="factlake-bench",
                          memory=os.environ.get("BENCH_MEMORY", "4g"))
    registry.load_all()
    # Untimed warm-up so the first timed query does not pay for JVM start-up and JIT.
    registry.QUERIES["filing_activity_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in sorted(registry.QUERIES):
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        try:
            registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
