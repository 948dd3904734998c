"""Time the registered queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` a subset.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexigrove.plans.catalog import QUERIES  # noqa: E402
from lexigrove.plans.runtime import local_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "").split()
    spark = local_session("bench", cpus, **{"spark.sql.shuffle.partitions": cpus})
    spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    seconds = {}
    for name, run in QUERIES.items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as problem:
            print(f"{name}: {problem}", file=sys.stderr)
            continue
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total query time", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf,
    }))


if __name__ == "__main__":
    main()
