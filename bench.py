"""Benchmark: every registered query on ``$BENCH_SF_DIR`` (default sf0.1) on
``local[$BENCH_CPUS]``; each query is run to completion with a ``noop`` write (the
whole plan executes, nothing is collected), twice, each time built from scratch.
Prints one JSON line: ``value`` / ``queries`` are the second (warm) runs,
``cold_value`` / ``cold_queries`` the first runs, which also pay JIT compilation."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from strandline.plans.queries import QUERIES  # noqa: E402
from strandline.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or list(QUERIES)
    scratch = tempfile.mkdtemp(prefix="strandline-bench-")
    spark = build_session(f"local[{cpus}]", max(cpus, 8), app="strandline-bench",
                          extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                                 "spark.local.dir": os.path.join(scratch, "local")})
    # warm-up: JVM, Python workers, parquet footers
    QUERIES["reads_per_chrom"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    for n in names:
        # each query twice, built from scratch both times (plan building and every job
        # it starts are timed): the first run also pays JIT compilation of its
        # generated code, the second is the steady state reported as the value
        for runs in (cold, times):
            t0 = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds_warm", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf,
                      "cold_value": round(sum(cold.values()), 3), "cold_queries": cold}))
    spark.stop()


if __name__ == "__main__":
    main()
