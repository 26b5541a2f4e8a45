"""Bench: run the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and executed in full into the ``noop`` sink (no rows
pulled into Python): one warm-up pass over all queries, then the median of
of queries that took over SLOW_S in the warm-up (streams of several batches), 2.
Prints one JSON line; ``value`` is the sum of the per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from squall.functions.parse import event_time  # noqa: E402
from squall.operators import store  # noqa: E402
from squall.operators.kpi import streaming_kpis  # noqa: E402
from squall.plans import fixtures as fx  # noqa: E402
from squall.plans.catalog import K3, K6, REGISTRY  # noqa: E402
from squall.session import delete_path, local_session, scratch_path  # noqa: E402

# Headline queries first; every registered query is timed.
HEADLINE = ["kpi_3h", "kpi_6h", "kpi_union", "kpi_3h_latest", "latest_points", "range_query", "stream_kpi_3h"]


#: seconds from which a query is run twice only
SLOW_S, SLOW_RUNS = 10.0, 2


def window_form(spec):

    def build(spark, sf_dir):
        recs = fx.wx(spark, sf_dir)
        return streaming_kpis(recs.where("forecast_time IS NOT NULL").withColumn("event_time", event_time("forecast_time")), spec)

    return build


COMPARISON = {"kpi_3h_window_form": window_form(K3), "kpi_6h_window_form": window_form(K6)}


def run_once(spark, build, sf_dir) -> float:
    t0 = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)), app="squall-bench")
    names = only or HEADLINE + [k for k in REGISTRY if k not in HEADLINE]
    errors: dict[str, str] = {}
    warm: dict[str, float] = {}
    # warm-up pass over every query (JVM JIT, table listings), then timed runs
    for name in names:
        try:
            warm[name] = run_once(spark, REGISTRY[name].build, sf_dir)
        except Exception as exc:  # keep timing the others; report this one
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
    timings: dict[str, float] = {}
    for name in names:
        if name in errors:
            continue
        build = REGISTRY[name].build
        try:
            times = runs if warm[name] < SLOW_S else min(runs, SLOW_RUNS)
            timings[name] = round(statistics.median(run_once(spark, build, sf_dir) for _ in range(times)), 4)
        except Exception as exc:
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
            continue
        print(f"# {name}: {timings[name]:.3f}s", file=sys.stderr, flush=True)
    comparison = {}
    if not only:
        for name, build in COMPARISON.items():
            run_once(spark, build, sf_dir)
            comparison[name] = round(statistics.median(run_once(spark, build, sf_dir) for _ in range(runs)), 4)
            print(f"# {name}: {comparison[name]:.3f}s", file=sys.stderr, flush=True)
    # the range reads' own queries read a store written once per session; writing it is a cost of its own
    writes = {}
    if not only:
        path = scratch_path(spark, "bench-store")
        rows = store.to_points(fx.wx(spark, sf_dir))
        for name in ("point_store_first_write", "point_store_upsert"):
            t0 = time.perf_counter()
            store.write_points(spark, rows, path)
            writes[name] = round(time.perf_counter() - t0, 4)
        delete_path(spark, path)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    out = {
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "window_form_comparison": comparison,
        "writes": writes,
        "errors": errors,
        "cpus": int(cpus),
        "runs": runs,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
