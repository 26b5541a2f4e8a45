"""Plan shape checks: the properties that make the queries scale."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as entry
from squall.functions.parse import event_time
from squall.operators.kpi import KpiWindow, streaming_kpis, window_kpis
from squall.plans import fixtures as fx

from .conftest import SF_SMALL

Q = entry.queries()


def _plan(df, execute=False):
    if execute:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _exchange_children(plan: str) -> list[str]:
    lines = plan.splitlines()
    out = []
    for i, ln in enumerate(lines):
        if re.search(r"\bExchange hashpartitioning", ln) and i + 1 < len(lines):
            out.append(lines[i + 1])
    return out


def test_kpi_shuffles_carry_partial_aggregates(spark):
    plan = _plan(Q["kpi_3h"](spark, SF_SMALL))
    kids = _exchange_children(plan)
    assert len(kids) == 2
    assert all("HashAggregate" in k and "partial_" in k for k in kids), kids
    assert "Expand" not in plan  # the fan-out is a Generate over buckets, not a per-row Expand


def test_union_reuses_bucket_exchange(spark):
    plan = _plan(Q["kpi_union"](spark, SF_SMALL), execute=True)
    assert "ReusedExchange" in plan


def test_latest_and_store_merge_combine_map_side(spark):
    for key in ("latest_points", "latest_rows", "kpi_3h_latest"):
        kids = _exchange_children(_plan(Q[key](spark, SF_SMALL)))
        assert kids and all("partial_" in k for k in kids), (key, kids)


def test_first_n_limits_before_shuffle(spark):
    plan = _plan(Q["first_n_per_key"](spark, SF_SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_enrich_broadcasts_the_checked_dimension(spark):
    assert "BroadcastHashJoin" in _plan(Q["enrich_join"](spark, SF_SMALL))


def test_last_n_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(Q["last_n"](spark, SF_SMALL))


def test_range_read_prunes_and_pushes(spark):
    plan = _plan(Q["range_query"](spark, SF_SMALL))
    assert re.search(r"PartitionFilters: \[[^\]]*_measurement", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(_time", plan)


def test_kpi_scan_reads_only_needed_columns(spark):
    plan = _plan(Q["kpi_3h"](spark, SF_SMALL))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert schema == "struct<ts:timestamp_ntz,event_type:string,value:double>"


def test_no_python_udfs_in_registered_plans(spark):
    for name in ("kpi_3h", "json_scan", "bad_records", "csv_scan", "array_rows", "points_long", "kpi_lines"):
        plan = _plan(Q[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_hot_location_gives_same_kpis(spark):
    """Two thirds of all rows in one location: bucket-first equals the windowed form."""
    w = fx.wx(spark, SF_SMALL).withColumn(
        "location_id", F.when(F.pmod("ingest_time", F.lit(3)) != 0, F.lit("hot")).otherwise(F.col("location_id"))
    )
    spec = KpiWindow()
    a = window_kpis(w, spec)
    b = streaming_kpis(w.withColumn("event_time", event_time("forecast_time")), spec)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.where("location_id = 'hot'").count() > 0
