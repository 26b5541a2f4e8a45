"""The partition upsert: it reads only what it touches, and survives a crash in the middle of a rewrite."""

import json
import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from squall.operators import store, upsert
from squall.operators.kpi import KpiWindow
from squall.session import list_names, path_exists
from squall.streaming import jobs

DAY = 86400
FIRST = 1704067200  # 2024-01-01 00:00 UTC


def points(spark, rows):
    """(location, time, version, speed) as points."""
    full = [(a, 1.0, 2.0, t, v, s, 30.0, 3.0, 0.0, 1000.0) for a, t, v, s in rows]
    return store.to_points(spark.createDataFrame(full, (
        "location_id string, latitude double, longitude double, forecast_time long, ingest_time long, wind_speed_10m "
        "double, wind_gusts_10m double, temperature_2m double, precipitation double, pressure_msl double"
    )))


def files_read(df):
    """numFiles of all scans of a plan that has run."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
            continue
        metric = node.metrics().get("numFiles")
        if node.nodeName().startswith("Scan") and metric.isDefined():
            found += metric.get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.fixture()
def month(spark, scratch):
    path = scratch("month")
    store.write_points(spark, points(spark, [("a", FIRST + DAY * d, 1, 1.0 + d) for d in range(30)]), path)
    return path


def test_only_touched_days_are_read(spark, month):
    parts = [n for n in list_names(spark, f"{month}/_measurement=weather_forecast") if n.startswith("event_date=")]
    assert len(parts) == 30
    day = date(2024, 1, 5)
    found = upsert.read_partitions(spark, month, store.STORED, store.PARTITIONS, [("weather_forecast", day)])
    assert files_read(found) == 1
    affected = spark.createDataFrame([("a", FIRST + 4 * DAY + 3600)], "location_id string, window_end_s long")
    spec = KpiWindow()
    days = jobs.covered_days(affected, spec)
    assert days == [day - timedelta(days=1), day]
    assert files_read(jobs.recompute_windows(store.read_days(spark, month, "weather_forecast", days), affected, spec)) <= 2 * 2


def test_merge_reads_the_touched_day_alone(spark, month, monkeypatch):
    read = []
    inner = upsert.read_partitions

    def spy(*args):
        read.append(inner(*args))
        return read[-1]

    monkeypatch.setattr(upsert, "read_partitions", spy)
    store.write_points(spark, points(spark, [("a", FIRST + 4 * DAY, 2, 50.0), ("b", FIRST + 4 * DAY, 2, 60.0)]), month)
    assert len(read[0].inputFiles()) == 1
    got = {(r.location_id, r._time): r.wind_speed_10m for r in store.read_points(spark, month).collect()}
    assert len(got) == 31 and got["a", FIRST + 4 * DAY] == 50.0 and got["b", FIRST + 4 * DAY] == 60.0


def test_replay_after_a_crash_in_the_rewrite(spark, month, monkeypatch):
    """The partition is gone and nothing is in its place: the replay writes the whole of it again."""
    inner = upsert._overwrite
    touched = f"{month}/_measurement=weather_forecast/event_date=2024-01-05"

    def crash(*args):
        upsert.delete_path(spark, touched)
        raise OSError("lost")

    new = points(spark, [("b", FIRST + 4 * DAY, 2, 60.0)])
    monkeypatch.setattr(upsert, "_overwrite", crash)
    with pytest.raises(OSError):
        store.write_points(spark, new, month, batch=("q", 7))
    assert not path_exists(spark, touched)
    monkeypatch.setattr(upsert, "_overwrite", inner)
    store.write_points(spark, new, month, batch=("q", 7))
    got = {(r.location_id, r._time): r.wind_speed_10m for r in store.read_points(spark, month).collect()}
    assert len(got) == 31 and got["a", FIRST + 4 * DAY] == 5.0
    store.write_points(spark, points(spark, [("c", FIRST, 2, 1.0)]), month, batch=("q", 8))
    assert list_names(spark, f"{month}__staged/q") == ["batch=8"]  # an earlier batch's rows go when the next one is through


def test_a_crash_before_the_rows_are_staged_changes_nothing(spark, month, monkeypatch):
    def crash(rows):
        raise OSError("lost")

    monkeypatch.setattr(store, "_merge_versions", crash)
    with pytest.raises(OSError):
        store.write_points(spark, points(spark, [("b", FIRST, 2, 60.0)]), month, batch=("q", 1))
    monkeypatch.undo()
    assert store.read_points(spark, month).count() == 30


def test_other_read_errors_are_not_taken_for_a_missing_table(spark, scratch):
    path = scratch("broken")
    assert upsert.read_if_exists(spark, path) is None
    os.makedirs(path.removeprefix("file:"))
    with open(f"{path.removeprefix('file:')}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        upsert.read_if_exists(spark, path).count()


def test_partition_folders_as_spark_names_them(spark, scratch):
    names = ["plain", "a b", "x=y/z%", "é:#'", "", None, "[q]{r}^"]
    path = scratch("names")
    spark.createDataFrame([(n, i) for i, n in enumerate(names)], "m string, i int").write.partitionBy("m").parquet(path)
    for i, n in enumerate(names):
        found = upsert.read_partitions(spark, path, spark.read.parquet(path).schema, ["m"], [(n,)])
        assert i in [r.i for r in found.collect()], n


def test_few_files_with_many_shuffle_partitions(spark, scratch):
    """A stateful query at 64 shuffle partitions leaves at most two files a day, and no checkpointed RDD."""
    from squall.sources.streams import MESSAGE, file_stream

    base = scratch("files")
    rows = [(None, bytearray(json.dumps({"location_id": f"l{i % 9}", "forecast_time": FIRST + i * 600, "wind_speed_10m": 1.0 * i, "wind_gusts_10m": 2.0}).encode()), "t", 0, i, None) for i in range(300)]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.parquet(f"{base}/landing")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        recs = jobs.parsed_records(file_stream(spark, f"{base}/landing"))
        jobs.run_to_end(jobs.start_kpis(recs, KpiWindow(), jobs.KpiUpsertSink(f"{base}/kpi", "3h"), f"{base}/_ckpt"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    table = spark.read.parquet(f"{base}/kpi")
    per_day = table.select("end_date", F.col("_metadata.file_path").alias("f")).distinct().groupBy("end_date").count()
    assert per_day.count() >= 3 and max(r["count"] for r in per_day.collect()) <= 2
    assert not [n for n in list_names(spark, f"{base}/kpi") if n.startswith("rdd-")]


def test_the_rows_of_a_merging_task_are_bounded(spark, scratch, monkeypatch):
    """The number of tasks follows the number of rows, not the session's number of shuffle partitions."""
    monkeypatch.setattr(upsert, "ROWS_PER_TASK", 10)
    dealt, merge, latest = [], store._merge_versions, store.latest_fields

    def spy_merge(rows):
        out = merge(rows)
        dealt.append(out.rdd.getNumPartitions())
        return out

    def spy_latest(*args, **options):
        out = latest(*args, **options)
        dealt.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(store, "_merge_versions", spy_merge)
    monkeypatch.setattr(store, "latest_fields", spy_latest)
    path = scratch("tasks")
    rows = [("a" if i % 3 else None, FIRST + 60 * (i % 100), i, float(i)) for i in range(200)]
    store.write_points(spark, points(spark, rows), path)
    found = store.read_points(spark, path).count()
    store.write_points(spark, points(spark, rows), path)
    assert dealt == [20, -(-found // 10), 20, -(-2 * found // 10)]
    got = {(r.location_id, r._time): r.wind_speed_10m for r in store.read_points(spark, path).collect()}
    want = {(r[0], r[1]): r[3] for r in rows}  # later rows have higher versions
    assert got == want and found == len(want)
