"""Bucket partials: any sequence of batches against KPIs of the merged records, replays, and what a batch reads."""

import random

import pytest

from squall.operators import latest, partials
from squall.operators.kpi import KpiWindow, kpis_from_buckets, window_kpis

SCHEMA = "location_id string, forecast_time long, ingest_time long, wind_speed_10m double, wind_gusts_10m double"
START = 1704067200  # 2024-01-01 00:00 UTC


def some_rows(r, n, days=1):
    """Records whose versions collide, with missing fields and versions, and speeds that are no exact units."""
    out = []
    for _ in range(n):
        speed = r.choice([None, r.randrange(40) / 4, r.randrange(40) / 4, r.random() * 1e-7, float("nan")])
        gust = r.choice([None, r.randrange(80) / 2])
        t = START + r.randrange(days * 86400) // 300 * 300
        out.append((r.choice(["a", "b", None]), t, r.choice([None, r.randrange(9)]), speed, gust))
    return out


def merged(spark, rows):
    return latest.latest_fields(spark.createDataFrame(rows, SCHEMA), ["location_id", "forecast_time"], partials.FIELDS, "ingest_time")


def shown(df):
    def close(v):  # sums of inexact speeds depend on their order
        return round(v, 9) if isinstance(v, float) else v

    return sorted(repr([close(v) for v in r]) for r in df.collect())


def check(spark, path, rows, spec=KpiWindow()):
    for s in (spec, KpiWindow("6 hours"), KpiWindow(distinct_hours=True)):
        got = kpis_from_buckets(partials.read_buckets(spark, path), s)
        assert shown(got) == shown(window_kpis(merged(spark, rows), s))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_batches_in_any_order(spark, scratch, seed):
    r = random.Random(seed)
    path, rows = scratch("partials"), []
    for n, size in enumerate([60, 40, 1, 30]):
        batch = some_rows(r, size) + r.sample(rows, min(len(rows), 10))  # some of it is re-sent
        rows += batch
        partials.update(spark, spark.createDataFrame(batch, SCHEMA), path, batch=("q", n))
    check(spark, path, rows)


def test_a_revision_lowers_a_maximum_and_the_average(spark, scratch):
    path = scratch("lower")
    first = [("a", START, 1, 9.0, 40.0), ("a", START + 60, 1, 5.0, 30.0), ("a", START + 120, 1, 1.0, 10.0)]
    second = [("a", START, 2, 2.0, 20.0), ("a", START + 60, 0, 50.0, 50.0), ("a", START + 120, 2, None, 11.0)]
    for n, rows in enumerate([first, second]):
        partials.update(spark, spark.createDataFrame(rows, SCHEMA), path, batch=("q", n))
    (row,) = partials.read_buckets(spark, path).collect()
    assert (row._max_speed, row._max_gust, row._ext, row._cnt, row._sum) == (5.0, 30.0, 1, 3, 8_000_000)
    check(spark, path, first + second)


def test_a_batch_counts_once_wherever_it_is_cut_off(spark, scratch, monkeypatch):
    path, r = scratch("replay"), random.Random(3)
    rows, more = some_rows(r, 50), some_rows(r, 50)
    partials.update(spark, spark.createDataFrame(rows, SCHEMA), path, batch=("q", 0))
    inner = partials.upsert_partitions
    for stop in (1, 2):  # before the buckets, and between them and the points
        calls = []

        def cut(*args, stop=stop, calls=calls):
            calls.append(args[2])
            if len(calls) == stop:
                raise OSError("lost")
            inner(*args)

        monkeypatch.setattr(partials, "upsert_partitions", cut)
        with pytest.raises(OSError):
            partials.update(spark, spark.createDataFrame(more, SCHEMA), path, batch=("q", 1))
        monkeypatch.setattr(partials, "upsert_partitions", inner)
    for _ in range(2):
        partials.update(spark, spark.createDataFrame(more, SCHEMA), path, batch=("q", 1))
    check(spark, path, rows + more)


def test_a_batch_reads_its_spans_alone(spark, scratch, monkeypatch):
    path, r = scratch("spans"), random.Random(4)
    rows = [(f"l{i % 3}", START + i * 600, 1, 1.0 + i % 7, 2.0) for i in range(5 * 144)]
    partials.update(spark, spark.createDataFrame(rows, SCHEMA), path)
    stored = spark.read.parquet(f"{path}/points").inputFiles()
    assert len(stored) == 20  # six hours each
    read = []
    inner = partials.read_partitions

    def spy(*args):
        read.append(inner(*args))
        return read[-1]

    monkeypatch.setattr(partials, "read_partitions", spy)
    batch = [("l0", START + 86400 + 600, 2, 50.0, 60.0)]
    partials.update(spark, spark.createDataFrame(batch, SCHEMA), path)
    assert [len(df.inputFiles()) for df in read] == [1, 1]
    check(spark, path, rows + batch)


def test_nothing_usable_and_a_bad_slide(spark, scratch):
    path = scratch("none")
    partials.update(spark, spark.createDataFrame([("a", None, 1, 1.0, 2.0), ("a", 1 << 60, 1, 1.0, 2.0)], SCHEMA), path)
    assert partials.read_buckets(spark, path).count() == 0
    with pytest.raises(ValueError):
        partials.update(spark, spark.createDataFrame([], SCHEMA), path, KpiWindow("14 hours", "7 hours"))
