"""Point store upsert and range reads; line protocol rendering; threshold classes."""

from datetime import datetime

from pyspark.sql import functions as F

from squall.constants import CLUSTER_MEASUREMENT, POINT_MEASUREMENT
from squall.functions.lines import render_lines
from squall.operators import store
from squall.operators.latest import latest_fields, latest_rows

REC = (
    "location_id string, latitude double, longitude double, forecast_time long, ingest_time long, "
    "wind_speed_10m double, wind_gusts_10m double, temperature_2m double, precipitation double, pressure_msl double"
)


def _recs(spark, rows):
    return spark.createDataFrame(rows, REC)


def test_upsert_later_null_keeps_value(spark, scratch):
    path = scratch("store")
    t = 1706650000
    store.write_points(spark, store.to_points(_recs(spark, [("a", 1.0, 2.0, t, 1, 5.0, 7.0, 3.0, 0.0, 1000.0)])), path)
    store.write_points(spark, store.to_points(_recs(spark, [("a", 1.0, 2.0, t, 2, 6.0, None, None, 0.1, 1001.0)])), path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.wind_speed_10m, r.wind_gusts_10m, r.temperature_2m, r.ingest_time) == (6.0, 7.0, 3.0, 2)


def test_upsert_touches_only_its_partitions(spark, scratch):
    path = scratch("store")
    day1, day2 = 1706572800, 1706659200  # 2024-01-30, 2024-01-31 (UTC midnight)
    store.write_points(spark, store.to_points(_recs(spark, [("a", 1.0, 2.0, day1 + 60, 1, 5.0, 7.0, 3.0, 0.0, 1000.0)])), path)
    store.write_points(spark, store.to_points(_recs(spark, [("a", 1.0, 2.0, day2 + 60, 2, 6.0, 8.0, 3.0, 0.0, 1000.0)])), path)
    got = sorted((r._time, r.wind_speed_10m) for r in spark.read.parquet(path).collect())
    assert got == [(day1 + 60, 5.0), (day2 + 60, 6.0)]


def test_range_is_half_open_and_by_measurement(spark, scratch):
    path = scratch("store")
    as_of = datetime(2024, 1, 31)
    stop = 1706659200
    rows = [
        ("a", 1.0, 2.0, stop - 6 * 3600, 1, 5.0, None, None, None, None),
        ("a", 1.0, 2.0, stop - 6 * 3600 - 1, 2, 6.0, None, None, None, None),
        ("a", 1.0, 2.0, stop, 3, 7.0, None, None, None, None),
        ("a", 1.0, 2.0, stop - 1, 4, 8.0, None, None, None, None),
    ]
    store.write_points(spark, store.to_points(_recs(spark, rows)), path)
    got = store.last_range(spark, path, POINT_MEASUREMENT, "6 hours", as_of).where("_field = 'wind_speed_10m'")
    assert sorted(r._value for r in got.collect()) == [5.0, 8.0]
    assert store.last_range(spark, path, CLUSTER_MEASUREMENT, "1 hour", as_of).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "PushedFilters" in plan


def test_long_and_short_ranges_agree(spark, scratch, monkeypatch):
    path, stop = scratch("store"), 1706659200
    rows = [("a", 1.0, 2.0, stop - 86400 * d, 1, float(d), None, None, None, None) for d in range(12)]
    store.write_points(spark, store.to_points(_recs(spark, rows)), path)
    short = store.read_range(spark, path, POINT_MEASUREMENT, stop - 86400 * 7, stop, long=False)
    assert len(short.inputFiles()) == 7
    monkeypatch.setattr(store, "LISTED_DAYS", 3)
    long = store.read_range(spark, path, POINT_MEASUREMENT, stop - 86400 * 7, stop, long=False)
    assert sorted(short.collect()) == sorted(long.collect()) and short.count() == 7
    assert store.read_range(spark, path, "none", stop - 86400, stop).collect() == []


def test_points_long_omits_nulls(spark):
    p = store.to_points(_recs(spark, [("a", 1.0, None, 10, 1, None, None, None, None, None)]))
    got = sorted((r._field, r._value) for r in store.points_long(p).collect())
    assert got == [("ingest_time", 1.0), ("latitude", 1.0)]


def test_latest_forms(spark):
    df = spark.createDataFrame([("k", 1, 1.0, 9.0), ("k", 2, None, 8.0)], "key string, v long, a double, b double")
    f = latest_fields(df, ["key"], ["a", "b"], "v").first()
    r = latest_rows(df, ["key"], ["a", "b"], "v").first()
    assert (f.a, f.b) == (1.0, 8.0)
    assert (r.a, r.b) == (None, 8.0)


def test_threshold_class(spark):
    df = spark.createDataFrame([(79.9,), (80.0,), (None,)], "v double")
    got = [r.c for r in df.select(store.threshold_class(F.col("v")).alias("c")).collect()]
    assert got == ["green", "red", None]


def test_line_protocol(spark):
    df = spark.createDataFrame(
        [
            ("reykjavik", 6.2, 3, True, 1735527000),
            (None, None, 1, None, 1735527600),
            ("a b,c=d", None, None, None, 1735528200),
            ("x", 1.0, 1, False, None),
        ],
        "loc string, f double, n int, b boolean, ts long",
    )
    got = [r.line for r in render_lines(df, "wind_kpi", {"location_id": "loc", "window": "3h"}, ["f", "n", "b"], "ts").collect()]
    assert got == [
        "wind_kpi,location_id=reykjavik,window=3h f=6.2,n=3i,b=true 1735527000",
        "wind_kpi,location_id=None,window=3h n=1i 1735527600",
    ]
    esc = render_lines(df.fillna({"f": 1.5}), "wind_kpi", {"location_id": "loc"}, ["f"], "ts").collect()
    assert any(r.line.startswith("wind_kpi,location_id=a\\ b\\,c\\=d f=1.5") for r in esc)


def test_line_breaks_stay_within_the_line(spark):
    df = spark.createDataFrame([("a\nb\r\nc", "x\n\"y", 1)], "loc string, s string, ts long")
    got = [r.line for r in render_lines(df, "m", {"loc": "loc"}, ["s"], "ts").collect()]
    assert got == ['m,loc=a\\nb\\nc s="x\\n\\"y" 1']


def test_upsert_order_free_by_version(spark, scratch):
    """A late-arriving older version does not overwrite a newer value, but
    fills a field the newer version left null."""
    path = scratch("store")
    t = 1706650000
    store.write_points(spark, store.to_points(_recs(spark, [("a", 1.0, 2.0, t, 5, 6.0, None, None, None, None)])), path)
    store.write_points(spark, store.to_points(_recs(spark, [("a", 1.0, 2.0, t, 3, 5.0, 7.0, None, None, None)])), path)
    store.write_points(spark, store.to_points(_recs(spark, [("a", 1.0, 2.0, t, 3, 5.0, 7.0, None, None, None)])), path)
    r = store.read_points(spark, path).collect()
    assert len(r) == 1
    assert (r[0].wind_speed_10m, r[0].wind_gusts_10m, r[0].ingest_time) == (6.0, 7.0, 5)


def test_float_text_matches_python_repr(spark):
    import math
    import random

    from squall.functions.lines import float_text

    rnd = random.Random(11)
    vals = [0.0, 1.0, 6.2, 6.65, 1e-5, 1.5e-5, 1e-4, 1.234e-4, 0.001, 1e7, 1.2345678e7, 1e15, 1.5e16,
            -0.00001, -1e7, 2.5e-300, 1.7976931348623157e308, 3.033333333333333, 1.2333333333333334, 100.0]
    vals += [rnd.uniform(1, 10) * 10 ** rnd.randint(-8, 15) * rnd.choice([1, -1]) for _ in range(400)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = {r.i: r.t for r in df.select("i", float_text(F.col("v")).alias("t")).collect()}
    assert [(v, got[i]) for i, v in enumerate(vals) if got[i] != repr(v)] == []
    special = spark.createDataFrame([(math.nan,), (math.inf,), (-math.inf,)], "v double")
    assert [r.t for r in special.select(float_text(F.col("v")).alias("t")).collect()] == ["nan", "inf", "-inf"]


def test_line_protocol_python_floats(spark):
    df = spark.createDataFrame([("a", 1e-05, 12345678.0, 10)], "loc string, f double, g double, ts long")
    got = render_lines(df, "m", {"location_id": "loc"}, ["f", "g"], "ts", python_floats=True).first().line
    assert got == "m,location_id=a f=1e-05,g=12345678.0 10"
    plain = render_lines(df, "m", {"location_id": "loc"}, ["f", "g"], "ts").first().line
    assert plain == "m,location_id=a f=1.0E-5,g=1.2345678E7 10"


def test_unversioned_and_tied_values(spark, scratch):
    """A value without a version stays until a versioned one comes; ties go to the greatest value, in any order."""
    t = 1735526400
    rows = [("a", 1.0, 2.0, t, None, 7.0, None, 3.0, None, None), ("b", 1.0, 2.0, t, 5, 5.0, 1.0, None, None, None),
            ("b", 1.0, 2.0, t, 5, 9.0, None, None, None, None), ("c", 1.0, 2.0, t, None, 8.0, None, None, None, None),
            ("c", 1.0, 2.0, t, 1, 2.0, None, None, None, None)]
    want = {"a": (7.0, None, 3.0), "b": (9.0, 1.0, None), "c": (2.0, None, None)}
    results = []
    for order in (rows, rows[::-1]):
        path = scratch("ties")
        for row in order:  # one write each
            store.write_points(spark, store.to_points(_recs(spark, [row])), path)
        stored = store.read_points(spark, path)
        merged = store.latest_points(store.to_points(_recs(spark, order)))
        for df in (stored, merged):
            got = {r.location_id: (r.wind_speed_10m, r.wind_gusts_10m, r.temperature_2m) for r in df.collect()}
            assert got == want
        newest = latest_rows(_recs(spark, order), ["location_id", "forecast_time"], ["wind_speed_10m", "ingest_time"], "ingest_time")
        results.append(sorted(map(tuple, newest.collect())))
    assert results[0] == results[1] and ("c", t, 2.0, 1) in results[0]


def test_latest_rows_hashes(spark):
    df = spark.range(100).selectExpr("cast(id % 7 as string) k", "id v", "cast(id as double) a")
    plan = latest_rows(df, ["k"], ["a"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_times_that_no_day_has_are_not_stored(spark, scratch):
    rows = [("a", 1.0, 2.0, t, 1, 5.0, None, None, None, None) for t in (2**63 - 1, -(2**63), 253402300800, None, 0)]
    points = store.to_points(_recs(spark, rows))
    assert [r._time for r in points.collect()] == [0]
    store.write_points(spark, points, path := scratch("range"))
    assert store.read_points(spark, path).count() == 1
