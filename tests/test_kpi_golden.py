"""Golden KPI rows for the three-row sample (FIXTURES.md §3)."""

import json

import pytest
from pyspark.sql import functions as F

from squall.functions.parse import event_time, parse_json
from squall.operators.kpi import KpiWindow, streaming_kpis, window_kpis

SAMPLE = [
    (1735526400, 1735526410, 6.2, 11.3, 2.1, 0.0, 1008.4),
    (1735527000, 1735527010, 7.1, 14.8, 1.6, 0.1, 1007.9),
    (1735527600, 1735527610, 8.9, 18.2, 1.2, 0.0, 1007.2),
]


def sample_records(spark):
    rows = []
    for ft, it, ws, wg, t2, pr, pm in SAMPLE:
        rec = {
            "location_id": "iceland_demo", "latitude": 64.1466, "longitude": -21.9426,
            "forecast_time": ft, "ingest_time": it, "wind_speed_10m": ws, "wind_gusts_10m": wg,
            "temperature_2m": t2, "precipitation": pr, "pressure_msl": pm,
        }
        rows.append((json.dumps(rec),))
    return parse_json(spark.createDataFrame(rows, "value string"), "value")


def expected_3h(thr):
    hi = thr == 12.0
    out = {1735527000: (6.2, 6.2, 11.3, 0, 0, 0.0)}
    out[1735527600] = (6.65, 7.1, 14.8, 1 if hi else 0, 1 if hi else 0, 1.2333333333333334 if hi else 0.0)
    for we in range(1735528200, 1735537200 + 1, 600):
        out[we] = (7.4, 8.9, 18.2, 1 if hi else 0, 2 if hi else 0, 3.033333333333333 if hi else 0.0)
    out[1735537800] = (8.0, 8.9, 18.2, 1 if hi else 0, 2 if hi else 0, 3.033333333333333 if hi else 0.0)
    out[1735538400] = (8.9, 8.9, 18.2, 1 if hi else 0, 1 if hi else 0, 1.5166666666666666 if hi else 0.0)
    return out


def as_map(df):
    return {
        r.window_end_s: (
            round(r.avg_wind_speed_10m, 6), r.max_wind_speed_10m, r.max_wind_gusts_10m,
            r.extreme_flag, r.extreme_duration_hours, r.severity_score,
        )
        for r in df.collect()
    }


@pytest.mark.parametrize("thr", [25.0, 12.0])
def test_sample_3h(spark, thr):
    got = as_map(window_kpis(sample_records(spark), KpiWindow("3 hours", "10 minutes", thr)))
    exp = expected_3h(thr)
    assert len(got) == 20
    assert set(got) == set(exp)
    for we, row in exp.items():
        g = got[we]
        assert g[:5] == row[:5], we
        assert g[5] == pytest.approx(row[5], rel=1e-15), we


def test_sample_6h(spark):
    got = as_map(window_kpis(sample_records(spark), KpiWindow("6 hours", "10 minutes", 12.0)))
    assert len(got) == 38
    mid = [we for we, r in got.items() if r[0] == 7.4]
    assert min(mid) == 1735528200 and max(mid) == 1735548000 and len(mid) == 34
    assert got[1735548600][0] == 8.0 and got[1735549200][0] == 8.9


def test_kpi_types(spark):
    df = window_kpis(sample_records(spark), KpiWindow())
    types = dict(df.dtypes)
    assert types["extreme_flag"] == "int"
    assert types["extreme_duration_hours"] == "bigint"
    assert types["severity_score"] == "double"
    assert types["window_end_s"] == "bigint"


def test_window_form_matches_bucket_form_on_sample(spark):
    recs = sample_records(spark)
    spec = KpiWindow("3 hours", "10 minutes", 12.0)
    a = sorted(window_kpis(recs, spec).collect())
    b = sorted(streaming_kpis(recs.withColumn("event_time", event_time("forecast_time")), spec).collect())
    assert a == b


def test_all_null_gusts(spark):
    rows = [("x", 1735526400, 5.0, None), ("x", 1735526700, 7.0, None)]
    df = spark.createDataFrame(rows, "location_id string, forecast_time long, wind_speed_10m double, wind_gusts_10m double")
    out = window_kpis(df, KpiWindow()).collect()
    assert len(out) == 18
    for r in out:
        assert r.extreme_flag == 0 and r.extreme_duration_hours == 0 and r.severity_score is None
        assert r.avg_wind_speed_10m == 6.0


def test_rows_without_time_are_dropped(spark):
    rows = [("x", None, 5.0, 30.0), ("x", 1735526400, 7.0, 30.0)]
    df = spark.createDataFrame(rows, "location_id string, forecast_time long, wind_speed_10m double, wind_gusts_10m double")
    out = window_kpis(df, KpiWindow()).collect()
    assert len(out) == 18 and all(r.extreme_duration_hours == 1 for r in out)


def test_null_location_is_its_own_group(spark):
    rows = [(None, 1735526400, 5.0, 30.0), ("x", 1735526400, 7.0, 30.0)]
    df = spark.createDataFrame(rows, "location_id string, forecast_time long, wind_speed_10m double, wind_gusts_10m double")
    out = window_kpis(df, KpiWindow()).collect()
    assert len(out) == 36
    assert {r.location_id for r in out} == {None, "x"}


def test_slide_must_divide_size(spark):
    with pytest.raises(ValueError):
        KpiWindow("3 hours", "7 minutes").check()
