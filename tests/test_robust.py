"""No record stops a KPI job or vanishes: odd speeds and times, bad messages, landed documents, report paths, runnable jobs."""

import json
import math

import pytest
from pyspark.sql import functions as F

from squall.functions import parse
from squall.operators import files
from squall.operators.kpi import KpiWindow, streaming_kpis, window_kpis
from squall.plans import fixtures as fx
from squall.sources.files import read_documents
from squall.sources.streams import MESSAGE, file_stream
from squall.streaming import app, jobs

T0 = 1735526400
INF, NAN = float("inf"), float("nan")


def records(spark, speeds, times=None):
    rows = [("a", T0 + 60 * i if times is None else times[i], s, s) for i, s in enumerate(speeds)]
    return spark.createDataFrame(rows, "location_id string, forecast_time long, wind_speed_10m double, wind_gusts_10m double")


@pytest.mark.parametrize(
    "speeds",
    [[NAN, 1.0], [INF, 1.0], [-INF, INF], [1e13, 2.0], [1e-7], [1.123456789012, 2.5], [1e300, 1e300], [None, 3.0], [-0.0], [None]],
)
def test_averages_equal_plain_avg(spark, speeds):
    recs = records(spark, speeds)
    plain = recs.agg(F.avg("wind_speed_10m")).first()[0]
    stream_form = streaming_kpis(recs.withColumn("event_time", parse.event_time()), KpiWindow())
    for kpis in (window_kpis(recs, KpiWindow()), stream_form):
        got = kpis.where(F.col("window_end_s") == T0 + 3 * 3600).first().avg_wind_speed_10m
        if plain is None or math.isnan(plain):
            assert got is None if plain is None else math.isnan(got)
        else:
            assert got == plain or math.isclose(got, plain, rel_tol=1e-12)


def land(spark, path, values):
    rows = [(None, None if v is None else bytearray(v.encode()), "t", 0, i, None) for i, v in enumerate(values)]
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.parquet(path)


ODD = [
    '{"location_id":"a","forecast_time":1735526400,"wind_speed_10m":NaN,"wind_gusts_10m":30}',
    '{"location_id":"a","forecast_time":1735526400,"wind_speed_10m":1e13,"wind_gusts_10m":Infinity}',
    '{"location_id":"a","forecast_time":9223372036854775807,"wind_speed_10m":1}',
    '{"location_id":"a","forecast_time":"x"}',
    "not json",
    "",
    None,
]


def test_odd_messages_neither_stop_a_stream_nor_vanish(spark, scratch):
    base = scratch("odd")
    land(spark, f"{base}/landing", ODD)
    src = file_stream(spark, f"{base}/landing")
    for query in jobs.start_kpi_series(src, {"3h": KpiWindow()}, base, f"{base}/_ckpt", upsert=True).values():
        jobs.run_to_end(query)
    assert jobs.read_kpis(spark, f"{base}/table/3h").count() == 18
    jobs.run_to_end(jobs.start_bad_records(src, f"{base}/bad", f"{base}/_ckpt/bad"))
    bad = {r.offset: r.bad_reason for r in spark.read.parquet(f"{base}/bad").collect()}
    assert bad == {2: parse.TIME_OUT_OF_RANGE, 3: parse.NO_FORECAST_TIME, 4: parse.UNPARSABLE, 5: parse.EMPTY, 6: parse.EMPTY}


def test_each_message_is_parsed_once(spark, scratch):
    land(spark, path := scratch("once"), ODD)
    messages = spark.read.parquet(path)
    text = messages.select("offset", parse.as_text("value").alias("value"))
    _, bad = parse.split_bad(parse.parse_json(text, "value", keep=["offset"], with_status=True))
    for df in (bad, jobs.parsed_records(messages, watermark=None), jobs.bad_messages(messages)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json") == 1


def test_documents_one_per_line_or_per_file(spark, scratch):
    path = scratch("docs")
    doc = json.dumps({"latitude": 1.0, "hourly": {"time": [1], "wind_speed_10m": [2.0]}})
    spark.createDataFrame([(doc,)] * 3, "value string").coalesce(1).write.text(path)
    assert read_documents(spark, path).where("latitude = 1.0").count() == 3
    one = scratch("doc")
    spark.createDataFrame([(json.dumps(json.loads(doc), indent=1),)], "value string").coalesce(1).write.text(one)
    assert read_documents(spark, one, whole_files=True).where("latitude = 1.0").count() == 1


def test_corrected_duration_counts_distinct_hours(spark):
    hour = T0 - T0 % 3600
    recs = records(spark, [30.0, 30.0, 30.0], [hour + 600, hour + 1200, hour + 1800])
    by = {r.window_end_s: r.extreme_duration_hours for r in window_kpis(recs, KpiWindow(distinct_hours=True)).collect()}
    assert by[hour + 3 * 3600] == 1 and set(by.values()) == {1}
    rows = {r.window_end_s: r.extreme_duration_hours for r in window_kpis(recs, KpiWindow()).collect()}
    assert rows[hour + 3 * 3600] == 3
    with pytest.raises(ValueError):
        streaming_kpis(recs.withColumn("event_time", parse.event_time()), KpiWindow(distinct_hours=True))


@pytest.mark.parametrize("name", ["plain", "a b", "é+ü", "raw/x/raw", "100%"])
def test_dataset_size_of_odd_paths(spark, scratch, name):
    path = f"{scratch('size')}/{name}"
    rows = [("a b", 1), ("a b", 2), ("é", 3), ("x+y", 4), ("p%q", 5)]
    spark.createDataFrame(rows, "k string, v int").coalesce(1).write.partitionBy("k").parquet(path)
    spark.createDataFrame([("note",)], "value string").coalesce(1).write.text(f"{path}/notes")
    got = {r.entry: r for r in files.dataset_size(spark, path).collect()}
    counts = {e: r["rows"] for e, r in got.items()}
    assert counts == {"k=a b": 2, "k=é": 1, "k=x+y": 1, "k=p%25q": 1, "notes": None, None: 5}
    assert got["notes"].files == 1 and got["notes"].bytes == 5
    assert got[None].files == sum(r.files for e, r in got.items() if e is not None)
    assert got[None].bytes == sum(r.bytes for e, r in got.items() if e is not None)


def test_reports_of_all_batches_are_kept(spark, scratch):
    base = scratch("many")
    land(spark, f"{base}/landing/0", ODD[:1])
    for i in range(1, 6):
        land(spark, f"{base}/landing/{i}", ODD[:2])
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    src = file_stream(spark, f"{base}/landing/*", max_files_per_trigger=1)
    reports = jobs.run_to_end(jobs.start_bad_records(src, f"{base}/bad", f"{base}/_ckpt"))
    assert sum(p["numInputRows"] for p in reports) == 11 and int(old) >= 1


JOBS = {
    "kpi": (["--sink", "upsert"], "table/3h"),
    "corrected": ([], "table"),
    "points": ([], ""),
    "archive": ([], ""),
}


@pytest.mark.parametrize("job", JOBS)
def test_jobs_run_over_two_polls(spark, scratch, job):
    base = scratch(f"job-{job}")
    extra, table = JOBS[job]
    for poll in range(2):
        land(spark, f"{base}/landing/poll={poll}", [
            json.dumps({"location_id": "a", "forecast_time": T0 + 3600 * h, "ingest_time": poll, "wind_speed_10m": 5.0 + poll, "wind_gusts_10m": 30.0})
            for h in range(4)
        ] + ["broken"])
        app.run(spark, [job, "--files", f"{base}/landing/*", "--out", f"{base}/out", "--checkpoint", f"{base}/ckpt", "--available-now", *extra])
    out = spark.read.parquet(f"{base}/out/{table}")
    if job == "archive":
        assert out.count() == 10
        return
    bad = f"{base}/out-bad" if job == "points" else f"{base}/out/bad"
    assert spark.read.parquet(bad).count() == 2
    if job == "points":
        assert [r.wind_speed_10m for r in out.collect()] == [6.0] * 4
    elif job == "corrected":
        assert {r.avg_wind_speed_10m for r in out.collect()} == {6.0}
    else:
        assert out.count() == 36  # ends from 00:10 to 06:00


def test_publish_job(spark, scratch):
    base = scratch("publish")
    for poll in range(2):
        docs = [(json.dumps({"location_id": loc, "hourly": {v: [1.0, None, 3.0] for v in fx.HOURLY_VARIABLES} | {"time": [T0, T0 + 3600, T0 + 7200]}}),) for loc in ("reykjavik", "nowhere")]
        spark.createDataFrame(docs, "value string").coalesce(1).write.text(f"{base}/landing/poll={poll}")
        app.run(spark, ["publish", "--documents", f"{base}/landing/*", "--out", f"{base}/out", "--checkpoint", f"{base}/ckpt", "--available-now"])
    got = [json.loads(r.value) for r in spark.read.text(f"{base}/out").collect()]
    assert len(got) == 6 and {g["location_id"] for g in got} == {"reykjavik"}
    assert {g["wind_speed_10m"] for g in got} == {1.0, None, 3.0} and all(g["ingest_time"] > 0 for g in got)


def test_contradicting_options_are_rejected():
    for argv in (["kpi", "--lines", "--sink", "upsert", "--files", "x"], ["publish"], ["points"]):
        with pytest.raises(SystemExit):
            app.parse_args([*argv, "--out", "o", "--checkpoint", "c"])
    args = app.parse_args(["archive", "--files", "x", "--out", "o", "--checkpoint", "c"])
    assert app._trigger(args) == {"processingTime": "300 seconds"}
