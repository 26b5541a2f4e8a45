"""File sources, message and line sinks, the point-store stream, two KPI
queries off one stream."""

import json

from pyspark.sql import functions as F

from squall.operators.kpi import KpiWindow
from squall.sources.files import documents_to_records, read_csv_records, read_documents, read_json_records
from squall.sources.locations import configured_locations
from squall.sources.sinks import write_lines, write_messages
from squall.sources.streams import MESSAGE, file_stream
from squall.streaming import jobs

from .test_kpi_golden import SAMPLE


def _sample_lines():
    out = []
    for ft, it, ws, wg, t2, pr, pm in SAMPLE:
        out.append(json.dumps({"location_id": "iceland_demo", "latitude": 64.1466, "longitude": -21.9426,
                               "forecast_time": ft, "ingest_time": it, "wind_speed_10m": ws, "wind_gusts_10m": wg,
                               "temperature_2m": t2, "precipitation": pr, "pressure_msl": pm}))
    return out


def test_read_json_records(spark, scratch):
    path = scratch("jsonl")
    spark.createDataFrame([(x,) for x in _sample_lines() + ["not json"]], "value string").coalesce(1).write.text(path)
    recs = read_json_records(spark, path, with_status=True)
    assert recs.where(~F.col("is_bad")).count() == 3
    assert recs.where("is_bad").first().bad_reason == "unparsable"


def test_read_csv_records(spark, scratch):
    path = scratch("csv")
    spark.createDataFrame([("reykjavik,2025-11-27T05:00Z,10.5",), ("akureyri,2025-11-27T05:00Z,7.2",)], "value string").write.text(path)
    assert sorted(r.wind_speed_10m for r in read_csv_records(spark, path).collect()) == [7.2, 10.5]


def test_documents_to_records(spark, scratch):
    path = scratch("docs")
    for loc in ("reykjavik", "akureyri", "elsewhere"):
        doc = {"latitude": 1.0, "longitude": 2.0, "hourly": {
            "time": [1735689600 + 3600 * i for i in range(30)],
            "wind_speed_10m": [float(i) for i in range(30)], "wind_gusts_10m": [float(i) for i in range(30)],
            "temperature_2m": [0.0] * 30, "precipitation": [0.0] * 30, "pressure_msl": [1000.0] * 29}}
        spark.createDataFrame([(json.dumps(doc),)], "value string").coalesce(1).write.text(f"{path}/location_id={loc}")
    docs = read_documents(spark, path)
    recs = documents_to_records(docs, configured_locations(spark), ingest_time=42)
    rows = recs.collect()
    assert len(rows) == 48  # 24 per configured location; the unconfigured one is not joined
    assert {(r.location_id, r.latitude) for r in rows} == {("reykjavik", 64.13), ("akureyri", 65.68)}
    assert {r.ingest_time for r in rows} == {42}


def test_write_messages_and_lines(spark, scratch):
    path = scratch("msgs")
    df = spark.createDataFrame([("a", None), ("b", 1.5)], "location_id string, wind_speed_10m double")
    write_messages(df, path=path)
    got = sorted(r.value for r in spark.read.text(path).collect())
    assert got == ['{"location_id":"a","wind_speed_10m":null}', '{"location_id":"b","wind_speed_10m":1.5}']
    lp = scratch("lines")
    write_lines(spark.createDataFrame([("x 1",)], "line string"), lp)
    assert spark.read.text(lp).first().value == "x 1"


def _land(spark, path, rows):
    msgs = [(None, bytearray(json.dumps(r).encode()), "t", 0, i, None) for i, r in enumerate(rows)]
    spark.createDataFrame(msgs, MESSAGE).coalesce(1).write.parquet(path)


def test_point_store_stream(spark, scratch):
    base = scratch("pts")
    rows = [{"location_id": "a", "forecast_time": 1735689600, "ingest_time": 1, "wind_speed_10m": 5.0, "temperature_2m": 1.0},
            {"location_id": "a", "forecast_time": 1735689600, "ingest_time": 2, "wind_speed_10m": 6.0}]
    _land(spark, f"{base}/landing/p=0", rows[:1])
    _land(spark, f"{base}/landing/p=1", rows[1:])
    q = jobs.start_points(file_stream(spark, f"{base}/landing/*", max_files_per_trigger=1), f"{base}/store", f"{base}/_ckpt")
    jobs.run_to_end(q)
    got = spark.read.parquet(f"{base}/store").collect()
    assert len(got) == 1 and got[0].wind_speed_10m == 6.0 and got[0].temperature_2m == 1.0 and got[0].ingest_time == 2


def test_two_kpi_queries_off_one_stream(spark, scratch):
    base = scratch("pair")
    rows = [{"location_id": "a", "forecast_time": 1735689600 + 600 * i, "wind_speed_10m": 1.0 * i, "wind_gusts_10m": 30.0}
            for i in range(6)]
    _land(spark, f"{base}/landing", rows)
    qs = jobs.start_kpi_series(file_stream(spark, f"{base}/landing"),
                               {"3h": KpiWindow("3 hours"), "6h": KpiWindow("6 hours")}, base, f"{base}/_ckpt", lines=True)
    for q in qs.values():
        jobs.run_to_end(q)
    n3 = jobs.latest_emissions(spark, f"{base}/kpi/3h").count()
    n6 = jobs.latest_emissions(spark, f"{base}/kpi/6h").count()
    assert (n3, n6) == (18 + 5, 36 + 5)
    assert spark.read.text(f"{base}/lines/3h").count() == n3


def test_log_error_search(spark, scratch):
    from squall.operators.files import error_lines, read_log_lines

    path = scratch("logs")
    lines = [
        "2025-11-27T05:00:00Z I! Starting agent",
        "2025-11-27T05:00:10Z E! [outputs] write failed",
        "2025-11-27T05:00:20Z W! Failed to write metric batch",
        "2025-11-27T05:00:30Z D! ok",
        "token was Unauthorized by server",
        "An ERROR occurred",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    got = [r.value for r in error_lines(read_log_lines(spark, path)).collect()]
    assert got == [lines[1], lines[2], lines[4], lines[5]]


def test_text_stream_archive(spark, scratch):
    from squall.sources.streams import text_stream

    base = scratch("txt")
    spark.createDataFrame([(x,) for x in _sample_lines()], "value string").coalesce(1).write.text(f"{base}/in")
    msgs = text_stream(spark, f"{base}/in").withColumn("timestamp", F.current_timestamp())
    jobs.run_to_end(jobs.start_archive(msgs, f"{base}/out", f"{base}/_ckpt"))
    assert jobs.read_archive(spark, f"{base}/out").where("location_id = 'iceland_demo'").count() == 3
