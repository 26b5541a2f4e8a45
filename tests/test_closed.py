"""Final-output streams: bucket-first KPIs in append mode, re-sent messages, late rows."""

import json

import pytest

from squall.operators.kpi import KpiWindow, final_kpis, window_kpis
from squall.schema import MESSAGE_RECORD
from squall.sources.streams import MESSAGE, file_stream
from squall.streaming import closed, jobs

DAY = 1735689600  # 2025-01-01 00:00 UTC


def land(spark, path, rows):
    """(location, seconds after DAY, ingest time, speed, gust) as one message file."""
    out = []
    for n, (loc, t, ingest, speed, gust) in enumerate(rows):
        rec = {"location_id": loc, "forecast_time": DAY + t, "ingest_time": ingest, "wind_speed_10m": speed, "wind_gusts_10m": gust}
        out.append((None, bytearray(json.dumps(rec).encode()), "t", 0, n, None))
    spark.createDataFrame(out, MESSAGE).coalesce(1).write.parquet(path)


def day(loc="a", step=600, ingest=1):
    return [(loc, t, ingest, 5.0 + t % 7, 20.0 + t // 3600) for t in range(0, 86400, step)]


def records(spark, base, watermark="1 hour", **options):
    return jobs.parsed_records(file_stream(spark, f"{base}/landing/*", **options), MESSAGE_RECORD, watermark)


def operator(progress, position, metric):
    """A metric of one stateful operator over all batches; 0 is the last of the plan."""
    return [int(p["stateOperators"][position][metric]) for p in progress if len(p.get("stateOperators") or []) > abs(position)]


def test_batch_form_equals_bucket_first(spark):
    rows = [(loc, DAY + t, s, g) for loc, t, _, s, g in day("a", 1700) + day(None, 2900)]
    df = spark.createDataFrame(rows, "location_id string, forecast_time long, wind_speed_10m double, wind_gusts_10m double")
    events = df.selectExpr("*", "timestamp_seconds(forecast_time) AS event_time")
    for spec in (KpiWindow(), KpiWindow("6 hours", "30 minutes", 22.0)):
        assert sorted(map(repr, final_kpis(events, spec).collect())) == sorted(map(repr, window_kpis(df, spec).collect()))


def test_distinct_hours_are_refused(spark):
    with pytest.raises(ValueError):
        final_kpis(spark.range(1), KpiWindow(distinct_hours=True))


def test_a_record_updates_one_row_of_state_and_ended_windows_come_once(spark, scratch):
    base = scratch("final")
    rows = day()
    land(spark, f"{base}/landing/poll=0", rows)
    query = closed.start_final_kpis(records(spark, base), KpiWindow(), f"{base}/kpi", f"{base}/_ckpt", "3h")
    progress = jobs.run_to_end(query)
    # the source's side comes last in the list of operators
    assert sum(operator(progress, -1, "numRowsUpdated")) == len(rows)
    update = jobs.start_kpis(records(spark, base), KpiWindow(), jobs.KpiBatchSink(f"{base}/parity", "3h"), f"{base}/_ckpt2")
    windows = {t // 600 * 600 + 600 * k for _, t, *_ in rows for k in range(1, 19)}
    assert sum(m[2] for m in jobs.state_metrics(jobs.run_to_end(update))) == len(windows)
    got = closed.read_final_kpis(spark, f"{base}/kpi")
    mark = DAY + 86400 - 600 - 3600
    assert sorted(r.window_end_s for r in got.collect()) == sorted(DAY + w for w in windows if DAY + w <= mark)
    # a second delivery closes the rest of the day and repeats nothing
    land(spark, f"{base}/landing/poll=1", [("a", 2 * 86400, 1, 1.0, 1.0)])
    jobs.run_to_end(closed.start_final_kpis(records(spark, base), KpiWindow(), f"{base}/kpi", f"{base}/_ckpt", "3h"))
    ends = sorted(r.window_end_s for r in closed.read_final_kpis(spark, f"{base}/kpi").collect())
    assert ends == sorted(DAY + w for w in windows)


def test_nothing_has_ended_yet(spark, scratch):
    base = scratch("early")
    land(spark, f"{base}/landing/poll=0", [("a", 0, 1, 1.0, 2.0)])
    jobs.run_to_end(closed.start_final_kpis(records(spark, base), KpiWindow(), f"{base}/kpi", f"{base}/_ckpt", "3h"))
    empty = closed.read_final_kpis(spark, f"{base}/kpi")
    assert empty.count() == 0 and "window" in empty.columns
    assert closed.read_final_kpis(spark, f"{base}/nowhere").dtypes == empty.dtypes


def test_repeated_messages_count_once_and_their_state_expires(spark, scratch):
    base = scratch("once")
    rows = day() + [("a", 0, 2, 9.0, 30.0)]  # a later version of a forecast is no repetition
    land(spark, f"{base}/landing/poll=0", rows + rows[:50])
    land(spark, f"{base}/landing/poll=1", rows)
    land(spark, f"{base}/landing/poll=2", [("a", 3 * 86400, 1, 1.0, 1.0)])
    recs = closed.once(records(spark, base, max_files_per_trigger=1))
    progress = jobs.run_to_end(closed.start_final_kpis(recs, KpiWindow(), f"{base}/kpi", f"{base}/_ckpt", "3h"))
    plain = spark.createDataFrame(
        [(loc, DAY + t, s, g) for loc, t, _, s, g in rows],
        "location_id string, forecast_time long, wind_speed_10m double, wind_gusts_10m double",
    )
    want = window_kpis(plain, KpiWindow())
    got = closed.read_final_kpis(spark, f"{base}/kpi").drop("window")
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    held = operator(progress, -1, "numRowsTotal")
    assert max(held) >= len(rows) and held[-1] <= 1


def test_late_rows_are_those_that_the_stream_drops(spark, scratch):
    base = scratch("late-rows")
    polls = [day("a"), day("b", 300) + [("b", 2 * 86400, 1, 0.0, 0.0)], day("c", 1200)]
    dropped = []
    for n, rows in enumerate(polls):  # a run per poll: every batch starts from the watermark of all before it
        land(spark, f"{base}/landing/poll={n}", rows)
        jobs.run_to_end(closed.start_late_rows(records(spark, base, None), f"{base}/late", f"{base}/_late"))
        query = closed.start_final_kpis(closed.once(records(spark, base)), KpiWindow(), f"{base}/kpi", f"{base}/_ckpt", "3h")
        dropped.append(sum(operator(jobs.run_to_end(query), -1, "numRowsDroppedByWatermark")))
    mark = 86400 - 600 - 3600
    want = [(loc, DAY + t) for loc, t, *_ in polls[1] if t <= mark] + [(loc, DAY + t) for loc, t, *_ in polls[2]]
    late = closed.read_late_rows(spark, f"{base}/late")
    assert sorted((r.location_id, r.forecast_time) for r in late.collect()) == sorted(want)
    assert dropped == [0, sum(t <= mark for _, t, *_ in polls[1]), len(polls[2])]
    assert late.count() == sum(dropped)
    assert late.where("event_time > watermark").count() == 0


def test_late_row_sink_can_replay_and_keeps_two_marks(spark, scratch):
    path = scratch("late-sink")
    sink = closed.LateRowSink(path)

    def batch(*hours):
        df = spark.createDataFrame([(h,) for h in hours], "h int")
        return df.selectExpr("h", f"timestamp_seconds({DAY} + h * 3600) AS event_time")

    sink(batch(1, 10), 0)
    assert closed.read_late_rows(spark, path) is None
    for _ in range(2):  # a replayed batch writes what it wrote
        sink(batch(9, 2, 20), 1)
    sink(batch(), 2)  # no rows: the mark stays
    sink(batch(19, 3), 3)
    late = closed.read_late_rows(spark, path)
    assert sorted((r.batch_id, r.h) for r in late.collect()) == [(1, 2), (1, 9), (3, 3), (3, 19)]
    marks = spark.read.parquet(f"{path}/marks").collect()
    assert sorted(r.batch_id for r in marks) == [2, 3]
    sink(batch(None), 4)
    assert closed.read_late_rows(spark, path).count() == 4
