"""Streams looked into: state rows against records, progress as a table."""

import pytest

from squall.operators.kpi import KpiWindow
from squall.streaming import audit, jobs

from .test_closed import DAY, day, land, records


def test_open_windows_are_what_the_records_derive(spark, scratch):
    base = scratch("state")
    polls = [day("a"), [("a", 86400 + t, 1, 3.0, 30.0) for t in (0, 60, 7200)]]
    for n, rows in enumerate(polls):  # stopped and restarted in between
        land(spark, f"{base}/landing/poll={n}", rows)
        jobs.run_to_end(jobs.start_kpis(records(spark, base), KpiWindow(), jobs.KpiBatchSink(f"{base}/kpi", "3h"), f"{base}/_ckpt"))
    mark = 86400 + 7200 - 3600
    want = {}
    for _, t, _, speed, gust in polls[0] + polls[1]:
        for end in range(t // 600 * 600 + 600, t // 600 * 600 + 10801, 600):
            if end > mark:
                want.setdefault(end, []).append((speed, gust))
    got = {r.window_end_s - DAY: tuple(r)[2:] for r in audit.open_windows(spark, f"{base}/_ckpt").collect()}
    assert got == {
        end: (len(v), max(s for s, _ in v), max(g for _, g in v), int(any(g >= 25 for _, g in v)), sum(g >= 25 for _, g in v))
        for end, v in want.items()
    }


def test_progress_of_every_batch_becomes_a_row(spark, scratch):
    base = scratch("progress")
    listener = audit.ProgressTable(spark, f"{base}/progress")
    assert audit.read_progress(spark, f"{base}/progress").count() == 0
    spark.streams.addListener(listener)
    try:
        for n in range(2):
            land(spark, f"{base}/landing/poll={n}", day("a", 3600))
            query = jobs.start_kpis(records(spark, base), KpiWindow(), jobs.KpiBatchSink(f"{base}/kpi", "3h"), f"{base}/_ckpt")
            reports = jobs.run_to_end(query)
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    rows = [r for r in audit.read_progress(spark, f"{base}/progress").collect() if r.query_id == str(query.id)]
    assert sum(r.input_rows for r in rows) == 48
    last = jobs.state_metrics(reports)
    assert sum(r.dropped_rows for r in rows) == sum(m[3] for m in last) > 0
    assert len({r.batch_id for r in rows}) == len(rows)


def test_a_report_without_operators():
    row = audit.progress_row({"batchId": 3, "id": "q", "runId": "r", "numInputRows": 5})
    assert row[3] == 3 and row[5] == 5 and row[7:10] == (0, 0, 0)
    with pytest.raises(KeyError):
        audit.progress_row({})
