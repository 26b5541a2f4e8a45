"""The line sink: each line once, whatever attempts fail; and the final job that uses it."""

import os

import pytest
from pyspark.sql import Row

from squall.sources import line_sink
from squall.sources.line_sink import LineSink, LineWriter
from squall.streaming import closed

from .test_closed import day, land


def lines_of(spark, path):
    return sorted((r.batch_id, r.value) for r in line_sink.read_lines(spark, path).collect())


def test_failed_and_doubled_attempts_leave_each_line_once(spark, scratch):
    path = scratch("lines")
    writer = LineWriter(path)
    rows = [Row(line=f"l{i}") for i in range(5)]

    def cut_off():
        yield rows[0]
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(cut_off())
    writer.write(iter(rows[:3]))  # an attempt that ended, but was not the one that counts
    said = [writer.write(iter(rows[:3])), writer.write(iter(rows[3:])), writer.write(iter([]))]
    assert [m.lines for m in said] == [3, 2, 0]
    assert line_sink.read_lines(spark, path).count() == 0  # nothing before the commit
    writer.commit(said, 0)
    want = [(0, f"l{i}") for i in range(5)]
    assert lines_of(spark, path) == want
    folder = path.removeprefix("file:")
    assert os.listdir(f"{folder}/_staged") == []
    writer.commit([writer.write(iter(rows)), None], 0)  # the batch is run again after its commit
    assert lines_of(spark, path) == want and os.listdir(f"{folder}/_staged") == []
    said = [writer.write(iter(rows[:1]))]
    writer.abort(said, 1)
    assert lines_of(spark, path) == want
    os.makedirs(f"{folder}/_batch-1")  # a commit that was cut off
    open(f"{folder}/_batch-1/part-00000.txt", "w").write("half\n")
    writer.commit([writer.write(iter(rows[:2]))], 1)
    assert lines_of(spark, path) == [*want, (1, "l0"), (1, "l1")]
    writer.commit([writer.write(iter([]))], 2)
    assert sorted(os.listdir(folder)) == ["_staged", "batch_id=0", "batch_id=1"]


def test_one_string_column_is_wanted(spark):
    schema = spark.createDataFrame([], "a int").schema
    with pytest.raises(ValueError):
        LineSink({"path": "x"}).streamWriter(schema, False)
    with pytest.raises(ValueError):
        LineSink({}).streamWriter(spark.createDataFrame([], "a string").schema, False)


def test_the_final_job(spark, scratch):
    from squall.streaming.app import run

    base = scratch("final-app")
    rows = day("a") + day("b", 1200)
    args = ["--files", f"{base}/landing/*", "--out", f"{base}/out", "--checkpoint", f"{base}/ckpt", "--available-now", "--lines"]
    land(spark, f"{base}/landing/poll=0", rows + rows[:20])
    run(spark, ["final", *args])
    land(spark, f"{base}/landing/poll=1", rows + [("a", 2 * 86400, 1, 1.0, 1.0)])
    run(spark, ["final", *args])
    for label in ("3h", "6h"):
        kpis = closed.read_final_kpis(spark, f"{base}/out/kpi/{label}")
        lines = line_sink.read_lines(spark, f"{base}/out/lines/{label}")
        assert 0 < kpis.count() == kpis.select("location_id", "window_end_s").distinct().count() == lines.count()
        assert lines.where(f"value NOT LIKE '%,window={label} avg_wind_speed_10m=%'").count() == 0
    assert closed.read_late_rows(spark, f"{base}/out/late").count() == sum(t <= 86400 - 600 - 3600 for _, t, *_ in rows)
