"""Record parsing edge cases (FIXTURES.md §4) and event time."""

from pyspark.sql import functions as F

from squall.functions.parse import event_time, parse_csv, parse_json, split_bad, utc_text


def _parse(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    return {r.i: r for r in parse_json(df, "value", keep=["i"], with_status=True).collect()}


def test_bad_record_kinds(spark):
    got = _parse(
        spark,
        [
            "reykjavik,2025-11-27T05:00Z,10.5",
            '{"location_id":"b","forecast_time":"x"}',
            '{"location_id":"c","forecast_time":1735526400,"wind_gusts_10m":"12.5","extra":1}',
            '{"location_id":"d","forecast_time":1735526400.7}',
            None,
            "",
            '{"location_id":"e","forecast_time":1735526400,"wind_speed_10m":3.5}',
            '{"forecast_time":"x","wind_speed_10m":1.0}',
        ],
    )
    assert got[0].is_bad and got[0].bad_reason == "unparsable" and got[0].location_id is None
    assert got[1].is_bad and got[1].location_id == "b" and got[1].forecast_time is None
    assert not got[2].is_bad and got[2].location_id == "c" and got[2].wind_gusts_10m is None
    assert got[2].forecast_time == 1735526400
    assert got[3].is_bad and got[3].location_id == "d" and got[3].forecast_time is None
    assert got[4].is_bad and got[4].bad_reason == "empty"
    assert got[5].is_bad and got[5].bad_reason == "empty"
    assert not got[6].is_bad and got[6].wind_speed_10m == 3.5 and got[6].bad_reason is None
    assert got[7].is_bad and got[7].bad_reason == "no_forecast_time" and got[7].wind_speed_10m == 1.0


def test_split_bad(spark):
    df = spark.createDataFrame([('{"location_id":"a","forecast_time":1}',), ("junk",)], "value string")
    good, bad = split_bad(parse_json(df, "value", with_status=True))
    assert good.count() == 1 and bad.count() == 1
    assert "is_bad" not in good.columns


def test_csv_lines(spark):
    df = spark.createDataFrame(
        [("reykjavik,2025-11-27T05:00Z,10.5",), ("akureyri,not-a-time,7.2",), ("keflavik,2025-11-27T05:00Z,n/a",), ("solo",)],
        "value string",
    )
    rows = parse_csv(df, "value").collect()
    assert rows[0].location_id == "reykjavik" and rows[0].forecast_time == 1764219600 and rows[0].wind_speed_10m == 10.5
    assert not rows[0].is_bad
    assert all(r.is_bad for r in rows[1:])


def test_event_time_is_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        df = spark.createDataFrame([(1761440400,)], "forecast_time long")
        r = df.select(
            F.unix_seconds(event_time("forecast_time")).alias("s"), utc_text(event_time("forecast_time")).alias("u")
        ).first()
        assert r.s == 1761440400
        assert r.u == "2025-10-26 01:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_ntz_epoch_seconds_ignore_session_zone(spark):
    from squall.plans.fixtures import epoch_seconds

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("Europe/Paris", "America/New_York", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.sql("SELECT TIMESTAMP_NTZ'2024-07-01 12:00:00.75' AS ts UNION ALL SELECT TIMESTAMP_NTZ'2024-01-15 23:59:59' AS ts")
            got = sorted(r.s for r in df.select(epoch_seconds(df, "ts").alias("s")).collect())
            hours = sorted(r.h for r in df.select(epoch_seconds(df, "ts", 3600).alias("h")).collect())
            assert got == [1705363199, 1719835200], tz
            assert hours == [1705359600, 1719835200], tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_apply_defaults_keeps_explicit_settings(spark):
    from squall.session import apply_defaults

    applied = apply_defaults(spark, {"spark.sql.shuffle.partitions": "4000", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"})
    try:
        assert "spark.sql.shuffle.partitions" not in applied  # set by the test session
        assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "64m"
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
