"""Fields that a fixed schema loses, read back from variants."""

from squall.functions.parse import odd_fields


def test_unnamed_and_wrongly_typed_fields(spark):
    texts = [
        '{"location_id":"a","forecast_time":1,"wind_speed_10m":2,"wind_gusts_10m":2.5,"pressure_msl":1e3}',
        '{"location_id":7,"forecast_time":1.5,"wind_speed_10m":"x","temperature_2m":null,"new":null,"deep":{"k":[1,2]}}',
        '{"forecast_time":"2024","ingest_time":true,"":0,"LOCATION_ID":"b"}',
        "[1,2]", "3", "not json", "", None, "{}",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, value string")
    got = {(r.n, r.field): (r.kind, r.text) for r in odd_fields(df, keep=["n"]).collect()}
    assert got == {
        (1, "location_id"): ("wrong_type", "7"),
        (1, "forecast_time"): ("wrong_type", "1.5"),
        (1, "wind_speed_10m"): ("wrong_type", "x"),
        (1, "new"): ("unnamed", "null"),
        (1, "deep"): ("unnamed", '{"k":[1,2]}'),
        (2, "forecast_time"): ("wrong_type", "2024"),
        (2, "ingest_time"): ("wrong_type", "true"),
        (2, ""): ("unnamed", "0"),
        (2, "LOCATION_ID"): ("unnamed", "b"),
    }
    assert odd_fields(df.limit(0), keep=["n"]).count() == 0


def test_counts_by_field(spark):
    df = spark.createDataFrame([(f'{{"extra":{i}}}',) for i in range(5)], "value string")
    assert [tuple(r) for r in odd_fields(df).groupBy("field", "kind").count().collect()] == [("extra", "unnamed", 5)]
