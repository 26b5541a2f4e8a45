"""Array flattening, location dimension, enrichment, limits."""

from pyspark.sql import functions as F

from squall.operators.arrays import hourly_rows, with_ingest_time
from squall.operators.enrich import enrich
from squall.operators.limits import first_n_per_key, has_data, last_n
from squall.schema import DOCUMENT
from squall.sources.locations import configured_locations, explode_locations, read_location_document


def _docs(spark, docs):
    return spark.createDataFrame(docs, DOCUMENT).withColumn("location_id", F.lit("x"))


def test_shortest_array_wins(spark):
    hourly = {"time": [1, 2, 3], "wind_speed_10m": [1.0, None], "wind_gusts_10m": [1.0, 2.0, 3.0],
              "temperature_2m": [0.0, 0.0, 0.0], "precipitation": [0.0, 0.0, 0.0], "pressure_msl": [1.0, 1.0, 1.0]}
    rows = hourly_rows(_docs(spark, [(1.0, 2.0, hourly)]), keep=["location_id"]).collect()
    assert len(rows) == 2
    assert rows[1].wind_speed_10m is None and rows[1].forecast_time == 2


def test_missing_hourly_or_array_gives_no_rows(spark):
    no_hourly = (1.0, 2.0, None)
    no_array = (1.0, 2.0, {"time": [1, 2], "wind_speed_10m": [1.0, 2.0]})
    assert hourly_rows(_docs(spark, [no_hourly, no_array])).count() == 0


def test_limit_24(spark):
    n = 40
    hourly = {k: list(range(n)) if k == "time" else [float(i) for i in range(n)] for k in DOCUMENT["hourly"].dataType.names}
    df = with_ingest_time(hourly_rows(_docs(spark, [(1.0, 2.0, hourly)])), 123)
    rows = df.collect()
    assert len(rows) == 24 and {r.ingest_time for r in rows} == {123}


def test_location_document(spark, scratch):
    path = scratch("loc")
    spark.createDataFrame(
        [('{"locations": {"reykjavik": {"latitude": 64.13, "longitude": -21.94}, "akureyri": {"latitude": 65.68, "longitude": -18.09}}}',)],
        "value string",
    ).write.text(path)
    got = {r.location_id: (r.latitude, r.longitude) for r in read_location_document(spark, path).collect()}
    assert got == {"reykjavik": (64.13, -21.94), "akureyri": (65.68, -18.09)}


def test_configured_locations_enrich(spark):
    dim = configured_locations(spark)
    facts = spark.createDataFrame([("reykjavik", 1), ("nowhere", 2)], "location_id string, forecast_time long")
    out = enrich(facts, dim, "location_id").collect()
    assert len(out) == 1 and out[0].latitude == 64.13


def test_planner_decides_how_to_join(spark):
    dim = configured_locations(spark)
    facts = spark.createDataFrame([("reykjavik", 1)], "location_id string, forecast_time long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold, join in (("10m", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            out = enrich(facts.limit(1), dim.limit(3), "location_id")
            assert len(out.collect()) == 1
            assert join in out._jdf.queryExecution().executedPlan().toString()  # with AQE's final sizes
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_map_explode(spark):
    df = spark.createDataFrame([({"a": (1.0, 2.0), "b": (3.0, 4.0)},)], "locations map<string, struct<latitude: double, longitude: double>>")
    assert sorted(tuple(r) for r in explode_locations(df).collect()) == [("a", 1.0, 2.0), ("b", 3.0, 4.0)]


def test_limits(spark):
    df = spark.createDataFrame([(k, i) for k in ("a", "b") for i in range(10)], "k string, i int")
    top = first_n_per_key(df, ["k"], [F.col("i").desc()], 3).collect()
    assert sorted((r.k, r.i) for r in top) == [("a", 7), ("a", 8), ("a", 9), ("b", 7), ("b", 8), ("b", 9)]
    assert [r.i for r in last_n(df.where("k = 'a'"), [F.col("i").desc()], 2).collect()] == [9, 8]
    assert has_data(df).first().has_data is True
    assert has_data(df.where("i > 100")).first().has_data is False


def test_dataset_size_report(spark, scratch):
    import os

    from squall.operators.files import dataset_size

    path = scratch("ds")
    spark.range(1000).withColumn("g", F.col("id") % 2).repartition(3).write.partitionBy("g").parquet(path)
    rows = {r.entry: r for r in dataset_size(spark, path).collect()}
    local = path.replace("file:", "")
    for g in ("g=0", "g=1"):
        files = [f for f in os.listdir(f"{local}/{g}") if f.endswith(".parquet")]
        assert rows[g].files == len(files)
        assert rows[g].bytes == sum(os.path.getsize(f"{local}/{g}/{f}") for f in files)
        assert rows[g].rows == 500
    assert rows[None].rows == 1000 and rows[None].bytes == rows["g=0"].bytes + rows["g=1"].bytes
    assert rows[None].size.endswith(" K") or rows[None].size.isdigit()


def test_human_size(spark):
    from squall.operators.files import human_size

    df = spark.createDataFrame([(512,), (55755,), (3 * 1024**3,)], "b long")
    assert [r.s for r in df.select(human_size(F.col("b")).alias("s")).collect()] == ["512", "54.4 K", "3.0 G"]


def test_array_missing_from_document_type(spark):
    df = spark.createDataFrame([("x", {"time": [1, 2], "wind_speed_10m": [1.0, 2.0]})],
                               "location_id string, hourly struct<time: array<bigint>, wind_speed_10m: array<double>>")
    assert hourly_rows(df, keep=["location_id"]).count() == 0
    assert hourly_rows(df, keep=["location_id"], arrays=("time", "wind_speed_10m")).count() == 2
