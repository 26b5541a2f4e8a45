"""KPIs kept up to date from stored bucket partials.

Two keyed tables below one path, both partitioned by ``span`` (``SPAN_S`` seconds of
UTC time, a few hours), so that a batch reads and rewrites the spans of its own rows:

* ``points``: the newest speed and gust of every (location, time), each with its version;
* ``buckets``: the partial KPIs of every (location, bucket), as ``kpi.kpi_buckets`` gives them.

``update`` folds a batch in. The points that it changes are looked up, and each of
their buckets moves by the difference: sums and counts by what came less what went,
maxima up to what came. Only a bucket that lost its maximum to a lower revision, or
that holds speeds which sums cannot be moved by exactly, is worked out again from
its points. ``read_buckets`` gives the partials, from which 3 h, 6 h and corrected
KPIs are finished (``kpi.kpis_from_buckets``), without going back to the points.

Buckets are written before points: until the points are, the same batch finds the
same differences, and a replay behind that finds its bucket rows staged
(``operators.upsert``). So a batch counts once, whenever it is cut off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.functions.parse import in_time_range
from squall.operators.kpi import KpiWindow, extreme_sql, kpi_buckets, units_sql
from squall.operators.latest import latest_fields, merged_fields
from squall.operators.upsert import read_if_exists, read_partitions, touched_partitions, upsert_partitions

#: a fraction of a day, yet not too many folders
SPAN_S = 6 * 3600
KEY = ["location_id", "_time"]
FIELDS = ["wind_speed_10m", "wind_gusts_10m"]
VERSIONS = ["_v_speed", "_v_gust"]
POINTS = "location_id string, _time long, wind_speed_10m double, _v_speed long, wind_gusts_10m double, _v_gust long, span long"
SUMS = ["_sum", "_rest", "_cnt", "_max_speed", "_max_gust", "_ext"]
BUCKET_KEY = ["location_id", "bucket"]
#: ``_seq`` counts how often a bucket has been written
BUCKETS = (
    "location_id string, bucket long, _sum long, _rest double, _cnt long, _max_speed double, _max_gust double, "
    "_ext long, _seq long, span long"
)


def _span(seconds: str) -> Column:
    return F.floor(F.col(seconds) / SPAN_S).cast("long").alias("span")


def _bucket(slide: int) -> Column:
    return F.expr(f"_time - pmod(_time, {slide})").alias("bucket")


def _same(a: str, b: str, keys: list[str]) -> Column:
    """Equal keys of two aliased tables; null locations are one location."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def _merge_points(rows: DataFrame) -> DataFrame:
    return merged_fields(rows, [*KEY, "span"], FIELDS, VERSIONS)


def _merge_buckets(rows: DataFrame) -> DataFrame:
    """The row that was written last; a bucket has at most a stored and a new one."""
    newest = [F.max_by(c, "_seq").alias(c) for c in SUMS]
    return rows.groupBy(*BUCKET_KEY, "span").agg(*newest, F.max("_seq").alias("_seq"))


def changes(old: DataFrame, new: DataFrame, spec: KpiWindow) -> DataFrame:
    """Per (location, bucket) that ``new`` points touch, how its partials move from ``old`` points.

    ``_low_speed`` and ``_low_gust`` are the greatest values that were replaced;
    ``_inexact``: some speed is no exact unit, so sums cannot be moved by it.
    """
    before = old.alias("o").join(new.alias("n"), _same("o", "n", KEY), "left_semi")
    columns = [*KEY, *FIELDS, *VERSIONS]
    after = merged_fields(before.select(*columns).unionByName(new.select(*columns)), KEY, FIELDS, VERSIONS)
    sides = after.withColumn("_sign", F.lit(1)).unionByName(before.select(*columns).withColumn("_sign", F.lit(-1)))
    sides = sides.select(
        "location_id", _bucket(spec.slide_s), *FIELDS, "_sign",
        F.expr(units_sql(spec.avg_scale)).alias("_units"), F.expr(extreme_sql(spec.threshold)).alias("_is"),
    )
    return sides.groupBy(*BUCKET_KEY).agg(
        F.expr("sum(_units * _sign) AS _sum"),
        F.expr("sum(CASE WHEN wind_speed_10m IS NOT NULL THEN _sign ELSE 0 END) AS _cnt"),
        F.expr("sum(_is * _sign) AS _ext"),
        F.expr("max(wind_speed_10m) FILTER (WHERE _sign > 0) AS _max_speed"),
        F.expr("max(wind_gusts_10m) FILTER (WHERE _sign > 0) AS _max_gust"),
        F.expr("max(wind_speed_10m) FILTER (WHERE _sign < 0) AS _low_speed"),
        F.expr("max(wind_gusts_10m) FILTER (WHERE _sign < 0) AS _low_gust"),
        F.expr("bool_or(wind_speed_10m IS NOT NULL AND _units IS NULL) AS _inexact"),
    )


def _lowered(kind: str) -> Column:
    """Whether the stored maximum was replaced and nothing as great came."""
    return F.expr(f"coalesce(_low_{kind} >= s._max_{kind} AND (c._max_{kind} IS NULL OR c._max_{kind} < s._max_{kind}), false)")


def moved_buckets(buckets: DataFrame, points: DataFrame, new: DataFrame, spec: KpiWindow) -> DataFrame:
    """The rows of ``BUCKETS`` of every bucket that ``new`` points touch, given what is stored of its span."""
    change = changes(points, new, spec)
    both = change.alias("c").join(buckets.alias("s"), _same("c", "s", BUCKET_KEY), "left")
    stale = F.col("c._inexact") | _lowered("speed") | _lowered("gust")
    seq = (F.coalesce(F.col("s._seq"), F.lit(-1)) + 1).alias("_seq")
    rows = both.select(
        F.col("c.location_id").alias("location_id"), F.col("c.bucket").alias("bucket"),
        F.expr("CASE WHEN s._sum IS NOT NULL OR c._sum IS NOT NULL THEN coalesce(s._sum, 0) + coalesce(c._sum, 0) END AS _sum"),
        F.col("s._rest").alias("_rest"),
        F.expr("coalesce(s._cnt, 0) + c._cnt AS _cnt"),
        F.expr("greatest(s._max_speed, c._max_speed) AS _max_speed"),
        F.expr("greatest(s._max_gust, c._max_gust) AS _max_gust"),
        F.expr("coalesce(s._ext, 0) + c._ext AS _ext"),
        seq, stale.alias("_stale"),
    )
    again = rows.where("_stale").select(*BUCKET_KEY, "_seq")
    columns = [*KEY, *FIELDS, *VERSIONS]
    held = points.select(*columns).unionByName(new.select(*columns)).withColumn("bucket", _bucket(spec.slide_s))
    held = held.alias("p").join(again.alias("a"), _same("p", "a", BUCKET_KEY), "left_semi")
    fresh = kpi_buckets(merged_fields(held, KEY, FIELDS, VERSIONS), spec, "_time")
    fresh = fresh.alias("f").join(again.alias("a"), _same("f", "a", BUCKET_KEY))
    fresh = fresh.select(*(F.col(f"f.{c}").alias(c) for c in [*BUCKET_KEY, *SUMS]), F.col("a._seq").alias("_seq"))
    return rows.where("NOT _stale").drop("_stale").unionByName(fresh).withColumn("span", _span("bucket"))


def update(
    spark: SparkSession,
    records: DataFrame,
    path: str,
    spec: KpiWindow = KpiWindow(),
    version: str = "ingest_time",
    time_col: str = "forecast_time",
    batch: tuple[str, int] | None = None,
) -> None:
    """Fold ``records`` into the partials at ``path``. Records without a usable time drop out.

    ``batch`` (writer, number) makes a replay harmless; without it a write that is
    cut off between the two tables must not be repeated.
    """
    spec.check()
    if SPAN_S % spec.slide_s:
        raise ValueError("a bucket must lie within a span")
    timed = records.where(in_time_range(F.col(time_col))).withColumnRenamed(time_col, "_time")
    new = latest_fields(timed, KEY, FIELDS, version, VERSIONS).withColumn("span", _span("_time")).persist()
    try:
        spans = list(touched_partitions(new, ["span"]))
        points = read_partitions(spark, f"{path}/points", POINTS, ["span"], spans)
        buckets = read_partitions(spark, f"{path}/buckets", BUCKETS, ["span"], spans)
        points = spark.createDataFrame([], POINTS) if points is None else points
        buckets = spark.createDataFrame([], BUCKETS) if buckets is None else buckets
        rows = moved_buckets(buckets, points, new, spec).persist()
        try:
            upsert_partitions(spark, rows, f"{path}/buckets", ["span"], _merge_buckets, BUCKET_KEY, batch)
        finally:
            rows.unpersist()
        upsert_partitions(spark, new, f"{path}/points", ["span"], _merge_points, KEY, batch)
    finally:
        new.unpersist()


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The partials so far, as ``kpi.kpi_buckets`` gives them."""
    found = read_if_exists(spark, f"{path}/buckets")
    found = spark.createDataFrame([], BUCKETS) if found is None else found
    return found.select(*BUCKET_KEY, *SUMS)
