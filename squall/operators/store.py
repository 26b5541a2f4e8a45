"""Forecast points: record -> point, long form, a keyed parquet point store,
measurement and time-range reads, and threshold classes.

A point is (measurement, tag ``location_id``, ``_time`` in unix seconds, typed
fields). The store is parquet partitioned by ``_measurement`` and
``event_date`` (UTC day of ``_time``) so measurement and range predicates
prune partitions, and ``_time`` bounds reach the scan as pushed filters.
Writes merge into the touched partitions field by field (the highest version
of each field wins, in any arrival order), then replace only those partitions.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.constants import POINT_MEASUREMENT, THRESHOLD_STEPS
from squall.functions.parse import in_time_range
from squall.operators.latest import latest_fields, merged_fields
from squall.operators.upsert import merge_tasks, read_if_exists, read_partitions, upsert_partitions
from squall.schema import POINT_FIELDS, POINT_FLOAT_FIELDS, POINT_INT_FIELDS

KEY = ["_measurement", "location_id", "_time"]
#: days of a range read whose folders are looked up one by one
LISTED_DAYS = 100
PARTITIONS = ["_measurement", "event_date"]
CLUSTER_BY = ["location_id", "_time"]


def to_points(records: DataFrame, measurement: str = POINT_MEASUREMENT) -> DataFrame:
    """Records to wide points: tag, typed fields, timestamp = forecast_time.

    Rows without a timestamp, or with one that no calendar day has, cannot be
    stored and are dropped.
    """
    fields = [F.col(f).cast("double").alias(f) for f in POINT_FLOAT_FIELDS]
    fields += [F.col(f).cast("bigint").alias(f) for f in POINT_INT_FIELDS]
    out = records.where(in_time_range(F.col("forecast_time"))).select(
        F.lit(measurement).alias("_measurement"),
        "location_id",
        F.col("forecast_time").cast("bigint").alias("_time"),
        *fields,
    )
    return out.select(*KEY, *POINT_FIELDS)


def points_long(points: DataFrame, fields: Sequence[str] = POINT_FIELDS) -> DataFrame:
    """Wide points to (series, _time, _field, _value) rows; null fields omitted."""
    present = [f for f in fields if f in points.columns]
    typed = points.select(*KEY, *[F.col(f).cast("double").alias(f) for f in present])
    long = typed.unpivot(KEY, present, "_field", "_value")
    return long.where(F.col("_value").isNotNull())


def latest_points(points: DataFrame, version: str = "ingest_time") -> DataFrame:
    """Merge repeated points: per key, each field's newest non-null value."""
    return latest_fields(points, KEY, POINT_FIELDS, version).select(*KEY, *POINT_FIELDS)


def _event_date(seconds: Column) -> Column:
    # UTC calendar day of unix seconds, independent of the session zone
    return F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))


def stored_points(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored points at ``path``, or None when no store exists yet."""
    return read_if_exists(spark, path)


def _version_col(field: str) -> str:
    return f"_v_{field}"


#: columns of a stored point
STORED = T.StructType(
    [T.StructField(c, T.LongType() if c == "_time" else T.StringType()) for c in KEY]
    + [T.StructField(f, T.DoubleType()) for f in POINT_FLOAT_FIELDS]
    + [T.StructField(f, T.LongType()) for f in POINT_INT_FIELDS]
    + [T.StructField(_version_col(f), T.LongType()) for f in POINT_FIELDS]
    + [T.StructField("event_date", T.DateType())]
)


def _merge_versions(rows: DataFrame) -> DataFrame:
    """Stored and new rows, each unique by key, as one row per key."""
    return merged_fields(rows, [*KEY, *PARTITIONS[1:]], POINT_FIELDS, [_version_col(f) for f in POINT_FIELDS])


def write_points(
    spark: SparkSession,
    points: DataFrame,
    path: str,
    version: str = "ingest_time",
    batch: tuple[str, int] | None = None,
) -> None:
    """Upsert points into the store at ``path``.

    Every field is stored with the version it came from (``_v_<field>``), so
    a merge keeps, field by field, the value of the highest version (ties: the
    greatest value; a value without a version yields to any that has one)
    whatever the order in which writes arrive, and replaying a write changes
    nothing. Only the (measurement, day) partitions the new points touch are
    listed, read and rewritten (see ``operators.upsert``, also for ``batch``).
    The points are counted first: that sets the number of tasks that merge them.
    """
    versions = [_version_col(f) for f in POINT_FIELDS]
    day = _event_date(F.col("_time")).alias("event_date")
    # dealt out by keys that no plan knows as constants, so both aggregations find them in place
    dealt = points.repartition(merge_tasks(points.count()), *CLUSTER_BY)
    new = latest_fields(dealt, KEY, POINT_FIELDS, version, versions).select(*KEY, day, *POINT_FIELDS, *versions)
    upsert_partitions(spark, new, path, PARTITIONS, _merge_versions, cluster_by=CLUSTER_BY, batch=batch)


def read_days(spark: SparkSession, path: str, measurement: str, days: Sequence[date]) -> DataFrame | None:
    """Stored points of one measurement on the given days; only their folders are listed and read."""
    found = read_partitions(spark, path, STORED, PARTITIONS, [(measurement, d) for d in days])
    return None if found is None else found.select(*KEY, *POINT_FIELDS, "event_date")


def read_points(spark: SparkSession, path: str) -> DataFrame:
    """All stored points (without their per-field versions)."""
    return spark.read.parquet(path).select(*KEY, *POINT_FIELDS, "event_date")


def _seconds(t: datetime | int) -> int:
    if isinstance(t, int):
        return t
    if t.tzinfo is None:
        t = t.replace(tzinfo=timezone.utc)
    return int(t.timestamp())


def read_range(
    spark: SparkSession,
    path: str,
    measurement: str,
    start: datetime | int,
    stop: datetime | int,
    long: bool = True,
) -> DataFrame:
    """Points of one measurement with ``start <= _time < stop`` (half-open).

    A range of up to ``LISTED_DAYS`` days reads its days' folders and lists
    nothing else of the store; a longer one prunes the store's partitions.
    """
    lo, hi = _seconds(start), _seconds(stop)
    day_lo = datetime.fromtimestamp(lo, timezone.utc).date()
    day_hi = datetime.fromtimestamp(max(hi - 1, lo), timezone.utc).date()
    days = (day_hi - day_lo).days + 1
    if days > LISTED_DAYS:
        stored = read_points(spark, path)
    else:
        stored = read_days(spark, path, measurement, [day_lo + timedelta(days=d) for d in range(days)])
    if stored is None:
        stored = spark.createDataFrame([], STORED)
    stored = stored.where(
        (F.col("_measurement") == F.lit(measurement)) & F.col("event_date").between(F.lit(day_lo), F.lit(day_hi))
    )
    points = stored.where((F.col("_time") >= F.lit(lo)) & (F.col("_time") < F.lit(hi))).select(*KEY, *POINT_FIELDS)
    return points_long(points) if long else points


def last_range(
    spark: SparkSession, path: str, measurement: str, span: str, as_of: datetime | int
) -> DataFrame:
    """``range(start: -span)`` evaluated at ``as_of``."""
    from squall.operators.kpi import interval_seconds

    stop = _seconds(as_of)
    return read_range(spark, path, measurement, stop - interval_seconds(span), stop)


def threshold_class(value: Column, steps: Sequence[tuple[float | None, str]] = THRESHOLD_STEPS) -> Column:
    """Colour of the highest step whose lower bound ``value`` reaches.

    ``steps`` is ordered by bound with ``None`` as the base step. A null
    value gets no colour.
    """
    base = [c for b, c in steps if b is None]
    bounded = sorted(((b, c) for b, c in steps if b is not None), key=lambda s: s[0], reverse=True)
    expr = None
    for bound, colour in bounded:
        cond = value >= F.lit(float(bound))
        expr = F.when(cond, F.lit(colour)) if expr is None else expr.when(cond, F.lit(colour))
    fallback = F.when(value.isNotNull(), F.lit(base[0])) if base else F.lit(None)
    return fallback if expr is None else expr.otherwise(fallback)
