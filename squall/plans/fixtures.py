"""Adapters from the driver's test tables to the measurement data model.

``wx`` maps ``events`` onto forecast records (see FIXTURES.md §2):
location_id = event_type, forecast_time = epoch seconds of ts, ingest_time =
event_id, wind speed = value, gust = 1.5 x value, temperature null on every
7th id, precipitation parsed from the ``props`` JSON, pressure from the id.
Coordinates come from user_id so that points carry float fields.

Each Spark adapter has a SQL twin (``WX_SQL`` etc.) for the DuckDB oracle.
"""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.constants import HOURLY_VARIABLES, HOURS_PER_POLL, TOPIC
from squall.functions.parse import json_text
from squall.schema import RECORD_COLUMNS


_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. The test tables are read-only, so each session lists and
    reads the footer of a table once and reuses that DataFrame."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per_session = _TABLES.setdefault(spark, {})
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]


def epoch_seconds_sql(df: DataFrame, col: str, unit_s: int = 1) -> str:
    """SQL for epoch seconds of a timestamp column, floored to ``unit_s``.

    For TIMESTAMP_NTZ the difference to the NTZ epoch is a day-time interval
    computed without any time zone, so the result does not depend on the
    session zone (a cast to TIMESTAMP would). Sub-second parts are truncated
    (epochs here are positive).
    """
    if isinstance(df.schema[col].dataType, T.TimestampNTZType):
        secs = f"CAST(`{col}` - TIMESTAMP_NTZ'1970-01-01 00:00:00' AS BIGINT)"
    else:
        secs = f"unix_seconds(`{col}`)"
    return secs if unit_s == 1 else f"({secs} - pmod({secs}, {unit_s}))"


def epoch_seconds(df: DataFrame, col: str, unit_s: int = 1) -> Column:
    return F.expr(epoch_seconds_sql(df, col, unit_s))


def wx(spark: SparkSession, sf_dir: str, floor: int = 1) -> DataFrame:
    """Forecast records over ``events``; ``floor`` (seconds) rounds forecast_time
    down, so that several versions of one point exist."""
    ev = table(spark, sf_dir, "events")
    ft = epoch_seconds_sql(ev, "ts", floor)
    return ev.selectExpr(
        "event_type AS location_id",
        "64.0D + pmod(user_id, 10) / 8 AS latitude",
        "-22.0D + pmod(user_id, 10) / 4 AS longitude",
        f"{ft} AS forecast_time",
        "event_id AS ingest_time",
        "value AS wind_speed_10m",
        "value * 1.5D AS wind_gusts_10m",
        "CASE WHEN pmod(event_id, 7) <> 0 THEN value - 20 END AS temperature_2m",
        "from_json(props, 'k BIGINT').k / 100 AS precipitation",
        "CAST(1000 + pmod(event_id, 50) AS DOUBLE) AS pressure_msl",
    )


def wx_sql(floor: int = 1) -> str:
    """DuckDB twin of :func:`wx` as a SELECT over the ``events`` view."""
    ft = f"(epoch_us(ts) // {floor * 1000000}) * {floor}"
    return f"""
SELECT event_type AS location_id,
       64.0 + (user_id % 10) / 8 AS latitude,
       -22.0 + (user_id % 10) / 4 AS longitude,
       CAST({ft} AS BIGINT) AS forecast_time,
       event_id AS ingest_time,
       value AS wind_speed_10m,
       value * 1.5 AS wind_gusts_10m,
       CASE WHEN event_id % 7 <> 0 THEN value - 20 END AS temperature_2m,
       CAST(json_extract(props, '$.k') AS BIGINT) / 100 AS precipitation,
       CAST(1000 + event_id % 50 AS DOUBLE) AS pressure_msl
FROM events"""


def with_wx(sql: str, floor: int = 1) -> str:
    """Prefix a query with ``WITH wx AS (...)`` (merged into its own WITH, if any)."""
    head = f"WITH wx AS ({wx_sql(floor)})"
    body = sql.lstrip()
    if body[:4].upper() == "WITH":
        return f"{head},\n{body[4:].lstrip()}"
    return f"{head}\n{body}"


#: speeds from 10^-12 on to beyond 10^12: hundredths of ``value`` times 2 to this power
_EXPONENT = "event_id % 81 - 40"


def wide_speeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose speeds span 80 powers of two, of either sign; every 13th has none."""
    units = "CAST(rint(wind_speed_10m * 100) AS BIGINT) * CASE WHEN pmod(ingest_time, 3) = 0 THEN -1 ELSE 1 END"
    power = f"pow(2D, {_EXPONENT.replace('event_id', 'ingest_time')})"
    speed = f"CASE WHEN pmod(ingest_time, 13) <> 0 THEN {units} * {power} END"
    return wx(spark, sf_dir).withColumn("wind_speed_10m", F.expr(speed))


WIDE_SPEEDS_SQL = f"""
SELECT event_type AS location_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS forecast_time,
       CASE WHEN event_id % 13 <> 0 THEN
         CAST(round(value * 100) AS HUGEINT) * (CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END)
         * (CAST(1 AS HUGEINT) << CAST({_EXPONENT} + 40 AS INTEGER)) END AS units
FROM events"""


# --- record text --------------------------------------------------------------
# Every 10th message is damaged; the kind cycles with the tens digit.
DAMAGE_EVERY = 10
JSON_DAMAGE_KINDS = 5  # csv line, string time, fractional time, empty, typed-wrong gust (kept)
CSV_DAMAGE_KINDS = 3  # bad time, bad speed, truncated line


def record_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-like messages (msg_offset, value) carrying wx records as JSON text."""
    w = wx(spark, sf_dir)
    return w.select(F.col("ingest_time").alias("msg_offset"), json_text(RECORD_COLUMNS).alias("value"))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`record_messages`, but every 10th message is damaged."""
    w = wx(spark, sf_dir)
    off = F.col("ingest_time")
    kind = F.pmod(F.expr(f"ingest_time div {DAMAGE_EVERY}"), F.lit(JSON_DAMAGE_KINDS))
    loc, ft = F.col("location_id"), F.col("forecast_time")
    clean = json_text(RECORD_COLUMNS)
    damaged = (
        F.when(kind == 0, F.concat_ws(",", loc, ft.cast("string"), F.col("wind_speed_10m").cast("string")))
        .when(kind == 1, F.format_string('{"location_id":"%s","forecast_time":"x"}', loc))
        .when(kind == 2, F.format_string('{"location_id":"%s","forecast_time":%d.7}', loc, ft))
        .when(kind == 3, F.lit(""))
        .otherwise(
            F.format_string('{"location_id":"%s","forecast_time":%d,"wind_gusts_10m":"12.5","extra":1}', loc, ft)
        )
    )
    value = F.when(F.pmod(off, F.lit(DAMAGE_EVERY)) == 0, damaged).otherwise(clean)
    return w.select(off.alias("msg_offset"), value.alias("value"))


def _damaged_messages_sql() -> str:
    off, loc = "event_id", "event_type"
    ft, gust, extra = "CAST(epoch_us(ts) // 1000000 AS BIGINT)", "12.5", 1
    kind = f"({off} // {DAMAGE_EVERY}) % {JSON_DAMAGE_KINDS}"
    head = f"'{{\"location_id\":\"' || {loc} || '\",\"forecast_time\":'"
    clean = f"CAST(to_json({{{', '.join(f"'{c}': {c}" for c in RECORD_COLUMNS)}}}) AS VARCHAR)"
    return f"""
SELECT event_id AS msg_offset, CASE
  WHEN {off} % {DAMAGE_EVERY} <> 0 THEN clean
  WHEN {kind} = 0 THEN {loc} || ',' || {ft} || ',' || value
  WHEN {kind} = 1 THEN {head} || '"x"}}'
  WHEN {kind} = 2 THEN {head} || {ft} || '.7}}'
  WHEN {kind} = 3 THEN ''
  ELSE {head} || {ft} || ',"wind_gusts_10m":"{gust}","extra":{extra}}}' END AS value
FROM events JOIN (SELECT ingest_time AS event_id, {clean} AS clean FROM ({wx_sql()}) w) c USING (event_id)"""


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``location,yyyy-MM-ddTHH:mmZ,speed`` lines from events; every 10th damaged."""
    ev = table(spark, sf_dir, "events")
    off = F.col("event_id")
    kind = F.pmod(F.expr(f"event_id div {DAMAGE_EVERY}"), F.lit(CSV_DAMAGE_KINDS))
    t = F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm'Z'")
    speed = F.col("value").cast("string")
    bad = F.pmod(off, F.lit(DAMAGE_EVERY)) == 0
    line = (
        F.when(bad & (kind == 0), F.concat_ws(",", "event_type", F.lit("not-a-time"), speed))
        .when(bad & (kind == 1), F.concat_ws(",", "event_type", t, F.lit("n/a")))
        .when(bad & (kind == 2), F.col("event_type"))
        .otherwise(F.concat_ws(",", "event_type", t, speed))
    )
    return ev.select(off.alias("msg_offset"), line.alias("value"))


DAMAGED_MESSAGES_SQL = _damaged_messages_sql()

CSV_LINES_SQL = f"""
SELECT event_id AS msg_offset,
       CASE WHEN event_id % {DAMAGE_EVERY} = 0 AND (event_id // {DAMAGE_EVERY}) % {CSV_DAMAGE_KINDS} = 0
              THEN concat_ws(',', event_type, 'not-a-time', CAST(value AS VARCHAR))
            WHEN event_id % {DAMAGE_EVERY} = 0 AND (event_id // {DAMAGE_EVERY}) % {CSV_DAMAGE_KINDS} = 1
              THEN concat_ws(',', event_type, strftime(ts, '%Y-%m-%dT%H:%MZ'), 'n/a')
            WHEN event_id % {DAMAGE_EVERY} = 0 AND (event_id // {DAMAGE_EVERY}) % {CSV_DAMAGE_KINDS} = 2
              THEN event_type
            ELSE concat_ws(',', event_type, strftime(ts, '%Y-%m-%dT%H:%MZ'), CAST(value AS VARCHAR)) END AS value
FROM events"""


# --- documents and dimensions -------------------------------------------------
EMBED_HOURS = 24


def embedding_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-like documents from ``embeddings``: speed = the vector, gust = elements 3..32."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").cast("string").alias("location_id"),
        F.struct(
            F.col("embedding").alias("wind_speed_10m"),
            F.slice("embedding", 3, 30).alias("wind_gusts_10m"),
        ).alias("hourly"),
    )


def nation_location_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One single-entry map<name, coords> per nation row."""
    n = table(spark, sf_dir, "nation")
    coords = F.struct(
        (F.lit(63.0) + F.col("n_nationkey") / F.lit(8)).alias("latitude"),
        (F.lit(-24.0) + F.col("n_regionkey") / F.lit(2)).alias("longitude"),
    )
    return n.select(F.col("n_nationkey"), F.create_map(F.col("n_name"), coords).alias("locations"))


NATION_LOCATIONS_SQL = """
SELECT n_nationkey, n_name AS location_id, 63.0 + n_nationkey / 8 AS latitude, -24.0 + n_regionkey / 2 AS longitude
FROM nation"""


# every 11th version is missing, and four neighbours share one
TIED_VERSION = "CASE WHEN event_id % 11 <> 0 THEN event_id {div} 4 END"


def tied_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly records whose ``ingest_time`` is null in places and tied elsewhere."""
    version = F.expr(TIED_VERSION.format(div="div").replace("event_id", "ingest_time"))
    return wx(spark, sf_dir, floor=3600).withColumn("ingest_time", version)


def tied_versions_sql() -> str:
    version = TIED_VERSION.format(div="//").replace("event_id", "ingest_time")
    return f"SELECT * REPLACE (CAST({version} AS BIGINT) AS ingest_time) FROM ({wx_sql(3600)}) h"


POLL_START = 1704067200


def api_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API documents from ``embeddings``: one location per vector, hourly arrays of eighths."""
    emb = table(spark, sf_dir, "embeddings")
    eighths = F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("double") / 8)
    hours = F.transform("embedding", lambda _, i: F.lit(POLL_START).cast("bigint") + i * 3600)
    arrays = [eighths.alias(v) if v != "wind_gusts_10m" else F.slice(eighths, 3, 30).alias(v) for v in HOURLY_VARIABLES]
    return emb.select(F.col("vec_id").cast("string").alias("location_id"), F.struct(hours.alias("time"), *arrays).alias("hourly"))


def api_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A location dimension for :func:`api_documents`."""
    vec = F.col("vec_id")
    return table(spark, sf_dir, "embeddings").select(
        vec.cast("string").alias("location_id"),
        (F.pmod(vec, F.lit(90)) / 8).alias("latitude"),
        (F.pmod(vec, F.lit(180)) / 4).alias("longitude"),
    )


def _eighth(i: str) -> str:
    return f"CAST(floor(CAST(embedding[{i}] AS DOUBLE) * 64) AS DOUBLE) / 8"


API_RECORDS_SQL = f"""
SELECT location_id, (vec_id % 90) / 8 AS latitude, (vec_id % 180) / 4 AS longitude,
       CAST({POLL_START} + 3600 * i AS BIGINT) AS forecast_time, CAST(1 AS BIGINT) AS ingest_time,
       {", ".join(f"{_eighth('i + 3' if v == 'wind_gusts_10m' else 'i + 1')} AS {v}" for v in HOURLY_VARIABLES)}
FROM (SELECT CAST(vec_id AS VARCHAR) AS location_id, vec_id, embedding,
             UNNEST(generate_series(0, least(len(embedding), len(embedding[3:32]), {HOURS_PER_POLL}) - 1)) AS i
      FROM embeddings WHERE embedding IS NOT NULL) d"""


# --- landed message files (for stream sources) --------------------------------


def message_rows(rows: DataFrame, value: Column, offset: Column, timestamp: Column) -> DataFrame:
    """Rows as Kafka-shaped messages."""
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.spark_partition_id().alias("partition"),
        offset.alias("offset"),
        timestamp.alias("timestamp"),
    )


def land_messages(spark: SparkSession, sf_dir: str, path: str, where: Column | None = None, floor: int = 1) -> None:
    """Write wx records as Kafka-shaped message files under ``path``, one file per task of the scan."""
    w = wx(spark, sf_dir, floor=floor)
    if where is not None:
        w = w.where(where)
    time = F.timestamp_seconds(F.col("forecast_time"))
    message_rows(w, json_text(RECORD_COLUMNS), F.col("ingest_time"), time).write.parquet(path)


def land_polls(spark: SparkSession, sf_dir: str, path: str, polls: list[Column], floor: int = 1) -> int:
    """Land one folder ``poll=N`` per condition and return the files of each:
    all polls get as many as the scan has tasks, so that a stream can take one
    poll per batch."""
    w = wx(spark, sf_dir, floor=floor)
    files = max(1, w.rdd.getNumPartitions())
    for n, where in enumerate(polls):
        rows = w.where(where).repartition(files)
        time = F.timestamp_seconds(F.col("forecast_time"))
        message_rows(rows, json_text(RECORD_COLUMNS), F.col("ingest_time"), time).write.parquet(f"{path}/poll={n}")
    return files


def time_ordered_polls(spark: SparkSession, sf_dir: str, n: int = 4) -> list[Column]:
    """Conditions that deal the whole table out to ``n`` polls by forecast time."""
    t = F.col("forecast_time")
    lo, hi = wx(spark, sf_dir).agg(F.min(t), F.max(t)).first()
    if lo is None:
        return [F.lit(True)] * n
    cuts = [lo + (hi - lo) * k // n for k in range(1, n)]
    return [
        F.lit(True) if a is b else (t < b) if a is None else (t >= a) if b is None else (t >= a) & (t < b)
        for a, b in zip([None, *cuts], [*cuts, None])
    ]
