"""Registered queries: key -> (spark builder, DuckDB oracle SQL or None).

Every builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole test tables. Oracle SQL runs in DuckDB over views with the same table
names. Column names match between the two.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.constants import (
    CLUSTER_MEASUREMENT,
    CLUSTER_PANEL_RANGE,
    EXTREME_GUST_THRESHOLD,
    FORECAST_PANEL_RANGE,
    KPI_MEASUREMENT,
    LOG_ERROR_PATTERN,
    LOG_TAIL_LINES,
    POINT_MEASUREMENT,
    THRESHOLD_STEPS,
)
from squall.functions import lines, parse
from squall.functions.parse import event_time, utc_text
from squall.operators import arrays, enrich, files, kpi, latest, limits, partials, store
from squall.operators.kpi import KpiWindow
from squall.plans import fixtures as fx
from squall.plans.fixtures import with_wx
from squall.schema import KPI_COLUMNS, MESSAGE_RECORD, POINT_FIELDS, RECORD, RECORD_COLUMNS
from squall.session import delete_path, scratch_path
from squall.sources import line_sink, locations, streams
from squall.sources.files import read_json_records
from squall.streaming import audit, closed, jobs

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Builder
    oracle: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(fn, oracle)
        return fn

    return deco


THR = EXTREME_GUST_THRESHOLD
K3 = kpi.KpiWindow("3 hours", "10 minutes", THR)
K6 = kpi.KpiWindow("6 hours", "10 minutes", THR)
# corrected mode: durations count distinct forecast hours
K3_HOURS = kpi.KpiWindow("3 hours", "10 minutes", THR, distinct_hours=True)


def kpi_sql(spec: kpi.KpiWindow, source: str = "wx", extra: str = "") -> str:
    """Oracle for a KPI window: fan each row out to its windows, then aggregate."""
    size, slide, thr, sc = spec.size_s, spec.slide_s, float(spec.threshold), spec.avg_scale
    ext = f"CASE WHEN wind_gusts_10m >= CAST({thr} AS DOUBLE) THEN 1 ELSE 0 END"
    hours = f"SUM({ext})"
    if spec.distinct_hours:
        hours = f"COUNT(DISTINCT CASE WHEN wind_gusts_10m >= CAST({thr} AS DOUBLE) THEN forecast_time // 3600 END)"
    return f"""
SELECT location_id,
       CAST(SUM(CAST(wind_speed_10m AS DECIMAL(18,{sc}))) AS DOUBLE) / NULLIF(COUNT(wind_speed_10m), 0)
         AS avg_wind_speed_10m,
       MAX(wind_speed_10m) AS max_wind_speed_10m,
       MAX(wind_gusts_10m) AS max_wind_gusts_10m,
       MAX({ext}) AS extreme_flag,
       CAST({hours} AS BIGINT) AS extreme_duration_hours,
       CAST({hours} AS BIGINT) * (MAX(wind_gusts_10m) / CAST({thr} AS DOUBLE)) AS severity_score,
       window_end_s{extra}
FROM (SELECT *, UNNEST(generate_series((forecast_time // {slide}) * {slide} + {slide},
                                       (forecast_time // {slide}) * {slide} + {size}, {slide})) AS window_end_s
      FROM {source} WHERE forecast_time IS NOT NULL) fanned
GROUP BY location_id, window_end_s"""


# --- step 1: event time, extreme predicate, KPI windows ----------------------


@register(
    "event_time",
    with_wx(
        """
SELECT ingest_time, forecast_time,
       strftime(make_timestamp(forecast_time * 1000000), '%Y-%m-%d %H:%M:%S') AS event_time_utc
FROM wx"""
    ),
)
def q_event_time(spark, sf_dir):
    return fx.wx(spark, sf_dir).select(
        "ingest_time", "forecast_time", utc_text(event_time("forecast_time")).alias("event_time_utc")
    )


@register(
    "extreme_rows",
    with_wx(
        f"""
SELECT location_id, forecast_time, ingest_time, wind_gusts_10m FROM wx
WHERE wind_gusts_10m >= CAST({THR} AS DOUBLE)"""
    ),
)
def q_extreme_rows(spark, sf_dir):
    return kpi.extreme_rows(fx.wx(spark, sf_dir), THR).select(
        "location_id", "forecast_time", "ingest_time", "wind_gusts_10m"
    )


@register("kpi_3h", with_wx(kpi_sql(K3)))
def q_kpi_3h(spark, sf_dir):
    return kpi.window_kpis(fx.wx(spark, sf_dir), K3)


@register("kpi_6h", with_wx(kpi_sql(K6)))
def q_kpi_6h(spark, sf_dir):
    return kpi.window_kpis(fx.wx(spark, sf_dir), K6)


_UNION_SQL = "\nUNION ALL\n".join(
    kpi_sql(spec, extra=f", '{label}' AS \"window\"") for label, spec in (("3h", K3), ("6h", K6))
)


@register("kpi_union", with_wx(_UNION_SQL))
def q_kpi_union(spark, sf_dir):
    return kpi.labelled_union(fx.wx(spark, sf_dir), {"3h": K3, "6h": K6})


def _exact_avg_sql(spec: KpiWindow) -> str:
    """Sums in whole units of 2^-40, rounded once to 53 bits (ties to even), divided by the count."""
    slide, size = spec.slide_s, spec.size_s
    return f"""
WITH wide AS ({fx.WIDE_SPEEDS_SQL}),
fanned AS (SELECT *, UNNEST(generate_series((forecast_time // {slide}) * {slide} + {slide},
                                            (forecast_time // {slide}) * {slide} + {size}, {slide})) AS window_end_s
           FROM wide WHERE forecast_time IS NOT NULL),
sums AS (SELECT location_id, window_end_s, COUNT(units) AS samples, coalesce(SUM(units), 0) AS total
         FROM fanned GROUP BY location_id, window_end_s),
bits AS (SELECT *, CAST(abs(total) AS HUGEINT) AS x,
                CAST(greatest(length(bin(CAST(abs(total) AS HUGEINT))) - 53, 0) AS INTEGER) AS cut FROM sums),
parts AS (SELECT *, x >> cut AS kept, x - ((x >> cut) << cut) AS rest,
                 CASE WHEN cut > 0 THEN CAST(1 AS HUGEINT) << (cut - 1) END AS half FROM bits)
SELECT location_id, window_end_s, samples,
       sign(total) * CAST(kept + CASE WHEN rest > half OR (rest = half AND kept % 2 = 1) THEN 1 ELSE 0 END AS DOUBLE)
         * pow(2, cut - 40) / NULLIF(samples, 0) AS avg_wind_speed_10m
FROM parts"""


@register("kpi_exact_avg", _exact_avg_sql(K3))
def q_kpi_exact_avg(spark, sf_dir):
    """Averages of speeds from 1e-12 to 1e12 of either sign, exact whatever the order of rows."""
    return kpi.exact_averages(fx.wide_speeds(spark, sf_dir), K3)


# --- step 2: parsing records, bad records, CSV, JSON rendering -----------------


_REC = ", ".join(RECORD_COLUMNS)


@register("json_scan", with_wx(f"SELECT {_REC} FROM wx"))
def q_json_scan(spark, sf_dir):
    msgs = fx.record_messages(spark, sf_dir)
    return parse.parse_json(msgs.select(parse.as_text("value").alias("value")), "value")


_BAD_SQL = f"""
SELECT event_id AS msg_offset,
       CASE WHEN (event_id // {fx.DAMAGE_EVERY}) % {fx.JSON_DAMAGE_KINDS} IN (1, 2) THEN event_type END AS location_id,
       CASE (event_id // {fx.DAMAGE_EVERY}) % {fx.JSON_DAMAGE_KINDS}
            WHEN 0 THEN 'unparsable' WHEN 3 THEN 'empty' ELSE 'no_forecast_time' END AS bad_reason
FROM events
WHERE event_id % {fx.DAMAGE_EVERY} = 0 AND (event_id // {fx.DAMAGE_EVERY}) % {fx.JSON_DAMAGE_KINDS} <> 4"""


@register("bad_records", _BAD_SQL)
def q_bad_records(spark, sf_dir):
    parsed = parse.parse_json(fx.damaged_messages(spark, sf_dir), "value", keep=["msg_offset"], with_status=True)
    _, bad = parse.split_bad(parsed)
    return bad.select("msg_offset", "location_id", "bad_reason")


_NAMED = ", ".join(f"'{c}'" for c in RECORD_COLUMNS)
_WHOLE = ", ".join(f"'{f.name}'" for f in RECORD.fields if f.dataType.simpleString() == "bigint")


@register(
    "json_variant",
    f"""
WITH messages AS ({fx.DAMAGED_MESSAGES_SQL}),
objects AS (SELECT * FROM messages WHERE CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END),
fields AS (SELECT msg_offset, value, UNNEST(json_keys(value)) AS field FROM objects),
typed AS (SELECT *, json_type(value, '$.' || field) AS t, json_extract_string(value, '$.' || field) AS text FROM fields)
SELECT msg_offset, field, CASE WHEN field IN ({_NAMED}) THEN 'wrong_type' ELSE 'unnamed' END AS kind, text
FROM typed
WHERE field NOT IN ({_NAMED})
   OR t <> 'NULL' AND NOT CASE WHEN field = 'location_id' THEN t = 'VARCHAR'
                               WHEN field IN ({_WHOLE}) THEN t IN ('BIGINT', 'UBIGINT')
                               ELSE t IN ('BIGINT', 'UBIGINT', 'DOUBLE') END""",
)
def q_json_variant(spark, sf_dir):
    """Fields of damaged messages that the schema does not name, or whose values it cannot hold."""
    odd = parse.odd_fields(fx.damaged_messages(spark, sf_dir), "value", keep=["msg_offset"])
    return odd.select("msg_offset", "field", "kind", "text")


@register(
    "csv_scan",
    f"""
WITH lines AS ({fx.CSV_LINES_SQL}),
parts AS (SELECT msg_offset, string_split(value, ',') AS p FROM lines),
typed AS (
  SELECT msg_offset, p[1] AS location_id,
         CAST(epoch_us(try_strptime(p[2], '%Y-%m-%dT%H:%MZ')) // 1000000 AS BIGINT) AS forecast_time,
         TRY_CAST(p[3] AS DOUBLE) AS wind_speed_10m
  FROM parts)
SELECT *, (location_id IS NULL OR forecast_time IS NULL OR wind_speed_10m IS NULL) AS is_bad FROM typed""",
)
def q_csv_scan(spark, sf_dir):
    return parse.parse_csv(fx.csv_lines(spark, sf_dir), "value", keep=["msg_offset"])


@register(
    "to_json_rows",
    with_wx(
        "SELECT ingest_time AS msg_offset, CAST(to_json({"
        + ", ".join(f"'{c}': {c}" for c in RECORD_COLUMNS)
        + "}) AS VARCHAR) AS value FROM wx"
    ),
)
def q_to_json_rows(spark, sf_dir):
    w = fx.wx(spark, sf_dir)
    return w.select(F.col("ingest_time").alias("msg_offset"), parse.json_text(RECORD_COLUMNS).alias("value"))


# --- step 3: arrays, location dimension, enrichment, first n per key ----------


@register(
    "array_rows",
    f"""
SELECT location_id, CAST(hour_index AS INTEGER) AS hour_index,
       CAST(embedding[hour_index + 1] AS DOUBLE) AS wind_speed_10m,
       CAST(embedding[hour_index + 3] AS DOUBLE) AS wind_gusts_10m
FROM (SELECT CAST(vec_id AS VARCHAR) AS location_id, embedding,
             UNNEST(generate_series(0, least(len(coalesce(embedding, [])), len(coalesce(embedding[3:32], [])),
                                             {fx.EMBED_HOURS}) - 1)) AS hour_index
      FROM embeddings) z""",
)
def q_array_rows(spark, sf_dir):
    docs = fx.embedding_documents(spark, sf_dir)
    return arrays.hourly_rows(
        docs, keep=["location_id"], arrays=("wind_speed_10m", "wind_gusts_10m"), limit=fx.EMBED_HOURS
    )


@register("location_dim", f"SELECT location_id, latitude, longitude FROM ({fx.NATION_LOCATIONS_SQL}) d")
def q_location_dim(spark, sf_dir):
    return locations.explode_locations(fx.nation_location_maps(spark, sf_dir), "locations")


@register(
    "enrich_join",
    f"""
WITH dim AS ({fx.NATION_LOCATIONS_SQL})
SELECT e.event_id AS ingest_time, d.location_id, d.latitude, d.longitude,
       CAST(epoch_us(e.ts) // 1000000 AS BIGINT) AS forecast_time, e.value AS wind_speed_10m
FROM events e JOIN dim d ON e.user_id % 25 = d.n_nationkey""",
)
def q_enrich_join(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    facts = ev.select(
        F.col("event_id").alias("ingest_time"),
        F.pmod(F.col("user_id"), F.lit(25)).alias("n_nationkey"),
        fx.epoch_seconds(ev, "ts").alias("forecast_time"),
        F.col("value").alias("wind_speed_10m"),
    )
    maps = fx.nation_location_maps(spark, sf_dir)
    dim = maps.select("n_nationkey", F.explode("locations").alias("location_id", "_c")).select(
        "n_nationkey", "location_id", F.col("_c.latitude").alias("latitude"), F.col("_c.longitude").alias("longitude")
    )
    joined = enrich.enrich(facts, dim, "n_nationkey")
    return joined.select("ingest_time", "location_id", "latitude", "longitude", "forecast_time", "wind_speed_10m")


FIRST_N = 5


@register(
    "first_n_per_key",
    f"""
SELECT o_custkey, o_orderkey, rn FROM (
  SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) t
WHERE rn <= {FIRST_N}""",
)
def q_first_n_per_key(spark, sf_dir):
    o = fx.table(spark, sf_dir, "orders")
    top = limits.first_n_per_key(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], FIRST_N)
    return top.select("o_custkey", "o_orderkey", F.col("rn").cast("bigint").alias("rn"))


# --- step 4: points, long form, latest versions, corrected KPIs ---------------


_PF = ", ".join(POINT_FIELDS)
_KEY = "_measurement, location_id, _time"
POINTS_SQL = f"""
SELECT 'weather_forecast' AS _measurement, location_id, forecast_time AS _time,
       latitude, longitude, ingest_time, wind_speed_10m, wind_gusts_10m, temperature_2m, precipitation, pressure_msl
FROM wx WHERE forecast_time IS NOT NULL"""


def long_sql(src: str) -> str:
    parts = [
        f"SELECT {_KEY}, '{f}' AS _field, CAST({f} AS DOUBLE) AS _value FROM {src} WHERE {f} IS NOT NULL"
        for f in POINT_FIELDS
    ]
    return "\nUNION ALL\n".join(parts)


def latest_sql(src: str, keys: str, fields=POINT_FIELDS, version: str = "ingest_time") -> str:
    aggs = ", ".join(f"arg_max({f}, {version}) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in fields)
    return f"SELECT {keys}, {aggs} FROM {src} GROUP BY {keys}"


@register("points", with_wx(POINTS_SQL))
def q_points(spark, sf_dir):
    return store.to_points(fx.wx(spark, sf_dir))


@register("points_long", with_wx(f"WITH p AS ({POINTS_SQL})\n{long_sql('p')}"))
def q_points_long(spark, sf_dir):
    return store.points_long(store.to_points(fx.wx(spark, sf_dir)))


@register("latest_points", with_wx(f"WITH p AS ({POINTS_SQL})\n{latest_sql('p', _KEY)}", floor=3600))
def q_latest_points(spark, sf_dir):
    return store.latest_points(store.to_points(fx.wx(spark, sf_dir, floor=3600)))


@register(
    "latest_rows",
    with_wx(
        f"""
SELECT location_id, forecast_time, {", ".join(f"arg_max_null({f}, ingest_time) AS {f}" for f in ("ingest_time", "wind_speed_10m", "wind_gusts_10m", "temperature_2m"))}
FROM wx GROUP BY location_id, forecast_time""",
        floor=3600,
    ),
)
def q_latest_rows(spark, sf_dir):
    fields = ["ingest_time", "wind_speed_10m", "wind_gusts_10m", "temperature_2m"]
    return latest.latest_rows(fx.wx(spark, sf_dir, floor=3600), ["location_id", "forecast_time"], fields, "ingest_time")


_KPI_FIELDS = ["wind_speed_10m", "wind_gusts_10m"]


@register(
    "kpi_3h_latest",
    with_wx(
        f"WITH lw AS ({latest_sql('wx', 'location_id, forecast_time', _KPI_FIELDS)})\n{kpi_sql(K3_HOURS, source='lw')}",
        floor=600,
    ),
)
def q_kpi_3h_latest(spark, sf_dir):
    """Corrected mode over 10-minute data: merge versions per (location,
    forecast time) first, so averages use the newest forecast only; durations
    count distinct hours."""
    merged = latest.latest_fields(
        fx.wx(spark, sf_dir, floor=600), ["location_id", "forecast_time"], _KPI_FIELDS, "ingest_time"
    )
    return kpi.window_kpis(merged, K3_HOURS)


_TIED_SQL = ", ".join(
    f"arg_max({f}, (coalesce(ingest_time, {latest.UNVERSIONED}), {f})) FILTER (WHERE {f} IS NOT NULL) AS {f}"
    for f in POINT_FIELDS
)


@register(
    "latest_ties",
    f"WITH wx AS ({fx.tied_versions_sql()}), p AS ({POINTS_SQL})\nSELECT {_KEY}, {_TIED_SQL} FROM p GROUP BY {_KEY}",
)
def q_latest_ties(spark, sf_dir):
    """Versions that are missing (the value yields to any versioned one) or tied (the greatest value wins)."""
    return store.latest_points(store.to_points(fx.tied_versions(spark, sf_dir)))


# --- step 5: range reads over the point store, thresholds, last n, probe ------


AS_OF = datetime(2024, 1, 31, 0, 0, 0)
AS_OF_S = 1706659200
_RANGE_LO = AS_OF_S - kpi.interval_seconds(FORECAST_PANEL_RANGE)
_STORED_SQL = f"WITH p AS ({POINTS_SQL}), stored AS ({latest_sql('p', _KEY)})"
_CLUSTER_POINTS_SQL = POINTS_SQL.replace(f"'{POINT_MEASUREMENT}'", f"'{CLUSTER_MEASUREMENT}'") + " AND ingest_time % 2 = 0"
_CLUSTER_SQL = f"WITH p AS ({_CLUSTER_POINTS_SQL}), stored AS ({latest_sql('p', _KEY)})"
_RANGE_SQL = f"""{_STORED_SQL},
ranged AS (SELECT * FROM stored WHERE _measurement = '{POINT_MEASUREMENT}'
           AND _time >= {_RANGE_LO} AND _time < {AS_OF_S}),
long AS ({long_sql('ranged')})"""


_STORES: "weakref.WeakKeyDictionary[SparkSession, dict[str, str]]" = weakref.WeakKeyDictionary()


def point_store(spark: SparkSession, sf_dir: str) -> str:
    """The point store loaded from the test records, written once per session
    and test-table folder (the tables are read-only); dashboards then query it
    repeatedly, as the range keys do."""
    per_session = _STORES.setdefault(spark, {})
    if sf_dir not in per_session or store.stored_points(spark, per_session[sf_dir]) is None:
        path = scratch_path(spark, "point-store")
        records = fx.wx(spark, sf_dir)
        machines = records.where(F.pmod("ingest_time", F.lit(2)) == 0)
        points = store.to_points(records).unionByName(store.to_points(machines, CLUSTER_MEASUREMENT))
        store.write_points(spark, points, path)
        per_session[sf_dir] = path
    return per_session[sf_dir]


def _stored_range(spark, sf_dir):
    return store.last_range(spark, point_store(spark, sf_dir), POINT_MEASUREMENT, FORECAST_PANEL_RANGE, AS_OF)


@register("range_query", with_wx(f"{_RANGE_SQL}\nSELECT * FROM long"))
def q_range_query(spark, sf_dir):
    return _stored_range(spark, sf_dir)


_CLUSTER_LO = AS_OF_S - kpi.interval_seconds(CLUSTER_PANEL_RANGE)


@register(
    "cluster_range",
    with_wx(
        f"""{_CLUSTER_SQL},
ranged AS (SELECT * FROM stored WHERE _measurement = '{CLUSTER_MEASUREMENT}'
           AND _time >= {_CLUSTER_LO} AND _time < {AS_OF_S}),
long AS ({long_sql('ranged')})
SELECT * FROM long"""
    ),
)
def q_cluster_range(spark, sf_dir):
    """The other measurement of the same store: every second record is stored under it too."""
    return store.last_range(spark, point_store(spark, sf_dir), CLUSTER_MEASUREMENT, CLUSTER_PANEL_RANGE, AS_OF)


_RED = [b for b, _ in THRESHOLD_STEPS if b is not None][0]


@register(
    "threshold_class",
    with_wx(
        f"""{_RANGE_SQL}
SELECT *, CASE WHEN _value >= CAST({_RED} AS DOUBLE) THEN 'red' WHEN _value IS NOT NULL THEN 'green' END AS level
FROM long"""
    ),
)
def q_threshold_class(spark, sf_dir):
    rows = _stored_range(spark, sf_dir)
    return rows.withColumn("level", store.threshold_class(F.col("_value"), THRESHOLD_STEPS))


LAST_N = LOG_TAIL_LINES


@register(
    "last_n",
    f"""
SELECT event_id, concat_ws(' ', event_id, event_type, props) AS line
FROM events ORDER BY ts DESC, event_id DESC LIMIT {LAST_N}""",
)
def q_last_n(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    newest = limits.last_n(ev, [F.col("ts").desc(), F.col("event_id").desc()], LAST_N)
    return newest.select("event_id", F.concat_ws(" ", "event_id", "event_type", "props").alias("line"))


@register("has_data", "SELECT count(*) > 0 AS has_data FROM (SELECT 1 FROM events LIMIT 1) t")
def q_has_data(spark, sf_dir):
    return limits.has_data(fx.table(spark, sf_dir, "events"))


# --- step 6: KPI rows rendered as line protocol --------------------------------


KPI_FIELDS = [c for c in KPI_COLUMNS if c not in ("location_id", "window_end_s")]


def _duck_field(name: str, kind: str) -> str:
    if kind == "int":
        return f"'{name}=' || CAST({name} AS VARCHAR) || 'i'"
    return f"'{name}=' || CAST({name} AS VARCHAR)"


_KPI_LINE_SQL = (
    f"'{KPI_MEASUREMENT},location_id=' || coalesce(location_id, 'None') || ',window=3h ' || concat_ws(',', "
    + ", ".join(
        _duck_field(f, "int" if f in ("extreme_flag", "extreme_duration_hours") else "float") for f in KPI_FIELDS
    )
    + ") || ' ' || CAST(window_end_s AS VARCHAR)"
)


@register("kpi_lines", with_wx(f"WITH k AS ({kpi_sql(K3)})\nSELECT {_KPI_LINE_SQL} AS line FROM k"))
def q_kpi_lines(spark, sf_dir):
    return lines.kpi_lines(kpi.window_kpis(fx.wx(spark, sf_dir), K3), "3h")


# --- step 7: streams (availableNow runs over landed message files) ------------


# Each key lands its messages under a scratch folder, runs its queries to the
# end and drops the landed copy and the checkpoints; the result stays.


def _drop_inputs(spark: SparkSession, base: str) -> None:
    for name in ("landing", "_ckpt"):
        delete_path(spark, f"{base}/{name}")


@register("stream_archive", with_wx(f"SELECT {_REC} FROM wx"))
def q_stream_archive(spark, sf_dir):
    base = scratch_path(spark, "stream-archive")
    fx.land_messages(spark, sf_dir, f"{base}/landing")
    q = jobs.start_archive(streams.file_stream(spark, f"{base}/landing"), f"{base}/archive", f"{base}/_ckpt")
    jobs.run_to_end(q)
    _drop_inputs(spark, base)
    return jobs.read_archive(spark, f"{base}/archive")


def _stream_kpis(spark, sf_dir, specs: dict[str, KpiWindow], runs: int) -> DataFrame:
    """KPI queries off one stream of four time-ordered polls of the whole table,
    one poll per batch, stopped and restarted from the checkpoint between runs."""
    base = scratch_path(spark, "stream-kpi-" + "-".join(specs))
    polls = fx.time_ordered_polls(spark, sf_dir, 4)
    each = len(polls) // runs
    for run in range(runs):
        files = fx.land_polls(spark, sf_dir, f"{base}/landing/run={run}", polls[run * each : (run + 1) * each])
        src = streams.file_stream(spark, f"{base}/landing/*/*", max_files_per_trigger=files)
        started = jobs.start_kpi_series(src, specs, base, f"{base}/_ckpt", upsert=True)
        for query in started.values():
            jobs.run_to_end(query)
    _drop_inputs(spark, base)
    parts = [jobs.read_kpis(spark, f"{base}/table/{label}") for label in specs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("stream_kpi_3h", with_wx(kpi_sql(K3)))
def q_stream_kpi_3h(spark, sf_dir):
    return _stream_kpis(spark, sf_dir, {"3h": K3}, runs=1).drop("window")


@register("stream_kpi_6h", with_wx(kpi_sql(K6)))
def q_stream_kpi_6h(spark, sf_dir):
    return _stream_kpis(spark, sf_dir, {"6h": K6}, runs=2).drop("window")


@register("stream_kpi_union", with_wx(_UNION_SQL))
def q_stream_kpi_union(spark, sf_dir):
    return _stream_kpis(spark, sf_dir, {"3h": K3, "6h": K6}, runs=1)


def _interleaved(spark, sf_dir, base: str, floor: int) -> DataFrame:
    """A stream of two interleaved deliveries (odd, then even message offsets), one per batch."""
    parity = F.pmod("ingest_time", F.lit(2))
    files = fx.land_polls(spark, sf_dir, f"{base}/landing", [parity == 1, parity == 0], floor=floor)
    return streams.file_stream(spark, f"{base}/landing/*", max_files_per_trigger=files)


@register(
    "stream_kpi_3h_latest",
    with_wx(
        f"WITH lw AS ({latest_sql('wx', 'location_id, forecast_time', _KPI_FIELDS)})\n{kpi_sql(K3_HOURS, source='lw')}",
        floor=600,
    ),
)
def q_stream_kpi_3h_latest(spark, sf_dir):
    """Corrected-mode stream: versions of one forecast time arrive in different
    batches and out of order; every revision reaches its windows, and the
    result equals the batch ``kpi_3h_latest``."""
    base = scratch_path(spark, "stream-kpi-latest")
    src = _interleaved(spark, sf_dir, base, 600)
    q = jobs.start_corrected_kpis(src, {"3h": K3_HOURS}, f"{base}/store", f"{base}/kpi", f"{base}/_ckpt")
    jobs.run_to_end(q)
    _drop_inputs(spark, base)
    return jobs.read_kpis(spark, f"{base}/kpi").drop("window")


@register(
    "kpi_from_partials",
    with_wx(
        f"WITH lw AS ({latest_sql('wx', 'location_id, forecast_time', _KPI_FIELDS)})\n{kpi_sql(K3_HOURS, source='lw')}",
        floor=600,
    ),
)
def q_kpi_from_partials(spark, sf_dir):
    """Corrected KPIs finished from bucket partials that two interleaved deliveries,
    with revisions in both, were folded into."""
    base = scratch_path(spark, "stream-partials")
    src = _interleaved(spark, sf_dir, base, 600)
    jobs.run_to_end(jobs.start_partials(src, f"{base}/partials", f"{base}/_ckpt", K3))
    _drop_inputs(spark, base)
    return kpi.kpis_from_buckets(partials.read_buckets(spark, f"{base}/partials"), K3_HOURS)


MID = 1705320000  # 2024-01-15 12:00 UTC


def _late_sql() -> str:
    """Second-poll rows count only in windows that end after the watermark: an
    hour before the newest time of the first poll."""
    body = kpi_sql(K3, source="late")
    fanned = f"FROM (SELECT *, UNNEST(generate_series((forecast_time // {K3.slide_s}) * {K3.slide_s}"
    assert fanned in body
    return f"""
WITH mark AS (SELECT max(forecast_time) - 3600 AS wm FROM wx WHERE forecast_time < {MID}),
late AS (SELECT *, 0 AS poll FROM wx WHERE forecast_time < {MID} UNION ALL SELECT *, 1 AS poll FROM wx)
{body.replace(") fanned", ") fanned, mark").replace(
    "GROUP BY location_id", "WHERE poll = 0 OR wm IS NULL OR window_end_s > wm GROUP BY location_id")}"""


@register("stream_late_drop", with_wx(_late_sql()))
def q_stream_late_drop(spark, sf_dir):
    """Two polls through one checkpointed 3 h KPI stream: the first half of the
    month, then the whole month re-sent. Rows behind the watermark (1 h behind
    the newest event time seen) are dropped from windows that have ended."""
    base = scratch_path(spark, "stream-late")
    for poll, where in enumerate([F.col("forecast_time") < F.lit(MID), None]):
        fx.land_messages(spark, sf_dir, f"{base}/landing/poll={poll}", where)
        recs = jobs.parsed_records(streams.file_stream(spark, f"{base}/landing/*"))
        jobs.run_to_end(jobs.start_kpis(recs, K3, jobs.KpiUpsertSink(f"{base}/kpi", "3h"), f"{base}/_ckpt"))
    _drop_inputs(spark, base)
    return jobs.read_kpis(spark, f"{base}/kpi").drop("window")


# --- streams whose output is final ---------------------------------------------


def _closed_sql(spec: KpiWindow) -> str:
    """The KPIs of the windows that the last watermark has passed."""
    return f"""
WITH k AS ({kpi_sql(spec)})
SELECT * FROM k WHERE window_end_s <= (SELECT max(forecast_time) - 3600 FROM wx)"""


@register("stream_kpi_final", with_wx(_closed_sql(K3)))
def q_stream_kpi_final(spark, sf_dir):
    """Append-mode KPIs of ended windows: four time-ordered polls, one per batch,
    stopped and restarted from the checkpoint in the middle."""
    base = scratch_path(spark, "stream-final")
    polls = fx.time_ordered_polls(spark, sf_dir, 4)
    for run in range(2):
        files = fx.land_polls(spark, sf_dir, f"{base}/landing/run={run}", polls[2 * run : 2 * run + 2])
        recs = jobs.parsed_records(streams.file_stream(spark, f"{base}/landing/*/*", max_files_per_trigger=files))
        jobs.run_to_end(closed.start_final_kpis(recs, K3, f"{base}/kpi", f"{base}/_ckpt", "3h"))
    _drop_inputs(spark, base)
    return closed.read_final_kpis(spark, f"{base}/kpi").drop("window")


@register("stream_dedup", with_wx(_closed_sql(K6)))
def q_stream_dedup(spark, sf_dir):
    """Every poll is delivered twice; the KPIs of ended windows count it once."""
    base = scratch_path(spark, "stream-dedup")
    polls = [p for poll in fx.time_ordered_polls(spark, sf_dir, 4) for p in (poll, poll)]
    files = fx.land_polls(spark, sf_dir, f"{base}/landing", polls)
    msgs = streams.file_stream(spark, f"{base}/landing/*", max_files_per_trigger=files)
    recs = closed.once(jobs.parsed_records(msgs, MESSAGE_RECORD))
    jobs.run_to_end(closed.start_final_kpis(recs, K6, f"{base}/kpi", f"{base}/_ckpt", "6h"))
    _drop_inputs(spark, base)
    return closed.read_final_kpis(spark, f"{base}/kpi").drop("window")


@register(
    "stream_state_rows",
    with_wx(
        f"""
WITH k AS ({kpi_sql(K3, extra=", COUNT(wind_speed_10m) AS samples")})
SELECT location_id, window_end_s, samples, max_wind_speed_10m, max_wind_gusts_10m, extreme_flag, extreme_duration_hours
FROM k WHERE window_end_s > (SELECT max(forecast_time) - 3600 FROM wx)"""
    ),
)
def q_stream_state_rows(spark, sf_dir):
    """The open windows in the state of a KPI stream of four polls, stopped and restarted in the middle."""
    base = scratch_path(spark, "stream-state")
    polls = fx.time_ordered_polls(spark, sf_dir, 4)
    for run in range(2):
        files = fx.land_polls(spark, sf_dir, f"{base}/landing/run={run}", polls[2 * run : 2 * run + 2])
        recs = jobs.parsed_records(streams.file_stream(spark, f"{base}/landing/*/*", max_files_per_trigger=files))
        jobs.run_to_end(jobs.start_kpis(recs, K3, jobs.KpiBatchSink(f"{base}/kpi", "3h"), f"{base}/ckpt"))
    delete_path(spark, f"{base}/landing")
    return audit.open_windows(spark, f"{base}/ckpt")


@register("stream_lines", with_wx(f"{_closed_sql(K3).replace('SELECT * FROM k', f'SELECT {_KPI_LINE_SQL} AS line FROM k')}"))
def q_stream_lines(spark, sf_dir):
    """KPIs of ended windows as line protocol, each batch committed once; stopped and restarted in the middle."""
    base = scratch_path(spark, "stream-lines")
    polls = fx.time_ordered_polls(spark, sf_dir, 4)
    for run in range(2):
        files = fx.land_polls(spark, sf_dir, f"{base}/landing/run={run}", polls[2 * run : 2 * run + 2])
        recs = jobs.parsed_records(streams.file_stream(spark, f"{base}/landing/*/*", max_files_per_trigger=files))
        jobs.run_to_end(line_sink.start_lines(lines.kpi_lines(kpi.final_kpis(recs, K3), "3h"), f"{base}/lines", f"{base}/_ckpt"))
    _drop_inputs(spark, base)
    return line_sink.read_lines(spark, f"{base}/lines").select(F.col("value").alias("line"))


@register(
    "stream_late_rows",
    with_wx(
        f"""
WITH mark AS (SELECT max(forecast_time) - 3600 AS wm FROM wx WHERE forecast_time < {MID})
SELECT location_id, forecast_time, ingest_time, wind_speed_10m, wind_gusts_10m FROM wx, mark WHERE forecast_time <= wm"""
    ),
)
def q_stream_late_rows(spark, sf_dir):
    """The rows behind the watermark when the whole month is re-sent after its first half."""
    base = scratch_path(spark, "stream-late-rows")
    for poll, where in enumerate([F.col("forecast_time") < F.lit(MID), None]):
        fx.land_messages(spark, sf_dir, f"{base}/landing/poll={poll}", where)
        msgs = streams.file_stream(spark, f"{base}/landing/*")
        recs = jobs.parsed_records(msgs, MESSAGE_RECORD, watermark=None)
        jobs.run_to_end(closed.start_late_rows(recs, f"{base}/late", f"{base}/_ckpt"))
    _drop_inputs(spark, base)
    late = closed.read_late_rows(spark, f"{base}/late")
    return late.select("location_id", "forecast_time", "ingest_time", "wind_speed_10m", "wind_gusts_10m")


@register("stream_points", with_wx(f"WITH p AS ({POINTS_SQL})\n{latest_sql('p', _KEY)}"))
def q_stream_points(spark, sf_dir):
    """Two interleaved deliveries streamed into the keyed point store (field-wise upsert per batch)."""
    base = scratch_path(spark, "stream-points")
    src = _interleaved(spark, sf_dir, base, 1)
    jobs.run_to_end(jobs.start_points(src, f"{base}/store", f"{base}/_ckpt"))
    _drop_inputs(spark, base)
    return store.read_points(spark, f"{base}/store").select(*store.KEY, *POINT_FIELDS)


@register("stream_bad_records", _BAD_SQL)
def q_stream_bad_records(spark, sf_dir):
    """Damaged messages streamed to the bad-record table, with the reason."""
    base = scratch_path(spark, "stream-bad")
    damaged = fx.damaged_messages(spark, sf_dir)
    fx.message_rows(damaged, F.col("value"), F.col("msg_offset"), F.lit(None).cast("timestamp")).write.parquet(f"{base}/landing")
    jobs.run_to_end(jobs.start_bad_records(streams.file_stream(spark, f"{base}/landing"), f"{base}/bad", f"{base}/_ckpt"))
    _drop_inputs(spark, base)
    return spark.read.parquet(f"{base}/bad").select(F.col("offset").alias("msg_offset"), "location_id", "bad_reason")


@register("stream_publish", fx.API_RECORDS_SQL)
def q_stream_publish(spark, sf_dir):
    """Landed documents streamed out as JSON messages, and these read back as records."""
    base = scratch_path(spark, "stream-publish")
    fx.api_documents(spark, sf_dir).select(parse.json_text(["location_id", "hourly"]).alias("value")).write.text(f"{base}/landing")
    docs = streams.document_stream(spark, f"{base}/landing")
    dim = fx.api_locations(spark, sf_dir)
    jobs.run_to_end(jobs.start_publish(docs, dim, f"{base}/_ckpt", f"{base}/messages", ingest_time=1))
    _drop_inputs(spark, base)
    return read_json_records(spark, f"{base}/messages").select(*RECORD_COLUMNS)


# --- step 8: dataset size report, log error search ----------------------------


@register(
    "dataset_size",
    """
SELECT 'location_id=' || coalesce(event_type, '__HIVE_DEFAULT_PARTITION__') AS entry, count(*) AS "rows"
FROM events GROUP BY event_type
UNION ALL SELECT NULL, count(*) FROM events""",
)
def q_dataset_size(spark, sf_dir):
    """Write wx records partitioned by location, then report rows per partition
    folder and in total (bytes and files depend on the writer; see the tests)."""
    path = scratch_path(spark, "dataset")
    fx.wx(spark, sf_dir).write.partitionBy("location_id").parquet(path)
    return files.dataset_size(spark, path).select("entry", "rows")


@register(
    "log_errors",
    f"""
SELECT event_id, line FROM (SELECT event_id, concat_ws(' ', event_id, event_type, props) AS line FROM events) l
WHERE regexp_matches(line, '{LOG_ERROR_PATTERN}')""",
)
def q_log_errors(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    lines_df = ev.select("event_id", F.concat_ws(" ", "event_id", "event_type", "props").alias("line"))
    return files.error_lines(lines_df, "line")
