"""Sliding-window wind KPIs per location.

Batch form ("bucket first"): aggregate each location's rows into slide-sized
buckets, then fan each bucket out to the ``size / slide`` windows that contain
it and aggregate again. Every KPI decomposes (sum and count, max, conditional
sum), so the result equals grouping by ``window(event_time, size, slide)``,
but the fan-out happens after the first aggregation has collapsed the input,
and both aggregations combine map-side before their shuffles, which also
tames a hot location. The 3 h and 6 h series share the same buckets.

Averages sum the speeds that are whole multiples of 10^-avg_scale (and below
2^20 in size) exactly, in bigint units, so that the result does not depend on
how rows were partitioned or ordered; all other speeds (finer, larger, NaN or
infinite ones) are summed as doubles beside them, as ``avg`` does.

Rows without a time, or with one beyond the years 1 to 9999, are in no window.
With ``distinct_hours`` the duration counts distinct forecast hours with an
extreme gust instead of rows: a bit per hour of the window.

Streaming forms: ``streaming_kpis`` is one ``groupBy(window(...))`` aggregate,
since Spark allows a single stateful aggregation per update-mode query; its
state takes size / slide updates a row. ``final_kpis`` is bucket-first like the
batch form, as two chained aggregations for append mode: a row updates one
bucket, and a closed bucket reaches its windows once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from squall.constants import EXTREME_GUST_THRESHOLD
from squall.functions import exact
from squall.functions.parse import MAX_TIME, MIN_TIME

_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def interval_seconds(text: str) -> int:
    """'3 hours' -> 10800. Accepts one '<n> <unit>' term."""
    n, unit = text.strip().split()
    unit = unit.lower().rstrip("s")
    if unit not in _UNITS:
        raise ValueError(f"unsupported interval unit in {text!r}")
    return int(n) * _UNITS[unit]


@dataclass(frozen=True)
class KpiWindow:
    size: str = "3 hours"
    slide: str = "10 minutes"
    threshold: float = EXTREME_GUST_THRESHOLD
    avg_scale: int = 6
    distinct_hours: bool = False

    @property
    def size_s(self) -> int:
        return interval_seconds(self.size)

    @property
    def slide_s(self) -> int:
        return interval_seconds(self.slide)

    def check(self) -> None:
        if self.slide_s <= 0 or self.size_s % self.slide_s:
            raise ValueError("bucket-first KPIs need a slide that divides the window size")
        if self.distinct_hours and (3600 % self.slide_s or self.size_s > 62 * 3600):
            raise ValueError("distinct hours need a slide that divides the hour and windows of at most 62 hours")


def extreme_sql(threshold: float) -> str:
    # a null gust compares to null, so it is never extreme
    return f"CASE WHEN wind_gusts_10m >= {float(threshold)!r}D THEN 1 ELSE 0 END"


def units_sql(scale: int) -> str:
    # whole multiples of 10^-scale (below 2^20 in size) in bigint units, else null (NaN compares as greatest)
    v, unit = "wind_speed_10m", f"{10 ** scale}D"
    return f"CASE WHEN abs({v}) < 1048576D AND rint({v} * {unit}) / {unit} = {v} THEN CAST(rint({v} * {unit}) AS BIGINT) END"


# over a column _units of these: the exact units, and the rest as doubles
_SUMS = ["sum(_units) AS _sum", "sum(CASE WHEN _units IS NULL THEN wind_speed_10m END) AS _rest"]


def _avg_sql(scale: int) -> str:
    # the exact sum, scaled back once, plus the rest, divided by the count
    total = f"coalesce(CAST(_sum AS DOUBLE) / {10 ** scale}D, 0D) + coalesce(_rest, 0D)"
    return f"({total}) / nullif(_cnt, 0) AS avg_wind_speed_10m"


def _in_range_sql(time_col: str) -> str:
    return f"{time_col} BETWEEN {MIN_TIME} AND {MAX_TIME}"


def _finish_sql(threshold: float, scale: int) -> list[str]:
    """Output projection over aggregated ``_sum``/``_cnt`` and finished maxima."""
    return [
        "location_id",
        _avg_sql(scale),
        "max_wind_speed_10m",
        "max_wind_gusts_10m",
        "extreme_flag",
        "extreme_duration_hours",
        f"extreme_duration_hours * (max_wind_gusts_10m / {float(threshold)!r}D) AS severity_score",
        "window_end_s",
    ]


def kpi_buckets(records: DataFrame, spec: KpiWindow = KpiWindow(), time_col: str = "forecast_time") -> DataFrame:
    """Per (location, slide bucket) partial KPIs. Rows without a time drop out."""
    spec.check()
    t, slide = f"`{time_col}`", spec.slide_s
    return (
        records.where(_in_range_sql(t))
        .selectExpr(
            "location_id", f"{t} - pmod({t}, {slide}) AS bucket", "wind_speed_10m", "wind_gusts_10m",
            f"{units_sql(spec.avg_scale)} AS _units",
        )
        .groupBy("location_id", "bucket")
        .agg(
            *[F.expr(e) for e in _SUMS],
            F.expr("count(wind_speed_10m)").alias("_cnt"),
            F.expr("max(wind_speed_10m)").alias("_max_speed"),
            F.expr("max(wind_gusts_10m)").alias("_max_gust"),
            F.expr(f"sum({extreme_sql(spec.threshold)})").alias("_ext"),
        )
    )


def kpis_from_buckets(buckets: DataFrame, spec: KpiWindow = KpiWindow()) -> DataFrame:
    """Fan buckets out to the windows containing them and finish the KPIs."""
    spec.check()
    size, slide = spec.size_s, spec.slide_s
    fanned = buckets.selectExpr(
        "*", f"explode(sequence(bucket + {slide}, bucket + {size}, {slide})) AS window_end_s"
    )
    duration = "sum(_ext)"
    if spec.distinct_hours:  # a bucket lies within one hour; its bit is the hour's number in the window
        hour = f"floor(bucket / 3600) - floor((window_end_s - {size}) / 3600)"
        duration = f"coalesce(bit_count(bit_or(CASE WHEN _ext > 0 THEN shiftleft(1L, CAST({hour} AS INT)) END)), 0)"
    agg = fanned.groupBy("location_id", "window_end_s").agg(
        F.expr("sum(_sum)").alias("_sum"),
        F.expr("sum(_rest)").alias("_rest"),
        F.expr("sum(_cnt)").alias("_cnt"),
        F.expr("max(_max_speed)").alias("max_wind_speed_10m"),
        F.expr("max(_max_gust)").alias("max_wind_gusts_10m"),
        F.expr("max(CASE WHEN _ext > 0 THEN 1 ELSE 0 END)").alias("extreme_flag"),
        F.expr(f"CAST({duration} AS BIGINT)").alias("extreme_duration_hours"),
    )
    return agg.selectExpr(*_finish_sql(spec.threshold, spec.avg_scale))


def window_kpis(records: DataFrame, spec: KpiWindow = KpiWindow(), time_col: str = "forecast_time") -> DataFrame:
    """Batch KPIs for one window spec (bucket-first)."""
    return kpis_from_buckets(kpi_buckets(records, spec, time_col), spec)


def labelled_union(records: DataFrame, specs: dict[str, KpiWindow], time_col: str = "forecast_time") -> DataFrame:
    """Several window specs as one series, told apart by a ``window`` tag.

    Specs with the same slide share one bucket aggregation.
    """
    shared: dict[tuple, DataFrame] = {}
    parts = []
    for label, spec in specs.items():
        key = (spec.slide_s, spec.threshold, spec.avg_scale)
        if key not in shared:
            shared[key] = kpi_buckets(records, spec, time_col)
        parts.append(kpis_from_buckets(shared[key], spec).withColumn("window", F.lit(label)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def streaming_kpis(events: DataFrame, spec: KpiWindow = KpiWindow(), time_col: str = "event_time") -> DataFrame:
    """KPIs as one windowed aggregate (for streams; also valid in batch)."""
    if spec.distinct_hours:
        raise ValueError("distinct hours need the batch form (the corrected stream recomputes with it)")
    ext = extreme_sql(spec.threshold)
    events = events.withColumn("_units", F.expr(units_sql(spec.avg_scale)))
    agg = events.groupBy(F.window(F.col(time_col), spec.size, spec.slide).alias("window"), F.col("location_id")).agg(
        *[F.expr(e) for e in _SUMS],
        F.expr("count(wind_speed_10m)").alias("_cnt"),
        F.expr("max(wind_speed_10m)").alias("max_wind_speed_10m"),
        F.expr("max(wind_gusts_10m)").alias("max_wind_gusts_10m"),
        F.expr(f"max({ext})").alias("extreme_flag"),
        F.expr(f"sum({ext})").alias("extreme_duration_hours"),
    )
    return agg.withColumn("window_end_s", F.expr("CAST(window.end AS BIGINT)")).selectExpr(
        *_finish_sql(spec.threshold, spec.avg_scale)
    )


def exact_averages(records: DataFrame, spec: KpiWindow = KpiWindow(), time_col: str = "forecast_time") -> DataFrame:
    """location_id, window_end_s, avg_wind_speed_10m, samples: averages of any doubles that no order of rows changes.

    The speeds' exact sums (``functions.exact``) take the bucket-first way: partial
    sums per (location, bucket, bin) fan out to windows and are added there.
    """
    spec.check()
    t, size, slide = f"`{time_col}`", spec.size_s, spec.slide_s
    keep = ["location_id", F.expr(f"{t} - pmod({t}, {slide})").alias("bucket"), F.expr("wind_speed_10m IS NOT NULL").alias("_there")]
    pieces = exact.parts(records.where(_in_range_sql(t)), "wind_speed_10m", keep)
    buckets = pieces.groupBy("location_id", "bucket", "_bin").agg(*exact.bin_sums(), F.count(F.when(F.col("_there"), 1)).alias("_cnt"))
    fanned = buckets.selectExpr("*", f"explode(sequence(bucket + {slide}, bucket + {size}, {slide})) AS window_end_s")
    windows = fanned.groupBy("location_id", "window_end_s", "_bin").agg(*exact.bin_sums(), F.sum("_cnt").alias("_cnt"))
    held = windows.groupBy("location_id", "window_end_s").agg(
        exact.bins().alias("_bins"), F.sum("_odd").alias("_odd"), F.sum("_cnt").alias("samples")
    )
    total = F.coalesce("_odd", exact.total("_bins"))
    return held.select("location_id", "window_end_s", (total / F.nullif("samples", F.lit(0))).alias("avg_wind_speed_10m"), "samples")


def final_kpis(events: DataFrame, spec: KpiWindow = KpiWindow(), time_col: str = "event_time") -> DataFrame:
    """KPIs of windows that have ended, as two chained aggregations (append mode streams; also valid in batch).

    The first aggregates each location's rows into slide-sized buckets; a bucket
    that the watermark has passed goes on to the windows around it, which end
    behind it and so are still open. ``events`` needs a watermark in a stream.
    """
    spec.check()
    if spec.distinct_hours:
        raise ValueError("distinct hours need the batch form (the corrected stream recomputes with it)")
    events = events.withColumn("_units", F.expr(units_sql(spec.avg_scale)))
    buckets = events.groupBy(F.window(F.col(time_col), spec.slide).alias("bucket"), F.col("location_id")).agg(
        *[F.expr(e) for e in _SUMS],
        F.expr("count(wind_speed_10m)").alias("_cnt"),
        F.expr("max(wind_speed_10m)").alias("_max_speed"),
        F.expr("max(wind_gusts_10m)").alias("_max_gust"),
        F.expr(f"sum({extreme_sql(spec.threshold)})").alias("_ext"),
    )
    timed = buckets.withColumn("_at", F.window_time("bucket"))
    agg = timed.groupBy(F.window("_at", spec.size, spec.slide).alias("window"), F.col("location_id")).agg(
        F.expr("sum(_sum)").alias("_sum"),
        F.expr("sum(_rest)").alias("_rest"),
        F.expr("sum(_cnt)").alias("_cnt"),
        F.expr("max(_max_speed)").alias("max_wind_speed_10m"),
        F.expr("max(_max_gust)").alias("max_wind_gusts_10m"),
        F.expr("max(CASE WHEN _ext > 0 THEN 1 ELSE 0 END)").alias("extreme_flag"),
        F.expr("sum(_ext)").alias("extreme_duration_hours"),
    )
    return agg.withColumn("window_end_s", F.expr("CAST(window.end AS BIGINT)")).selectExpr(
        *_finish_sql(spec.threshold, spec.avg_scale)
    )


def extreme_rows(records: DataFrame, threshold: float = EXTREME_GUST_THRESHOLD) -> DataFrame:
    """Rows whose gust reaches the threshold (a null gust is never extreme)."""
    return records.where(F.col("wind_gusts_10m") >= F.lit(float(threshold)))
