"""Record parsing: text to typed measurement rows, with bad records routed aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.schema import RECORD

_CORRUPT = "_corrupt_text"

# bad_reason values
EMPTY = "empty"
UNPARSABLE = "unparsable"
NO_FORECAST_TIME = "no_forecast_time"
TIME_OUT_OF_RANGE = "forecast_time_out_of_range"

# unix seconds of the years 1 to 9999, the range of dates and timestamps
MIN_TIME, MAX_TIME = -62135596800, 253402300799


def as_text(col: str | Column) -> Column:
    """Binary message value (or text) to UTF-8 text."""
    return F.col(col).cast("string") if isinstance(col, str) else col.cast("string")


def in_time_range(seconds: Column) -> Column:
    """Whether unix seconds are a time of the years 1 to 9999; false for null."""
    return F.coalesce(seconds.between(F.lit(MIN_TIME), F.lit(MAX_TIME)), F.lit(False))


def event_time(seconds: str | Column = "forecast_time") -> Column:
    """Unix seconds to an instant, independent of the session time zone; null out of range."""
    s = F.col(seconds) if isinstance(seconds, str) else seconds
    return F.when(in_time_range(s), F.timestamp_seconds(s))


def parse_json(
    df: DataFrame,
    text_col: str = "value",
    schema: T.StructType = RECORD,
    keep: Sequence[str] = (),
    with_status: bool = False,
) -> DataFrame:
    """Parse JSON text by a fixed schema (permissive) and flatten it.

    Non-JSON text yields all-null fields, a wrong-typed field yields a null in
    that field only, extra keys are ignored, null or empty text yields nulls.
    With ``with_status`` two columns are added: ``is_bad`` (the row has no
    ``forecast_time``, or one out of range, and would vanish at any event-time
    window) and ``bad_reason``.

    Each text is parsed once, whatever is filtered or selected afterwards: the
    parsed record leaves a generator, which filters are not moved through.
    """
    fields = [f.name for f in schema.fields]
    if not with_status:
        parsed = F.from_json(F.col(text_col), schema)
        rows = df.select(*keep, F.explode(F.array(parsed)).alias("_r"))
        return rows.select(*keep, *[F.col(f"_r.{f}").alias(f) for f in fields])

    wide = T.StructType(schema.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(text_col), wide, {"columnNameOfCorruptRecord": _CORRUPT})
    rows = df.select(*keep, F.explode(F.array(parsed)).alias("_r"))
    r = F.col("_r")
    any_field = r[fields[0]].isNotNull()
    for f in fields[1:]:
        any_field = any_field | r[f].isNotNull()
    reason = (
        F.when(r.isNull(), F.lit(EMPTY))
        .when(r[_CORRUPT].isNotNull() & ~any_field, F.lit(UNPARSABLE))
        .when(r["forecast_time"].isNull(), F.lit(NO_FORECAST_TIME))
        .when(~in_time_range(r["forecast_time"]), F.lit(TIME_OUT_OF_RANGE))
    )
    return rows.select(
        *keep,
        *[r[f].alias(f) for f in fields],
        reason.isNotNull().alias("is_bad"),
        reason.alias("bad_reason"),
    )


#: variant types that a field of the schema may have; decimals are numbers with a fraction
_RIGHT_TYPES = {"string": "^STRING$", "bigint": "^BIGINT$", "double": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"}
UNNAMED, WRONG_TYPE = "unnamed", "wrong_type"


def odd_fields(
    df: DataFrame, text_col: str = "value", schema: T.StructType = RECORD, keep: Sequence[str] = ()
) -> DataFrame:
    """What ``parse_json`` loses: ``keep``, field, kind, type, text per field of a JSON object that
    ``schema`` does not name (``unnamed``) or whose value it cannot hold (``wrong_type``).

    Each text is parsed once, into a variant. Null values are right for every field; text
    that is no JSON object has no fields. A nested value's text is its JSON.
    """
    parsed = df.select(*keep, F.try_parse_json(F.col(text_col)).alias("_v"))
    fields = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer())).where("key IS NOT NULL")
    found = fields.select(*keep, F.col("key").alias("field"), F.schema_of_variant("value").alias("type"), F.col("value").alias("_value"))
    right = F.lit(False)
    for f in schema.fields:
        right = right | ((F.col("field") == f.name) & F.col("type").rlike(_RIGHT_TYPES[f.dataType.simpleString()]))
    named = F.col("field").isin([f.name for f in schema.fields])
    odd = found.where(~named | (~right & (F.col("type") != "VOID")))
    text = F.when(F.col("type") == "STRING", F.try_variant_get("_value", "$", "string")).otherwise(F.to_json("_value"))
    return odd.select(
        *keep, "field", F.when(named, F.lit(WRONG_TYPE)).otherwise(F.lit(UNNAMED)).alias("kind"), "type", text.alias("text")
    )


def split_bad(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, bad) views of a ``parse_json(..., with_status=True)`` result."""
    good = parsed.where(~F.col("is_bad")).drop("is_bad", "bad_reason")
    bad = parsed.where(F.col("is_bad"))
    return good, bad


def parse_csv(df: DataFrame, text_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Parse ``location,yyyy-MM-ddTHH:mmZ,speed`` lines.

    Output: location_id, forecast_time (unix seconds), wind_speed_10m, is_bad.
    Unparsable time or speed, or a missing field, gives null and is_bad.
    """
    parts = F.from_csv(F.col(text_col), "location_id STRING, t STRING, speed STRING").alias("_c")
    c = F.col("_c")
    ts = F.try_to_timestamp(c["t"], F.lit("yyyy-MM-dd'T'HH:mmX"))
    speed = c["speed"].try_cast("double")
    out = df.select(*keep, parts).select(
        *keep,
        c["location_id"].alias("location_id"),
        F.unix_seconds(ts).alias("forecast_time"),
        speed.alias("wind_speed_10m"),
    )
    return out.withColumn(
        "is_bad",
        F.col("location_id").isNull() | F.col("forecast_time").isNull() | F.col("wind_speed_10m").isNull(),
    )


def json_text(columns: Sequence[str]) -> Column:
    """Columns as one JSON object text; null fields written out (not dropped)."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def utc_text(ts: Column) -> Column:
    """An instant as 'yyyy-MM-dd HH:mm:ss' UTC wall-clock text, whatever the session zone."""
    wall = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(
        secs=(F.unix_micros(ts) / F.lit(1_000_000)).cast("decimal(18,6)")
    )
    return wall.cast("string")
