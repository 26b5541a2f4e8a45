"""Declared schemas: measurement record, API document, KPI row."""

from __future__ import annotations

from pyspark.sql import types as T

from squall.constants import HOURLY_VARIABLES

# One forecast record as published on the topic; every field nullable.
RECORD = T.StructType(
    [
        T.StructField("location_id", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("forecast_time", T.LongType()),
        T.StructField("ingest_time", T.LongType()),
        *[T.StructField(name, T.DoubleType()) for name in HOURLY_VARIABLES],
    ]
)
RECORD_COLUMNS = [f.name for f in RECORD.fields]

# The four fields the KPI path reads; a narrower schema keeps from_json lean.
KPI_RECORD = T.StructType(
    [f for f in RECORD.fields if f.name in ("location_id", "forecast_time", "wind_speed_10m", "wind_gusts_10m")]
)

# What the KPI path reads, and the ingest time that tells a re-sent message from a later version.
MESSAGE_RECORD = T.StructType([*KPI_RECORD.fields, RECORD["ingest_time"]])

# API document: parallel hourly arrays (any may be missing; elements may be null).
HOURLY = T.StructType(
    [T.StructField("time", T.ArrayType(T.LongType()))]
    + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in HOURLY_VARIABLES]
)
DOCUMENT = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("hourly", HOURLY),
    ]
)

# Location dimension document: name -> coordinates.
COORDS = T.StructType([T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())])
LOCATION_MAP = T.MapType(T.StringType(), COORDS)

# Output columns of a KPI row, in output order.
KPI_COLUMNS = [
    "location_id",
    "avg_wind_speed_10m",
    "max_wind_speed_10m",
    "max_wind_gusts_10m",
    "extreme_flag",
    "extreme_duration_hours",
    "severity_score",
    "window_end_s",
]

# Point fields: every float measure plus the integer ingest stamp.
POINT_FLOAT_FIELDS = ["latitude", "longitude", *HOURLY_VARIABLES]
POINT_INT_FIELDS = ["ingest_time"]
POINT_FIELDS = ["latitude", "longitude", "ingest_time", *HOURLY_VARIABLES]
