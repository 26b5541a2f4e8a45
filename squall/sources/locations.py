"""Location dimension: a map name -> (latitude, longitude) as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.constants import LOCATIONS
from squall.schema import LOCATION_MAP


def explode_locations(df: DataFrame, map_col: str = "locations") -> DataFrame:
    """One row per map entry: location_id, latitude, longitude."""
    e = df.select(F.explode(F.col(map_col)).alias("location_id", "_c"))
    return e.select("location_id", F.col("_c.latitude").alias("latitude"), F.col("_c.longitude").alias("longitude"))


def read_location_document(spark: SparkSession, path: str) -> DataFrame:
    """Read ``{"locations": {name: {"latitude": .., "longitude": ..}}}`` JSON documents."""
    doc = spark.read.schema(f"locations {LOCATION_MAP.simpleString()}").option("multiLine", "true").json(path)
    return explode_locations(doc, "locations")


def configured_locations(spark: SparkSession) -> DataFrame:
    """The fixed configured locations as a dimension DataFrame."""
    rows = [(name, lat, lon) for name, (lat, lon) in LOCATIONS.items()]
    return spark.createDataFrame(rows, "location_id string, latitude double, longitude double")
