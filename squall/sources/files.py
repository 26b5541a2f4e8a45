"""Batch file sources: JSON-lines records, CSV lines, landed API documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.functions.parse import parse_csv, parse_json
from squall.operators.arrays import hourly_rows, with_ingest_time
from squall.operators.enrich import enrich
from squall.schema import DOCUMENT, RECORD, RECORD_COLUMNS


def read_json_records(spark: SparkSession, path: str, with_status: bool = False) -> DataFrame:
    """JSON-lines measurement records (one object per line), fixed schema.

    Read as text and parsed with ``from_json`` so that bad lines can be
    flagged (``with_status``) instead of silently becoming nulls.
    """
    return parse_json(spark.read.text(path), "value", RECORD, with_status=with_status)


def read_csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``location,yyyy-MM-ddTHH:mmZ,speed`` text lines."""
    return parse_csv(spark.read.text(path), "value")


def read_documents(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Landed API documents (``hourly`` parallel arrays), one per line.

    With ``whole_files`` each file is one document of any number of lines; such
    a file is one task, so land large data one document per line. A
    ``location_id=<name>`` folder level becomes a column.
    """
    reader = spark.read.schema(DOCUMENT)
    if whole_files:
        reader = reader.option("multiLine", "true")
    return reader.json(path)


def documents_to_records(docs: DataFrame, locations: DataFrame, ingest_time: int | Column | None = None) -> DataFrame:
    """Flatten documents to hourly records with configured coordinates.

    Each document's first 24 complete hours become rows; the configured
    location dimension supplies latitude and longitude; every row of a poll
    gets one ingest stamp.
    """
    rows = hourly_rows(docs, keep=["location_id"], pos_col=None)
    rows = enrich(rows, locations.select("location_id", "latitude", "longitude"), "location_id")
    return with_ingest_time(rows, ingest_time).select(*RECORD_COLUMNS)
