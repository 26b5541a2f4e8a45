"""Looking into running and stopped streams: their state as rows, their progress as a table.

* ``open_windows`` reads the state store of a KPI stream (``jobs.start_kpis``) from its
  checkpoint: the windows that are still open, with the partial KPIs they hold. The
  reader runs as a batch job over the state files, a partition each, and disturbs
  nothing; a stream that has been restarted must hold what the records derive.
* ``ProgressTable`` is a listener that appends each batch's progress to a table: what
  came in, what the state operators hold, updated and dropped, the watermark.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from squall.operators.upsert import read_if_exists

#: the aggregate buffers of ``kpi.streaming_kpis``, in its order
BUFFERS = "units long, rest double, samples long, max_wind_speed_10m double, max_wind_gusts_10m double, extreme_flag int, extreme_duration_hours long"


def state_rows(spark: SparkSession, checkpoint: str, operator: int = 0, batch_id: int | None = None) -> DataFrame:
    """key, value and partition_id of every row of a stateful operator, as of its last (or the given) batch."""
    reader = spark.read.format("statestore").option("operatorId", str(operator))
    if batch_id is not None:
        reader = reader.option("batchId", str(batch_id))
    return reader.load(checkpoint)


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """location_id, window_end_s, samples, maxima, extreme flag and duration of a KPI stream's open windows."""
    rows = state_rows(spark, checkpoint, batch_id=batch_id)
    held = rows.select(
        F.col("key").cast("struct<window:struct<start:timestamp,end:timestamp>,location_id:string>").alias("k"),
        F.col("value").cast(f"struct<{', '.join(f.replace(' ', ':') for f in BUFFERS.split(', '))}>").alias("v"),
    )
    return held.select(
        F.col("k.location_id").alias("location_id"), F.col("k.window.end").cast("long").alias("window_end_s"),
        "v.samples", "v.max_wind_speed_10m", "v.max_wind_gusts_10m", "v.extreme_flag", "v.extreme_duration_hours",
    )


PROGRESS = (
    "query_id string, run_id string, name string, batch_id long, timestamp string, input_rows long, watermark string, "
    "state_rows long, updated_rows long, dropped_rows long, duration_ms long"
)


def progress_row(progress: dict) -> tuple:
    """A progress report as a row of ``PROGRESS``; state counts are sums over its operators."""
    operators = progress.get("stateOperators") or []
    counts = (sum(int(o.get(c) or 0) for o in operators) for c in ("numRowsTotal", "numRowsUpdated", "numRowsDroppedByWatermark"))
    return (
        progress.get("id"), progress.get("runId"), progress.get("name"), int(progress["batchId"]), progress.get("timestamp"),
        int(progress.get("numInputRows") or 0), (progress.get("eventTime") or {}).get("watermark"), *counts,
        int((progress.get("durationMs") or {}).get("triggerExecution") or 0),
    )


class ProgressTable(StreamingQueryListener):
    """Appends a row per batch of every query of the session to the table at ``path``.

    Add it with ``spark.streams.addListener``. A batch that is run again after a
    restart has a row per run; ``read_progress`` keeps the last.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = progress_row(json.loads(event.progress.json))
        self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each query and batch."""
    rows = read_if_exists(spark, path)
    if rows is None:
        return spark.createDataFrame([], PROGRESS)
    names = [c for c in rows.columns if c not in ("query_id", "batch_id")]
    return rows.groupBy("query_id", "batch_id").agg(*(F.max_by(c, "timestamp").alias(c) for c in names)).select(*rows.columns)
