"""Streams whose output is final: KPIs of ended windows, re-sent messages counted once, late rows kept.

* ``start_final_kpis``: bucket-first KPIs as two chained stateful aggregations in
  append mode. A row updates one bucket of state (the update-mode stream of
  ``jobs`` updates 18 or 36 windows), each window is written once, when the
  watermark has passed its end, and the file sink's log makes that exactly once.
* ``once``: records that a producer sends again are dropped before they reach
  any aggregation. State holds a key until the watermark has passed its time by
  the delay; a copy that comes later still is late and dropped as such.
* ``start_late_rows``: the rows that these streams drop as late, kept as a table.
  Spark tells only their number. The greatest event time so far is written
  beside the table with each batch, which gives the watermark that the next one
  starts with; the rows at or behind it are the late ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from squall.constants import WATERMARK
from squall.operators.kpi import KpiWindow, final_kpis, interval_seconds
from squall.operators.upsert import read_if_exists
from squall.schema import KPI_COLUMNS
from squall.session import delete_path, list_names

#: what tells a message from a later version of the same forecast
MESSAGE_KEY = ("location_id", "forecast_time", "ingest_time")


def once(records: DataFrame, key: tuple[str, ...] = MESSAGE_KEY) -> DataFrame:
    """``records`` (with a watermark) without repeated messages."""
    return records.dropDuplicatesWithinWatermark(list(key))


def start_final_kpis(
    records: DataFrame, spec: KpiWindow, path: str, checkpoint: str, label: str, trigger: dict | None = None
) -> StreamingQuery:
    """KPIs of ended windows, appended to parquet under ``path``; ``records`` carry ``event_time`` and a watermark."""
    rows = final_kpis(records, spec).select(*KPI_COLUMNS, F.lit(label).alias("window"))
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def read_final_kpis(spark: SparkSession, path: str) -> DataFrame:
    """What ``start_final_kpis`` has committed; no rows where no window has ended yet."""
    found = read_if_exists(spark, path)
    if found is None:
        types = {c: "double" for c in KPI_COLUMNS} | {"location_id": "string", "extreme_flag": "int"}
        types |= {"extreme_duration_hours": "bigint", "window_end_s": "bigint", "window": "string"}
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in types.items()))
    return found.select(*KPI_COLUMNS, "window")


@dataclass
class LateRowSink:
    """foreachBatch sink: rows at or behind the watermark to ``path/late/batch_id=N``.

    The watermark of a batch is the greatest event time of all earlier ones
    less ``delay``, which ``path/marks/batch_id=N`` carries from batch to batch;
    the marks of the last two are kept. A replayed batch starts from the mark
    before it and rewrites its own folders, so it finds the same rows.

    Spark drops by this watermark after a restart or a batch without data;
    between batches with data its filter is one batch behind, so it may still
    count rows that are listed here.
    """

    path: str
    delay: str = WATERMARK

    def newest(self, spark: SparkSession, batch_id: int) -> int | None:
        """The greatest event time (unix microseconds) before batch ``batch_id``."""
        marks = read_if_exists(spark, f"{self.path}/marks")
        if marks is None:
            return None
        return marks.where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = self.newest(spark, batch_id)
        rows = batch.persist()
        try:
            if before is not None:
                # Spark keeps its watermark in whole milliseconds, and never below the epoch
                mark = max(0, before // 1000 - 1000 * interval_seconds(self.delay)) * 1000
                late = rows.where(F.unix_micros("event_time") <= F.lit(mark))
                late = late.withColumn("watermark", F.timestamp_micros(F.lit(mark)))
                late.write.mode("overwrite").parquet(f"{self.path}/late/batch_id={batch_id}")
            now = F.greatest(F.max(F.unix_micros("event_time")), F.lit(before).cast("bigint"))
            rows.agg(now.alias("newest")).write.mode("overwrite").parquet(f"{self.path}/marks/batch_id={batch_id}")
        finally:
            rows.unpersist()
        for name in list_names(spark, f"{self.path}/marks"):
            if name.startswith("batch_id=") and int(name.split("=")[1]) < batch_id - 1:
                delete_path(spark, f"{self.path}/marks/{name}")


def start_late_rows(
    records: DataFrame, path: str, checkpoint: str, delay: str = WATERMARK, trigger: dict | None = None
) -> StreamingQuery:
    """The late rows of ``records`` (with ``event_time``, no watermark) under ``path/late``.

    Run it over the same source and with the same batch limits as the stream
    whose late rows it keeps, so that both see the same batches.
    """
    writer = records.writeStream.foreachBatch(LateRowSink(path, delay)).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_late_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The late rows so far, with the watermark they were behind; None before the second batch."""
    return read_if_exists(spark, f"{path}/late")
