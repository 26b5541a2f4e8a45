"""Streaming jobs and their sinks.

* ``start_archive``: messages -> text -> parquet, append mode, partitioned by
  the UTC day of the message timestamp.
* ``start_bad_records``: messages that no KPI can use -> parquet, append mode,
  with the reason, so that nothing vanishes uncounted.
* ``start_kpis`` (parity mode): messages -> parsed records -> event time +
  watermark -> one windowed aggregate per spec -> update mode -> a KPI sink;
  ``start_kpi_series`` runs several specs off one stream.
* ``start_points``: messages -> typed points -> ``PointStoreSink`` (upsert).
* ``start_corrected_kpis`` (corrected mode): messages -> ``CorrectedKpiSink``,
  which upserts into the point store and recomputes the touched windows.
* ``start_partials``: messages -> ``PartialsSink``, which keeps bucket partials.
* ``start_publish``: landed documents -> hourly records -> messages.

Every query has its own checkpoint location (shared storage). Sinks are
idempotent per batch id: a replayed batch rewrites its own folder, or repeats
the same upsert from its staged rows (``operators.upsert``), so a restart after
a lost executor or driver neither duplicates nor loses output. Empty batches
write nothing.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from squall.constants import KPI_MEASUREMENT, POINT_MEASUREMENT, WATERMARK
from squall.functions.lines import render_lines
from squall.functions.parse import as_text, event_time, in_time_range, json_text, parse_json, split_bad
from squall.operators import partials
from squall.operators.kpi import KpiWindow, streaming_kpis, window_kpis
from squall.operators.store import read_days, to_points, write_points
from squall.operators.upsert import upsert_partitions
from squall.schema import KPI_COLUMNS, KPI_RECORD, RECORD, RECORD_COLUMNS
from squall.sources.files import documents_to_records


def _utc_day(ts_col: str):
    return F.date_from_unix_date(F.floor(F.unix_seconds(F.col(ts_col)) / F.lit(86400)).cast("int"))


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def start_archive(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append raw message text to parquet (stateless, no shuffle)."""
    rows = messages.select(as_text("value").alias("value"), _utc_day("timestamp").alias("archive_date"))
    writer = (
        rows.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("archive_date")
        .outputMode("append")
    )
    return _trigger(writer, trigger).start()


def compact_archive(spark: SparkSession, path: str, out: str) -> None:
    """Rewrite an archive into fewer, larger files per day at ``out``.

    Reading ``path`` goes through the file sink's metadata log, so only
    committed files are read. The file sink owns ``path``, so compaction
    writes a new dataset. Range partitioning on (day, hash of the message)
    gives each day a number of files in proportion to its size, and still
    splits a hot day over several tasks.
    """
    raw = spark.read.parquet(path)
    (
        raw.repartitionByRange("archive_date", F.xxhash64("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("archive_date")
        .parquet(out)
    )


def parsed_records(messages: DataFrame, schema=KPI_RECORD, watermark: str | None = WATERMARK) -> DataFrame:
    """Messages to typed records with ``event_time``; rows without a usable time
    are dropped here (``start_bad_records`` keeps them)."""
    rec = parse_json(messages.select(as_text("value").alias("value")), "value", schema)
    rec = rec.where(in_time_range(F.col("forecast_time"))).withColumn("event_time", event_time("forecast_time"))
    return rec.withWatermark("event_time", watermark) if watermark else rec


BAD_COLUMNS = ["topic", "partition", "offset", "value", "location_id", "bad_reason"]


def bad_messages(messages: DataFrame) -> DataFrame:
    """The messages that ``parsed_records`` drops: where they stand, their text and why."""
    text = messages.select("topic", "partition", "offset", as_text("value").alias("value"))
    _, bad = split_bad(parse_json(text, "value", RECORD, keep=["topic", "partition", "offset", "value"], with_status=True))
    return bad.select(*BAD_COLUMNS)


def start_bad_records(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Route bad messages to parquet (stateless, no shuffle); counting its rows counts them."""
    writer = (
        bad_messages(messages)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return _trigger(writer, trigger).start()


def batch_key(batch: DataFrame, batch_id: int) -> tuple[str, int] | None:
    """(query id, batch id) inside a streaming query: what a replay has in common; else None."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return (query, batch_id) if query else None


@dataclass
class KpiBatchSink:
    """foreachBatch sink: each batch's KPI rows to ``path/batch_id=N`` (parquet),
    optionally also rendered as line protocol to ``lines_path/batch_id=N``.
    The batch is computed once (persisted for both writes); a batch without
    changed windows writes nothing."""

    path: str
    label: str
    lines_path: str | None = None
    measurement: str = KPI_MEASUREMENT

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*KPI_COLUMNS).withColumn("window", F.lit(self.label)).persist()
        try:
            if rows.isEmpty():  # nothing changed in this batch
                return
            rows.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
            if self.lines_path:
                text = render_lines(
                    rows, self.measurement, {"location_id": "location_id", "window": self.label},
                    [c for c in KPI_COLUMNS if c not in ("location_id", "window_end_s")], "window_end_s",
                )
                text.write.mode("overwrite").text(f"{self.lines_path}/batch_id={batch_id}")
        finally:
            rows.unpersist()


KPI_KEY = ["location_id", "window", "window_end_s"]
_KPI_FIELDS = [c for c in KPI_COLUMNS if c not in ("location_id", "window_end_s")]


def _newest_batch(rows: DataFrame) -> DataFrame:
    fields = [F.max_by(f, "batch_id").alias(f) for f in _KPI_FIELDS]
    best = rows.groupBy(*KPI_KEY, "end_date").agg(*fields, F.max("batch_id").alias("batch_id"))
    return best.select(*KPI_KEY, "end_date", *_KPI_FIELDS, "batch_id")


def upsert_kpis(
    spark: SparkSession, rows: DataFrame, path: str, batch_id: int, batch: tuple[str, int] | None = None
) -> None:
    """Merge KPI rows into the KPI table at ``path`` (one row per location,
    window tag and window end; the newest batch wins), partitioned by tag and
    UTC day of the window end so that a batch rewrites only the days it touches."""
    new = rows.select(
        *KPI_KEY,
        *_KPI_FIELDS,
        F.lit(int(batch_id)).cast("bigint").alias("batch_id"),
        F.date_from_unix_date(F.floor(F.col("window_end_s") / F.lit(86400)).cast("int")).alias("end_date"),
    )
    upsert_partitions(
        spark, new, path, ["window", "end_date"], _newest_batch, cluster_by=["location_id", "window_end_s"], batch=batch
    )


def read_kpis(spark: SparkSession, path: str) -> DataFrame:
    """The KPI table written by ``KpiUpsertSink``."""
    return spark.read.parquet(path).select(*KPI_COLUMNS, "window")


@dataclass
class KpiUpsertSink:
    """foreachBatch sink: merge each batch's changed windows into one compact
    KPI table (update mode + upsert downstream, like repeated writes of a
    series replacing each other). Replays are harmless; empty batches skip."""

    path: str
    label: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*KPI_COLUMNS).withColumn("window", F.lit(self.label)).persist()
        try:
            if not rows.isEmpty():
                upsert_kpis(batch.sparkSession, rows, self.path, batch_id, batch_key(batch, batch_id))
        finally:
            rows.unpersist()


def start_kpis(
    records: DataFrame,
    spec: KpiWindow,
    sink: KpiBatchSink,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Windowed KPIs in update mode: each batch emits the windows it changed."""
    kpis = streaming_kpis(records, spec)
    writer = (
        kpis.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, trigger).start()


def start_kpi_series(
    messages: DataFrame,
    specs: dict[str, KpiWindow],
    out_base: str,
    checkpoint_base: str,
    trigger: dict | None = None,
    lines: bool = False,
    upsert: bool = False,
) -> dict[str, StreamingQuery]:
    """One KPI query per labelled window spec, all off one parsed stream; each
    has its own checkpoint and sink. With ``upsert`` every query merges into
    the compact table ``<base>/table/<label>``; otherwise each batch lands in
    ``<base>/kpi/<label>/batch_id=N`` (and ``<base>/lines/<label>/...``)."""
    records = parsed_records(messages)
    out = {}
    for label, spec in specs.items():
        if upsert:
            sink = KpiUpsertSink(f"{out_base}/table/{label}", label)
        else:
            sink = KpiBatchSink(f"{out_base}/kpi/{label}", label, f"{out_base}/lines/{label}" if lines else None)
        out[label] = start_kpis(records, spec, sink, f"{checkpoint_base}/{label}", trigger)
    return out


def await_any(spark: SparkSession, timeout_s: float | None = None) -> None:
    """Block until any active query ends (its failure is raised)."""
    spark.streams.awaitAnyTermination(timeout_s)


@dataclass
class PointStoreSink:
    """foreachBatch sink: upsert each batch's points into the store. Re-running
    a batch writes the same rows again, so replays are harmless."""

    path: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        points = to_points(batch).persist()
        try:
            if not points.isEmpty():
                write_points(batch.sparkSession, points, self.path, batch=batch_key(batch, batch_id))
        finally:
            points.unpersist()


def start_points(messages: DataFrame, store_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Messages -> typed points -> keyed parquet store (stateless stream; the
    checkpoint plays the role of the consumer group's committed offsets)."""
    records = parsed_records(messages, RECORD, watermark=None)
    writer = records.writeStream.foreachBatch(PointStoreSink(store_path)).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def touched_windows(changed: DataFrame, spec: KpiWindow, time_col: str = "forecast_time") -> DataFrame:
    """(location_id, window_end_s) of every window containing a changed row."""
    t, slide, size = f"`{time_col}`", spec.slide_s, spec.size_s
    buckets = changed.where(f"{t} IS NOT NULL").selectExpr("location_id", f"{t} - pmod({t}, {slide}) AS bucket").distinct()
    return buckets.selectExpr(
        "location_id", f"explode(sequence(bucket + {slide}, bucket + {size}, {slide})) AS window_end_s"
    ).distinct()


def covered_days(affected: DataFrame, spec: KpiWindow) -> list:
    """The UTC days that the ``affected`` windows cover: as many as one batch's windows span."""
    days = affected.selectExpr(
        f"explode(sequence(date_from_unix_date(CAST(floor((window_end_s - {spec.size_s}) / 86400) AS INT)),"
        " date_from_unix_date(CAST(floor((window_end_s - 1) / 86400) AS INT)))) AS day"
    )
    return sorted(r.day for r in days.distinct().collect())


def recompute_windows(stored: DataFrame, affected: DataFrame, spec: KpiWindow) -> DataFrame:
    """KPIs of the ``affected`` windows from the stored points of the days they
    cover, computed bucket-first and narrowed to these windows."""
    rows = stored.selectExpr("location_id", "_time AS forecast_time", "wind_speed_10m", "wind_gusts_10m")
    return window_kpis(rows, spec).join(affected, ["location_id", "window_end_s"], "left_semi")


@dataclass
class CorrectedKpiSink:
    """foreachBatch sink for corrected KPIs: upsert the batch into the point
    store (newest version per field), then recompute every window the batch
    touched from the stored points and merge those rows into the KPI table at
    ``kpi_path``. Revisions and late rows update their windows instead of
    being dropped; a replayed batch rewrites the same rows. Only the days that
    the batch's windows cover are listed and read."""

    store_path: str
    kpi_path: str
    specs: dict
    measurement: str = POINT_MEASUREMENT

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, key = batch.sparkSession, batch_key(batch, batch_id)
        points = to_points(batch, self.measurement).persist()
        try:
            if points.isEmpty():
                return
            write_points(spark, points, self.store_path, batch=key)
            parts = []
            for label, spec in self.specs.items():
                affected = touched_windows(points, spec, "_time")
                stored = read_days(spark, self.store_path, self.measurement, covered_days(affected, spec))
                parts.append(recompute_windows(stored, affected, spec).withColumn("window", F.lit(label)))
            out = parts[0]
            for p in parts[1:]:
                out = out.unionByName(p)
            upsert_kpis(spark, out, self.kpi_path, batch_id, key)
        finally:
            points.unpersist()


def start_corrected_kpis(
    messages: DataFrame,
    specs: dict,
    store_path: str,
    kpi_path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Corrected-mode KPI stream (stateless; the point store is the state)."""
    records = parsed_records(messages, RECORD, watermark=None)
    writer = records.writeStream.foreachBatch(CorrectedKpiSink(store_path, kpi_path, specs)).option(
        "checkpointLocation", checkpoint
    )
    return _trigger(writer, trigger).start()


@dataclass
class PartialsSink:
    """foreachBatch sink: fold each batch into stored bucket partials (``operators.partials``),
    from which KPIs of any window size are finished without going back to the points."""

    path: str
    spec: KpiWindow

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        partials.update(batch.sparkSession, batch, self.path, self.spec, batch=batch_key(batch, batch_id))


def start_partials(
    messages: DataFrame, path: str, checkpoint: str, spec: KpiWindow = KpiWindow(), trigger: dict | None = None
) -> StreamingQuery:
    """Bucket partials kept up to date (stateless stream; the partials are the state)."""
    records = parsed_records(messages, RECORD, watermark=None)
    writer = records.writeStream.foreachBatch(PartialsSink(path, spec)).option("checkpointLocation", checkpoint)
    return _trigger(writer, trigger).start()


def start_publish(
    documents: DataFrame,
    locations: DataFrame,
    checkpoint: str,
    path: str | None = None,
    kafka: dict | None = None,
    trigger: dict | None = None,
    ingest_time: int | None = None,
) -> StreamingQuery:
    """Landed documents -> hourly records -> JSON messages, to Kafka or to text files under ``path``.

    Run it with a periodic trigger; each batch is one poll and its rows carry
    the batch's time as ingest stamp (or ``ingest_time``).
    """
    rows = documents_to_records(documents, locations, ingest_time).select(json_text(RECORD_COLUMNS).alias("value"))
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if kafka:
        writer = writer.format("kafka").options(**kafka)
    elif path:
        writer = writer.format("text").option("path", path)
    else:
        raise ValueError("give a path or kafka options")
    return _trigger(writer, trigger).start()


def latest_emissions(spark: SparkSession, path: str) -> DataFrame:
    """The last emitted row of every (location, window, end) across batches."""
    fields = [F.max_by(f, "batch_id").alias(f) for f in _KPI_FIELDS]
    best = spark.read.parquet(path).groupBy(*KPI_KEY).agg(*fields)
    return best.select("location_id", *_KPI_FIELDS, "window_end_s", "window")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived text parsed back into records."""
    return parse_json(spark.read.parquet(path).select("value"), "value", RECORD)


def run_to_end(query: StreamingQuery, timeout_s: float | None = None) -> list[dict]:
    """Wait for an ``availableNow`` query; return all its progress reports.

    Spark keeps only the last reports, so they are gathered while the query runs.
    """
    reports: dict[tuple, dict] = {}
    until = None if timeout_s is None else time.monotonic() + timeout_s
    while True:
        ended = query.awaitTermination(1)
        reports |= {(p["runId"], p["batchId"]): dict(p) for p in query.recentProgress}
        if ended:
            break
        if until is not None and time.monotonic() > until:
            query.stop()
            raise TimeoutError(f"stream {query.name or query.id} did not finish")
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(str(exc))
    return list(reports.values())


def state_metrics(progress: list[dict]) -> list[tuple[int, int, int, int]]:
    """(batch_id, input rows, state rows updated, rows dropped by watermark) per data batch."""
    out = []
    for p in progress:
        ops = p.get("stateOperators") or []
        upd = sum(int(o.get("numRowsUpdated", 0)) for o in ops)
        dropped = sum(int(o.get("numRowsDroppedByWatermark", 0)) for o in ops)
        n = int(p.get("numInputRows", 0))
        if n or upd or dropped:
            out.append((int(p["batchId"]), n, upd, dropped))
    return out
