"""spark-submit entry point for the streaming jobs.

    spark-submit --py-files squall.zip squall/streaming/app.py JOB --bootstrap host:9092 \\
        --out <shared>/x --checkpoint <shared>/x-ckpt [--topic T] [--trigger-seconds 300]

Jobs:

* ``kpi``        3 h and 6 h KPIs off one parsed stream (``--sink upsert``: one compact
                 table per series; ``--sink batches``: a folder per batch, with ``--lines``
                 also as line protocol), and the bad messages under ``<out>/bad``
* ``corrected``  3 h and 6 h KPIs with revisions applied, over the store ``<out>/store``
* ``final``      3 h and 6 h KPIs of ended windows, re-sent messages counted once, under
                 ``<out>/kpi``; with ``--lines`` also as line protocol, each batch committed
                 once; late rows and bad messages under ``<out>/late`` and ``<out>/bad``
* ``points``     typed points in the keyed store ``<out>``, bad messages under ``<out>-bad``
* ``archive``    raw text in parquet by day
* ``publish``    landed documents (``--documents``) -> messages, to ``--bootstrap`` or as
                 text under ``--out``

``--files PATH`` replaces Kafka with landed Kafka-shaped parquet files (replays and tests);
``--available-now`` processes what is there and stops. The bootstrap servers and topic fall
back to $KAFKA_BOOTSTRAP and $KAFKA_TOPIC. Each query keeps its own checkpoint under
``--checkpoint``; a job ends when any of its queries ends. Both folders must be on storage
that the driver and all executors share; they are created at the start, so a folder that
cannot be written fails the job then and not at a later batch.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from squall.constants import EXTREME_GUST_THRESHOLD, KPI_WINDOWS, TOPIC
from squall.functions.lines import kpi_lines
from squall.operators.kpi import KpiWindow, final_kpis
from squall.schema import MESSAGE_RECORD
from squall.session import STREAM_DEFAULTS, apply_defaults, make_folder
from squall.sources.line_sink import start_lines
from squall.sources.locations import configured_locations, read_location_document
from squall.sources.streams import MAX_OFFSETS_PER_TRIGGER, document_stream, file_stream, kafka_stream
from squall.streaming import closed, jobs

#: seconds between batches; the archive waits longer, since each batch adds files to a day
DEFAULT_TRIGGER_S = {"archive": 300, "publish": 3600}


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="squall.streaming.app")
    p.add_argument("job", choices=["kpi", "corrected", "final", "points", "archive", "publish"])
    p.add_argument("--bootstrap", default=os.environ.get("KAFKA_BOOTSTRAP"))
    p.add_argument("--topic", default=os.environ.get("KAFKA_TOPIC", TOPIC))
    p.add_argument("--starting-offsets", default="earliest")
    p.add_argument("--max-offsets-per-trigger", type=int, default=MAX_OFFSETS_PER_TRIGGER)
    p.add_argument("--files", help="landed message files instead of Kafka")
    p.add_argument("--max-files-per-trigger", type=int, help="with --files or --documents")
    p.add_argument("--documents", help="landed documents, one JSON document per line (publish)")
    p.add_argument("--locations", help="location map document (publish); the configured locations otherwise")
    p.add_argument("--out", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--threshold", type=float, default=EXTREME_GUST_THRESHOLD)
    p.add_argument("--lines", action="store_true", help="also line-protocol text per batch (final, or kpi with --sink batches)")
    p.add_argument("--sink", choices=["upsert", "batches"],
                   help="compact KPI table merged per batch (default), or one folder per batch")
    p.add_argument("--trigger-seconds", type=int)
    p.add_argument("--available-now", action="store_true")
    args = p.parse_args(argv)
    if args.lines and args.job == "kpi" and args.sink == "upsert":
        p.error("--lines writes per batch: it needs --sink batches")
    args.sink = args.sink or ("batches" if args.lines else "upsert")
    if args.job == "publish" and not args.documents:
        p.error("publish needs --documents")
    if args.job != "publish" and not args.files and not args.bootstrap:
        p.error("--bootstrap or $KAFKA_BOOTSTRAP is required without --files")
    return args


def _trigger(args: argparse.Namespace) -> dict:
    if args.available_now:
        return {"availableNow": True}
    seconds = args.trigger_seconds if args.trigger_seconds is not None else DEFAULT_TRIGGER_S.get(args.job, 0)
    return {"processingTime": f"{seconds} seconds"}


def _messages(spark: SparkSession, args: argparse.Namespace):
    if args.files:
        return file_stream(spark, args.files, max_files_per_trigger=args.max_files_per_trigger)
    return kafka_stream(
        spark, args.bootstrap, args.topic, args.starting_offsets,
        maxOffsetsPerTrigger=str(args.max_offsets_per_trigger),
    )


def _publish(spark: SparkSession, args: argparse.Namespace, trigger: dict):
    docs = document_stream(spark, args.documents, args.max_files_per_trigger)
    dim = read_location_document(spark, args.locations) if args.locations else configured_locations(spark)
    kafka = {"kafka.bootstrap.servers": args.bootstrap, "topic": args.topic} if args.bootstrap else None
    return jobs.start_publish(docs, dim, args.checkpoint, args.out, kafka, trigger)


def _final(messages, specs: dict, args: argparse.Namespace, out: str, ckpt: str, trigger: dict) -> dict:
    records = closed.once(jobs.parsed_records(messages, MESSAGE_RECORD))
    found = {}
    for label, spec in specs.items():
        found[label] = closed.start_final_kpis(records, spec, f"{out}/kpi/{label}", f"{ckpt}/{label}", label, trigger)
        if args.lines:
            lines = kpi_lines(final_kpis(records, spec), label)
            found[f"{label}-lines"] = start_lines(lines, f"{out}/lines/{label}", f"{ckpt}/{label}-lines", trigger)
    timed = jobs.parsed_records(messages, MESSAGE_RECORD, watermark=None)
    return found | {"late": closed.start_late_rows(timed, f"{out}/late", f"{ckpt}/late", trigger=trigger)}


def start(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Start the queries of a job."""
    trigger, out, ckpt = _trigger(args), args.out.rstrip("/"), args.checkpoint.rstrip("/")
    if args.job == "publish":
        return {"publish": _publish(spark, args, trigger)}
    messages = _messages(spark, args)
    if args.job == "archive":
        return {"archive": jobs.start_archive(messages, out, ckpt, trigger)}
    if args.job == "points":
        return {
            "points": jobs.start_points(messages, out, f"{ckpt}/points", trigger),
            "bad": jobs.start_bad_records(messages, f"{out}-bad", f"{ckpt}/bad", trigger),
        }
    bad = {"bad": jobs.start_bad_records(messages, f"{out}/bad", f"{ckpt}/bad", trigger)}
    corrected = args.job == "corrected"
    specs = {label: KpiWindow(size, slide, args.threshold, distinct_hours=corrected) for size, slide, label in KPI_WINDOWS}
    if args.job == "final":
        return _final(messages, specs, args, out, ckpt, trigger) | bad
    if corrected:
        query = jobs.start_corrected_kpis(messages, specs, f"{out}/store", f"{out}/table", f"{ckpt}/corrected", trigger)
        return {"corrected": query} | bad
    series = jobs.start_kpi_series(messages, specs, out, ckpt, trigger, lines=args.lines, upsert=args.sink == "upsert")
    return series | bad


def run(spark: SparkSession, argv: list[str]) -> dict:
    args = parse_args(argv)
    applied = apply_defaults(spark, STREAM_DEFAULTS)
    try:
        for folder in (args.out, args.checkpoint):
            make_folder(spark, folder)
        queries = start(spark, args)
        if args.available_now:
            for q in queries.values():
                jobs.run_to_end(q)
        else:
            jobs.await_any(spark)
    finally:
        for key in applied:  # the session is the caller's
            spark.conf.unset(key)
    return queries


def main() -> None:
    spark = SparkSession.builder.appName("squall-streaming").getOrCreate()
    run(spark, sys.argv[1:])


if __name__ == "__main__":
    main()
