"""Stream sources. The message source is injectable: Kafka in production,
a folder of Kafka-shaped files (key, value, topic, partition, offset,
timestamp) in tests and replays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from squall.constants import TOPIC
from squall.schema import DOCUMENT

MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)


#: messages of one micro-batch unless the caller says otherwise
MAX_OFFSETS_PER_TRIGGER = 10_000_000


def kafka_options(bootstrap: str, topic: str = TOPIC, starting_offsets: str = "earliest", **extra: str) -> dict:
    """Options for ``readStream.format("kafka")``.

    ``earliest`` replays what the topic retains on first start; the checkpoint
    decides the position afterwards. ``maxOffsetsPerTrigger`` bounds every
    batch, also the first one over a long topic.
    """
    if not bootstrap:
        raise ValueError("a bootstrap server list is required")
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting_offsets,
            "maxOffsetsPerTrigger": str(MAX_OFFSETS_PER_TRIGGER)}
    opts.update(extra)
    return opts


def kafka_stream(spark: SparkSession, bootstrap: str, topic: str = TOPIC, starting_offsets: str = "earliest",
                 **extra: str) -> DataFrame:
    """Message stream from Kafka (needs the Kafka connector on the classpath)."""
    reader = spark.readStream.format("kafka")
    for k, v in kafka_options(bootstrap, topic, starting_offsets, **extra).items():
        reader = reader.option(k, v)
    return reader.load()


def file_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = MESSAGE,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Message stream over landed files with the Kafka message schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def text_stream(spark: SparkSession, path: str) -> DataFrame:
    """One message per line of landed text files (column ``value``)."""
    return spark.readStream.format("text").load(path)


def document_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed API documents as a stream, one JSON document per line; ``location_id``
    comes from the document or from a ``location_id=<name>`` folder level."""
    reader = spark.readStream.schema(T.StructType([*DOCUMENT.fields, T.StructField("location_id", T.StringType())]))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(path)
