"""Batch sinks: JSON messages (Kafka or files) and line-protocol text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from squall.functions.parse import json_text


def write_messages(df: DataFrame, path: str | None = None, kafka: dict | None = None,
                   columns: Sequence[str] | None = None) -> None:
    """Publish rows as JSON text (nulls written, UTF-8, no key).

    With ``kafka`` options (``kafka.bootstrap.servers``, ``topic``) the rows go
    to Kafka; otherwise they are appended as text files under ``path``.
    """
    msgs = df.select(json_text(list(columns) if columns else df.columns).alias("value"))
    if kafka:
        writer = msgs.write.format("kafka")
        for k, v in kafka.items():
            writer = writer.option(k, v)
        writer.save()
    elif path:
        msgs.write.mode("append").text(path)
    else:
        raise ValueError("give a path or kafka options")


def write_lines(lines: DataFrame, path: str, col: str = "line") -> None:
    """Append rendered lines as UTF-8 text files (one task per partition)."""
    lines.select(col).write.mode("append").text(path)
