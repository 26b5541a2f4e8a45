"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``, and masks of keys."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.llm.text import free_name
from squall.session import delete_path, scratch_path

_MADE: "weakref.WeakKeyDictionary[SparkSession, list[str]]" = weakref.WeakKeyDictionary()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared folder, for :func:`clean` to remove."""
    path = scratch_path(spark, f"llm-{name}")
    _MADE.setdefault(spark, []).append(path)
    return path


def clean(spark: SparkSession) -> int:
    """Remove the intermediate tables that this session's operators have written; return their number.

    Results are lazy and read them, so call it when the results that are wanted have
    been written elsewhere. What an ended session has left lies under
    ``<spark.checkpoint.dir>/squall`` in folders that begin with ``llm-``.
    """
    paths = _MADE.pop(spark, [])
    for path in paths:
        delete_path(spark, path)
    return len(paths)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back.

    This cuts the lineage and computes ``df`` once: whatever reads the result reads
    files that survive the loss of executors.
    """
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: 64-bit words of a mask; bounds what is broadcast, not the data
MASKS = 1 << 18


def masks(keys: DataFrame, column: str) -> DataFrame:
    """(word, mask): at most ``MASKS`` rows that hold a bit for the hash of every key."""
    h = F.xxhash64(column)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(64)).cast("int"))
    word = F.pmod(F.shiftrightunsigned(h, 6), F.lit(MASKS))
    return keys.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("mask"))


def marked(df: DataFrame, column: str, known: DataFrame, mark: str) -> DataFrame:
    """``df`` with whether its key may be among those of the masks ``known``; "no" is certain.

    This keeps rows that meet nothing out of a shuffle. With far more keys than bits
    every row is marked, and the join that follows does all the work.
    """
    word, mask = free_name(df, "_word", "_mask")
    h = F.xxhash64(column)
    table = F.broadcast(known.select(F.col("word").alias(word), F.col("mask").alias(mask)))  # at most MASKS rows
    bit = F.call_function("getbit", F.coalesce(F.col(mask), F.lit(0).cast("long")), F.pmod(h, F.lit(64)).cast("int"))
    joined = df.join(table, F.pmod(F.shiftrightunsigned(h, 6), F.lit(MASKS)) == F.col(word), "left")
    return joined.select(*df.columns, (bit == 1).alias(mark))
