"""Documents of parallel hourly arrays to one row per hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.constants import HOURLY_VARIABLES, HOURS_PER_POLL


def hourly_rows(
    docs: DataFrame,
    keep: Sequence[str] = (),
    hourly_col: str = "hourly",
    arrays: Sequence[str] = ("time", *HOURLY_VARIABLES),
    limit: int | None = HOURS_PER_POLL,
    pos_col: str | None = "hour_index",
) -> DataFrame:
    """Zip the named arrays of ``hourly_col`` position by position.

    Rows stop at the shortest array (a missing ``hourly`` or a missing array
    counts as empty, so it yields no rows) and at ``limit`` per document.
    Null elements stay null. The array named ``time`` becomes
    ``forecast_time``; measures are cast to double.
    """
    h = F.col(hourly_col)
    htype = docs.schema[hourly_col].dataType
    cols = []
    present = set(htype.names) if isinstance(htype, T.StructType) else set()
    for name in arrays:
        if name in present:
            elem = htype[name].dataType.elementType
            cols.append(F.coalesce(h[name], F.array().cast(T.ArrayType(elem))).alias(name))
        else:  # an array the document type does not have at all counts as empty
            elem = T.LongType() if name == "time" else T.DoubleType()
            cols.append(F.array().cast(T.ArrayType(elem)).alias(name))
    staged = docs.select(*keep, *cols)
    n = F.least(*[F.size(F.col(a)) for a in arrays])
    if limit is not None:
        n = F.least(n, F.lit(int(limit)))
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    exploded = staged.select(*keep, F.posexplode(F.slice(zipped, 1, n)).alias("_pos", "_e"))
    out_cols = []
    for name in arrays:
        if name == "time":
            out_cols.append(F.col("_e")[name].cast("bigint").alias("forecast_time"))
        else:
            out_cols.append(F.col("_e")[name].cast("double").alias(name))
    pos = [F.col("_pos").alias(pos_col)] if pos_col else []
    return exploded.select(*keep, *pos, *out_cols)


def with_ingest_time(rows: DataFrame, stamp: int | Column | None = None) -> DataFrame:
    """One ingest stamp (unix seconds) for every row of a poll."""
    col = F.unix_seconds(F.current_timestamp()) if stamp is None else (
        stamp if isinstance(stamp, Column) else F.lit(int(stamp))
    )
    return rows.withColumn("ingest_time", col.cast("bigint"))
