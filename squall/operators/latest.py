"""Keep the latest version of each point (repeated writes replace).

Two forms:

* per field (``latest_fields``): every field keeps its newest non-null value,
  so a later null does not erase an earlier value, like a time-series store
  that merges the fields of repeated writes of one series and timestamp;
* per row (``latest_rows``): the newest whole row.

A value without a version counts as older than any versioned one. Values of
equal version are told apart by the value (the greatest wins), so a result
never depends on the order in which rows arrive.

Both first reduce the rows of one version, then take each field at the newest
version that has it: two hash aggregations over fixed-width buffers, which
combine map-side. ``merged_fields`` merges rows that are unique by key, such as
stored rows and a batch's, whose fields each carry a version of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: orders below every version
UNVERSIONED = -(1 << 63)


def versioned(version: str | Column) -> Column:
    """The version as a bigint, lowest where it is null."""
    col = F.col(version) if isinstance(version, str) else version
    return F.coalesce(col.cast("bigint"), F.lit(UNVERSIONED).cast("bigint"))


def _tied(df: DataFrame, keys: Sequence[str], fields: Sequence[str], version: str) -> DataFrame:
    """The rows of one version as one, field by field; keys, version and fields get their own or working names."""
    stamped = df.select(*keys, versioned(version).alias("_version"), *[F.col(f).alias(f"_{f}") for f in fields])
    return stamped.groupBy(*keys, "_version").agg(*[F.max(f"_{f}").alias(f"_{f}") for f in fields])


def latest_fields(
    df: DataFrame, keys: Sequence[str], fields: Sequence[str], version: str, versions: Sequence[str] = ()
) -> DataFrame:
    """Per key, each field's value at the highest version where it is not null.

    ``versions`` names, field by field, further columns for the versions they come
    from. Keys, version and fields must be of fixed width for the aggregations to
    hash (strings as keys are fine).
    """
    tied = _tied(df, keys, fields, version)
    found = [F.expr(f"max_by(`_{f}`, _version) FILTER (WHERE `_{f}` IS NOT NULL)").alias(f) for f in fields]
    found += [F.expr(f"max(_version) FILTER (WHERE `_{f}` IS NOT NULL)").alias(v) for f, v in zip(fields, versions)]
    return tied.groupBy(*keys).agg(*found)


def merged_fields(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], versions: Sequence[str]) -> DataFrame:
    """At most two ``rows`` per key as one: each field at its higher version, or the greater value at equal ones.

    Two fixed-width pairs of extremes tell these cases apart, so the aggregation hashes.
    """
    found = []
    for f, v in zip(fields, versions, strict=True):
        there = f"FILTER (WHERE `{f}` IS NOT NULL)"
        sums = {"by": f"max_by(`{f}`, `{v}`)", "top": f"max(`{f}`)", "hi": f"max(`{v}`)", "lo": f"min(`{v}`)"}
        found += [F.expr(f"{e} {there}").alias(f"_{f}_{k}") for k, e in sums.items()]
    both = rows.groupBy(*keys).agg(*found)
    out = []
    for f, v in zip(fields, versions):
        equal = F.col(f"_{f}_hi") == F.col(f"_{f}_lo")
        out += [F.when(equal, F.col(f"_{f}_top")).otherwise(F.col(f"_{f}_by")).alias(f), F.col(f"_{f}_hi").alias(v)]
    return both.select(*keys, *out)


def latest_rows(df: DataFrame, keys: Sequence[str], fields: Sequence[str], version: str) -> DataFrame:
    """Per key, the row with the highest version; a null in it stays null.

    Rows tied at one version merge field by field. Keys, version and fields
    must be of fixed width for the aggregations to hash (strings as keys are fine).
    """
    tied = _tied(df, keys, fields, version)
    return tied.groupBy(*keys).agg(*[F.max_by(f"_{f}", "_version").alias(f) for f in fields])
