"""Upsert into a partitioned parquet table: rows replace rows by key.

Only the partitions that the new rows touch are listed, read, merged and
rewritten. Their values are collected first (bounded by the calendar days, and
the few tags, of one batch) and become explicit folders of the read, so neither
the listing nor the scan grows with the table.

Merged rows are written once, in the table's layout but beside it, under the
batch's key. Each touched partition is then replaced by renaming its folder. A crash in
between loses nothing: a replay of the batch finds the staged folder complete and
goes on with the partitions that are left in it. The folder of a batch goes when the next batch of the same writer is through, or at once for a write
without a key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from squall.session import delete_path, list_names, make_folder, move_path, new_name, path_exists

#: rows per written file
ROWS_PER_FILE = 2_000_000
#: rows that one task merges; it holds them in hash tables, whose size this bounds
ROWS_PER_TASK = 200_000
#: partitions that one task writes, one after the other
PARTITIONS_PER_TASK = 30
#: partitions that are renamed at the same time
RENAMES_AT_ONCE = 16

# fixed values: characters that a partition folder's name escapes, and the name of null
_ESCAPED = {chr(c) for c in range(1, 32)} | set("\"#%'*/:=?\\\x7f{[]^")
_NULL_NAME = "__HIVE_DEFAULT_PARTITION__"


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where there is no such path; any other error is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or nothing in it yet
            return None
        raise


def partition_folder(path: str, names: Sequence[str], values: Sequence) -> str:
    """The folder of one partition."""
    def shown(value) -> str:
        if value is None or value == "":
            return _NULL_NAME
        return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))

    return "/".join([path.rstrip("/"), *(f"{n}={shown(v)}" for n, v in zip(names, values, strict=True))])


def read_partitions(
    spark: SparkSession, path: str, schema: T.StructType | str, names: Sequence[str], values: Sequence[Sequence]
) -> DataFrame | None:
    """The given partitions of the table at ``path``, by folder; None if none of them exists."""
    wanted = [partition_folder(path, names, v) for v in values]
    # each parent is listed once, however many of its partitions are asked for
    there = {f"{parent}/{n}" for parent in {f.rpartition("/")[0] for f in wanted} for n in list_names(spark, parent)}
    folders = [f for f in wanted if f in there]
    if not folders:
        return None
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def touched_partitions(rows: DataFrame, names: Sequence[str]) -> dict[tuple, int]:
    """The partition values of ``rows``, as many as one batch has days (and tags), and their numbers of rows."""
    return {tuple(r)[:-1]: r[-1] for r in rows.groupBy(*names).count().collect()}


def _stage(rows: DataFrame, staged: str, partitions: Sequence[str], cluster_by: Sequence[str], files: int) -> None:
    # one file holds a small batch; beyond it, sampled ranges split a large day over several tasks
    dealt = rows.repartitionByRange(files, *partitions, *cluster_by) if files > 1 else rows.repartition(1)
    dealt.write.mode("overwrite").partitionBy(*partitions).parquet(staged)


def _folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders below ``path``, relative to it."""
    names = [n for n in list_names(spark, path) if "=" in n]
    if depth == 1:
        return names
    return [f"{n}/{rest}" for n in names for rest in _folders(spark, f"{path}/{n}", depth - 1)]


def _overwrite(spark: SparkSession, staged: str, path: str, depth: int) -> None:
    """Replace the partitions of ``path`` by those that ``staged`` still holds."""
    folders = _folders(spark, staged, depth)
    for parent in {f"{path}/{f}".rpartition("/")[0] for f in folders}:
        make_folder(spark, parent)

    def replace(folder: str) -> None:
        delete_path(spark, f"{path}/{folder}")
        move_path(spark, f"{staged}/{folder}", f"{path}/{folder}")

    with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:  # calls of the file system, which mostly wait
        list(pool.map(replace, folders))


def merge_tasks(rows: int) -> int:
    """Tasks that merge this many rows, so that what each holds does not grow with their number."""
    return max(1, math.ceil(rows / ROWS_PER_TASK))


def _files(rows: int, partitions: int) -> int:
    return max(1, math.ceil(rows / ROWS_PER_FILE), math.ceil(partitions / PARTITIONS_PER_TASK))


def upsert_partitions(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    partitions: Sequence[str],
    merge: Callable[[DataFrame], DataFrame],
    cluster_by: Sequence[str] = (),
    batch: tuple[str, int] | None = None,
) -> None:
    """Merge ``new`` (which carries the partition columns) into ``path``.

    ``merge`` reduces stored-plus-new rows to the rows to keep, with the same
    columns as ``new``; it must be a keyed aggregation, so that merging the
    same ``new`` again leaves the table unchanged. Its rows come dealt out by
    ``cluster_by``, which should be among its keys, to as many tasks as their number
    asks for. ``batch`` is (writer, number):
    what tells a replayed batch, such as a streaming query's id and its batch id.
    """
    path = path.rstrip("/")
    writer, number = batch or (f"once-{new_name()}", 0)
    folder = f"{path}__staged/{writer}"
    staged = f"{folder}/batch={number}"
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        touched = touched_partitions(new, partitions)
        if not touched:
            return
        stored = read_partitions(spark, path, new.schema, partitions, list(touched))
        rows = new if stored is None else stored.select(*new.columns).unionByName(new)
        count = sum(touched.values()) + (0 if stored is None else stored.count())
        # a partition column may be a constant to the plan, which would then shuffle again for the merge
        rows = rows.repartition(merge_tasks(count), *(cluster_by or partitions))
        _stage(merge(rows).select(*new.columns), staged, partitions, cluster_by, _files(count, len(touched)))
    _overwrite(spark, staged, path, len(partitions))
    if batch is None:
        delete_path(spark, folder)
        return
    for name in list_names(spark, folder):
        if name != f"batch={number}":
            delete_path(spark, f"{folder}/{name}")
