"""Column helpers shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: white space as the contracts define it: space and the control codes 9 to 13
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """Runs of characters other than white space, in order."""
    return F.array_remove(F.split(text, f"[{SPACE}]+"), "")


def squeeze(text: Column) -> Column:
    """The words of ``text`` joined by one space."""
    return F.trim(F.regexp_replace(text, f"[{SPACE}]+", " "))


def free_name(df: DataFrame, *names: str) -> list[str]:
    """Names for working columns that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
