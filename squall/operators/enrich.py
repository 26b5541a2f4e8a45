"""Join facts to a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def enrich(facts: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column, how: str = "inner") -> DataFrame:
    """Attach dimension columns to each fact row.

    The planner broadcasts the dimension if its bytes are below
    ``spark.sql.autoBroadcastJoinThreshold``, at planning or, with AQE, once
    its size is known; otherwise it sort-merges and AQE splits skewed keys.
    """
    return facts.join(dim, on, how)
