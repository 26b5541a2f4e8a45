"""Work on Arrow batches: one helper for all operators that run Python per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: rows handed on at once; a batch of results never holds more
ROWS = 1024


def map_rows(df: DataFrame, schema: str, each: Callable[[], Callable[..., Iterator[tuple]]]) -> DataFrame:
    """A row function over Arrow batches: ``each()``, called once per task, returns it.

    The row function gets a row's values and yields any number of result rows.
    """
    fields = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, out = each(), []
        for batch in batches:
            # value by value, so that a batch of long texts is not held twice
            for row in zip(*batch.columns):
                out.extend(work(*(x.as_py() for x in row)))
                if len(out) >= ROWS:
                    yield _batch(out, arrow)
                    out = []
        if out:
            yield _batch(out, arrow)

    return df.mapInArrow(run, fields)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema
    )
