"""Render rows as time-series line protocol text with built-in functions.

``measurement,tag=v,... field=v,... timestamp``: booleans lower-case,
integers suffixed ``i``, floats in Spark's text (shortest digits; ``E``
notation outside 1e-3..1e7) or, with ``python_floats``, spelled exactly as
the original writes them (``float_text``; a large expression, so it costs
whole-stage code generation on wide rows), strings quoted. Null fields are left out; a row with no field or no timestamp
yields no line (null). Tag values and the measurement have commas, spaces
and equals signs escaped and line breaks spelled ``\\n``; a null tag value
prints as ``None``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from squall.constants import KPI_MEASUREMENT
from squall.schema import KPI_COLUMNS

NULL_TAG = "None"


def _escape(col: Column, chars: str) -> Column:
    # line breaks end a line whatever stands before them: they become the two signs \n
    one_line = F.regexp_replace(F.regexp_replace(col, r"\r\n?", "\n"), r"\n", r"\\n")
    return F.regexp_replace(one_line, f"([{chars}])", r"\\$1")


def field_text(name: str, col: Column, dtype: T.DataType, python_floats: bool = False) -> Column:
    """``name=value`` for one field, null when the value is null."""
    if isinstance(dtype, T.BooleanType):
        v = F.lower(col.cast("string"))
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        v = F.concat(col.cast("string"), F.lit("i"))
    elif isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        v = float_text(col) if python_floats else col.cast("double").cast("string")
    else:
        quoted = F.regexp_replace(col.cast("string"), r'(["\\\\])', r"\\$1")
        v = F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(quoted, r"\r\n?", "\n"), r"\n", r"\\n"), F.lit('"'))
    return F.concat(F.lit(f"{name}="), v)


def line_protocol(
    df: DataFrame,
    measurement: str,
    tags: Mapping[str, str | Column],
    fields: Sequence[str],
    ts_col: str,
    python_floats: bool = False,
) -> Column:
    """Line text per row (null when it has no field or no timestamp)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    tag_parts = []
    for key, value in tags.items():
        v = F.col(value) if isinstance(value, str) and value in types else (
            value if isinstance(value, Column) else F.lit(value)
        )
        v = F.coalesce(v.cast("string"), F.lit(NULL_TAG))
        tag_parts.append(F.concat(F.lit(f"{key}="), _escape(v, ", =")))
    head = F.concat_ws(",", _escape(F.lit(measurement), ", "), *tag_parts)
    body = F.concat_ws(",", *[field_text(f, F.col(f), types[f], python_floats) for f in fields])
    ts = F.col(ts_col).cast("bigint")
    return F.when((body != F.lit("")) & ts.isNotNull(), F.concat(head, F.lit(" "), body, F.lit(" "), ts.cast("string")))


def render_lines(
    df: DataFrame,
    measurement: str,
    tags: Mapping[str, str | Column],
    fields: Sequence[str],
    ts_col: str,
    alias: str = "line",
    python_floats: bool = False,
) -> DataFrame:
    """One ``line`` column; rows that render to nothing are dropped."""
    out = df.select(line_protocol(df, measurement, tags, fields, ts_col, python_floats).alias(alias))
    return out.where(F.col(alias).isNotNull())


def kpi_lines(kpis: DataFrame, label: str) -> DataFrame:
    """KPI rows as lines of the KPI measurement, with the series' label as a tag."""
    fields = [c for c in KPI_COLUMNS if c not in ("location_id", "window_end_s")]
    tags = {"location_id": "location_id", "window": label}
    return render_lines(kpis.select(*KPI_COLUMNS), KPI_MEASUREMENT, tags, fields, "window_end_s")


def float_text(col: Column) -> Column:
    """A double as the original renders floats: positional for 1e-4 <= |x| < 1e16,
    else ``d.ddde±XX``; ``nan``/``inf`` for non-finite values.

    Spark's text for a double has the same significant digits but switches to
    ``d.dddE±X`` outside 1e-3 <= |x| < 1e7; this re-spells those cases.
    """
    s = col.cast("double").cast("string")
    pat = r"^(-?)(\d)\.(\d+)E(-?\d+)$"
    sign = F.regexp_extract(s, pat, 1)
    lead = F.regexp_extract(s, pat, 2)
    rest = F.regexp_replace(F.regexp_extract(s, pat, 3), "0+$", "")
    e = F.regexp_extract(s, pat, 4).cast("int")
    digits = F.concat(lead, rest)
    n = F.length(digits)
    # positional spelling of digits x 10^(e - n + 1)
    short = n <= e + 1
    int_part = F.when(short, F.concat(digits, F.repeat(F.lit("0"), e + 1 - n))).otherwise(digits.substr(F.lit(1), e + 1))
    frac_part = F.when(short, F.lit("0")).otherwise(digits.substr(e + 2, n))
    big = F.concat(sign, int_part, F.lit("."), frac_part)
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    positional = F.when(e >= 0, big).otherwise(small)
    mant = F.when(rest == F.lit(""), lead).otherwise(F.concat(lead, F.lit("."), rest))
    mag = F.abs(e).cast("string")
    expo = F.concat(F.when(e < 0, F.lit("-")).otherwise(F.lit("+")), F.when(F.abs(e) < 10, F.concat(F.lit("0"), mag)).otherwise(mag))
    scientific = F.concat(sign, mant, F.lit("e"), expo)
    respelled = F.when((e >= -4) & (e < 16), positional).otherwise(scientific)
    return (
        F.when(s == "NaN", F.lit("nan"))
        .when(s == "Infinity", F.lit("inf"))
        .when(s == "-Infinity", F.lit("-inf"))
        .when(s.rlike(pat), respelled)
        .otherwise(s)
    )
