"""Exact sums of doubles, with built-in expressions only.

A sum of doubles depends on the order of its additions, and so on how rows were
partitioned. A finite double is a whole number m of at most 53 bits times 2^e.
``parts`` gives it as four pieces of 16 bits of m, moved left by up to 7 bits so
that they count multiples of 2^(8 * bin), (8 * bin + 16) and so on. The pieces of
rows with equal ``bin`` are added as bigints, which is exact in any order and
leaves room for 2^40 rows. ``total`` adds a group's few bins digit by digit (base
256) and rounds the exact sum once, to the nearest double, ties to even.

NaN and infinities are no whole numbers: they are added as doubles, whose result
does not depend on the order either, and decide the total where there are any.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECES = ("_p0", "_p1", "_p2", "_p3")
#: what a bin is worth, in bits, and a piece
STEP, WIDTH = 8, 16
#: 2^(n / 2) for the smallest unit of a double is within range, 2^n is not
SMALLEST = -1074


def _power(exponent: str) -> str:
    """SQL factors that multiply by 2 to the given whole number without leaving the range of doubles."""
    return f"* pow(2D, floor(({exponent}) / 2)) * pow(2D, ({exponent}) - floor(({exponent}) / 2))"


def parts(df: DataFrame, value: str, keep: Sequence[str | Column]) -> DataFrame:
    """``keep`` with the pieces of ``value``: _bin, _p0 to _p3, and _odd for NaN and infinities.

    A null or zero value has no bin and no pieces.
    """
    v = f"abs(`{value}`)"
    rows = df.select(*keep, F.col(value).alias("_v"), F.expr(f"{v} < double('Infinity') AND {v} > 0").alias("_ok"))
    # log2 may be one off beside a power of two; the mantissa then shows it
    rows = rows.withColumn("_e", F.expr(f"CASE WHEN _ok THEN greatest(CAST(floor(log2(abs(_v))) AS INT) - 52, {SMALLEST}) END"))
    rows = rows.withColumn("_m", F.expr(f"abs(_v) {_power('-_e')}"))
    # one off below: halves and doubles are exact, so the unit can still be moved
    e = f"CASE WHEN _m >= 9007199254740992D THEN _e + 1 WHEN _m < 4503599627370496D AND _e > {SMALLEST} THEN _e - 1 ELSE _e END"
    m = "CASE WHEN _m >= 9007199254740992D THEN _m / 2 WHEN _m < 4503599627370496D AND _e > -1074 THEN _m * 2 ELSE _m END"
    rows = rows.select("*", F.expr(f"CAST({m} AS BIGINT)").alias("_n"), F.expr(e).alias("_u"))
    rows = rows.withColumn("_bin", F.expr(f"CAST(floor(_u / {STEP}) AS INT)"))
    rows = rows.withColumn("_f", F.expr(f"CASE WHEN _v < 0 THEN -1 ELSE 1 END * shiftleft(1L, _u - {STEP} * _bin)"))
    pieces = [F.expr(f"(shiftright(_n, {WIDTH * i}) & {(1 << WIDTH) - 1}L) * _f").alias(p) for i, p in enumerate(PIECES)]
    odd = F.expr("CASE WHEN isnan(_v) OR abs(_v) = double('Infinity') THEN _v END").alias("_odd")
    names = [c for c in rows.columns if c not in ("_v", "_ok", "_e", "_m", "_n", "_u", "_f")]
    return rows.select(*names, *pieces, odd)


def bin_sums() -> list[Column]:
    """Aggregates over rows of :func:`parts`, grouped by the keys and ``_bin``; they can be aggregated again."""
    return [*(F.sum(p).alias(p) for p in PIECES), F.sum("_odd").alias("_odd")]


def bins() -> Column:
    """Aggregate over rows of :func:`bin_sums`, grouped by the keys: a group's bins, at most 267."""
    return F.collect_list(F.when(F.col("_bin").isNotNull(), F.struct("_bin", *PIECES)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def total(found: str | Column) -> Column:
    """The sum held in ``bins``, rounded once; zero for no bins."""
    found = F.col(found) if isinstance(found, str) else found
    zero = F.lit(0).cast("long")

    def coefficient(by: Column, at: Column) -> Column:
        """What all pieces hold of 256^at."""
        of = zero
        for i, p in enumerate(PIECES):
            of = of + F.coalesce(F.try_element_at(by, (at - i * WIDTH // STEP).cast("int"))[p], zero)
        return of

    def coefficients(by: Column) -> Column:
        places = F.sequence(F.array_min(F.map_keys(by)), F.array_max(F.map_keys(by)) + F.lit(6 + 8))
        return F.transform(places, lambda at: F.struct(at.cast("int").alias("at"), coefficient(by, at).alias("c")))

    by = F.map_from_entries(F.transform(found, lambda b: F.struct(b["_bin"], F.struct(*(b[p].alias(p) for p in PIECES)))))

    # digits from the lowest on: the last 7 (win), the one before (guard), whether any is below (more),
    # and the same as they were at the highest digit that is not zero
    begin = F.struct(
        zero.alias("carry"), zero.alias("win"), zero.alias("guard"), F.lit(False).alias("more"),
        F.struct(zero.alias("win"), zero.alias("guard"), F.lit(False).alias("more"), F.lit(0).alias("at")).alias("top"),
    )

    def step(s: Column, p: Column, sign: Column) -> Column:
        return _let(s["carry"] + p["c"] * sign, lambda t: digits(s, p, t))

    def digits(s: Column, p: Column, t: Column) -> Column:
        digit = t.bitwiseAND(F.lit(255).cast("long"))
        win = F.shiftright(s["win"], STEP) + digit * F.lit(1 << 48).cast("long")
        guard = s["win"].bitwiseAND(F.lit(255).cast("long"))
        more = s["more"] | (s["guard"] != 0)
        now = F.struct(win.alias("win"), guard.alias("guard"), more.alias("more"), p["at"].alias("at"))
        return F.struct(
            F.shiftright(t, STEP).alias("carry"), win.alias("win"), guard.alias("guard"), more.alias("more"),
            F.when(digit != 0, now).otherwise(s["top"]).alias("top"),
        )

    def rounded(t: Column) -> Column:
        # 53 bits and some to round by: from the window alone, or with the guard digit where it is too short
        short = t["win"] < F.lit(1 << 54).cast("long")
        number = F.when(short, t["win"] * 256 + t["guard"]).otherwise(t["win"])
        more = F.when(short, t["more"]).otherwise(t["more"] | (t["guard"] != 0))
        exponent = F.lit(STEP) * (t["at"] - 6) - F.when(short, F.lit(STEP)).otherwise(F.lit(0))
        return F.struct(number.alias("n"), more.alias("more"), exponent.alias("e"))

    def double(r: Column) -> Column:
        cut = F.greatest(F.lit(0), F.length(F.bin(r["n"])) - 53)
        unit = F.call_function("shiftleft", F.lit(1).cast("long"), cut)
        kept = F.call_function("shiftright", r["n"], cut)
        rest = r["n"] - kept * unit
        half = F.call_function("shiftright", unit, F.lit(1))
        up = (cut > 0) & ((rest > half) | ((rest == half) & (r["more"] | (kept % 2 == 1))))
        e = r["e"] + cut
        near = F.floor(e / 2)
        value = (kept + F.when(up, F.lit(1)).otherwise(F.lit(0))).cast("double")
        return value * F.pow(F.lit(2.0), near) * F.pow(F.lit(2.0), e - near)

    def signed(places: Column, sign: Column) -> Column:
        top = F.aggregate(places, begin, lambda s, p: step(s, p, sign), lambda s: s["top"])
        return _let(top, lambda t: _let(rounded(t), double)) * sign

    def negative(places: Column) -> Column:
        # the last carry tells the sign; digits of the opposite number are those of a positive one
        carry = F.aggregate(places, zero, lambda c, p: F.shiftright(c + p["c"], STEP))
        return F.when(carry < 0, F.lit(-1)).otherwise(F.lit(1)).cast("long")

    value = _let(_let(by, coefficients), lambda places: _let(negative(places), lambda sign: signed(places, sign)))
    return F.when(F.size(found) == 0, F.lit(0.0)).otherwise(value)


def exact_sum(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """``keys``, the exact sum of ``value`` as ``alias`` (null without values) and their number ``_count``."""
    pieces = parts(df, value, [*keys, F.col(value).isNotNull().alias("_there")])
    sums = pieces.groupBy(*keys, "_bin").agg(*bin_sums(), F.count(F.when(F.col("_there"), 1)).alias("_count"))
    held = sums.groupBy(*keys).agg(bins().alias("_bins"), F.sum("_odd").alias("_odd"), F.sum("_count").alias("_count"))
    value_ = F.coalesce(F.col("_odd"), total("_bins"))
    return held.select(*keys, F.when(F.col("_count") > 0, value_).alias(alias), "_count")
