"""Exact sums of doubles: against fractions, over the whole range, in any order of rows."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from squall.functions import exact
from squall.operators.kpi import KpiWindow, exact_averages


def some_double(r):
    kind = r.random()
    if kind < 0.3:
        return r.uniform(-1, 1) * 10 ** r.randint(-12, 12)
    if kind < 0.5:
        return math.ldexp(r.randint(-(2**53), 2**53), r.randint(-1074, 900))
    if kind < 0.6:
        return math.ldexp(r.choice([1, -1]), r.randint(-1074, 1000))
    if kind < 0.8:  # beside a power of two
        return math.nextafter(math.ldexp(1, r.randint(-1060, 1000)), r.choice([0, math.inf]))
    return r.randint(-1000, 1000) / 8


def groups(seed, n):
    r = random.Random(seed)
    out = {}
    for g in range(n):
        values = [some_double(r) for _ in range(r.randint(1, 12))]
        if g % 5 == 0:  # all cancel
            values += [-v for v in values]
        if g % 7 == 0:  # the smallest double decides a tie, or is all that is left
            values.append(5e-324)
        if g % 11 == 0:
            values += [2.0**53, 1.0, 2.0**-40]
        out[g] = values
    return out


def sums(df):
    return {x.g: (x.s, x["_count"]) for x in exact.exact_sum(df, ["g"], "v", "s").collect()}


def test_sums_are_exact_and_rounded_once(spark):
    found = groups(1, 300)
    df = spark.createDataFrame([(g, v) for g, vs in found.items() for v in vs], "g int, v double")
    assert sums(df) == {g: (float(sum(map(Fraction, vs))), len(vs)) for g, vs in found.items()}


def test_every_power_of_two_and_its_neighbours(spark):
    found = {}
    for e in range(-1074, 1024):
        x = math.ldexp(1, e)
        found[len(found)] = [x]
        found[len(found)] = [math.nextafter(x, 0)]
        found[len(found)] = [-math.nextafter(x, math.inf)]
    df = spark.createDataFrame([(g, v) for g, vs in found.items() for v in vs], "g int, v double")
    assert sums(df) == {g: (vs[0], 1) for g, vs in found.items()}


def test_nulls_zeros_and_no_numbers(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (1, None), (1, 2.5), (2, 0.0), (2, -0.0), (3, inf), (3, 1.0), (4, -inf), (5, inf), (5, -inf), (6, nan), (6, 1e300)]
    rows += [(7, 1.7e308), (7, 1.7e308), (8, 1.7e308), (8, 1.7e308), (8, -1.7e308)]
    got = sums(spark.createDataFrame(rows, "g int, v double"))
    assert got[0] == (None, 0) and got[1] == (2.5, 1) and got[2] == (0.0, 2)
    assert got[3] == (inf, 2) and got[4] == (-inf, 1)
    assert math.isnan(got[5][0]) and math.isnan(got[6][0])
    assert got[7] == (inf, 2) and got[8] == (1.7e308, 3)
    assert exact.exact_sum(spark.createDataFrame([], "g int, v double"), ["g"], "v", "s").collect() == []


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_window_averages_have_equal_bits_in_any_partitioning(spark, parts):
    r = random.Random(5)
    rows = [(r.choice(["a", "b", None]), r.randrange(40_000), r.choice([None, r.choice([-1, 1]) * 10 ** r.uniform(-12, 12)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "location_id string, forecast_time long, wind_speed_10m double")
    spec = KpiWindow("3 hours", "30 minutes")
    want = {}
    for loc, t, v in rows:
        begin = t // 1800 * 1800
        for end in range(begin + 1800, begin + 10800 + 1, 1800):
            want.setdefault((loc, end), []).extend([] if v is None else [Fraction(v)])
    want = {k: (float(sum(v)) / len(v) if v else None, len(v)) for k, v in want.items()}
    got = exact_averages(df.orderBy(F.rand(parts)).repartition(parts), spec).collect()
    assert {(x.location_id, x.window_end_s): (x.avg_wind_speed_10m, x.samples) for x in got} == want
