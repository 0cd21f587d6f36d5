import math
import random
from datetime import timedelta

import pytest
from helpers import rows, ts
from pyspark.sql import functions as F

from tidemark.functions import (
    as_timestamp,
    at_least,
    at_most,
    clock,
    exact_avg,
    exact_sum,
    floor_instant,
    percent_of,
    round_half_up,
    tumbling_window,
)


def doubles(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


@pytest.mark.parametrize(
    "value,digits,expected",
    [
        (0.125, 2, 0.13),
        (-0.125, 2, -0.13),
        (2.5, 0, 3.0),
        (-2.5, 0, -3.0),
        (0.1249, 2, 0.12),
        (1e300, 2, 1e300),
        (None, 2, None),
    ],
)
def test_round_half_up(spark, value, digits, expected):
    assert doubles(spark, [value]).select(round_half_up("v", digits)).first()[0] == expected


def test_round_gives_no_negative_zero(spark):
    result = doubles(spark, [-0.001]).select(round_half_up("v", 2)).first()[0]
    assert math.copysign(1.0, result) == 1.0


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e6 + 0.001, 7.123456] * 50
    sums = set()
    for seed in range(3):
        random.Random(seed).shuffle(values)
        frame = doubles(spark, values).repartition(seed + 1)
        sums.add(frame.agg(exact_sum("v")).first()[0])
    assert sums == {round(sum(values), 6)}


@pytest.mark.parametrize(
    "values,total,mean",
    [
        ([1e13, -1.2e13], -2e12, -1e12),
        ([1e-7] * 3, 3e-7, 1e-7),
        ([math.inf, -math.inf], math.nan, math.nan),
        ([math.nan, 1.0], math.nan, math.nan),
        ([math.inf, 1.0, None], math.inf, math.inf),
        ([9.0e12] * 3, 2.7e13, 9.0e12),
        ([1.0, None, 2.0], 3.0, 1.5),
        ([None], None, None),
    ],
)
def test_sums_lose_nothing(spark, values, total, mean):
    found = doubles(spark, values).agg(exact_sum("v"), exact_avg("v")).first()
    for value, expected in zip(found, (total, mean), strict=True):
        assert value is None if expected is None else value == pytest.approx(expected, nan_ok=True, rel=1e-15)


def test_a_total_that_does_not_fit_is_an_error(spark):
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|ARITHMETIC_OVERFLOW"):
        doubles(spark, [1e30]).agg(exact_sum("v")).first()


def test_percent_of_nothing_is_null(spark):
    frame = spark.createDataFrame([(1, 4), (0, 0)], "part long, whole long")
    assert rows(frame.select(percent_of("part", "whole"))) == [(None,), (25.0,)]


def test_bounds_keep_null(spark):
    frame = doubles(spark, [None, 1.0, 200.0])
    assert rows(frame.select(at_most("v", 100.0))) == [(None,), (1.0,), (100.0,)]
    assert rows(frame.select(at_least("v", 5.0))) == [(None,), (5.0,), (200.0,)]


def test_floor_instant():
    quarter = timedelta(minutes=15)
    assert floor_instant(ts("2024-01-01 10:29:59.999999"), quarter) == ts("2024-01-01 10:15:00")
    assert floor_instant(ts("2024-01-01 10:30:00"), quarter) == ts("2024-01-01 10:30:00")
    assert floor_instant(ts("1969-12-31 23:50:00"), quarter) == ts("1969-12-31 23:45:00")


def test_tumbling_window_includes_its_start(spark):
    times = [(ts("2024-01-01 10:14:59.999999"),), (ts("2024-01-01 10:15:00"),)]
    frame = spark.createDataFrame(times, "t timestamp_ntz")
    window = frame.select(tumbling_window("t", timedelta(minutes=15)).alias("w")).select("w.start", "w.end")
    assert rows(window) == [
        (ts("2024-01-01 10:00:00"), ts("2024-01-01 10:15:00")),
        (ts("2024-01-01 10:15:00"), ts("2024-01-01 10:30:00")),
    ]


def test_clock_is_injectable(spark):
    instant = ts("2024-01-30 12:00:00.000001")
    assert spark.range(1).select(clock(instant), as_timestamp(instant)).first() == (instant, instant)
    assert spark.range(1).select(clock(None) > F.lit("2024-01-01").cast("timestamp_ntz")).first()[0]
