"""Means of readings are exact and rounded once; nothing is dropped silently."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from meteocube.functions.exact import LARGEST
from meteocube.operators.hourly import hourly_fact
from meteocube.operators.rollup import daily_rollup, daily_rollup_join_form

from helpers import raw_df

ST = (33.68, -117.87)


def day(spark, readings, form=daily_rollup):
    rows = [(f"2020-01-01 {k % 24:02d}:{k // 24:02d}", *ST, v, None, None, None) for k, v in enumerate(readings)]
    return form(hourly_fact(raw_df(spark, rows))).first()


@pytest.mark.parametrize("form", [daily_rollup, daily_rollup_join_form])
@pytest.mark.parametrize("readings,avg", [
    ((0.005, 0.005, 0.004), 0.0),      # rounding the readings first would give 0.01
    ((0.015, 0.015, 0.014), 0.01),
    ((-0.005, -0.005, -0.004), 0.0),
    ((0.005,), 0.01),
    ((-0.005,), -0.01),
    ((1e20, 1.0, 2.0), 3.333333333333333e19),
    ((-1e20, 1.0, 2.0), -3.333333333333333e19),
    ((1e17, -1e17, 0.03), 0.01),       # the small one survives beside the large ones
    ((123456789012.345, 0.1), 61728394506.22),
    ((1 / 3, 1 / 3, 1 / 3), 0.33),
    ((0.1 + 0.2, 0.0), 0.15),
])
def test_mean_is_rounded_once(spark, form, readings, avg):
    assert day(spark, readings, form).avgTMP == pytest.approx(avg, rel=1e-15, abs=0)


def test_extremes_are_numeric_and_large_values_stay(spark):
    r = day(spark, (1e20, 1.0, 2.0))
    assert (r.minTMP, r.maxTMP) == (1.0, 1e20)
    r = day(spark, (2.675, -2.675, 1.005))
    assert (r.minTMP, r.maxTMP) == (-2.68, 2.68)


def test_random_readings_of_many_sizes_match_decimal(spark):
    rng = random.Random(23)
    rows, want = [], {}
    for d in range(1, 29):
        values = []
        for _ in range(rng.randrange(1, 30)):
            v = rng.uniform(-1, 1) * 10 ** rng.randrange(-3, 19)
            values.append(round(v, rng.randrange(0, 6)) if rng.random() < 0.5 else v)
        rows += [(f"2020-01-{d:02d} {k % 24:02d}:{k // 24:02d}", *ST, v, None, None, None) for k, v in enumerate(values)]
        exact = [Decimal(repr(v)).quantize(Decimal("1e-12"), ROUND_HALF_UP) if abs(v) < 2**53 else Decimal(int(v)) for v in values]
        want[d] = float((sum(exact) / len(exact)).quantize(Decimal("0.01"), ROUND_HALF_UP))
    got = {r.DATE.day: r.avgTMP for r in daily_rollup(hourly_fact(raw_df(spark, rows))).collect()}
    assert got == want


def test_a_reading_beyond_the_exact_range_fails_loudly(spark):
    with pytest.raises(Exception, match="too large"):
        day(spark, (LARGEST, 1.0))
