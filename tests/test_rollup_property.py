"""Rollups against a pure-Python Decimal reference on random readings."""

import collections
import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from meteocube.operators.hourly import hourly_fact
from meteocube.operators.rollup import daily_rollup, monthly_rollup, yearly_rollup

from helpers import raw_df

STATIONS = [(33.68, -117.87, "12300-6213"), (-33.95, 151.18, "5600-33118"), (-0.55, 0.29, "8900-18029")]


def q2(x):
    return float(Decimal(x).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def mean(vals):
    vals = [Decimal(str(v)) for v in vals if v is not None]
    return q2(sum(vals) / len(vals)) if vals else None


def ext(vals, f):
    vals = [v for v in vals if v is not None]
    return f(vals) if vals else None


def test_random_readings_match_decimal_reference(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(1500):
        lat, lon, _ = rng.choice(STATIONS)
        t = dt.datetime(2019, 1, 1) + dt.timedelta(hours=rng.randrange(0, 24 * 500))
        val = lambda: None if rng.random() < 0.1 else round(rng.uniform(-60, 60), 2)
        rows.append((t, lat, lon, val(), val(), val(), val()))
    daily = daily_rollup(hourly_fact(raw_df(spark, rows)))

    by_day = collections.defaultdict(list)
    key_of = {(la, lo): k for la, lo, k in STATIONS}
    for t, lat, lon, *vals in rows:
        by_day[(key_of[(lat, lon)], t.date())].append(vals)
    want_daily = {}
    for (k, d), rs in by_day.items():
        cols = list(zip(*rs))
        want_daily[(k, d)] = [x for c in cols for x in (mean(c), ext(c, min), ext(c, max))]
    got_daily = {(r.id, r.DATE): [r[c] for c in daily.columns[2:14]] for r in daily.collect()}
    assert got_daily == want_daily

    def period(keyf):
        groups = collections.defaultdict(list)
        for (k, d), v in want_daily.items():
            groups[keyf(k, d)].append(v)
        out = {}
        for g, vs in groups.items():
            res = []
            for m in range(4):
                a, lo, hi = ([v[3 * m + i] for v in vs] for i in range(3))
                res += [mean(a), mean(lo), ext(lo, min), mean(hi), ext(hi, max)]
            out[g] = res
        return out

    monthly = monthly_rollup(daily)
    got_m = {(r.id, r.year, r.month): [r[c] for c in monthly.columns[1:21]] for r in monthly.collect()}
    assert got_m == period(lambda k, d: (k, d.year, d.month))
    yearly = yearly_rollup(daily)
    got_y = {(r.id, r.year): [r[c] for c in yearly.columns[2:22]] for r in yearly.collect()}
    assert got_y == period(lambda k, d: (k, d.year))
