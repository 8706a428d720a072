"""The registered forecasts of real trips, against plain versions of the models written independently of them."""

import datetime as dt
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from farelake.operators import models
from harness import queries

SF_DIR = "/root/testdata/sf0.001"
ZONES = 4


@pytest.fixture(scope="module")
def trips(spark):
    """Daily trips by zone: of the zones with the most days, and of one with few."""
    found = defaultdict(dict)
    for r in queries.zone_series(spark, SF_DIR).collect():
        found[r["zone"]][r["ds"]] = r["y"]
    return found


def checked_zones(trips):
    by_length = sorted(trips, key=lambda z: (-len(trips[z]), z))
    return by_length[:ZONES] + by_length[-1:]


def forecasts(spark, name):
    found = defaultdict(dict)
    for r in queries.registry()[name](spark, SF_DIR).collect():
        found[r["zone"]][r["ds"]] = (r["forecast"], r["note"] if "note" in r.asDict() else None)
    return found


def plain_holtwinters(y, horizon):
    """One setting after the other, one day after the other."""
    best = None
    first, second = y[:7], y[7:14]
    for alpha in models.HW_LEVEL:
        for beta in models.HW_TREND:
            for gamma in models.HW_SEASON:
                for phi in models.HW_DAMPING:
                    level, trend = sum(first) / 7, (sum(second) / 7 - sum(first) / 7) / 7
                    season = [(first[d] - sum(first) / 7 + second[d] - sum(second) / 7) / 2 for d in range(7)]
                    squares = 0.0
                    for i, value in enumerate(y):
                        error = value - (level + phi * trend + season[i % 7])
                        squares += error ** 2
                        level, trend = level + phi * trend + alpha * error, phi * trend + alpha * beta * error
                        season[i % 7] += gamma * (1 - alpha) * error
                    if best is None or squares < best[0] * (1 - 1e-12):
                        best = squares, level, trend, season, phi
    _, level, trend, season, phi = best
    return [level + sum(phi ** k for k in range(1, h + 1)) * trend + season[(len(y) + h - 1) % 7] for h in range(1, horizon + 1)]


def plain_sarma(y, horizon):
    """The differenced series by index, both regressions by augmented least squares."""
    w = [y[i] - y[i - 1] - y[i - 7] + y[i - 8] for i in range(8, len(y))]
    rows = range(15, len(w))
    long_fit = np.linalg.lstsq(np.array([[w[i - k] for k in range(1, 16)] for i in rows]), np.array([w[i] for i in rows]), rcond=None)[0]
    shock = [0.0] * 15 + [w[i] - sum(c * w[i - k] for k, c in enumerate(long_fit, 1)) for i in rows]
    x = np.array([[w[i - k] for k in (1, 7, 8)] + [shock[i - k] for k in (1, 7, 8)] for i in range(23, len(w))])
    shrink = math.sqrt(1e-3 * (x ** 2).sum() / 6)
    fit = np.linalg.lstsq(np.vstack([x, shrink * np.eye(6)]), np.array(w[23:] + [0.0] * 6), rcond=None)[0]
    out = list(y)
    for _ in range(horizon):
        w.append(float(sum(c * v for c, v in zip(fit, [w[-1], w[-7], w[-8], shock[-1], shock[-7], shock[-8]]))))
        shock.append(0.0)
        out.append(w[-1] + out[-1] + out[-7] - out[-8])
    return out[len(y):]


def plain_additive(y, horizon, ridge=0.01):
    n, end = len(y), max(len(y) - 1, 1)

    def row(day):
        t = day / end
        return [t, *(max(t - 0.8 * i / 26, 0) for i in range(1, 26)),
                *(f(2 * math.pi * k * day / p) for p, m in ((365.25, 10), (7, 3)) for k in range(1, m + 1) for f in (math.sin, math.cos))]

    x = np.array([row(i) for i in range(n)])
    mean, spread = x.mean(0), x.std(0)
    spread[spread == 0] = 1
    z = np.vstack([(x - mean) / spread, math.sqrt(ridge * n) * np.eye(x.shape[1])])
    fit = np.linalg.lstsq(z, np.concatenate([np.array(y) - np.mean(y), np.zeros(x.shape[1])]), rcond=None)[0]
    return [float((np.array(row(n - 1 + h)) - mean) / spread @ fit + np.mean(y)) for h in range(1, horizon + 1)]


PLAIN = {"forecast_sarma_trips": plain_sarma, "forecast_holtwinters_trips": plain_holtwinters, "forecast_additive_zones": plain_additive}
SHORTEST = {"forecast_sarma_trips": 77, "forecast_holtwinters_trips": 21, "forecast_additive_zones": 1}


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_zones_like_plain(spark, trips, name):
    got = forecasts(spark, name)
    assert set(got) == set(trips)
    for zone, days in got.items():
        last = max(trips[zone])
        assert sorted(days) == [last + dt.timedelta(days=h) for h in range(1, 31)]
        short = len(trips[zone]) < SHORTEST[name]
        assert all((f is None) == short and (note is not None) == short for f, note in days.values())
    for zone in checked_zones(trips):
        y = [trips[zone][d] for d in sorted(trips[zone])]
        if len(y) >= SHORTEST[name]:
            want = PLAIN[name](y, 30)
            assert [got[zone][d][0] for d in sorted(got[zone])] == pytest.approx(want, rel=1e-6, abs=1e-6)


def test_one_series(spark):
    """The additive model by Spark's normal equations: its penalty is relative to the spread of the trips."""
    real = sorted((r["ds"], r["y"]) for r in queries.stored_training(spark, SF_DIR).collect())
    got = queries.registry()["forecast_additive_trips"](spark, SF_DIR).orderBy("ds").collect()
    y = [v for _, v in real]
    if len(y) == (real[-1][0] - real[0][0]).days + 1:
        want = plain_additive(y, 30, 0.01 / np.std(y))
        assert [r["forecast"] for r in got] == pytest.approx(want, rel=0.02, abs=0.02 * np.std(y))
    assert [r["ds"] for r in got] == [real[-1][0] + dt.timedelta(days=h) for h in range(1, 31)]


@pytest.mark.parametrize("key", [None, "zone"])
def test_boosted_trees(spark, key):
    """Trees learn a week whose days differ, to a tenth, and stay within what they have seen."""
    days = spark.range(420).select(F.date_add(F.lit("2023-01-02").cast("date"), F.col("id").cast("int")).alias("ds"))
    value = (F.weekday("ds") + 1) * 10
    if key:
        days = days.select("ds", F.explode(F.array(F.lit(1), F.lit(5))).alias("zone"))
        value = value * F.col("zone")
    series = days.withColumn("y", value.cast("double")).coalesce(1)
    got = models.forecast_gbt(series, 14, trees=30, key=key).withColumn("want", value).collect()
    assert len(got) == 14 * (2 if key else 1)
    assert all(abs(r["forecast"] / r["want"] - 1) < 0.1 for r in got)


@pytest.mark.parametrize("name,slope", [("additive", 0.25), ("sarma", 0.25), ("holtwinters", 0.0)])
def test_known_continuation(spark, name, slope):
    """A line and a value for each weekday go on as they are."""
    days = spark.range(400).select(F.date_add(F.lit("2023-01-02").cast("date"), F.col("id").cast("int")).alias("ds"))
    value = 70 + slope * F.datediff("ds", F.lit("2023-01-02")) + (F.weekday("ds") + 1) * 10
    options = {"ridge": 1e-9} if name == "additive" else {}
    keyed = days.select("ds", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("zone")).withColumn("y", value.cast("double"))
    got = models.MODELS[name](keyed, 30, key="zone", **options).withColumn("want", value).collect()
    assert len(got) == 60 and all(abs(r["forecast"] - r["want"]) < 0.01 for r in got)
