"""The keyed backtest against separate forecasts, and fits as of an origin against separate fits."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.operators import backtest as BT
from blotter.operators import forecast as FC
from blotter.operators import train as TR

SCHEMA = (
    "date date, city string, crime_count long, year int, population int, total_officers int, male_officer int,"
    " female_officer int, officers_per_1000_people double, crime_rate_per_1000_people double"
)
START = dt.date(2019, 11, 20)
ORIGINS = [dt.date(2020, 3, 1), dt.date(2020, 1, 5), dt.date(2020, 2, 14)]


def _daily(spark, late=0):
    """City A has every day, B starts late with gaps, C has its first days after two of the origins."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(125):
        d = START + dt.timedelta(days=i)
        for c in "ABC":
            n = int(rng.integers(0, 9))
            if (c == "B" and (i < 40 or i % 5 == 0)) or (c == "C" and d < dt.date(2020, 2, 10)):
                continue
            if d >= dt.date(2020, 2, 14):
                n += late
            rows.append((d, c, n, d.year, 1000 + ord(c), 10 + i // 60, 5, 5, 1.5 + i / 100, 2.0))
    return spark.createDataFrame(rows, SCHEMA)


def _coefs(spark):
    from blotter.operators.forecast import DEMO_GLOBAL, coefficient_schema
    from blotter.schema import FORECAST_FEATURES

    values = [DEMO_GLOBAL["intercept"], *[DEMO_GLOBAL[f] for f in FORECAST_FEATURES]]
    return spark.createDataFrame([(None, *values), ("A", *[v * 1.2 for v in values])], coefficient_schema())


def _rows(df):
    return {(r["City"], r["Date"]): (r["Predicted Count"], r["policy"], r["is_holiday"]) for r in df.collect()}


def test_equals_separate_forecasts(spark):
    daily, coefs = _daily(spark), _coefs(spark)
    together = BT.forecasts(daily, coefs, ORIGINS, steps=20)
    together.cache()
    for o in ORIGINS:
        want = _rows(FC.forecast(daily, coefs, F.lit(o), 20))
        got = _rows(together.where(F.col("origin") == F.lit(o)))
        assert set(got) == set(want)
        for k, (p, policy, holiday) in want.items():
            assert got[k][0] == pytest.approx(p) and got[k][1:] == (policy, holiday)
    assert {r["City"] for r in together.where(F.col("origin") == F.lit(ORIGINS[1])).collect()} == {"A", "B"}
    together.unpersist()


def test_scores_by_hand(spark):
    daily = _daily(spark)
    fc = BT.forecasts(daily, _coefs(spark), ORIGINS[:1], steps=20).toPandas().sort_values("Date")
    real = {(r["city"], r["date"]): r["crime_count"] for r in daily.collect()}
    for r in BT.backtest(daily, _coefs(spark), ORIGINS[:1], steps=20).collect():
        mine = fc[fc["City"] == r["City"]].reset_index(drop=True)
        mine["lag"] = mine["Predicted Count"].shift(7)
        mine["y"] = [real.get((r["City"], d)) for d in mine["Date"]]
        mine = mine[mine["y"].notna()]
        assert r["days"] == len(mine)
        assert r["mae"] == pytest.approx((mine["Predicted Count"] - mine["y"]).abs().mean())
        assert r["lag7_autocorr"] == pytest.approx(mine["Predicted Count"].corr(mine["lag"]))


def test_fits_see_earlier_rows_only(spark):
    """Each fit equals a plain one on the rows before its origin; rows with a missing value are counted."""
    features = ["lag_1", "roll_mean_7", "day_of_week"]
    rows = TR.volume_training_rows(_daily(spark)).select("date", "city", "label", *features)
    rows = rows.withColumn("lag_1", F.when(~((F.col("city") == "A") & (F.dayofmonth("date") == 9)), F.col("lag_1")))
    fits = {(r["origin_id"], r["city"]): r for r in BT.fit_as_of(rows, ORIGINS, 1e-3, features).collect()}
    data = rows.toPandas()
    for k, o in enumerate(sorted(ORIGINS)):
        for city in (None, "A", "B", "C"):
            mine = data[[d < o for d in data["date"]]]
            mine = mine if city is None else mine[mine["city"] == city]
            if not len(mine):
                assert (k, city) not in fits
                continue
            whole = mine.dropna()
            x = np.column_stack([np.ones(len(whole)), whole[features].to_numpy(dtype=float)])
            a = x.T @ x + 1e-3 * np.eye(x.shape[1]) * max(1, len(x))
            w = np.linalg.lstsq(a, x.T @ whole["label"].to_numpy(), rcond=None)[0]
            got = fits[k, city]
            assert (got["rows"], got["skipped"]) == (len(whole), len(mine) - len(whole))
            assert np.allclose([got["intercept"], *[got[f] for f in features]], w)


def test_later_rows_change_nothing_before(spark):
    """Counts from an origin on are changed: its forecast and the earlier ones stay, with fits as of the origin, too."""
    outs = []
    for late in (0, 50):
        daily = _daily(spark, late)
        fits = BT.fit_as_of(TR.volume_training_rows(daily), ORIGINS)
        fc = BT.forecasts(daily, fits, ORIGINS, steps=5)
        outs.append({(r["origin"], r["City"], r["Date"]): r["Predicted Count"] for r in fc.collect()})
    same = [k for k in outs[0] if outs[1][k] == pytest.approx(outs[0][k], abs=1e-6)]
    assert {k[0] for k in same} >= set(sorted(ORIGINS)[:2])
    assert all(k in same for k in outs[0] if k[0] <= dt.date(2020, 2, 14))
    assert any(k not in same for k in outs[0] if k[0] == dt.date(2020, 3, 1))
