"""S4 upkeep: increments that share days give the bundle of all rows; a retried one counts once; legacy lookups."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from blotter.operators import lookups as L
from blotter.operators import risk as R
from blotter.sources import bundle as BU
from blotter.sources import bundle_states as BS

SCHEMA = (
    "row_order long, date date, year int, hour int, city string, location_area string, offense_category_name string, "
    "offense_category_clean string, population long, total_officers long, male_officer long, female_officer long, "
    "officers_per_1000_people double, crime_rate_per_1000_people double"
)


@pytest.fixture(scope="module")
def inc(spark):
    rows = []
    for i in range(240):
        day = dt.date(2001, 1, 1) + dt.timedelta(days=(i * 37) % 500)
        city = None if i % 17 == 0 else f"C{i % 3}"
        known = None if i % 5 == 0 else 100 + i
        place = None if i % 11 == 0 else f"P{i % 4}"
        offense = f"O{(i * 7) % 5}"
        rows.append((i, day, day.year, i % 24, city, place, offense, offense.lower(), known, i, 1, i - 1, i / 10, 1.5))
    return spark.createDataFrame(rows, SCHEMA)


def same(a, b):
    cols = sorted(b.columns)
    assert sorted(a.columns) == cols
    assert sorted(map(repr, a.select(*cols).collect())) == sorted(map(repr, b.select(*cols).collect()))


def test_increments_equal_one_build(spark, inc, tmp_path):
    path = str(tmp_path / "states")
    parts = [("a", F.col("row_order") % 3 == 1), ("b", F.col("row_order") % 3 != 1), ("a", F.col("row_order") % 3 == 1), ("none", F.lit(False))]
    for batch, rows in parts:
        BS.apply_increment(inc.where(rows), path, batch)
    got, want = BS.bundle_from_states(BS.read_states(spark, path)), BU.bundle_from_incidents(inc)
    for name in want:
        same(got[name], want[name])
    last = BS.read_states(spark, path)["last"].where("city is not null")
    same(last.select("city", *L.LOOKUP_STAT_COLS), L.city_stats_last(inc))
    BS.compact(spark, path, str(tmp_path / "one"))
    again = BS.bundle_from_states(BS.read_states(spark, str(tmp_path / "one")))
    for name in got:
        same(again[name], got[name])


def test_legacy_lookups_reach_the_risk_context(spark, inc, tmp_path):
    path = str(tmp_path / "states")
    BS.apply_increment(inc, path, "all")
    BU.write_bundle(BS.bundle_from_states(BS.read_states(spark, path)), str(tmp_path / "bundle"), "2.0", "m")
    tables = BU.load_bundle(spark, str(tmp_path / "bundle"))
    got = R.context_from_bundle(spark, tables["daily_city"], tables["location_areas"], tables["legacy_lookups"])
    want = R.context_from_incidents(inc)
    for name in ("loc_total", "loc_daily", "hour_typical", "hour_diversity", "loc_cats", "htc_cats"):
        same(getattr(got, name), getattr(want, name))
    without = R.context_from_bundle(spark, tables["daily_city"], tables["location_areas"])
    assert without.hour_typical.isEmpty() and without.htc_cats.isEmpty()


def test_no_rows_at_all(spark, inc, tmp_path):
    BS.apply_increment(inc.where(F.lit(False)), str(tmp_path), "none")
    tables = BS.bundle_from_states(BS.read_states(spark, str(tmp_path)))
    assert all(t.isEmpty() for t in tables.values())
