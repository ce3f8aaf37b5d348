"""A bundle is made from counts at its tables' grains, and an increment's rows are read for three counts only."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from blotter.plans import registry
from blotter.sources import bundle as BU
from blotter.sources import bundle_states as BS
from blotter.sources import fixtures

N = 600
KINDS = (
    "date date, year int, month int, day int, hour int, city string, location_area string, offense_category_name string, "
    "offense_category_clean string, population int, total_officers int, male_officer int, female_officer int, "
    "officers_per_1000_people double, crime_rate_per_1000_people double, row_order date"
)


def _rows() -> list[tuple]:
    out = []
    for i in range(N):
        d = dt.date(2000, 12, 31) + dt.timedelta(days=i % 2) if i % 50 else None
        offense, place = [None, "Arson", "Bribery"][i % 3], [None, "Residence/Home"][i // 2 % 2]
        city = [None, "A"][i // 4 % 2]
        rate = 10.0 if i % 2 else None
        out.append((d, d and d.year, d and d.month, d and d.day, i % 24, city, place, offense, offense, 1000, 10, 8, 2, rate, 3.0, d))
    return out


@pytest.fixture
def counted(spark, monkeypatch):
    """Incidents whose evaluated rows are counted."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    inc = spark.createDataFrame(_rows(), KINDS).mapInArrow(count, KINDS)
    monkeypatch.setattr(registry, "incidents", lambda spark, sf: inc)
    return inc, seen


def test_bundle_keeps_counts_not_incidents(spark, counted, monkeypatch):
    kept, write = [], registry.materialize
    monkeypatch.setattr(registry, "materialize", lambda df: kept.append(write(df)) or kept[-1])
    got = {(r.City, r["Crime Type"]): r.Count for r in registry.QUERIES["bundle_offense_distribution"](spark, "").collect()}
    want: dict = {}
    for r in _rows():
        if r[7]:
            want[r[5], r[7]] = want.get((r[5], r[7]), 0) + 1
    assert got == want and counted[1].value == N
    assert sum(k.count() for k in kept) < N / 10


def test_bundle_from_counts_and_nulls(spark, counted):
    inc, _ = counted
    tables = BU.bundle_from_incidents(inc)
    days, trends = {}, set()
    for r in _rows():
        if r[0]:
            days[r[0], r[5]] = days.get((r[0], r[5]), 0) + 1
        trends.add((r[0] and r[0].replace(day=1), r[5], *r[9:14]))
    cells = tables["daily_city"].select("date", "city", "crime_count").collect()
    assert cells and all(days[r.date, r.city] == r.crime_count for r in cells)
    assert sorted(map(str, [tuple(r)[:-1] for r in tables["officer_trends"].collect()])) == sorted(map(str, trends))
    assert {r.year for r in tables["years"].collect()} == {None, 2000, 2001}
    assert [r[0] for r in tables["location_areas"].collect()] == ["Residence/Home"]
    assert tables["crime_distribution"].agg(F.sum("count")).first()[0] == N


def test_increment_is_read_for_three_counts(counted, tmp_path):
    inc, seen = counted
    BS.apply_increment(inc, str(tmp_path), "all")
    assert seen.value <= 3 * N


def test_round4_is_round(spark):
    values = [0.0, -0.00001, 2.12345, 2.12355, 1.00005, 0.00015, -2.12345, 7.0, 1 / 3, 12345.67895, 2.1234499999999, 2.1234500000001, None]
    rows = spark.createDataFrame([(v,) for v in values], "x double").unionByName(
        spark.range(1, 40001).select(((50 + F.col("id") % 140) * 1000.0 / (20000 + F.col("id") * 25)).alias("x"))
    )
    assert rows.where(~fixtures._round4(F.col("x")).eqNullSafe(F.round("x", 4))).count() == 0


def test_lineitem_is_not_sorted_for_orders(spark, tmp_path):
    kinds = {
        "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_shipdate timestamp",
        "orders": "o_orderkey bigint, o_custkey bigint",
        "customer": "c_custkey bigint, c_nationkey bigint",
        "nation": "n_nationkey bigint, n_name string",
        "part": "p_partkey bigint, p_size int, p_brand string",
    }
    for name, kind in kinds.items():
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = fixtures.raw_incidents(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ShuffledHashJoin [l_orderkey" in plan and "Sort [l_orderkey" not in plan
