"""Incidents are shuffled and kept with no more columns than their queries read."""

from __future__ import annotations

import datetime as dt

import pytest

from blotter.plans import registry
from blotter.sources import fixtures


@pytest.fixture
def tables(spark, tmp_path):
    day = dt.datetime(1999, 5, 17)
    kinds = {
        "lineitem": ("l_orderkey bigint, l_partkey bigint, l_linenumber int, l_shipdate timestamp",
                     [(1, 1, 1, day), (50, 1, 2, day), (211, 2, 3, day), (1, 9, 1, day), (None, 1, 1, day), (1, 1, 1, None), (2, 1, 1, day)]),
        "orders": ("o_orderkey bigint, o_custkey bigint", [(1, 1), (50, 1), (211, 1), (2, 2)]),
        "customer": ("c_custkey bigint, c_nationkey bigint", [(1, 5), (2, 24)]),
        "nation": ("n_nationkey bigint, n_name string", [(5, "E"), (24, "Y")]),
        "part": ("p_partkey bigint, p_size int, p_brand string", [(1, 13, "Brand#1"), (2, 12, "Brand#25")]),
    }
    for name, (schema, rows) in kinds.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_lineitem_is_shuffled_narrow(spark, tables):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inc = fixtures.raw_incidents(spark, tables)
        plan = inc._jdf.queryExecution().executedPlan().toString().split("\n")
        rows = inc.select("year", "hour", "city", "location_area", "offense_category_name").collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    place, offense = fixtures.FIXTURE_LOCATIONS[0], fixtures.FIXTURE_OFFENSES[0]
    assert sorted(map(tuple, rows), key=str) == sorted(
        [(1999, 8, "E", place, offense), (1999, None, "E", place, offense), (1999, (211 * 7 + 3) % 24, None, None, None),
         (None, 8, "E", place, offense), (1999, 15, "Y", place, offense)], key=str
    )
    sent = {key: plan[i + 1] for i, line in enumerate(plan) for key in ("l_orderkey", "l_partkey") if f"Exchange hashpartitioning({key}#" in line}
    assert "cast(l_shipdate" in sent["l_orderkey"]
    assert "l_shipdate" not in sent["l_partkey"] and "o_orderkey" not in sent["l_partkey"] and "AS unnamed" in sent["l_partkey"]


@pytest.mark.parametrize(
    "name, unread",
    [
        ("risk_headline", {"year", "month", "day", "offense_category_name", "male_officer", "female_officer"}),
        ("bundle_daily_city", {"month", "day", "hour", "offense_category_clean"}),
        ("bundle_increments_daily", {"month", "day"}),
    ],
)
def test_kept_incidents_hold_what_is_read(spark, tables, monkeypatch, name, unread):
    kept, write = [], registry.materialize
    monkeypatch.setattr(registry, "materialize", lambda df: kept.append(df.columns) or write(df))
    registry.QUERIES[name](spark, tables)
    assert kept and not unread & set(kept[0])
