"""Scenarios of equal keys, file order of CSV scans, bundles that lack a table, two runs of a stream."""

import datetime as dt

import pytest

from blotter.operators import risk as R
from blotter.schema import RAW_INCIDENT_SCHEMA
from blotter.sources import bundle as BU
from blotter.sources.incidents import read_incidents_csv, type_incidents
from blotter.streaming import daily_counts as ST

NAMES = RAW_INCIDENT_SCHEMA.fieldNames()
STAFF = {"population": 900, "total_officers": 9, "male_officer": 5, "female_officer": 4, "officers_per_1000_people": 10.0, "crime_rate_per_1000_people": 2.0}


def write_csv(path, rows):
    with open(path, "w") as f:
        f.write(",".join(NAMES) + "\n")
        for r in rows:
            f.write(",".join(str(r.get(c, "")) for c in NAMES) + "\n")


def incident(city, day=1, **more):
    return {"year": 2001, "month": 1, "day": day, "hour": 3, "city": city, "location_area": "Bar", "offense_category_name": "Robbery", **STAFF, **more}


@pytest.fixture
def incidents(spark, tmp_path):
    (tmp_path / "in").mkdir()
    write_csv(tmp_path / "in" / "a.csv", [incident("First")])
    write_csv(tmp_path / "in" / "b.csv", [incident("Later", 1 + k % 28) for k in range(400)])
    return read_incidents_csv(spark, str(tmp_path / "in"))


def test_csv_rows_follow_the_files(incidents):
    rows = incidents.orderBy("row_order").select("city", "day").collect()
    assert rows[0]["city"] == "First" and [r["day"] for r in rows[1:4]] == [1, 2, 3]
    assert incidents.select("row_order").distinct().count() == 401


def test_scenarios_of_equal_keys_stay_apart(spark, incidents):
    day = dt.date(2001, 1, 5)
    asked = [("s1", None), ("s2", "Retail"), ("s3", ""), ("s4", None)]
    scen = spark.createDataFrame(
        [(i, "Later", "Bar", 3, day, t) for i, t in asked] + [("s5", "Nowhere", "No place", 77, day, None)],
        "scenario_id string, city string, location_area string, hour int, input_date date, location_type string",
    )
    feats = R.risk_features(scen, R.context_from_incidents(type_incidents(incidents)))
    kinds = {r["scenario_id"]: r["location_type"] for r in feats.select("scenario_id", "location_type").collect()}
    assert kinds["s3"] == kinds["s1"] == kinds["s4"] and len(kinds) == 5  # an empty type is inferred like a missing one
    top = R.top_specific(R.score(feats, R.demo_classifiers(spark))).collect()
    per = {}
    for r in top:
        per.setdefault((r["scenario_id"], r["location_type_in"]), []).append(r["rank"])
    assert set(per) == {*asked, ("s5", None)}
    assert all(sorted(v) == [1, 2, 3, 4, 5] for v in per.values())


def test_bundle_without_a_table_is_none(spark, incidents, tmp_path):
    tables = BU.bundle_from_incidents(type_incidents(incidents))
    path = str(tmp_path / "bundle")
    BU.write_bundle(tables, path, "2.0", "m")
    loaded = BU.load_bundle(spark, path)
    for name, t in tables.items():
        assert loaded[name].dtypes == t.dtypes, name
    (tmp_path / "bundle" / "years").rename(tmp_path / "elsewhere")
    assert BU.load_bundle(spark, path) is None


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))

    def land(days):
        rows = [(dt.datetime(2001, 1, d, 12), "A") for d in days]
        spark.createDataFrame(rows, ST.EVENT_SCHEMA).write.mode("append").parquet(src)

    land([1, 1, 2])
    ST.run_daily_counts(spark, src, out, ckpt)
    land([2, 3])
    ST.run_daily_counts(spark, src, out, ckpt)
    got = {r["date"].day: r["crime_count"] for r in ST.current_counts(spark, out).collect()}
    assert got == {1: 2, 2: 2, 3: 1}
