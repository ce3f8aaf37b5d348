"""Queries that read the incidents several times evaluate the joins behind them once."""

from __future__ import annotations

import datetime as dt

import pytest

from blotter.operators import softmax as SM
from blotter.operators import train as TR
from blotter.plans import registry
from blotter.schema import OFFENSE_CLASSES, RISK_FEATURES

N = 240
KINDS = (
    "date date, year int, month int, day int, hour int, city string, location_area string, offense_category_name string, "
    "offense_category_clean string, population int, total_officers int, male_officer int, female_officer int, "
    "officers_per_1000_people double, crime_rate_per_1000_people double, row_order date"
)


def _rows() -> list[tuple]:
    out = []
    for i in range(N):
        d = dt.date(2000, 1, 1) + dt.timedelta(days=(i * 37) % 800)
        offense = OFFENSE_CLASSES[i % 13] if i % 17 else None
        city, place = [None, "A", "B", "C"][i % 4], [None, "Residence/Home", "Bar/Nightclub"][i % 3]
        out.append((d, d.year, d.month, d.day, i % 24, city, place, offense, offense, 1000, 10, 8, 2, 10.0, 3.0, d))
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
    return seen


@pytest.mark.parametrize(
    "name",
    ["risk_features", "risk_headline", "risk_model_fit", "class_quality", "probability_quality", "bundle_daily_city", "bundle_increments_daily"],
)
def test_incidents_are_evaluated_once(spark, counted, name):
    rows = registry.QUERIES[name](spark, "").collect()
    assert rows and counted.value == N


def test_training_rows_have_one_row_a_scenario_and_class(spark, counted):
    from blotter.operators import risk as R

    inc = registry._kept_incidents(spark, "")
    rows = TR.classifier_training_rows(inc, R.context_from_incidents(inc)).collect()
    wanted = {(r[5], r[6], r[4], r[0], r[7]) for r in _rows() if r[5] and r[6] and r[7]}
    assert {(r.city, r.location_area, r.hour, r.input_date, r.y13) for r in rows} == wanted and len(rows) == len(wanted)
    assert all(len(r.x) == len(RISK_FEATURES) and None not in r.x for r in rows)


def test_prepared_rows_by_columns(spark):
    data = spark.createDataFrame([("A", 0, 2.0, [1.0, 2.0]), ("B", 1, 1.0, [3.0, 4.0])], "city string, label int, w double, x array<double>")
    kept = SM.prepared(data, 2)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, SM.prepared(data).collect()))
    for bad in ([1.0], [1.0, None]):
        with pytest.raises(Exception, match="training row"):
            SM.prepared(spark.createDataFrame([("A", 0, 2.0, bad)], data.schema), 2)


def test_class_quality_over_many_partitions(spark, monkeypatch):
    keys = [("A", "p", h, dt.date(2000, 1, 1)) for h in range(24)]
    probs = [[(1 + (h + k) % 13) / 91 for k in range(13)] for h in range(24)]
    scored = spark.createDataFrame([(*k, p) for k, p in zip(keys, probs)], "city string, location_area string, hour int, input_date date, specific_probs array<double>")
    truth = spark.createDataFrame(
        [(*k, OFFENSE_CLASSES[i % 13], i + 1) for i, k in enumerate(keys)], "city string, location_area string, hour int, input_date date, y13 string, w long"
    )
    whole = TR.class_quality(scored, truth).first()
    monkeypatch.setattr(TR, "JOIN_ROWS", 1)
    parts = TR.class_quality(scored, truth).first()
    hits = sum(i + 1 for i, p in enumerate(probs) if p.index(max(p)) == i % 13)
    assert whole.n == parts.n == 300 and whole.accuracy == parts.accuracy == hits / 300
    assert parts.log_loss == pytest.approx(whole.log_loss) and parts.macro_f1 == pytest.approx(whole.macro_f1)
