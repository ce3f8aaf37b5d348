"""Lookups as of a date: against a plain version, defaults, and blindness to later rows."""

import datetime as dt
import random
from collections import Counter

import pytest

from blotter.operators import asof as AO
from blotter.schema import LOOKUP_STAT_COLS

SCHEMA = "date date, city string, location_area string, hour int, offense_category_clean string, " + ", ".join(
    f"{c} double" for c in LOOKUP_STAT_COLS
)
START = dt.date(2021, 2, 20)


def _incidents(seed, late=0):
    rng = random.Random(seed)
    rows = []
    for _ in range(300):
        day = rng.randint(0, 40)
        d = START + dt.timedelta(days=day)
        offense = rng.choice(["Theft", "Arson", "Fraud", None])
        if day >= 25 and late:
            offense = "Later"
        stats = [None if rng.random() < 0.3 else float(day * 10 + k) for k in range(len(LOOKUP_STAT_COLS))]
        rows.append((d, rng.choice(["A", "B", None]) if day > 8 else "A", rng.choice(["Home", "Road", None]), rng.randint(0, 3), offense, *stats))
    for extra in range(late):
        rows.append((START + dt.timedelta(days=25 + extra % 9), "A", "Home", extra % 4, "Later", *[9.0] * len(LOOKUP_STAT_COLS)))
    # file order: the last of a day's rows by position must not matter, so a day's stats agree
    by_day = {}
    return [(*r[:5], *by_day.setdefault((r[0], r[1]), r[5:])) for r in rows]


def _plain(rows, asked):
    out = []
    for city, place, hour, d in asked:
        past = [r for r in rows if r[0] < d]
        days = len({r[0] for r in past})
        here = sum(r[2] == place for r in past) if place is not None else 0
        mine = [r for r in past if r[1] == city and r[3] == hour and city is not None and hour is not None]
        kinds = {}
        for r in mine:
            kinds.setdefault(r[0], set()).update([r[4]] if r[4] else [])
        named = Counter(r[4] for r in mine if r[4])
        known = city is not None and any(r[1] == city for r in past)
        product = known and any(r[3] == hour for r in past)
        diversity = sum(map(len, kinds.values())) / days if mine else 0.0 if product else 1.5
        typical = min(named, key=lambda o: (-named[o], o)) if named else "Other" if mine or not product else None
        stats = []
        for k in range(len(LOOKUP_STAT_COLS)):
            values = [(r[0], r[5 + k]) for r in past if r[1] == city and r[5 + k] is not None]
            stats.append(0.0 if not known else max(values)[1] if values else None)
        out.append((city, place, hour, d, float(here) if here else 100.0, here / days if here else 5.0, diversity, typical, *stats))
    return sorted(out, key=str)


ASKED = [
    *[(c, p, h, START + dt.timedelta(days=n)) for c in ("A", "B", "X") for p in ("Home", "Moon") for h in (0, 3, 77) for n in (0, 1, 9, 10, 17, 41, 90)],
    (None, "Home", 1, START + dt.timedelta(days=20)),
    ("A", None, 1, START + dt.timedelta(days=20)),
    ("A", "Home", None, START + dt.timedelta(days=20)),
]


def _asked(spark):
    return spark.createDataFrame([*ASKED, ASKED[0]], "city string, location_area string, hour int, input_date date")


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_version(spark, seed):
    """Days with and without rows, before the first and after the last; null, unknown and repeated keys."""
    rows = _incidents(seed)
    got = [tuple(r) for r in AO.lookups_as_of(spark.createDataFrame(rows, SCHEMA), _asked(spark)).collect()]
    want = _plain(rows, ASKED)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=str), want):
        assert g[:4] == w[:4] and g[7] == w[7]
        assert list(g[4:7]) + list(g[8:]) == pytest.approx(list(w[4:7]) + list(w[8:]))


def test_later_rows_change_nothing_before(spark):
    day = START + dt.timedelta(days=25)
    outs = []
    for late in (0, 60):
        rows = AO.lookups_as_of(spark.createDataFrame(_incidents(5, late), SCHEMA), _asked(spark)).collect()
        outs.append({tuple(r[:4]): tuple(r[4:]) for r in rows})
    assert all(outs[0][k] == outs[1][k] for k in outs[0] if k[3] <= day)
    assert any(outs[0][k] != outs[1][k] for k in outs[0] if k[3] > day)
