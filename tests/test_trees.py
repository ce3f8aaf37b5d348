"""Tree forecasters: the walk, and histogram boosting against a plain numpy version."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.operators import forecast as FC
from blotter.operators import trees as TM

FEATURES = ["a", "b", "c"]


def _rows(spark, seed, n=400):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b = float(rng.integers(0, 9)), float(rng.normal())
        y = 2.0 * (a > 4) + (b > 0.3) * (a < 3) + rng.normal() * 0.1
        rows.append(("X" if i % 3 else "Y", None if i % 41 == 0 else a, b, 5.0, None if i % 97 == 5 else float(y)))
    return rows, spark.createDataFrame(rows, "city string, a double, b double, c double, label double")


def _brute(x, y, edges, trees, depth, rate, reg, least):
    """Plain boosting on bins; returns the predictions of the rows."""
    bins = np.array([[len(e) + 1 if v is None else sum(t < v for t in e) for v, e in zip(row, edges)] for row in x])
    pred = np.full(len(y), y.mean())
    for _ in range(trees):
        node = np.zeros(len(y), dtype=int)
        g = y - pred
        for _ in range(depth):
            after = node.copy()
            for k in np.unique(node):
                mine = node == k
                best = None
                for f in range(bins.shape[1]):
                    for b in np.unique(bins[mine, f]):
                        left = mine & (bins[:, f] <= b)
                        nl, n = left.sum(), mine.sum()
                        if nl < least or n - nl < least:
                            continue
                        part = lambda s, m: s * s / (m + reg)
                        gain = part(g[left].sum(), nl) + part(g[mine].sum() - g[left].sum(), n - nl) - part(g[mine].sum(), n)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, f, b)
                if best:
                    after[mine] = 2 * k + 1 + (bins[mine, best[1]] > best[2])
            node = after
        for k in np.unique(node):
            mine = node == k
            pred[mine] += rate * g[mine].sum() / (mine.sum() + reg)
    return pred


def _walk(model, x):
    out = model["base"]
    for at in model["roots"]:
        while model["nodes"][at]["feature"] >= 0:
            n = model["nodes"][at]
            v = x[n["feature"]]
            at = n["left"] if v is not None and v <= n["threshold"] else n["right"]
        out += model["nodes"][at]["value"]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_fit_equals_plain_boosting(spark, seed):
    """All models at once equal separate fits; missing features, missing labels and a constant feature included."""
    rows, df = _rows(spark, seed)
    args = {"trees": 3, "depth": 3, "rate": 0.3, "reg": 1.0, "least_rows": 15}
    models = {r["city"]: r for r in TM.fit_trees(df, FEATURES, bins=12, **args).collect()}
    assert set(models) == {None, "X", "Y"}
    edges = TM.bin_edges(df, FEATURES, 12)
    assert edges[2] == []
    for city, model in models.items():
        mine = [r for r in rows if r[4] is not None and city in (None, r[0])]
        x, y = [r[1:4] for r in mine], np.array([r[4] for r in mine])
        want = _brute(x, y, edges, 3, 3, 0.3, 1.0, 15)
        got = [_walk(model, r) for r in x]
        assert np.allclose(got, want)
        assert np.mean((np.array(got) - y) ** 2) < 0.5 * np.var(y)


def test_walk_in_expressions(spark):
    """The expression equals a plain walk; a missing value goes right."""
    rows, df = _rows(spark, 3)
    models = TM.fit_trees(df, FEATURES, trees=2, depth=2, bins=8)
    m = models.where("city is null")
    plain = m.first()
    scored = df.crossJoin(F.broadcast(m.drop("city"))).select(
        *FEATURES, TM.predict(F.array(*FEATURES), F.col("base"), F.col("roots"), F.col("nodes")).alias("p")
    )
    for r in scored.collect():
        assert r["p"] == pytest.approx(_walk(plain, [r[f] for f in FEATURES]))


def test_nothing_to_split(spark):
    """Too few rows, or one value of everything: the base alone."""
    df = spark.createDataFrame([("X", 1.0, 2.0, 3.0, 4.0)] * 5, "city string, a double, b double, c double, label double")
    for r in TM.fit_trees(df, FEATURES, trees=2, depth=2).collect():
        assert _walk(r, [1.0, 2.0, 3.0]) == pytest.approx(4.0)
    assert TM.fit_trees(df.limit(0), FEATURES, trees=1, depth=1).count() == 0


def test_city_model_over_global(spark):
    """A city's own ensemble gives raw predictions, other cities get the blend of the global one."""
    leaf = lambda v: [(-1, None, None, None, v)]
    trees = spark.createDataFrame([(None, 1.0, [0], leaf(0.5)), ("A", 7.0, [0], leaf(0.0))], TM.TREE_SCHEMA)
    days = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), c, 10, 2020, 5, 1, 1, 0, 1.0, 1.0) for i in range(60) for c in ("A", "B")]
    daily = spark.createDataFrame(
        days,
        "date date, city string, crime_count long, year int, population int, total_officers int, male_officer int,"
        " female_officer int, officers_per_1000_people double, crime_rate_per_1000_people double",
    )
    out = FC.forecast_trees(daily, trees, F.lit(dt.date(2020, 3, 1)), steps=3).collect()
    by = {(r["City"], r["Date"].day): r for r in out}
    assert by["A", 1]["Predicted Count"] == 7.0 and by["A", 1]["policy"] == FC.POLICY_CITY
    assert by["B", 1]["Predicted Count"] == pytest.approx(0.6 * 1.5 + 0.4 * 10) and by["B", 1]["policy"] == FC.POLICY_GLOBAL
    only = FC.forecast_trees(daily, trees, F.lit(dt.date(2020, 3, 1)), steps=1, use_city_models=False)
    assert {r["policy"] for r in only.collect()} == {FC.POLICY_GLOBAL}
