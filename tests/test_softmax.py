"""The grouped softmax solver against separate fits, its optimum, and its report."""

import numpy as np
import pytest

from blotter.operators import softmax as SM

LABELS = ["a", "b", "c", "never"]
SCHEMA = "city string, label int, w double, x array<double>"


def _rows(seed, n=600):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        city = "XYZ"[i % 3]
        x = rng.normal(size=3) * [1.0, 50.0, 0.01] + [0.0, 300.0, 5.0]
        z = np.array([x[0] * (1 + (city == "X")), (x[1] - 300) / 50, 0.3])
        label = int(np.argmax(z + rng.gumbel(size=3)))
        rows.append((city, label, float(rng.integers(1, 4)), [*map(float, x), 7.0]))
    return rows


def _fit(spark, rows, **kw):
    models, report = SM.fit_cities(SM.prepared(spark.createDataFrame(rows, SCHEMA).repartition(4)), LABELS, **kw)
    held = {}
    for r in models.collect():
        held.setdefault(r["city"], {})[r["class_id"]] = [*r["weights"], r["intercept"]]
    return {c: np.array([m[i] for i in sorted(m)]) for c, m in held.items()}, {r["city"]: r for r in report.collect()}


def _loss(w, rows, reg):
    """The penalised mean loss on scaled features, from raw weights."""
    x = np.array([r[3] for r in rows])
    y, n = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    mean = (x * n[:, None]).sum(0) / n.sum()
    sd = np.sqrt(np.maximum((x**2 * n[:, None]).sum(0) / n.sum() - mean**2, 0))
    lp = SM.log_probabilities(x, w)
    scaled = w[:, :-1] * sd
    b = w[:, -1] + w[:, :-1] @ mean
    return -(n * lp[np.arange(len(y)), y]).sum() / n.sum() + 0.5 * reg * (scaled**2).sum() + 0.005 * reg * (b**2).sum()


def test_all_cities_equal_separate_fits(spark):
    rows = _rows(1)
    together, report = _fit(spark, rows, max_iter=15)
    assert set(together) == set("XYZ")
    alone, _ = _fit(spark, [r for r in rows if r[0] == "Y"], max_iter=15)
    assert np.allclose(alone["Y"], together["Y"], atol=1e-8)
    assert all(r["iterations"] <= 15 for r in report.values())


def test_optimum_and_report(spark):
    """Converged weights can't be bettered nearby; a constant feature has none; too few steps are reported as such."""
    rows = _rows(2, 300)
    weights, report = _fit(spark, rows, reg=0.05, max_iter=300, tol=1e-5)
    rng = np.random.default_rng(0)
    for city, w in weights.items():
        mine = [r for r in rows if r[0] == city]
        assert report[city]["converged"] and report[city]["rows"] == sum(r[2] for r in mine)
        best = _loss(w, mine, 0.05)
        assert report[city]["loss"] == pytest.approx(best, abs=1e-6)
        assert np.all(w[:, 3] == 0) and np.isfinite(w).all()
        for _ in range(20):
            step = rng.normal(size=w.shape) * np.array([1, 0.02, 100, 0, 0]) * 0.01
            step[:, -1] -= step[:, :-1] @ np.array([0, 300.0, 5.0, 0])  # moves scaled weights alone
            assert _loss(w + step, mine, 0.05) >= best - 1e-7
    _, report = _fit(spark, rows, max_iter=1, tol=1e-9)
    assert not any(r["converged"] for r in report.values())


def test_losses_of_held_out_rows(spark):
    rows = _rows(3)
    models, _ = SM.fit_cities(SM.prepared(spark.createDataFrame([r for r in rows if r[0] != "Z"], SCHEMA)), LABELS, max_iter=20)
    got = {r["city"]: r for r in SM.city_losses(SM.prepared(spark.createDataFrame(rows, SCHEMA)), models).collect()}
    assert set(got) == {"X", "Y"} and all(0.2 < r["log_loss"] < np.log(4) for r in got.values())


def test_incomplete_rows_raise(spark):
    with pytest.raises(Exception, match="lacks a city"):
        SM.prepared(spark.createDataFrame([("X", 0, 1.0, [1.0, None])], SCHEMA))
    with pytest.raises(Exception, match="lacks a city"):
        SM.prepared(spark.createDataFrame([(None, 0, 1.0, [1.0, 2.0])], SCHEMA))


def test_labels_unseen_in_training_fold(spark):
    """M12 applied: rare and unseen labels become Other, a missing one stays missing."""
    import datetime as dt

    from pyspark.sql import functions as F

    from blotter.operators import train as TR

    day = dt.date(2020, 1, 1)
    rows = [("Theft", day)] * 9 + [("Arson", day), (None, day), ("New", day + dt.timedelta(days=5)), ("Theft", day + dt.timedelta(days=5))]
    inc = spark.createDataFrame(rows, "offense_category_name string, date date")
    folded = TR.fold_labels(inc, TR.rare_label_map(inc, F.lit(day + dt.timedelta(days=2)), 0.2))
    got = {(r["offense_category_name"], r["label"]) for r in folded.collect()}
    assert folded.count() == len(rows)
    assert got == {("Theft", "Theft"), ("Arson", "Other"), (None, None), ("New", "Other")}
