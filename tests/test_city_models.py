"""From index to coefficients, and probability quality."""

import json
import random

import pytest
from pyspark.sql import functions as F

from blotter.operators import forecast as FC
from blotter.operators import reliability as RB
from blotter.schema import FORECAST_FEATURES
from blotter.sources import city_models as CM
from blotter.sources import model_index as MI

CITIES = ["a", "b", "c", "d", "e", "nowhere"]


def _root(spark, tmp_path, city_list, stored=True):
    coefs = FC.demo_coefficients(spark).withColumn("model_path", F.coalesce(F.concat(F.lit("per_city/"), "city"), F.lit(CM.GLOBAL_MODEL)))
    names = coefs.where(F.col("city").isNull())
    own = coefs.where(F.col("city").isNotNull())
    models = CM.artifacts(names, FORECAST_FEATURES).unionByName(CM.artifacts(own, city_list))
    broken = spark.createDataFrame([(1.0, [1.0], "per_city/short"), (1.0, None, "per_city/null")], CM.MODEL_SCHEMA)
    lists = {CM.GLOBAL_LIST: FORECAST_FEATURES} | ({CM.CITY_LIST: city_list} if stored else {})
    CM.save(str(tmp_path), models.unionByName(broken), lists)
    return str(tmp_path)


def _index(spark, forecasters, **more):
    text = json.dumps({"forecasters": forecasters, "classifiers": {}, **more})
    return spark.createDataFrame([(text,)], "value string").select(MI.parse_index(F.col("value")).alias("index"))


def _asked(spark):
    return spark.createDataFrame([(c,) for c in CITIES], "city string")


PATHS = {"a": "per_city/NATION_1", "b": "per_city/NATION_1", "c": "elsewhere/NATION_12", "d": "per_city/short", "e": "per_city/gone", "z": "per_city/NATION_12"}


def test_paths_lists_and_fallback(spark, tmp_path):
    turned = FORECAST_FEATURES[::-1]
    root = _root(spark, tmp_path, turned)
    coefs, status = CM.indexed_forecasters(spark, root, _index(spark, PATHS), _asked(spark))
    assert {r.city: r.status for r in status.collect()} == {
        "a": CM.OWN_MODEL, "b": CM.OWN_MODEL, "c": CM.FOREIGN_PATH, "d": CM.BAD_WEIGHTS, "e": CM.NO_ARTIFACT, "nowhere": CM.NO_ENTRY,
    }
    rows = {r.city: r for r in coefs.collect()}
    assert set(rows) == {None, "a", "b"}
    for f in FORECAST_FEATURES:
        assert rows[None][f] == FC.DEMO_GLOBAL[f]
        assert rows["a"][f] == rows["b"][f] == FC.DEMO_GLOBAL[f] * FC.DEMO_CITY_MODELS["NATION_1"]


def test_lists_of_the_index_go_first(spark, tmp_path):
    turned = FORECAST_FEATURES[::-1]
    root = _root(spark, tmp_path, turned, stored=False)
    asked = _asked(spark)

    def kinds(index):
        return {r.status for r in CM.indexed_forecasters(spark, root, index, asked)[1].where("city = 'a'").collect()}

    assert kinds(_index(spark, PATHS, forecast_features=turned)) == {CM.OWN_MODEL}
    assert kinds(_index(spark, PATHS)) == {CM.NO_LIST}
    assert kinds(_index(spark, PATHS, forecast_features=[*turned[:-1], "else"])) == {CM.BAD_LIST}
    assert kinds(_index(spark, PATHS, forecast_features=[*turned[:-1], turned[0]])) == {CM.BAD_LIST}
    assert kinds(_index(spark, "text")) == {CM.NO_ENTRY}  # a rejected index


def test_only_asked_models_are_read(spark, tmp_path):
    root = _root(spark, tmp_path, FORECAST_FEATURES)
    coefs, _ = CM.indexed_forecasters(spark, root, _index(spark, PATHS), _asked(spark))
    assert "dynamicpruning" in coefs._jdf.queryExecution().executedPlan().toString()


def test_global_model_is_required(spark, tmp_path):
    root = _root(spark, tmp_path, FORECAST_FEATURES)
    CM.save(root + "/none", spark.createDataFrame([(1.0, [1.0], "per_city/x")], CM.MODEL_SCHEMA), {CM.GLOBAL_LIST: FORECAST_FEATURES})
    with pytest.raises(ValueError, match="global model"):
        CM.global_forecaster(spark, root + "/none")


def test_bins_by_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice("xy"), rng.random(), rng.random() < 0.3, rng.randint(1, 5)) for _ in range(700)]
    rows += [("x", 1.0, True, 2), ("x", 0.0, False, 1)]
    odd = [(None, 0.5, True, 1), ("x", None, True, 1), ("x", 0.5, None, 1), ("x", 0.5, True, None), ("x", 0.5, True, 0)]
    events = spark.createDataFrame(rows + odd, "label string, p double, event boolean, w int")
    halves = [events.where("w % 2 = 0"), events.where("w % 2 = 1")]
    cells = RB.merge_cells(RB.cell_sums(halves[0]).unionByName(RB.cell_sums(halves[1])))
    for name, table in (("width", RB.equal_width(cells, 10)), ("weight", RB.equal_weight(cells, 10))):
        expected = {}
        for label in "xy":
            mine = sorted((min(int(p * RB.CELLS), RB.CELLS - 1), p, e, w) for x, p, e, w in rows if x == label)
            total, upto = sum(r[3] for r in mine), {}
            for cell, _, _, w in mine:
                upto[cell] = upto.get(cell, 0) + w
            before, at = 0, {}
            for cell in sorted(upto):
                at[cell] = cell * 10 // RB.CELLS if name == "width" else min(9, (2 * before + upto[cell]) * 10 // (2 * total))
                before += upto[cell]
            for cell, p, e, w in mine:
                n, wp, we = expected.get((label, at[cell]), (0, 0.0, 0))
                expected[label, at[cell]] = (n + w, wp + w * p, we + w * e)
        got = {(r.label, r.bin): r for r in table.collect()}
        assert set(got) == set(expected)
        for key, (n, wp, we) in expected.items():
            assert got[key].n == n and got[key].mean_probability == pytest.approx(wp / n) and got[key].observed == pytest.approx(we / n)
    half = {r.label: r.p for r in RB.quantiles(cells, [0.5]).collect()}
    for label in "xy":
        mine = sorted((p, w) for x, p, e, w in rows if x == label)
        assert sum(w for p, w in mine if p <= half[label]) >= sum(w for _, w in mine) / 2
        assert sum(w for p, w in mine if p < half[label] - 1 / RB.CELLS) < sum(w for _, w in mine) / 2
    assert RB.equal_weight(RB.cell_sums(events.limit(0)), 10).count() == 0
