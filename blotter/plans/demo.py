"""Fixed demonstration tree models for queries whose results SQL must equal (stand-ins for trained artifacts)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators import forecast as FC
from blotter.operators.trees import TREE_SCHEMA
from blotter.schema import FORECAST_FEATURES
from blotter.sources import city_models as CM

#: A tree is a leaf's value or (feature, threshold, left, right).
DEMO_BASE = 0.25
DEMO_TREES = [
    ("lag_1", 0.5, ("roll_mean_7", 0.91, 0.6, 1.1), ("day_of_week", 4.5, 1.3, 0.9)),
    ("is_holiday", 0.5, ("month", 6.5, 0.05, -0.05), -0.3),
    ("roll_std_7", 0.83, 0.1, ("total_officers", 90.5, -0.1, ("lag_7", 1.5, 0.2, 0.35))),
]
#: City models: the same trees with scaled values.
DEMO_TREE_CITIES = {"NATION_1": 0.9, "NATION_12": 1.1}
#: Static features that the trees read.
DEMO_STATIC = ["day_of_week", "month", "is_holiday", "total_officers"]

#: Features of the split search that SQL repeats: all whole numbers, so that its sums are exact.
SPLIT_FEATURES = ["lag_1", "lag_3", "lag_7", "roll_max_7", "roll_min_7", "day_of_week", "month", "total_officers"]
SPLIT_BINS, SPLIT_REG, SPLIT_ROWS = 16, 1.0, 20


def _flat(tree, scale: float, nodes: list) -> int:
    at = len(nodes)
    nodes.append(None)
    if isinstance(tree, tuple):
        feature, threshold, left, right = tree
        nodes[at] = (FORECAST_FEATURES.index(feature), threshold, _flat(left, scale, nodes), _flat(right, scale, nodes), None)
    else:
        nodes[at] = (-1, None, None, None, tree * scale)
    return at


def demo_trees(spark: SparkSession) -> DataFrame:
    rows = []
    for city, scale in [(None, 1.0), *DEMO_TREE_CITIES.items()]:
        nodes: list = []
        roots = [_flat(t, scale, nodes) for t in DEMO_TREES]
        rows.append((city, DEMO_BASE * scale, roots, nodes))
    return spark.createDataFrame(rows, TREE_SCHEMA)


def tree_sql(names: dict[str, str], scale: float) -> str:
    """The ensemble as nested CASE expressions over the named feature columns."""

    def one(tree) -> str:
        if not isinstance(tree, tuple):
            return repr(float(tree * scale))
        feature, threshold, left, right = tree
        return f"CASE WHEN {names[feature]} <= {threshold!r} THEN {one(left)} ELSE {one(right)} END"

    return f"({DEMO_BASE * scale!r} + " + " + ".join(f"({one(t)})" for t in DEMO_TREES) + ")"


#: A demonstration index: a shared model, a path that isn't a city model's, a model that isn't there, one
#: whose weights are too few, and a city without history.
INDEX_PATHS = {
    "NATION_1": "per_city/forecasters/shared",
    "NATION_7": "per_city/forecasters/shared",
    "NATION_12": "elsewhere/NATION_12",
    "NATION_3": "per_city/forecasters/gone",
    "NATION_5": "per_city/forecasters/short",
    "NATION_99": "per_city/forecasters/shared",
}
#: The model of NATION_1 is the shared one.
INDEX_SHARED = "NATION_1"
INDEX_OWN = ["NATION_1", "NATION_7"]


def write_index(spark: SparkSession, root: str) -> None:
    """The demonstration models, whose list is in another order than the global one, and their index."""
    coefs = FC.demo_coefficients(spark)
    turned = FORECAST_FEATURES[::-1]
    whole = coefs.where("city IS NULL").withColumn("model_path", F.lit(CM.GLOBAL_MODEL))
    shared = coefs.where(F.col("city") == INDEX_SHARED).withColumn("model_path", F.lit(INDEX_PATHS[INDEX_SHARED]))
    foreign = coefs.where("city = 'NATION_12'").withColumn("model_path", F.lit(INDEX_PATHS["NATION_12"]))
    short = spark.createDataFrame([(1.0, [1.0], INDEX_PATHS["NATION_5"])], CM.MODEL_SCHEMA)
    models = CM.artifacts(whole, FORECAST_FEATURES).unionByName(CM.artifacts(shared.unionByName(foreign), turned))
    CM.save(root, models.unionByName(short), {CM.GLOBAL_LIST: FORECAST_FEATURES})
    text = json.dumps({"forecasters": INDEX_PATHS, "classifiers": {}, "forecast_features": turned})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{root}/index")
