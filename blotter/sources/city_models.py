"""From a model index to coefficients.

Artifacts under a root folder:
  * ``models``: one row a model (intercept, weights), partitioned by ``model_path``;
  * ``feature_lists``: ordered lists by name; a model's weights stand in the order of its list.

The index (``model_index``) says which path a city's model has, so several cities may
share one. Only the asked cities' entries are joined with the models, and that join
prunes the partitions at run time: a model nobody asked for isn't read. The projection
from a stored list to the forecast's features is built by name, so the order of a
list is free and a feature that it leaves out has weight 0.

Fallback: the global model and its list are required. A city keeps the global model when it
has no entry, a path outside ``per_city/``, no artifact, weights that don't fit the list, or
a list with repeated or unknown names; ``status`` says which. Without any list for city
models all of them are off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators import forecast as FC
from blotter.schema import FORECAST_FEATURES
from blotter.sources import model_index as MI

MODELS = "models"
FEATURE_LISTS = "feature_lists"
GLOBAL_MODEL = "forecaster"
GLOBAL_LIST = "forecast_features"
CITY_LIST = "per_city_forecast_features"

MODEL_SCHEMA = "intercept double, weights array<double>, model_path string"
LIST_SCHEMA = "name string, features array<string>"

OWN_MODEL = "own model"
NO_ENTRY = "no entry"
FOREIGN_PATH = "foreign path"
NO_ARTIFACT = "no artifact"
NO_LIST = "no feature list"
BAD_LIST = "unknown or repeated feature"
BAD_WEIGHTS = "weights don't fit the list"


def artifacts(coefs: DataFrame, features: list[str]) -> DataFrame:
    """Rows of ``forecast.coefficient_schema`` with a ``model_path`` as artifacts: weights in the order of ``features``."""
    weights = F.array(*[F.col(f).cast("double") for f in features])
    return coefs.select("intercept", weights.alias("weights"), "model_path")


def save(root: str, models: DataFrame, lists: dict[str, list[str]]) -> None:
    """Write models and feature lists."""
    models.write.mode("overwrite").partitionBy("model_path").parquet(f"{root}/{MODELS}")
    rows = models.sparkSession.createDataFrame([(k, list(v)) for k, v in lists.items()], LIST_SCHEMA)
    rows.write.mode("overwrite").parquet(f"{root}/{FEATURE_LISTS}")


def _stored_list(spark: SparkSession, root: str, name: str) -> Column:
    """The list of this name as a scalar, null if there is none."""
    lists = spark.read.schema(LIST_SCHEMA).parquet(f"{root}/{FEATURE_LISTS}")
    return lists.where(F.col("name") == name).select(F.first("features").alias("f")).scalar()


def _by_name(features: Column, weights: Column) -> list[Column]:
    """Each feature's weight, found by the list's order."""
    return [
        F.coalesce(F.get(weights, (F.array_position(features, F.lit(f)) - 1).cast("int")), F.lit(0.0)).alias(f)
        for f in FORECAST_FEATURES
    ]


def _fault(features: Column, weights: Column) -> Column:
    """Why a model can't be used, null if it can."""
    known = F.array(*[F.lit(f) for f in FORECAST_FEATURES])
    odd = (F.size(F.array_except(features, known)) > 0) | (F.size(F.array_distinct(features)) < F.size(features))
    fits = weights.isNotNull() & (F.size(weights) == F.size(features)) & ~F.exists(weights, lambda w: w.isNull() | F.isnan(w))
    return F.when(features.isNull(), NO_LIST).when(odd, BAD_LIST).when(~F.coalesce(fits, F.lit(False)), BAD_WEIGHTS)


def global_forecaster(spark: SparkSession, root: str) -> DataFrame:
    """The required global row; raises when its model or list is absent or can't be used."""
    models = spark.read.schema(MODEL_SCHEMA).parquet(f"{root}/{MODELS}").where(F.col("model_path") == GLOBAL_MODEL)
    row = models.select("*", _stored_list(spark, root, GLOBAL_LIST).alias("features")).select(
        F.lit(None).cast("string").alias("city"), "intercept", *_by_name(F.col("features"), F.col("weights")),
        _fault(F.col("features"), F.col("weights")).alias("fault"),
    )
    got = row.select("fault").take(2)
    if len(got) != 1 or got[0]["fault"]:
        raise ValueError(f"{root}: the global model can't be used ({got[0]['fault'] if len(got) == 1 else f'{len(got)} rows'})")
    return row.drop("fault")


def indexed_forecasters(spark: SparkSession, root: str, index: DataFrame, cities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(coefficients, status) for the asked cities.

    ``index``: ``model_index.read_index``; a rejected one has no entries. The list for city models is the index's
    ``forecast_features``, else the stored one. Coefficients hold the global row and a row
    per city with a usable model; status has city, path and status, one row per asked city."""
    asked = cities.select("city").distinct()
    listed = MI.index_entries(index).where(F.col("asset_group") == "forecasters").select("city", "path", "usable")
    chosen = MI.select_city_models(MI.index_entries(index), "forecasters", asked).select("city", "path")
    models = spark.read.schema(MODEL_SCHEMA).parquet(f"{root}/{MODELS}")
    in_index = index.where(F.col("index").isNotNull()).select(F.first("index.forecast_features").alias("f")).scalar()
    features = F.coalesce(in_index, _stored_list(spark, root, CITY_LIST))
    found = (
        models.join(F.broadcast(chosen), F.col("model_path") == F.col("path"))  # one JSON text's entries
        .select("city", "intercept", "weights", features.alias("features"))
        .withColumn("fault", _fault(F.col("features"), F.col("weights")))
    )
    own = found.where("fault IS NULL").select("city", "intercept", *_by_name(F.col("features"), F.col("weights")))
    status = (
        asked.join(listed, ["city"], "left")
        .join(found.select("city", "fault", F.lit(True).alias("found")), ["city"], "left")
        .select(
            "city",
            "path",
            F.when(F.col("path").isNull(), NO_ENTRY)
            .when(~F.col("usable"), FOREIGN_PATH)
            .when(F.col("found").isNull(), NO_ARTIFACT)
            .otherwise(F.coalesce("fault", F.lit(OWN_MODEL)))
            .alias("status"),
        )
    )
    return global_forecaster(spark, root).unionByName(own), status


def forecast_by_index(
    daily: DataFrame, root: str, index: DataFrame, cities: DataFrame, origin: Column
) -> DataFrame:
    """Index to forecast: every asked city's 30 days with its model's status; a city without
    history has one row with null days."""
    coefs, status = indexed_forecasters(daily.sparkSession, root, index, cities)
    days = FC.forecast(daily, coefs, origin, cities=status.select("city"))
    return status.select(F.col("city").alias("City"), "status").join(days, ["City"], "left")
