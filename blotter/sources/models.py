"""Model artifacts as Parquet tables.

Forecast and classifier models are coefficient tables (``forecast.
coefficient_schema`` / ``risk.MODEL_SCHEMA``). The global/statewide rows are
required; per-city tables are optional: when missing or unreadable, the
feature degrades to the global model and a warning says why, as the
reference's optional loaders do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators import forecast as FC
from blotter.operators import risk as R

FORECASTER = "forecaster"
CITY_FORECASTERS = "per_city_forecasters"
CLASSIFIERS = "classifiers"
CITY_CLASSIFIERS = "per_city_classifiers"


def save_models(path: str, forecast_coefs: DataFrame, classifiers: DataFrame) -> None:
    """Write the global rows and the per-city rows as separate tables (per-city partitioned by city)."""
    forecast_coefs.where(F.col("city").isNull()).write.mode("overwrite").parquet(f"{path}/{FORECASTER}")
    forecast_coefs.where(F.col("city").isNotNull()).write.mode("overwrite").partitionBy("city").parquet(
        f"{path}/{CITY_FORECASTERS}"
    )
    classifiers.where(F.col("city").isNull()).write.mode("overwrite").parquet(f"{path}/{CLASSIFIERS}")
    classifiers.where(F.col("city").isNotNull()).write.mode("overwrite").partitionBy("city").parquet(
        f"{path}/{CITY_CLASSIFIERS}"
    )


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def load_forecast_models(spark: SparkSession, path: str, city_models: bool = True) -> tuple[DataFrame, list[str]]:
    """Required global forecaster + optional per-city forecasters -> (coefficients, warnings)."""
    schema = FC.coefficient_schema()
    coefs = _read(spark, f"{path}/{FORECASTER}", schema)  # required: raises when missing
    warnings: list[str] = []
    if city_models:
        try:
            per_city = _read(spark, f"{path}/{CITY_FORECASTERS}", schema)
            per_city.limit(1).collect()
            coefs = coefs.unionByName(per_city)
        except Exception as exc:  # noqa: BLE001 - optional artifact
            warnings.append(f"No city forecasters: {CITY_FORECASTERS} could not be read ({type(exc).__name__}).")
    return coefs, warnings


def load_risk_models(spark: SparkSession, path: str, city_models: bool = True) -> tuple[DataFrame, list[str]]:
    """Required statewide classifiers + optional per-city ones -> (model table, warnings)."""
    models = _read(spark, f"{path}/{CLASSIFIERS}", R.MODEL_SCHEMA)
    warnings: list[str] = []
    if city_models:
        try:
            per_city = _read(spark, f"{path}/{CITY_CLASSIFIERS}", R.MODEL_SCHEMA)
            per_city.limit(1).collect()
            models = models.unionByName(per_city)
        except Exception as exc:  # noqa: BLE001 - optional artifact
            warnings.append(f"No city classifiers: {CITY_CLASSIFIERS} could not be read ({type(exc).__name__}).")
    return models, warnings


def load_city_model(coefs: DataFrame, city: str) -> DataFrame:
    """S7 on tables: one city's rows; a partition-pruned read when ``coefs`` is the per-city table."""
    return coefs.where(F.col("city") == F.lit(city))
