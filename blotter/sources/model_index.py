"""Per-city model index.

The index is a JSON object ``{"forecasters": {city: path}, "classifiers":
{city: path}, "forecast_features": [...]}``. It is parsed with
``from_json`` against a map schema (a member that is not an object parses
to null and rejects the index) and exploded to (asset_group, city, path)
rows; a city's model is usable when its path starts with ``per_city/``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schema import MODEL_GROUPS, PER_CITY_PREFIX

INDEX_SCHEMA = (
    "forecasters map<string,string>, classifiers map<string,string>, forecast_features array<string>"
)


def parse_index(json_text: Column) -> Column:
    """the parsed index struct, or null when the text is not a valid index."""
    parsed = F.from_json(json_text, INDEX_SCHEMA, {"mode": "PERMISSIVE"})
    # a member that is there must be an object: text, lists, numbers and null are not
    whole = F.try_parse_json(json_text)
    raw_ok = F.lit(True)
    for group in MODEL_GROUPS:
        kind = F.schema_of_variant(F.try_variant_get(whole, f"$.{group}", "variant"))
        raw_ok = raw_ok & F.coalesce(kind.startswith("OBJECT"), F.lit(True))
    is_obj = F.trim(json_text).startswith("{")
    return F.when(is_obj & raw_ok & parsed.isNotNull(), parsed)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Read an index file (whole file as one JSON text) -> one row with ``index``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(parse_index(F.col("value")).alias("index"))


def index_entries(index_df: DataFrame) -> DataFrame:
    """(asset_group, city, path, usable) for every entry of a parsed index."""
    parts = []
    for group in MODEL_GROUPS:
        parts.append(
            index_df.where(F.col("index").isNotNull()).select(
                F.lit(group).alias("asset_group"), F.explode(F.col(f"index.{group}")).alias("city", "path")
            )
        )
    out = parts[0].unionByName(parts[1])
    return out.withColumn("usable", F.col("path").startswith(PER_CITY_PREFIX) & (F.length("path") > 0))


def select_city_models(entries: DataFrame, group: str, cities: DataFrame) -> DataFrame:
    """Usable entries of one group for the requested cities (semi join)."""
    if group not in MODEL_GROUPS:
        raise ValueError(f"{group!r} is not one of the model groups {sorted(MODEL_GROUPS)}")
    return (
        entries.where((F.col("asset_group") == group) & F.col("usable"))
        .join(cities.select("city"), ["city"], "left_semi")
    )


def build_index_json(forecasters: DataFrame, classifiers: DataFrame, features: list[str]) -> DataFrame:
    """One-row DataFrame with the JSON text of an index built from (city, path) tables."""
    f = forecasters.select(F.map_from_entries(F.collect_list(F.struct("city", "path"))).alias("m"))
    c = classifiers.select(F.map_from_entries(F.collect_list(F.struct("city", "path"))).alias("m"))
    feats = F.array(*[F.lit(x) for x in features])
    return f.select(
        F.to_json(
            F.struct(F.col("m").alias("forecasters"), c.select("m").scalar().alias("classifiers"), feats.alias("forecast_features"))
        ).alias("value")
    )
