"""Pre-aggregated table bundle.

A bundle is a directory of Parquet tables plus a one-row manifest
(schema_version, model_version). The writer partitions the large tables
by year so a year-scoped read prunes files; the loader checks the manifest
(version must start with "2", every table present) and returns ``None``
when the bundle is unusable, like the reference's loader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schema import BUNDLE_SCHEMA_MAJOR, BUNDLE_TABLES, STAT_COLS
from blotter.session import materialize

MANIFEST = "manifest.json"


def write_bundle(tables: dict[str, DataFrame], path: str, schema_version: str = "2.0", model_version: str = "") -> None:
    """Write each table as Parquet (daily/crime tables partitioned by year) and the manifest."""
    missing = [t for t in BUNDLE_TABLES if t not in tables]
    if missing:
        raise ValueError(f"bundle is missing tables: {missing}")
    for name, df in tables.items():
        w = df.write.mode("overwrite")
        if "year" in df.columns and name in ("daily_city", "crime_distribution"):
            w = w.partitionBy("year")
        w.parquet(f"{path}/{name}")
    spark = next(iter(tables.values())).sparkSession
    manifest = spark.createDataFrame(
        [(schema_version, model_version, sorted(tables))], "schema_version string, model_version string, tables array<string>"
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/{MANIFEST}")


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    try:
        rows = spark.read.schema(
            "schema_version string, model_version string, tables array<string>"
        ).json(f"{path}/{MANIFEST}").collect()
    except Exception:  # noqa: BLE001 - an unreadable manifest means no bundle
        return None
    if len(rows) != 1:
        return None
    return rows[0].asDict()


def validate_manifest(manifest: dict | None) -> bool:
    """The reference's checks: a mapping with every required key and a version starting with '2'."""
    if not isinstance(manifest, dict):
        return False
    if manifest.get("schema_version") is None or manifest.get("model_version") is None:
        return False
    if not str(manifest["schema_version"]).startswith(BUNDLE_SCHEMA_MAJOR):
        return False
    return set(BUNDLE_TABLES).issubset(set(manifest.get("tables") or []))


def load_bundle(spark: SparkSession, path: str) -> dict[str, DataFrame] | None:
    """S3: the bundle's tables (lazy DataFrames), or None when it is unusable."""
    manifest = read_manifest(spark, path)
    if not validate_manifest(manifest):
        return None
    out = {}
    for name in BUNDLE_TABLES + ["legacy_lookups"]:
        p = f"{path}/{name}"
        if not _exists(spark, p):
            if name == "legacy_lookups":
                continue
            return None
        out[name] = _year_last(spark.read.parquet(p))
    out["manifest"] = spark.createDataFrame([manifest])
    return out


def _year_last(df: DataFrame) -> DataFrame:
    """A partition column reads back as the last one and an int: the same on both paths."""
    if "year" not in df.columns:
        return df
    return df.select(*[c for c in df.columns if c != "year"], F.col("year").cast("int").alias("year"))


def _exists(spark: SparkSession, p: str) -> bool:
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem check, works for any URI
    conf = spark.sparkContext._jsc.hadoopConfiguration()  # noqa: SLF001
    hp = jvm.org.apache.hadoop.fs.Path(p)
    return hp.getFileSystem(conf).exists(hp)


def counted_incidents(inc: DataFrame) -> DataFrame:
    """Incidents counted in one pass at the three grains that the bundle's tables need, told apart by ``grain``.

    The grains are counted map-side, so what is shuffled and written grows with days, cities
    and offenses and not with the incidents; keys of another grain are null.
    """
    order = F.col("row_order") if "row_order" in inc.columns else F.col("date")
    sets = {
        "staff": ["date", "year", "city", *STAT_COLS],
        "offense": ["city", "year", "offense_category_name"],
        "place": ["location_area"],
    }
    keys = [*sets["staff"], "offense_category_name", "location_area"]
    grain = F.when(F.grouping("location_area") == 0, "place").when(F.grouping("offense_category_name") == 0, "offense").otherwise("staff")
    counted = inc.groupingSets([[F.col(k) for k in s] for s in sets.values()], *keys)
    return counted.agg(grain.alias("grain"), F.count(F.lit(1)).alias("n"), F.min(order).alias("row_order"))


def bundle_from_incidents(inc: DataFrame) -> dict[str, DataFrame]:
    """The tables a bundle holds, aggregated from incident rows, or from those of ``counted_incidents``
    (recognised by their ``grain``)."""
    from blotter.operators import daily as D
    from blotter.operators import staffing as S

    counted = inc if "grain" in inc.columns else materialize(counted_incidents(inc))
    staff, offenses, places = (counted.where(F.col("grain") == g) for g in ("staff", "offense", "place"))
    tables = {
        "daily_city": D.daily_city_of(D.city_day_summary(staff, "n")),
        "officer_trends": S.officer_trends(staff),
        "crime_distribution": D.crime_distribution(offenses, "n"),
        "location_areas": places.where(F.col("location_area").isNotNull()).select("location_area").distinct(),
        "years": staff.select("year").distinct(),
    }
    return {name: _year_last(t) for name, t in tables.items()}


def load_tables(spark: SparkSession, bundle_path: str | None, incidents: DataFrame | None) -> dict[str, DataFrame]:
    """The bundle when valid, else the same tables aggregated from raw rows.

    Both paths return the same table names, columns and types; ``source`` says which.
    """
    if bundle_path is not None:
        b = load_bundle(spark, bundle_path)
        if b is not None:
            b["source"] = spark.createDataFrame([("bundle",)], "source string")
            return b
    if incidents is None:
        raise ValueError("no valid bundle and no incident rows to aggregate")
    t = bundle_from_incidents(incidents)
    t["source"] = spark.createDataFrame([("raw",)], "source string")
    return t

