"""Incident scans (S1) and typing.

The 13-column contract is read with a fixed schema (no inference) and only
those columns are selected, so Parquet/CSV column pruning applies.
A file order column (``row_order``) is attached at the scan when the
source has none: order-dependent reads (A2, A8) need it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.schema import INCIDENT_COLUMNS, RAW_INCIDENT_SCHEMA


def read_incidents_csv(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """CSV scan of the 13 named columns, fixed schema, header row. ``where`` is
    pushed into the scan, which a filter after the row order can't be."""
    df = (
        spark.read.schema(RAW_INCIDENT_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
    df = df if where is None else df.where(where)
    return df.select(*INCIDENT_COLUMNS, _file_order())


MALFORMED, NO_DATE = "malformed", "no such date"


def read_incidents_csv_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S1 with a reject table: (rows, rejects). Rejects are rows that don't fit the contract
    (a value of another type, too few or too many columns) and rows without a date,
    with their text as far as malformed, the reason and the file order.

    Whole rows are parsed on both sides, so that what is malformed doesn't depend on
    the columns read later."""
    df = (
        spark.read.schema(T.StructType([*RAW_INCIDENT_SCHEMA, T.StructField("_corrupt", T.StringType())]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("columnPruning", False)
        .csv(path)
    )
    parts = F.format_string("%04d-%02d-%02d", "year", "month", "day")
    no_date = F.col("year").isNull() | F.col("month").isNull() | F.col("day").isNull() | parts.try_cast("date").isNull()
    reason = F.when(F.col("_corrupt").isNotNull(), MALFORMED).when(no_date, NO_DATE)
    df = df.select(*INCIDENT_COLUMNS, "_corrupt", _file_order(), reason.alias("reason"))
    line = F.to_csv(F.struct(*INCIDENT_COLUMNS))
    bad = df.where("reason IS NOT NULL").select(F.coalesce("_corrupt", line).alias("text"), "reason", "row_order")
    return df.where("reason IS NULL").drop("_corrupt", "reason"), bad


def read_incidents_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S1, Parquet form: the same projection; ``row_order`` kept if written."""
    df = spark.read.parquet(path)
    return df.select(*INCIDENT_COLUMNS, "row_order" if "row_order" in df.columns else _file_order())


def _file_order() -> Column:
    """Order of the rows over all files: path, block of the file, row of the scan. Spark's
    splits come largest first, so the row number alone doesn't follow the files."""
    return F.struct(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    ).alias("row_order")


def type_incidents(raw: DataFrame) -> DataFrame:
    """Date from parts (raises on an invalid date under ANSI, Q19), null hour -> 0 (Q1),
    null head counts -> 0 (Q2), rates kept nullable, offense copy."""
    cols = [
        F.make_date("year", "month", "day").alias("date"),
        F.col("year").cast("int").alias("year"),
        F.col("month").cast("int").alias("month"),
        F.col("day").cast("int").alias("day"),
        F.coalesce(F.col("hour").cast("int"), F.lit(0)).alias("hour"),
        F.col("city").cast("string").alias("city"),
        F.col("location_area").cast("string").alias("location_area"),
        F.col("offense_category_name").cast("string").alias("offense_category_name"),
        F.col("offense_category_name").cast("string").alias("offense_category_clean"),
    ]
    for c in ["population", "total_officers", "male_officer", "female_officer"]:
        cols.append(F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(c))
    for c in ["officers_per_1000_people", "crime_rate_per_1000_people"]:
        cols.append(F.col(c).cast("double").alias(c))
    if "row_order" in raw.columns:
        cols.append(F.col("row_order"))
    return raw.select(*cols)
