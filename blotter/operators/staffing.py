"""Staffing trends and status (A3, A22, A27, A29, P6, O2, W7, U5, F13, F19, F22; R6-R9).

``officer_trends`` is the distinct monthly 7-tuple table. Because the
reference keeps tuples in file order, each tuple carries ``first_order``
(min row order of its rows); "last row" reads become ``max_by`` on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.features import month_label, per_1000

TREND_COLS = ["population", "total_officers", "male_officer", "female_officer", "officers_per_1000_people"]
HEAD_COUNTS = ["population", "total_officers", "male_officer", "female_officer"]


def officer_trends(inc: DataFrame) -> DataFrame:
    """A3 + F7: distinct (month_start, city, 5 staffing values); null city kept as its own tuple."""
    order = F.col("row_order") if "row_order" in inc.columns else F.col("date")
    return inc.groupBy(F.trunc("date", "MM").alias("month_start"), "city", *TREND_COLS).agg(
        F.min(order).alias("first_order")
    )


def statewide_staffing(trends: DataFrame) -> DataFrame:
    """A22 + F13: monthly sums over the distinct tuples (Q14) and the recomputed rate."""
    sums = trends.groupBy("month_start").agg(*[F.sum(c).cast("long").alias(c) for c in HEAD_COUNTS])
    return sums.withColumn("officers_per_1000_people", per_1000("total_officers", "population"))


def city_staffing(trends: DataFrame, cities: DataFrame) -> DataFrame:
    """P6 + O2: trends for a set of cities (left-semi join on the set), ordered by city, month."""
    return trends.join(cities.select("city"), ["city"], "left_semi").orderBy("city", "month_start", "first_order")


def last_per_city_month(trends: DataFrame) -> DataFrame:
    """The last tuple per (month, city) -- male and female side by side."""
    last = F.max_by(F.struct(*[F.col(c) for c in TREND_COLS]), F.col("first_order"))
    return (
        trends.where(F.col("city").isNotNull())
        .groupBy("month_start", "city")
        .agg(last.alias("t"))
        .select("month_start", "city", "t.male_officer", "t.female_officer", "t.total_officers")
    )


def gender_text_by_month(per_month: DataFrame, city_order: DataFrame | None = None) -> DataFrame:
    """per month, one 'city: count' line per city in comparison order.

    ``city_order`` (city, ord) gives the order; by default the city name. The
    list per month is bounded by the number of compared cities.
    """
    df = per_month
    if city_order is not None:
        df = df.join(city_order.select("city", "ord"), ["city"])
    else:
        df = df.withColumn("ord", F.col("city"))

    def text(col: str):
        line = F.concat(F.col("city"), F.lit(": "), F.format_number(F.col(col), 0))
        items = F.array_sort(F.collect_list(F.struct(F.col("ord"), line.alias("line"))))
        return F.concat_ws("\n", F.transform(items, lambda x: x["line"]))

    return df.groupBy("month_start").agg(
        text("male_officer").alias("male_text"), text("female_officer").alias("female_text")
    )


def force_status(trends: DataFrame) -> DataFrame:
    """W7 + A27 + F19: latest tuple per city (last month, last tuple in it) and the as-of label."""
    latest = F.max_by(F.struct(*[F.col(c) for c in TREND_COLS]), F.struct("month_start", "first_order"))
    as_of = trends.where(F.col("city").isNotNull()).select(F.max("month_start")).scalar()
    return (
        trends.where(F.col("city").isNotNull())
        .groupBy("city")
        .agg(latest.alias("t"), F.max("month_start").alias("month_start"))
        .select(
            "city",
            "month_start",
            "t.total_officers",
            "t.male_officer",
            "t.female_officer",
            "t.officers_per_1000_people",
            month_label(as_of).alias("as_of"),
        )
    )


def statewide_status(statewide: DataFrame) -> DataFrame:
    """Statewide current status: the last month's sums."""
    last = F.max_by(F.struct(*[F.col(c) for c in HEAD_COUNTS + ["officers_per_1000_people"]]), F.col("month_start"))
    return statewide.agg(last.alias("t"), F.max("month_start").alias("month_start")).select(
        "month_start", "t.*", month_label(F.col("month_start")).alias("as_of")
    )


def missing_scopes(requested: DataFrame, present: DataFrame, key: str = "city") -> DataFrame:
    """Requested scopes with no rows (left-anti join)."""
    return requested.select(key).join(present.select(key), [key], "left_anti")


def city_cards(daily: DataFrame) -> DataFrame:
    """Officers, population and rate from each city's latest daily row (W7, row-wise, Q6)."""
    last = F.max_by(
        F.struct("total_officers", "population", "officers_per_1000_people", "crime_rate_per_1000_people"),
        F.col("date"),
    )
    return daily.groupBy("city").agg(last.alias("t"), F.max("date").alias("date")).select("city", "date", "t.*")
