"""Lookup tables for risk features.

The reference builds these as dicts over a city x hour (or date x
location) product; here each is an aggregate over the observed keys, and
the zero-filled means divide by the number of distinct dates, so the
product is never materialised. The small domain product (cities x hours,
both bounded domains) is expanded per city by a generator where a full
table is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.schema import LOOKUP_STAT_COLS
from blotter.session import materialize


def _order(df: DataFrame) -> Column:
    return F.col("row_order") if "row_order" in df.columns else F.col("date")


def _weight(weight: str | None) -> Column:
    """Row weight: the named count column of a summary, or 1 for incident rows."""
    return F.col(weight) if weight else F.lit(1)


def hour_counts(inc: DataFrame) -> DataFrame:
    """Incidents per (city, hour, offense), counted map-side and written once: bounded by
    these domains whatever the number of incidents."""
    return materialize(inc.groupBy("city", "hour", "offense_category_clean").agg(F.count(F.lit(1)).alias("n")))


def place_counts(inc: DataFrame) -> DataFrame:
    """Incidents per location, counted map-side and written once."""
    return materialize(inc.groupBy("location_area").agg(F.count(F.lit(1)).alias("n")))


def _last_non_null(c: str, order: Column) -> Column:
    return F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c)


def city_stats_last(inc: DataFrame) -> DataFrame:
    """A8 (raw path): last non-null value per column per city, in file order (Q6)."""
    order = _order(inc)
    named = inc.where(F.col("city").isNotNull()).groupBy("city")
    return named.agg(*[_last_non_null(c, order) for c in LOOKUP_STAT_COLS])


def city_stats_latest(daily: DataFrame) -> DataFrame:
    """A7 (bundle path): latest non-null value per column per city by date."""
    return daily.groupBy("city").agg(*[_last_non_null(c, F.col("date")) for c in LOOKUP_STAT_COLS])


def location_totals(inc: DataFrame, weight: str | None = None) -> DataFrame:
    """Incidents per location."""
    return (
        inc.where(F.col("location_area").isNotNull())
        .groupBy("location_area")
        .agg(F.sum(_weight(weight)).cast("double").alias("location_total_crimes"))
    )


def distinct_dates(inc: DataFrame) -> Column:
    """Number of distinct dates in the whole table (scalar subquery)."""
    return inc.select(F.count_distinct("date")).scalar()


def location_daily_mean(inc: DataFrame, weight: str | None = None, days: Column | None = None) -> DataFrame:
    """A13 + A14: mean incidents per day per location, days without any counted as 0."""
    d = distinct_dates(inc) if days is None else days
    return (
        inc.where(F.col("location_area").isNotNull())
        .groupBy("location_area")
        .agg((F.sum(_weight(weight)) / d).cast("double").alias("avg_location_daily_freq"))
    )


def hour_typical_observed(counts: DataFrame) -> DataFrame:
    """A10 from ``hour_counts``: most frequent offense per observed (city, hour); ties ->
    smallest label (Q7); a group whose offenses are all null -> 'Other'."""
    o = F.col("offense_category_clean")
    best = F.min_by(o, F.when(o.isNotNull(), F.struct((-F.col("n")).alias("most"), o.alias("o"))))
    named = counts.where(F.col("city").isNotNull())
    return named.groupBy("city", "hour").agg(F.coalesce(best, F.lit("Other")).alias("hour_typical_crime"))


def hour_diversity_observed(inc: DataFrame, days: Column | None = None) -> DataFrame:
    """A11 + A12: mean over all dates of the distinct-offense count per (date, hour, city).

    Pre-aggregates per (date, hour, city) first (map-side combine), then sums
    per (city, hour) and divides by the number of distinct dates (Q3).
    """
    d = distinct_dates(inc) if days is None else days
    per_day = (
        inc.where(F.col("city").isNotNull())
        .groupBy("date", "hour", "city")
        .agg(F.count_distinct("offense_category_clean").alias("k"))
    )
    return per_day.groupBy("city", "hour").agg((F.sum("k") / d).cast("double").alias("avg_crime_diversity"))


def city_hour_domain(counts: DataFrame) -> DataFrame:
    """The city x hour product the reference's lookups are keyed on, from ``hour_counts``.

    Hours (at most 24 values) are gathered by a scalar subquery and expanded
    per city row: a generator over a bounded domain, no join.
    """
    hours = counts.select(F.array_sort(F.collect_set("hour"))).scalar()
    cities = counts.where(F.col("city").isNotNull()).select("city").distinct()
    return cities.select("city", F.explode(hours).alias("hour"))


def hour_typical(counts: DataFrame) -> DataFrame:
    """A10 over the full product: unobserved (city, hour) -> null (Q7)."""
    return city_hour_domain(counts).join(hour_typical_observed(counts), ["city", "hour"], "left")


def hour_diversity(inc: DataFrame, counts: DataFrame, days: Column | None = None) -> DataFrame:
    """A12 over the full product: unobserved (city, hour) -> 0.0 (Q3)."""
    return (
        city_hour_domain(counts)
        .join(hour_diversity_observed(inc, days), ["city", "hour"], "left")
        .select("city", "hour", F.coalesce("avg_crime_diversity", F.lit(0.0)).alias("avg_crime_diversity"))
    )


def domains(inc: DataFrame, typical: DataFrame | None = None) -> DataFrame:
    """A15 + O5: sorted domains as (domain, value, pos): cities, locations,
    typical-offense labels (ascending) and years (descending). Nulls are not
    part of a domain (documented deviation, Q15)."""

    def ranked(df: DataFrame, name: str, col: str, desc: bool = False) -> DataFrame:
        vals = df.where(F.col(col).isNotNull()).select(F.col(col).alias("v")).distinct()
        order = F.desc("v") if desc else F.asc("v")
        from pyspark.sql import Window

        w = Window.partitionBy(F.lit(name)).orderBy(order)
        return vals.select(
            F.lit(name).alias("domain"), F.col("v").cast("string").alias("value"), (F.row_number().over(w) - 1).alias("pos")
        )

    typical = typical if typical is not None else hour_typical(hour_counts(inc))
    years = inc if "year" in inc.columns else inc.select(F.year("date").alias("year"))
    return (
        ranked(inc, "city", "city")
        .unionByName(ranked(inc, "location_area", "location_area"))
        .unionByName(ranked(typical, "hour_typical_crime", "hour_typical_crime"))
        .unionByName(ranked(years, "year", "year", desc=True))
    )
