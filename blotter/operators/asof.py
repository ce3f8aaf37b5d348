"""Risk lookups as of a date (M11): each scenario sees the rows before its own day only.

Trained on lookups over the whole table, a classifier would see its own label and later rows. Here every
lookup (A8-A14) is a running aggregate: rows are counted per (key, day), map-side, the days that
scenarios ask for join in with no count, and a range frame up to the day before adds up. So windows run over
days x keys, not over incidents, and no scenario is joined to its past.

The typical offense as of a day needs no state per offense: running counts only grow, so the offense with the
highest count so far is the one of the highest running count among all earlier (day, offense)
entries; a running minimum of (-count, label) keeps it, the smallest label on ties (Q7).

Defaults (Q9) apply where a key has no row before the day: a place without earlier rows, a city or an hour without
earlier rows. A city and an hour that are both known, but not together, have diversity 0 and no typical offense.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.operators.lookups import _order
from blotter.operators.risk import DEFAULT_DIVERSITY, DEFAULT_LOCATION_DAILY, DEFAULT_LOCATION_TOTAL, DEFAULT_STAT, DEFAULT_TYPICAL_OFFENSE
from blotter.schema import LOOKUP_STAT_COLS
from blotter.session import materialize

#: What a scenario is asked by.
KEYS = ["city", "location_area", "hour", "input_date"]


def running(days: DataFrame, asked: DataFrame, keys: list[str], aggregates: dict[str, Column]) -> DataFrame:
    """(keys, date, aggregates over all earlier days) for the asked (keys, date).

    ``days`` has a row per (keys, date); aggregates ignore nulls, which is what asked days bring."""
    points = asked.select(*keys, "date").distinct().withColumn("_asked", F.lit(True))
    rows = days.unionByName(points, allowMissingColumns=True)
    number = F.datediff("date", F.lit("1970-01-01").cast("date"))
    before = Window.partitionBy(*keys).orderBy("_day").rangeBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("_day", number).select(*keys, "date", "_asked", *[a.over(before).alias(n) for n, a in aggregates.items()])
    return out.where("_asked").drop("_asked")


def _first_days(inc: DataFrame, key: str) -> DataFrame:
    return inc.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("date").alias(f"first_{key}"))


def _dates_before(inc: DataFrame, asked: DataFrame) -> DataFrame:
    """(date, n_days): distinct dates of the table before each asked one; a window over one row a day."""
    days = inc.select("date").distinct().withColumn("one", F.lit(1))
    one = running(days.withColumn("all", F.lit(0)), asked.select(F.lit(0).alias("all"), "date"), ["all"], {"n_days": F.sum("one")})
    return one.select("date", F.coalesce("n_days", F.lit(0)).alias("n_days"))


def _typical_days(inc: DataFrame) -> DataFrame:
    """(city, hour, date, k, best): distinct offenses of the day, and the day's best running (-count, offense)."""
    o = F.col("offense_category_clean")
    per = inc.where(F.col("city").isNotNull()).groupBy("city", "hour", "date", o.alias("o")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("city", "hour", "o").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    most = F.struct((-F.sum("n").over(upto)).alias("most"), F.col("o").alias("o"))
    counted = per.withColumn("entry", F.when(F.col("o").isNotNull(), most))
    return counted.groupBy("city", "hour", "date").agg(F.count("o").alias("k"), F.min("entry").alias("best"), F.lit(1).alias("seen"))


def _staffing_days(inc: DataFrame) -> DataFrame:
    """(city, date, stats): each day's last value in file order, nulls passed over (Q6)."""
    order = _order(inc)
    last = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in LOOKUP_STAT_COLS]
    return inc.where(F.col("city").isNotNull()).groupBy("city", "date").agg(*last, F.lit(1).alias("seen"))


def lookups_as_of(inc: DataFrame, scenarios: DataFrame) -> DataFrame:
    """One row per distinct scenario key: the lookups of M5 from the rows before ``input_date``. A null key has no
    earlier rows, so it gets the defaults."""
    asked = materialize(scenarios.select(*KEYS).distinct())
    at = asked.withColumnRenamed("input_date", "date")
    places = inc.where(F.col("location_area").isNotNull()).groupBy("location_area", "date").agg(F.count(F.lit(1)).alias("n"))
    known_place, known_hour, known_city = (at.where(F.col(c).isNotNull()) for c in ("location_area", "hour", "city"))
    place = running(places, known_place, ["location_area"], {"total": F.sum("n")})
    both = known_hour.where(F.col("city").isNotNull())
    typical = running(_typical_days(inc), both, ["city", "hour"], {"k_sum": F.sum("k"), "best": F.min("best"), "met": F.max("seen")})
    staffing = running(
        _staffing_days(inc), known_city, ["city"], {**{c: F.last(c, ignorenulls=True) for c in LOOKUP_STAT_COLS}, "known": F.max("seen")}
    )
    rows = (
        at.join(_dates_before(inc, at), ["date"])
        .join(place, ["location_area", "date"], "left")
        .join(typical, ["city", "hour", "date"], "left")
        .join(staffing, ["city", "date"], "left")
        .join(_first_days(inc, "hour"), ["hour"], "left")
    )
    total = F.col("total").cast("double")
    in_product = F.col("known").isNotNull() & (F.col("first_hour") < F.col("date"))
    diversity = F.when(F.col("met").isNotNull(), F.col("k_sum") / F.col("n_days")).when(in_product, F.lit(0.0)).otherwise(F.lit(DEFAULT_DIVERSITY))
    offense = F.when(F.col("met").isNotNull(), F.coalesce(F.col("best.o"), F.lit("Other"))).when(
        ~F.coalesce(in_product, F.lit(False)), F.lit(DEFAULT_TYPICAL_OFFENSE)
    )
    return rows.select(
        "city",
        "location_area",
        "hour",
        F.col("date").alias("input_date"),
        F.coalesce(total, F.lit(DEFAULT_LOCATION_TOTAL)).alias("location_total_crimes"),
        F.coalesce(total / F.col("n_days"), F.lit(DEFAULT_LOCATION_DAILY)).alias("location_daily_freq"),
        diversity.alias("crime_diversity"),
        offense.alias("hour_typical_crime"),
        *[F.when(F.col("known").isNotNull(), F.col(c).cast("double")).otherwise(F.lit(DEFAULT_STAT)).alias(c) for c in LOOKUP_STAT_COLS],
    )
