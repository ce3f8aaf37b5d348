"""Dense daily city series (A1, A2, A16, J1, J2, W1, W2, P8, P14) and the
pre-aggregated bundle tables.

Scale plan: the raw incident table is read **once**, into a (date, city)
summary (row count + the first row's staffing stats), with a map-side
partial aggregate. Everything after that -- calendar bounds, the dense
grid, city-year stats, the fills -- works on the summary, whose size is
days x cities (bounded by the calendar, not by the incident count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.schema import STAT_COLS
from blotter.session import materialize

BACKFILL_FRAME = "frame"
BACKFILL_PER_CITY = "per_city"


def _order_col(inc: DataFrame) -> Column:
    return F.col("row_order") if "row_order" in inc.columns else F.col("date")


def _count(weight: str | None) -> Column:
    """Number of incidents: of rows, or by the named count column of counted rows."""
    return F.sum(weight) if weight else F.count(F.lit(1))


def city_day_staff(inc: DataFrame) -> DataFrame:
    """Incidents counted per (date, city, staffing), with the first and last order of their rows.

    The daily summary, the staffing trends and the last stats all follow from it (with
    ``weight="n"`` where they count), so that the incidents are read once for them.
    """
    order = _order_col(inc)
    return inc.groupBy("date", "city", *STAT_COLS).agg(
        F.count(F.lit(1)).alias("n"), F.min(order).alias("row_order"), F.max(order).alias("last_order")
    )


def city_day_summary(inc: DataFrame, weight: str | None = None) -> DataFrame:
    """One pass over incidents: (date, city) -> crime_count and the first row's stats.

    The null-city group is kept: its dates still count for the calendar bounds.
    ``weight`` names the count column of counted rows, as ``city_day_staff`` makes them.
    """
    order = _order_col(inc)
    # per-column min_by with primitive values keeps the aggregate hash-based;
    # with a unique row order it picks the same (first) row for every column
    return materialize(
        inc.groupBy("date", "city").agg(
            _count(weight).alias("crime_count"),
            F.min(order).alias("ord"),
            *[F.min_by(F.col(c), order).alias(c) for c in STAT_COLS],
        )
    )


def daily_city_counts(inc: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """A1: incidents per (date, city) for named cities."""
    s = summary if summary is not None else city_day_summary(inc)
    return s.where(F.col("city").isNotNull()).select("date", "city", "crime_count")


def calendar_bounds(summary: DataFrame) -> tuple[Column, Column]:
    """First and last date as scalar subqueries (evaluated once, no join)."""
    lo = summary.select(F.min("date")).scalar()
    hi = summary.select(F.max("date")).scalar()
    return lo, hi


def daily_city_dense(inc: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """Every day min..max x every named city, absent -> 0, plus ``year``.

    Each city row expands its own day sequence (a generator, not a join).
    """
    s = summary if summary is not None else city_day_summary(inc)
    lo, hi = calendar_bounds(s)
    cities = s.where(F.col("city").isNotNull()).select("city").distinct()
    grid = cities.select(F.explode(F.sequence(lo, hi)).alias("date"), "city")
    counts = daily_city_counts(inc, s)
    return grid.join(counts, ["date", "city"], "left").select(
        "date",
        "city",
        F.coalesce(F.col("crime_count"), F.lit(0)).cast("long").alias("crime_count"),
        F.year("date").alias("year"),
    )


def city_year_stats(inc: DataFrame, summary: DataFrame | None = None) -> DataFrame:
    """A2: the first row (file order) per (year, city) -- nulls inside it kept (Q4)."""
    s = summary if summary is not None else city_day_summary(inc)
    return (
        s.where(F.col("city").isNotNull())
        .groupBy(F.year("date").alias("year"), "city")
        .agg(*[F.min_by(F.col(c), F.col("ord")).alias(c) for c in STAT_COLS])
    )


def _ffill(c: str, by: str, order: str) -> Column:
    w = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(F.col(c), ignorenulls=True).over(w)


def _bfill(c: str, by: str, order: str) -> Column:
    """Next non-null at or after the row. Written as a running frame over the
    reversed order: Spark evaluates growing frames incrementally, while a
    current..unbounded-following frame is re-aggregated for every row."""
    w = Window.partitionBy(by).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(F.col(c), ignorenulls=True).over(w)


def backfill_frame(df: DataFrame, cols: list[str]) -> DataFrame:
    """Backward fill over the whole frame in (date, city) order, without a
    single-partition window over the rows.

    (a) the next non-null at the same date, city >= current: window by date;
    (b) else the first non-null (smallest city) of the next date that has one:
        a per-date summary (one row a day) and a window over the days only.
    """
    same_day = df.select("date", "city", *[_bfill(c, "date", "city").alias(f"_a_{c}") for c in cols], *[
        x for x in df.columns if x not in ("date", "city", *cols)
    ])
    per_day = df.groupBy("date").agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("city"))).alias(f"_d_{c}") for c in cols]
    )
    # one row a day: the window over the days is bounded by the calendar, not the data
    w_next = Window.orderBy(F.desc("date")).rowsBetween(Window.unboundedPreceding, -1)
    next_day = per_day.select(
        "date", *[F.last(F.col(f"_d_{c}"), ignorenulls=True).over(w_next).alias(f"_b_{c}") for c in cols]
    )
    joined = same_day.join(next_day, ["date"], "left")
    rest = [x for x in df.columns if x not in cols]
    return joined.select(*rest, *[F.coalesce(F.col(f"_a_{c}"), F.col(f"_b_{c}")).alias(c) for c in cols]).select(
        *df.columns
    )


def daily_city(inc: DataFrame, backfill: str = BACKFILL_FRAME, dropna: bool = True) -> DataFrame:
    """J1 + W1 + W2 + P8: the dense grid with city-year stats, forward filled per
    city by date, then backward filled (whole frame in (date, city) order as the
    reference does, or per city with ``backfill='per_city'``), rows with any null dropped.

    The result (days x cities rows) is materialised once: every forecast part
    reads it several times.
    """
    return daily_city_of(city_day_summary(inc), backfill, dropna)


def daily_city_of(summary: DataFrame, backfill: str = BACKFILL_FRAME, dropna: bool = True) -> DataFrame:
    """``daily_city`` from the rows of ``city_day_summary``, wherever these come from."""
    dense = daily_city_dense(summary, summary)
    stats = city_year_stats(summary, summary)
    joined = dense.join(stats, ["city", "year"], "left").select("date", "city", "crime_count", "year", *STAT_COLS)
    out = fill_stats(joined, STAT_COLS, backfill)
    return materialize(out.na.drop("any") if dropna else out)


def fill_stats(df: DataFrame, cols: list[str], backfill: str = BACKFILL_FRAME) -> DataFrame:
    """W1 + W2 on a (date, city, ...) frame: forward fill per city by date, then
    backward fill over the whole frame (or per city)."""
    keep = [c for c in df.columns if c not in cols]
    ff = df.select(*keep, *[_ffill(c, "city", "date").alias(c) for c in cols])
    if backfill == BACKFILL_PER_CITY:
        return ff.select(*keep, *[_bfill(c, "city", "date").alias(c) for c in cols]).select(*df.columns)
    if backfill == BACKFILL_FRAME:
        return backfill_frame(ff, cols).select(*df.columns)
    raise ValueError(f"unknown backfill mode: {backfill}")


def with_profile_columns(daily: DataFrame) -> DataFrame:
    """P14 / build_forecast_profiles: month, day_of_week (Monday 0, Q11), day_of_year."""
    return daily.withColumns(
        {
            "month": F.month("date"),
            "day_of_week": F.weekday("date"),
            "day_of_year": F.dayofyear("date"),
        }
    )


def crime_distribution(inc: DataFrame, weight: str | None = None) -> DataFrame:
    """Bundle table: (city, year, offense_category_name, count) -- the partial
    aggregate that A5/A6 finish."""
    return inc.groupBy("city", "year", "offense_category_name").agg(_count(weight).alias("count"))
