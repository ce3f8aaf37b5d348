"""Historical offense distributions and totals.

Every function takes either incident rows or the pre-aggregated
``crime_distribution`` table (recognised by a ``count`` column) and keeps
``city`` as a group key instead of looping over scopes: one aggregation
answers every city at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.features import offense_class, share_label
from blotter.schema import OFFENSE_CLASSES

ALL_YEARS = "All Years"


def filter_scope(df: DataFrame, city: str | None = None, year: int | str | None = ALL_YEARS) -> DataFrame:
    """City scope (None = statewide) and year scope ('All Years' = none).

    Uses ``year`` when present, else ``year(date)``. Both predicates reach the
    Parquet scan as pushed filters (and prune a year/city partitioned layout).
    """
    out = df if city is None else df.where(F.col("city") == F.lit(city))
    if year is not None and str(year) != ALL_YEARS:
        y = int(year)
        if "year" in df.columns:
            out = out.where(F.col("year") == F.lit(y))
        else:
            out = out.where(F.year("date") == F.lit(y))
    return out


def _is_partial(df: DataFrame) -> bool:
    return "count" in df.columns


def offense_distribution(
    df: DataFrame,
    city: str | None = None,
    year: int | str | None = ALL_YEARS,
    by: list[str] | None = None,
) -> DataFrame:
    """(by..., 'Crime Type', 'Count') with Count > 0, nulls dropped.

    Raw rows count occurrences; pre-aggregated input sums ``count`` (the
    final stage of a partial aggregate). ``by`` adds scope keys (e.g. city).
    """
    by = list(by or [])
    scoped = filter_scope(df, city, year)
    keys = [*by, F.col("offense_category_name").alias("Crime Type")]
    if _is_partial(df):
        agg = F.sum(F.col("count")).cast("long").alias("Count")
    else:
        agg = F.count(F.lit(1)).alias("Count")
    out = scoped.where(F.col("offense_category_name").isNotNull()).groupBy(*keys).agg(agg)
    return out.where(F.col("Count") > 0)


def order_distribution(dist: DataFrame) -> DataFrame:
    """O1: by count descending; the label breaks ties (Q18)."""
    return dist.orderBy(F.desc("Count"), F.asc("Crime Type"))


def incident_total(
    df: DataFrame,
    city: str | None = None,
    year: int | str | None = ALL_YEARS,
    by: list[str] | None = None,
) -> DataFrame:
    """Incidents per scope, null offenses included (Q8); 0 for an empty statewide scope."""
    by = list(by or [])
    scoped = filter_scope(df, city, year)
    if _is_partial(df):
        agg = F.coalesce(F.sum("count"), F.lit(0)).cast("long").alias("total")
    else:
        agg = F.count(F.lit(1)).alias("total")
    return scoped.groupBy(*by).agg(agg)


def _stack_classes(wide: DataFrame, by: list[str]) -> DataFrame:
    """(by..., one column per class) -> (by..., 'Crime Type', 'Count'), missing -> 0."""
    stack = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("Crime Type"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("long").alias("Count"))
                for c in OFFENSE_CLASSES
            ]
        )
    ).alias("_kv")
    return wide.select(*by, stack).select(*by, "_kv.*")


def _class_sums(df: DataFrame, label: str, weight, by: list[str]) -> DataFrame:
    """One aggregation of 13 conditional sums (a pivot with explicit values
    would run two: group by the pivot column, then PivotFirst)."""
    folded = offense_class(label)
    sums = [F.sum(F.when(folded == F.lit(c), weight)).alias(c) for c in OFFENSE_CLASSES]
    return df.groupBy(*by).agg(*sums)


def align_to_classes(dist: DataFrame, by: list[str] | None = None) -> DataFrame:
    """F8 + A23 + J3: fold 'Crime Type' into the 13 classes, sum per scope and
    complete every scope onto all 13 classes with 0.

    One aggregation of conditional sums, then a 13-way stack per scope.
    Scopes with no rows produce no rows (the reference skips empty scopes).
    """
    by = list(by or [])
    out = _stack_classes(_class_sums(dist, "Crime Type", F.col("Count"), by), by)
    if not by:
        # a statewide frame with no rows stays empty
        nonempty = dist.select(F.count(F.lit(1)).alias("_n"))
        out = out.where(nonempty.scalar() > 0)
    return out


def class_distribution(
    df: DataFrame,
    city: str | None = None,
    year: int | str | None = ALL_YEARS,
    by: list[str] | None = None,
) -> DataFrame:
    """Distribution folded onto the 13 classes, per scope: A4/A5 + F8 + A23 + J3
    in a single aggregation over the input rows (null offenses dropped)."""
    by = list(by or [])
    scoped = filter_scope(df, city, year).where(F.col("offense_category_name").isNotNull())
    weight = F.col("count") if _is_partial(df) else F.lit(1)
    out = _stack_classes(_class_sums(scoped, "offense_category_name", weight, by), by)
    if not by:
        nonempty = scoped.select(F.count(F.lit(1)).alias("_n"))
        out = out.where(nonempty.scalar() > 0)
    return out


def class_pivot(aligned: DataFrame, cities: list[str], city_col: str = "City") -> DataFrame:
    """Class rows x one column per city, in the caller's order, and 'Total' (their sum) last.

    One aggregation of conditional sums; a city named like another column is refused."""
    if len({*cities, "Crime Type", "Total"}) != len(cities) + 2:
        raise ValueError("city names must differ from each other and from the other columns")
    sums = [
        F.coalesce(F.sum(F.when(F.col(city_col) == c, F.col("Count"))), F.lit(0)).cast("long").alias(c) for c in cities
    ]
    wide = aligned.groupBy("Crime Type").agg(*sums)
    total = F.lit(0).cast("long")
    for c in cities:
        total = total + wide[f"`{c}`"]
    return wide.withColumn("Total", total)


def class_share(aligned: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A25 + F18: share of the scope total in percent (0 when the total is 0) and its label.

    The window spans one scope (at most 13 rows).
    """
    by = list(by or [])
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    total = F.sum("Count").over(w)
    share = F.when(total > 0, F.col("Count") / total).otherwise(F.lit(0.0))
    return aligned.select(
        *by,
        "Crime Type",
        "Count",
        (share * F.lit(100.0)).alias("Share (%)"),
        share_label(share).alias("label"),
    )
