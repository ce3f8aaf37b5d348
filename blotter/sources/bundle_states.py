"""Bundle upkeep (S4, A1-A15): mergeable partial states, a folder an increment.

An increment of incident rows is reduced to partial aggregates that merge by
sums and by first or last values, so a bundle over all increments is built from
their states, and no increment's rows are read twice. Each increment owns one
folder a state, ``<path>/<state>/batch=<name>``, which a retry of the same
increment replaces as a whole: applying it twice counts it once. Increments may
share days, cities and locations, and may come in any order, for the first and
last rows are told apart by ``row_order``, which must be comparable across them.
``compact`` folds many increments into one state under a new path.

States grow with days x keys, not with incidents: everything is counted map-side.
An empty increment writes empty states; null cities and locations stay keys of
their own until a table is made, as in the raw path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators import daily as D
from blotter.operators import lookups as L
from blotter.operators import staffing as S
from blotter.schema import LOOKUP_STAT_COLS, STAT_COLS
from blotter.session import materialize, materialize_all, write_all

OFFENSE_KEYS = ["date", "year", "hour", "city", "offense_category_name", "offense_category_clean"]
PLACE_KEYS = ["date", "year", "location_area"]
TREND_KEYS = ["month_start", "city", *S.TREND_COLS]


def _last(c: str) -> list:
    seen = F.when(F.col(c).isNotNull(), F.col("last_order"))
    return [F.max_by(F.col(c), seen).alias(c), F.max(seen).alias(f"{c}_at")]


def partial_states(inc: DataFrame) -> dict[str, DataFrame]:
    """The partial aggregates of some incident rows, which need ``row_order`` or one row a day and city.

    Days, trends and last stats follow from one count of the rows by day, city and staffing."""
    n = F.count(F.lit(1)).alias("n")
    staff = materialize(D.city_day_staff(inc))
    return {
        "days": D.city_day_summary(staff, "n"),
        "trends": S.officer_trends(staff),
        "offenses": inc.groupBy(*OFFENSE_KEYS).agg(n),
        "places": inc.groupBy(*PLACE_KEYS).agg(n),
        "last": staff.groupBy("city").agg(*[x for c in LOOKUP_STAT_COLS for x in _last(c)]),
    }


def _merge(name: str, state: DataFrame) -> DataFrame:
    """One row a key from the partial rows of any number of increments."""
    if name == "days":
        firsts = [F.min_by(F.col(c), F.col("ord")).alias(c) for c in STAT_COLS]
        return state.groupBy("date", "city").agg(F.sum("crime_count").alias("crime_count"), F.min("ord").alias("ord"), *firsts)
    if name == "trends":
        return state.groupBy(*TREND_KEYS).agg(F.min("first_order").alias("first_order"))
    if name == "last":
        lasts = [[F.max_by(F.col(c), F.col(f"{c}_at")).alias(c), F.max(f"{c}_at").alias(f"{c}_at")] for c in LOOKUP_STAT_COLS]
        return state.groupBy("city").agg(*[x for pair in lasts for x in pair])
    keys = OFFENSE_KEYS if name == "offenses" else PLACE_KEYS
    return state.groupBy(*keys).agg(F.sum("n").alias("n"))


STATES = ["days", "trends", "offenses", "places", "last"]


def apply_increment(inc: DataFrame, path: str, batch: str) -> None:
    """Write the states of one increment; the same ``batch`` again replaces them."""
    write_all({f"{path}/{name}/batch={batch}": state for name, state in partial_states(inc).items()})


def read_states(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The merged states of all increments under ``path``, each written once for its consumers."""
    return materialize_all({name: _merge(name, spark.read.parquet(f"{path}/{name}").drop("batch")) for name in STATES})


def compact(spark: SparkSession, path: str, to: str, batch: str = "base") -> None:
    """Fold all increments under ``path`` into one at another path; later increments go there."""
    for name in STATES:
        merged = _merge(name, spark.read.parquet(f"{path}/{name}").drop("batch"))
        merged.write.mode("overwrite").parquet(f"{to}/{name}/batch={batch}")


def bundle_from_states(states: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables of ``bundle_from_incidents`` and ``legacy_lookups``, from merged states."""
    offenses, places, days = states["offenses"], states["places"], states["days"]
    tables = {
        "daily_city": D.daily_city_of(days),
        "officer_trends": states["trends"],
        "crime_distribution": offenses.groupBy("city", "year", "offense_category_name").agg(F.sum("n").alias("count")),
        "location_areas": places.where(F.col("location_area").isNotNull()).select("location_area").distinct(),
        "years": places.select("year").distinct(),
    }
    tables = {k: t.select(*[c for c in t.columns if c != "year"], *["year"] * ("year" in t.columns)) for k, t in tables.items()}
    return {**tables, "legacy_lookups": legacy_lookups(offenses, places, days)}


def hour_counts(offenses: DataFrame) -> DataFrame:
    """``lookups.hour_counts`` from the offense state."""
    return materialize(offenses.groupBy("city", "hour", "offense_category_clean").agg(F.sum("n").alias("n")))


def legacy_lookups(offenses: DataFrame, places: DataFrame, days: DataFrame) -> DataFrame:
    """A9, A10, A12, A14 as one table (kind, city, hour, location_area, amount, label), sized by the domains."""
    hours, dates = hour_counts(offenses), L.distinct_dates(days)
    parts = [
        ("loc_total", L.location_totals(places, "n").withColumnRenamed("location_total_crimes", "amount")),
        ("avg_loc", L.location_daily_mean(places, "n", dates).withColumnRenamed("avg_location_daily_freq", "amount")),
        ("hour_typical", L.hour_typical(hours).withColumnRenamed("hour_typical_crime", "label")),
        ("avg_div", L.hour_diversity(offenses, hours, dates).withColumnRenamed("avg_crime_diversity", "amount")),
    ]
    kinds = {"city": "string", "hour": "int", "location_area": "string", "amount": "double", "label": "string"}
    out = None
    for kind, t in parts:
        cols = [(F.col(c) if c in t.columns else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]
        t = t.select(F.lit(kind).alias("kind"), *cols)
        out = t if out is None else out.unionByName(t)
    return out
