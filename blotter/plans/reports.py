"""Report tables (R1-R10): the data behind each view of the reference,
composed from the operators. Each returns named DataFrames; nothing is
collected. Cities are a group key throughout (the comparison set is a
small DataFrame joined in, not a loop)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators import daily as D
from blotter.operators import forecast as FC
from blotter.operators import history as H
from blotter.operators import lookups as L
from blotter.operators import risk as R
from blotter.operators import staffing as S
from blotter.schema import MAX_COMPARE


def comparison_set(spark: SparkSession, selected: str, others: list[str] | None = None) -> DataFrame:
    """P13 + U4: the selected city plus at most two others, first-seen order kept as ``ord``."""
    others = [c for c in (others or []) if c != selected]
    if len(others) > MAX_COMPARE:
        raise ValueError(f"compare with at most {MAX_COMPARE} cities")
    cities = list(dict.fromkeys([selected, *others]))
    return spark.createDataFrame([(c, i) for i, c in enumerate(cities)], "city string, ord int")


def forecast_report(daily: DataFrame, coefs: DataFrame, origin: Column, cities: DataFrame) -> dict[str, DataFrame]:
    """Forecasts for the set, holiday points, totals and the cities with no forecast."""
    fc = FC.forecast(daily, coefs, origin, cities=cities)
    return {
        "forecast": fc,
        "holiday_points": FC.holiday_points(fc),
        "totals": FC.forecast_totals(fc),
        "missing": FC.forecast_missing(cities, fc),
        "window": daily.sparkSession.range(1).select(
            F.date_format(origin, "MMM dd, yyyy").alias("start"),
            F.date_format(F.date_add(origin, FC.FORECAST_DAYS - 1), "MMM dd, yyyy").alias("end"),
        ),
    }


def risk_report(scenarios: DataFrame, inc: DataFrame, models: DataFrame) -> dict[str, DataFrame]:
    """R2: broad probabilities (all classes), top-5 specific, headline, class order."""
    scored = R.score(R.risk_features(scenarios, R.context_from_incidents(inc)), models)
    probs = R.probabilities(scored)
    return {
        "broad": probs.where(F.col("model") == "broad").orderBy("Probability"),
        "top_specific": R.top_specific(scored).orderBy("Probability"),
        "headline": R.headline(scored),
        "class_order": class_order(probs),
    }


def class_order(probs: DataFrame) -> DataFrame:
    """Classes ordered by their total probability over all scenarios (label breaks ties)."""
    from pyspark.sql import Window

    tot = probs.groupBy("model", "label").agg(F.sum("Probability").alias("total_probability"))
    w = Window.partitionBy("model").orderBy(F.desc("total_probability"), F.asc("label"))
    return tot.withColumn("rank", F.row_number().over(w))


def history_report(inc: DataFrame, cities: DataFrame | None = None, year=H.ALL_YEARS) -> dict[str, DataFrame]:
    """13-class distribution (statewide, or per city of the set), the
    count table (pivot + Total, or Count + Share with labels) and totals."""
    if cities is None:
        aligned = H.class_distribution(inc, year=year)
        return {
            "distribution": aligned,
            "counts": H.class_share(aligned),
            "totals": H.incident_total(inc, year=year).select(F.lit("Statewide").alias("scope"), "total"),
        }
    scoped = inc.join(cities.select("city"), ["city"], "left_semi").withColumnRenamed("city", "City")
    aligned = H.class_distribution(scoped, year=year, by=["City"])
    return {
        "distribution": aligned,
        # the caller's own list of cities, which becomes the columns
        "counts": H.class_pivot(aligned, list(dict.fromkeys(r["city"] for r in cities.select("city").collect() if r["city"] is not None))),
        "shares": H.class_share(aligned, by=["City"]),
        "totals": H.incident_total(scoped, year=year, by=["City"]),
    }


def staffing_report(inc: DataFrame, cities: DataFrame | None = None) -> dict[str, DataFrame]:
    """Trends (statewide sums or the set's rows), gender by month, status, city cards."""
    trends = S.officer_trends(inc)
    if cities is None:
        state = S.statewide_staffing(trends)
        return {"trend": state.orderBy("month_start"), "status": S.statewide_status(state)}
    chosen = S.city_staffing(trends, cities)
    per_month = S.last_per_city_month(chosen)
    status = S.force_status(chosen)
    return {
        "trend": chosen,
        "gender": per_month,
        "gender_text": S.gender_text_by_month(per_month, cities),
        "status": status,
        "missing": S.missing_scopes(cities, status),
        "cards": S.city_cards(D.daily_city(inc)).join(cities.select("city"), ["city"], "left_semi"),
    }
