"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Each reads the driver's tables through the fixture adapter, so its work
grows with them. Column names equal the oracle SQL's (plans/oracle.py).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.operators import history as H
from blotter.schema import INCIDENT_COLUMNS, LOOKUP_STAT_COLS, OFFENSE_CLASSES, RISK_FEATURES, STAT_COLS
from blotter.session import checkpoint_dir, materialize
from blotter.sources.fixtures import incidents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def _kept_incidents(spark: SparkSession, sf: str, columns: list[str] | None = None) -> DataFrame:
    """The incidents, or those of their columns that a query reads, written once, for queries that read them several
    times: the joins they come from then run once."""
    inc = incidents(spark, sf)
    return materialize(inc.select(*columns) if columns else inc)


#: What the tables of a bundle and the risk lookups and scenarios are made from.
BUNDLE_INPUT = ["date", "year", "city", "location_area", "offense_category_name", *STAT_COLS, "row_order"]
RISK_INPUT = ["date", "hour", "city", "location_area", "offense_category_clean", *LOOKUP_STAT_COLS, "row_order"]


def _named(inc: DataFrame) -> DataFrame:
    """Incidents with a city, with the city column named as the app names it."""
    return inc.where(F.col("city").isNotNull()).withColumnRenamed("city", "City")


# --- S2 / F15 -------------------------------------------------------------


@register("incidents_typed")
def q_incidents_typed(spark: SparkSession, sf: str) -> DataFrame:
    return incidents(spark, sf)


# --- history: A4-A6, F8, A23-A25, J3 ---------------------------------------


@register("offense_distribution")
def q_offense_distribution(spark, sf):
    return H.order_distribution(H.offense_distribution(incidents(spark, sf)))


@register("offense_distribution_by_city_year")
def q_offense_distribution_by_city_year(spark, sf):
    inc = _named(incidents(spark, sf))
    return H.offense_distribution(inc, by=["City", "year"])


@register("offense_distribution_partial")
def q_offense_distribution_partial(spark, sf):
    from blotter.operators.daily import crime_distribution

    dist_table = crime_distribution(incidents(spark, sf))
    return H.offense_distribution(dist_table, by=["city"]).withColumnRenamed("city", "City")


@register("incident_totals")
def q_incident_totals(spark, sf):
    inc = incidents(spark, sf)
    per_city = H.incident_total(inc.where(F.col("city").isNotNull()), by=["city"]).select(
        F.col("city").alias("scope"), "total"
    )
    statewide = H.incident_total(inc).select(F.lit("Statewide").alias("scope"), "total")
    return per_city.unionByName(statewide)


@register("offense_13")
def q_offense_13(spark, sf):
    return H.class_distribution(incidents(spark, sf))


@register("offense_13_by_city")
def q_offense_13_by_city(spark, sf):
    return H.class_distribution(_named(incidents(spark, sf)), by=["City"])


@register("offense_13_by_city_of_year")
def q_offense_13_by_city_of_year(spark, sf):
    """The caller asks for one year."""
    return H.class_distribution(_named(incidents(spark, sf)), year=2000, by=["City"])


#: The fixture's cities, in the order that a caller asks for.
CITIES = [f"NATION_{k}" for k in range(25)]


@register("offense_pivot")
def q_offense_pivot(spark, sf):
    aligned = H.class_distribution(_named(incidents(spark, sf)), by=["City"])
    return H.class_pivot(aligned, CITIES)


@register("offense_share")
def q_offense_share(spark, sf):
    aligned = H.class_distribution(_named(incidents(spark, sf)), by=["City"])
    return H.class_share(aligned, by=["City"])


# --- dense daily series: A1, A2, A16, J1, J2, W1, W2, P8 -------------------

from blotter.operators import daily as D  # noqa: E402
from blotter.operators import lookups as L  # noqa: E402
from blotter.operators import staffing as S  # noqa: E402


@register("daily_city_counts")
def q_daily_city_counts(spark, sf):
    return D.daily_city_counts(incidents(spark, sf))


@register("daily_city_dense")
def q_daily_city_dense(spark, sf):
    return D.daily_city_dense(incidents(spark, sf))


@register("city_year_stats")
def q_city_year_stats(spark, sf):
    return D.city_year_stats(incidents(spark, sf))


@register("daily_city_filled")
def q_daily_city_filled(spark, sf):
    return D.daily_city(incidents(spark, sf))


@register("daily_city_filled_per_city")
def q_daily_city_filled_per_city(spark, sf):
    return D.daily_city(incidents(spark, sf), backfill=D.BACKFILL_PER_CITY)


# --- staffing: A3, A22, P6, O2, A29, F22, W7, A27 ---------------------------


@register("officer_trends")
def q_officer_trends(spark, sf):
    return S.officer_trends(incidents(spark, sf))


@register("statewide_staffing")
def q_statewide_staffing(spark, sf):
    return S.statewide_staffing(S.officer_trends(incidents(spark, sf)))


@register("city_staffing")
def q_city_staffing(spark, sf):
    inc = incidents(spark, sf)
    cities = inc.where(F.col("city").isNotNull()).select("city").distinct()
    return S.city_staffing(S.officer_trends(inc), cities)


@register("gender_by_month")
def q_gender_by_month(spark, sf):
    return S.last_per_city_month(S.officer_trends(incidents(spark, sf)))


@register("gender_text_by_month")
def q_gender_text_by_month(spark, sf):
    return S.gender_text_by_month(S.last_per_city_month(S.officer_trends(incidents(spark, sf))))


@register("force_status")
def q_force_status(spark, sf):
    return S.force_status(S.officer_trends(incidents(spark, sf)))


@register("statewide_status")
def q_statewide_status(spark, sf):
    return S.statewide_status(S.statewide_staffing(S.officer_trends(incidents(spark, sf))))


@register("city_cards")
def q_city_cards(spark, sf):
    return S.city_cards(D.daily_city(incidents(spark, sf)))


# --- lookups: A7-A15 ------------------------------------------------------


@register("city_stats_latest")
def q_city_stats_latest(spark, sf):
    return L.city_stats_latest(D.daily_city(incidents(spark, sf)))


@register("city_stats_last_row")
def q_city_stats_last_row(spark, sf):
    return L.city_stats_last(incidents(spark, sf))


@register("location_totals")
def q_location_totals(spark, sf):
    return L.location_totals(incidents(spark, sf))


@register("location_daily_mean")
def q_location_daily_mean(spark, sf):
    return L.location_daily_mean(incidents(spark, sf))


@register("hour_typical")
def q_hour_typical(spark, sf):
    return L.hour_typical(L.hour_counts(incidents(spark, sf)))


@register("hour_diversity")
def q_hour_diversity(spark, sf):
    inc = incidents(spark, sf)
    return L.hour_diversity(inc, L.hour_counts(inc))


@register("domains")
def q_domains(spark, sf):
    return L.domains(incidents(spark, sf))


# --- scalar features: F1-F6, F9, J8 -----------------------------------------------

from blotter.functions import calendar as C  # noqa: E402
from blotter.functions import features as FX  # noqa: E402
from blotter.operators import forecast as FC  # noqa: E402


@register("location_types")
def q_location_types(spark, sf):
    locs = incidents(spark, sf).select("location_area").distinct()
    return locs.select("location_area", FX.location_type("location_area").alias("location_type"))


@register("broad_classes")
def q_broad_classes(spark, sf):
    offs = incidents(spark, sf).select("offense_category_name").distinct()
    return offs.select(
        "offense_category_name",
        FX.offense_class("offense_category_name").alias("offense_class"),
        FX.broad_class(FX.offense_class("offense_category_name")).alias("broad_class"),
    )


def _dates(spark, sf) -> DataFrame:
    return incidents(spark, sf).select("date").distinct()


@register("payday_features")
def q_payday_features(spark, sf):
    return _dates(spark, sf).select("date", *[v.alias(k) for k, v in C.payday_features("date").items()])


@register("calendar_features")
def q_calendar_features(spark, sf):
    d = F.col("date")
    dow, month, dom, week = C.weekday(d), F.month(d), F.dayofmonth(d), C.iso_week(d)
    cols = {
        "dayofweek": dow,
        "month": month,
        "day_of_month": dom,
        "week_of_year": week,
        "day_of_year": F.dayofyear(d),
        "quarter": F.quarter(d),
        **C.weekend_flags(d),
    }
    for name, x, n in (("month", month, 12), ("dow", dow, 7), ("day_of_month", dom, 31), ("week", week, 52)):
        s, c = C.cyclic(x, n)
        cols[f"{name}_sin"], cols[f"{name}_cos"] = s, c
    return _dates(spark, sf).select("date", *[v.alias(k) for k, v in cols.items()])


@register("holiday_flags")
def q_holiday_flags(spark, sf):
    days = D.daily_city_dense(incidents(spark, sf)).select("date").distinct()
    return days.select(
        "date",
        *[v.alias(k) for k, v in C.holiday_flags("date").items()],
        C.holiday_name("date").alias("holiday_name"),
    )


# --- forecast: W3-W5, J6, J7, A17-A21, O8, M1-M4, A26, U5 ---------------------------


def _daily(spark, sf) -> DataFrame:
    return D.daily_city(incidents(spark, sf))


@register("forecast_history_features")
def q_forecast_history_features(spark, sf):
    return FC.history_features(_daily(spark, sf))


@register("seasonal_profile")
def q_seasonal_profile(spark, sf):
    daily = _daily(spark, sf)
    hist = FC.forecast_history(daily, FC.origin_after_last_day(daily))
    city_avg, md, dw = FC.seasonal_profile(hist)
    return md.join(dw, ["city", "day_of_week"]).join(city_avg, ["city"])


@register("analog_profile")
def q_analog_profile(spark, sf):
    daily = _daily(spark, sf)
    origin = FC.origin_after_last_day(daily)
    hist = FC.forecast_history(daily, origin)
    tgt = FC.targets(hist.select("city").distinct(), origin)
    return FC.analog_profile(hist, tgt)


@register("recent_level")
def q_recent_level(spark, sf):
    daily = _daily(spark, sf)
    origin = FC.origin_after_last_day(daily)
    return FC.recent_and_seed(FC.forecast_history(daily, origin), origin).select("city", "recent")


@register("forecast_seed")
def q_forecast_seed(spark, sf):
    daily = _daily(spark, sf)
    origin = FC.origin_after_last_day(daily)
    seeds = FC.recent_and_seed(FC.forecast_history(daily, origin), origin)
    return seeds.select("city", F.posexplode("seed").alias("pos", "value"))


def _forecast(spark, sf) -> DataFrame:
    daily = _daily(spark, sf)
    return FC.forecast(daily, FC.demo_coefficients(spark), FC.origin_after_last_day(daily))


@register("forecast_30d")
def q_forecast_30d(spark, sf):
    return _forecast(spark, sf)


@register("forecast_totals")
def q_forecast_totals(spark, sf):
    return FC.forecast_totals(_forecast(spark, sf))


@register("forecast_missing")
def q_forecast_missing(spark, sf):
    inc = incidents(spark, sf)
    requested = inc.where(F.col("city").isNotNull()).select("city").distinct()
    return FC.forecast_missing(requested, _forecast(spark, sf))


from blotter.operators import trees as TM  # noqa: E402
from blotter.plans import demo as DM  # noqa: E402


@register("forecast_tree_30d")
def q_forecast_tree_30d(spark, sf):
    """M3 with tree ensembles: walked inside the recursion."""
    daily = _daily(spark, sf)
    return FC.forecast_trees(daily, DM.demo_trees(spark), FC.origin_after_last_day(daily))


@register("tree_first_splits")
def q_tree_first_splits(spark, sf):
    """M10's split search: the best first split of each city's model and of the global one."""
    daily = _daily(spark, sf)
    rows = TR.volume_training_rows(daily)
    names = DM.SPLIT_FEATURES
    edges = TM.bin_edges(rows, names, DM.SPLIT_BINS)
    data = TM.binned(rows, names, edges).select("key", "bins", F.col("label").alias("residual"), F.lit(0).alias("node"))
    best = TM.best_splits(data, DM.SPLIT_REG, DM.SPLIT_ROWS)
    return best.select(
        F.when(F.col("key") == TM.GLOBAL_KEY, F.lit("Statewide")).otherwise(F.col("key")).alias("scope"),
        F.get(F.array(*[F.lit(n) for n in names]), F.col("feature")).alias("feature"),
        "bin",
        "gain",
    )


@register("tree_model_fit")
def q_tree_model_fit(spark, sf):
    daily = _daily(spark, sf)
    rows = TR.volume_training_rows(daily).where(F.col("date") < F.date_sub(daily.select(F.max("date")).scalar(), 59))
    return TM.fit_trees(rows, trees=5, depth=3)


#: A caller's set of cities, one of which has no history.
REQUESTED = ["NATION_7", "NATION_99", "NATION_12"]


@register("forecast_requested")
def q_forecast_requested(spark, sf):
    """A named set of cities. Each one's forecast total, and null for a city that has none."""
    daily = _daily(spark, sf)
    asked = spark.createDataFrame([(c, i) for i, c in enumerate(REQUESTED)], "city string, ord int")
    fc = FC.forecast(daily, FC.demo_coefficients(spark), FC.origin_after_last_day(daily), cities=asked)
    totals = FC.forecast_totals(fc).withColumnRenamed("City", "city")
    missing = FC.forecast_missing(asked, fc).withColumn("total", F.lit(None).cast("long"))
    return asked.join(totals.unionByName(missing), ["city"]).select("ord", "city", "total")


@register("offense_distribution_of_city")
def q_offense_distribution_of_city(spark, sf):
    """One city, one year, with each class's place in the order."""
    dist = H.offense_distribution(incidents(spark, sf), city="NATION_7", year=1999)
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("Count"), F.asc("Crime Type"))  # at most one row a class
    return dist.withColumn("pos", F.row_number().over(order) - 1)


# --- risk: M5-M9, J4, J5, F10-F12, F17, A28, W8 ------------------------------------------

from blotter.operators import risk as R  # noqa: E402


def _risk_scored(spark, sf, inc: DataFrame | None = None) -> DataFrame:
    inc = _kept_incidents(spark, sf, RISK_INPUT) if inc is None else inc
    feats = R.risk_features(R.scenarios_from_incidents(inc), R.context_from_incidents(inc))
    return R.score(feats.drop("location_type_in"), R.demo_classifiers(spark))  # no type is asked for


@register("risk_features")
def q_risk_features(spark, sf):
    inc = _kept_incidents(spark, sf, RISK_INPUT)
    return R.risk_features(R.scenarios_from_incidents(inc), R.context_from_incidents(inc))


@register("risk_probabilities")
def q_risk_probabilities(spark, sf):
    return R.probabilities(_risk_scored(spark, sf))


@register("risk_top5")
def q_risk_top5(spark, sf):
    return R.top_specific(_risk_scored(spark, sf))


@register("risk_headline")
def q_risk_headline(spark, sf):
    return R.headline(_risk_scored(spark, sf))


# --- training, backtest, evaluation: M10-M14 --------------------------------------------------

from blotter.operators import asof as AO  # noqa: E402
from blotter.operators import backtest as BT  # noqa: E402
from blotter.operators import reliability as RB  # noqa: E402
from blotter.operators import softmax as SM  # noqa: E402
from blotter.operators import train as TR  # noqa: E402
from blotter.sources import bundle as BU  # noqa: E402
from blotter.sources import bundle_states as BS  # noqa: E402
from blotter.sources import city_models as CM  # noqa: E402
from blotter.sources import incidents as IN  # noqa: E402
from blotter.sources import model_index as MI  # noqa: E402
from blotter.streaming import daily_counts as ST  # noqa: E402
from blotter.streaming import late_counts as LC  # noqa: E402


@register("rare_label_fold")
def q_rare_label_fold(spark, sf):
    inc = incidents(spark, sf)
    train_end = inc.select(F.date_sub(F.max("date"), 365)).scalar()
    return TR.rare_label_map(inc, train_end, min_share=0.02)


@register("rare_labels_applied")
def q_rare_labels_applied(spark, sf):
    """M12 applied: labels folded by shares of the first four days' rows, counted over all rows."""
    inc = incidents(spark, sf)
    folded = TR.rare_label_map(inc, inc.select(F.date_add(F.min("date"), 4)).scalar(), min_share=0.04)
    return TR.fold_labels(inc, folded).groupBy("offense_category_name", "label").agg(F.count(F.lit(1)).alias("n"))


@register("lookups_as_of")
def q_lookups_as_of(spark, sf):
    """Every incident's scenario with the lookups of the rows before its day."""
    inc = _kept_incidents(spark, sf)
    return AO.lookups_as_of(inc, R.scenarios_from_incidents(inc))


@register("city_classifier_fit")
def q_city_classifier_fit(spark, sf):
    """M11 per city on days before the last year, with the loss on the days after and convergence."""
    inc = _kept_incidents(spark, sf)
    rows = TR.as_of_training_rows(inc, R.context_from_incidents(inc)).withColumn("cut", inc.select(F.date_sub(F.max("date"), 365)).scalar())
    width = len(RISK_FEATURES)
    models, report = SM.fit_cities(SM.prepared(rows.where("input_date < cut"), width), list(OFFENSE_CLASSES), tol=1e-3)
    held_out = SM.city_losses(SM.prepared(rows.where("input_date >= cut"), width), models)
    held_out = held_out.select("city", F.col("rows").alias("held_out_rows"), F.col("log_loss").alias("held_out_loss"))
    return report.join(held_out, ["city"], "left")


@register("volume_model_fit")
def q_volume_model_fit(spark, sf):
    daily = _daily(spark, sf)
    return TR.fit_volume_models(daily, train_end=F.date_sub(daily.select(F.max("date")).scalar(), 59))


@register("risk_model_fit")
def q_risk_model_fit(spark, sf):
    inc = _kept_incidents(spark, sf)
    return TR.fit_risk_models(inc, R.context_from_incidents(inc))


def _origins(daily: DataFrame) -> list:
    """Three origins, the last 90, 60 and 30 days to be forecast."""
    import datetime as dt

    last = daily.select(F.max("date").alias("d")).first()["d"]
    return [last - dt.timedelta(days=n) for n in (89, 59, 29)]


@register("backtest")
def q_backtest(spark, sf):
    daily = _daily(spark, sf)
    return BT.backtest(daily, FC.demo_coefficients(spark), _origins(daily))


@register("backtest_fitted")
def q_backtest_fitted(spark, sf):
    """Each origin with the coefficients fitted on the days before it."""
    daily = _daily(spark, sf)
    origins = _origins(daily)
    return BT.backtest(daily, BT.fit_as_of(TR.volume_training_rows(daily), origins), origins)


#: Whole-number features, whose sums of products are exact.
GRAM_FEATURES = ["lag_1", "lag_7", "roll_max_7", "day_of_week", "month", "total_officers"]


@register("gram_as_of")
def q_gram_as_of(spark, sf):
    """Sums of products before each origin, per city and over all."""
    daily = _daily(spark, sf)
    origins = _origins(daily)
    parts = BT.gram_segments(TR.volume_training_rows(daily), GRAM_FEATURES, origins)
    sums = BT.as_of(parts, ["key", "i", "j"], {"total": F.col("g")}, len(origins))
    scope = F.when(F.col("key") == BT.GLOBAL_KEY, F.lit("Statewide")).otherwise(F.col("key"))
    return sums.where("i >= 0").select("origin_id", scope.alias("scope"), "i", "j", "total")


@register("class_quality")
def q_class_quality(spark, sf):
    inc = _kept_incidents(spark, sf)
    return TR.class_quality(_risk_scored(spark, sf, inc), TR.truth_from_incidents(inc))


@register("probability_quality")
def q_probability_quality(spark, sf):
    """Reliability of the specific classes' probabilities over the last year's scenarios, by bins of equal
    width and of equal weight."""
    inc = _kept_incidents(spark, sf)
    recent = inc.where(F.col("date") >= inc.select(F.date_sub(F.max("date"), 365)).scalar())
    feats = R.risk_features(R.scenarios_from_incidents(recent), R.context_from_incidents(inc))
    scored = R.score(feats.drop("location_type_in"), R.demo_classifiers(spark))
    cells = materialize(RB.cell_sums(RB.class_events(scored, TR.truth_from_incidents(recent), R.SCENARIO_KEYS)))
    kinds = {"width": RB.equal_width(cells, 10), "weight": RB.equal_weight(cells, 10)}
    a, b = (t.withColumn("kind", F.lit(k)) for k, t in kinds.items())
    return a.unionByName(b)


# --- sources: S3-S7 round trips ------------------------------------------------------------


def _bundle(spark, sf) -> dict:
    path = f"{checkpoint_dir(spark).rstrip('/')}/bundle-{uuid.uuid4().hex}"
    counted = materialize(BU.counted_incidents(incidents(spark, sf).select(*BUNDLE_INPUT)))
    BU.write_bundle(BU.bundle_from_incidents(counted), path, schema_version="2.1", model_version="demo")
    tables = BU.load_tables(spark, path, None)
    return tables


@register("bundle_daily_city")
def q_bundle_daily_city(spark, sf):
    return _bundle(spark, sf)["daily_city"].select(
        "date", "city", "crime_count", F.col("year").cast("int").alias("year"), *D.STAT_COLS
    )


@register("bundle_offense_distribution")
def q_bundle_offense_distribution(spark, sf):
    dist = _bundle(spark, sf)["crime_distribution"]
    return H.offense_distribution(dist, by=["city"]).withColumnRenamed("city", "City")


def _increments(spark, sf) -> dict:
    """The bundle of two increments: odd and even months, so that their days interleave; the first comes twice."""
    inc = _kept_incidents(spark, sf, [*BUNDLE_INPUT, "hour", "offense_category_clean"])
    path = f"{checkpoint_dir(spark).rstrip('/')}/states-{uuid.uuid4().hex}"
    odd = F.month("date") % 2 == 1
    for batch, rows in (("odd", odd), ("even", ~odd), ("odd", odd)):
        BS.apply_increment(inc.where(rows), path, batch)
    return BS.bundle_from_states(BS.read_states(spark, path))


@register("bundle_increments_daily")
def q_bundle_increments_daily(spark, sf):
    return _increments(spark, sf)["daily_city"].select("date", "city", "crime_count", "year", *D.STAT_COLS)


@register("bundle_increments_lookups")
def q_bundle_increments_lookups(spark, sf):
    return _increments(spark, sf)["legacy_lookups"]


@register("per_city_index")
def q_per_city_index(spark, sf):
    inc = incidents(spark, sf)
    cities = inc.where(F.col("city").isNotNull()).select("city").distinct()
    fore = cities.select("city", F.concat(F.lit("per_city/forecasters/"), "city", F.lit(".parquet")).alias("path"))
    clf = cities.select("city", F.concat(F.lit("per_city/classifiers/"), "city", F.lit(".parquet")).alias("path"))
    text = MI.build_index_json(fore, clf, list(FC.FORECAST_FEATURES))
    entries = MI.index_entries(text.select(MI.parse_index(F.col("value")).alias("index")))
    return entries


@register("forecast_from_index")
def q_forecast_from_index(spark, sf):
    """From index to path to city model to forecast, for every city and one without history."""
    daily = _daily(spark, sf)
    root = f"{checkpoint_dir(spark).rstrip('/')}/models-{uuid.uuid4().hex}"
    DM.write_index(spark, root)
    asked = daily.select("city").distinct().unionByName(spark.createDataFrame([("NATION_99",)], "city string"))
    return CM.forecast_by_index(daily, root, MI.read_index(spark, f"{root}/index"), asked, FC.origin_after_last_day(daily))


@register("incidents_csv_rejects")
def q_incidents_csv_rejects(spark, sf):
    """The incidents as CSV files in which some rows are spoiled, read back as rows and rejects."""
    inc = incidents(spark, sf)
    spoiled = {
        "month": F.when(F.col("day") == 13, F.concat(F.lit("x"), "month")).otherwise(F.col("month").cast("string")),
        "day": F.when((F.col("day") == 30) & F.col("month").isin(4, 6, 9, 11), F.lit("31")).otherwise(F.col("day").cast("string")),
    }
    root = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    inc.select(*[spoiled.get(c, F.col(c)).alias(c) for c in INCIDENT_COLUMNS]).write.option("header", True).csv(root)
    rows, rejects = IN.read_incidents_csv_rejects(spark, root)
    city = F.from_csv("text", ", ".join(f"{c} string" for c in INCIDENT_COLUMNS))["city"]
    kinds = rows.select(F.lit("read").alias("kind"), "city").unionByName(rejects.select(F.col("reason").alias("kind"), city.alias("city")))
    return kinds.groupBy("kind", "city").agg(F.count(F.lit(1)).alias("n"))


@register("streaming_daily_counts")
def q_streaming_daily_counts(spark, sf):
    return ST.stream_incident_counts(spark, incidents(spark, sf))


@register("streaming_merged_counts")
def q_streaming_merged_counts(spark, sf):
    return LC.merged_counts(spark, LC.stream_out_of_order(spark, incidents(spark, sf)))


@register("streaming_late_counts")
def q_streaming_late_counts(spark, sf):
    return LC.late_counts(spark, LC.stream_out_of_order(spark, incidents(spark, sf)))


# --- report pieces: P9, A30 -----------------------------------------------------------------

from blotter.plans import reports as RP  # noqa: E402


@register("forecast_holiday_points")
def q_forecast_holiday_points(spark, sf):
    return FC.holiday_points(_forecast(spark, sf))


@register("risk_class_order")
def q_risk_class_order(spark, sf):
    return RP.class_order(R.probabilities(_risk_scored(spark, sf)))
