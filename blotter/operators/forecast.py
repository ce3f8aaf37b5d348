"""30-day recursive volume forecast for every city in one job (M1-M4, J5-J9,
A17-A21, O8, P4, P5, W3-W6, U5).

Plan:
  * history = daily series strictly before the origin (leakage guard, P4);
  * everything that does not depend on the previous prediction is computed
    as grouped aggregates and joined per (city, target day): seasonal
    (month, dow) -> dow -> city mean (J6), the analog mean over +-14 days of
    year (J7: an equi-join on the 29 candidate days of year, history first
    reduced to <= 366 rows a city), the recent 14-day level (A21), calendar
    and holiday features, the latest staffing row, and the static part of a
    linear model;
  * one row per city then carries a seed buffer (<= 14 values, O8) and an
    array of 30 day structs, and the recursion runs inside the JVM as a
    ``F.aggregate`` fold (state = last 14 values + outputs), then
    ``posexplode`` gives one row per (city, day).
Cities are the group key: no per-city loop, no collect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions import calendar as C
from blotter.operators import trees as TR
from blotter.operators.daily import with_profile_columns
from blotter.schema import (
    ANALOG_HALF_WINDOW,
    BLEND_WEIGHTS,
    DOY_BASE,
    FORECAST_DAYS,
    FORECAST_FEATURES,
    LOOKUP_STAT_COLS,
    RECENT_DAYS,
    SEED_BUFFER,
    SEED_MIN,
    TREND_MIN_BUFFER,
    TREND_WEIGHT,
)

DYNAMIC_FEATURES = [
    "lag_1",
    "lag_3",
    "lag_7",
    "roll_mean_7",
    "rolling_mean_7",
    "roll_std_7",
    "rolling_std_7",
    "roll_max_7",
    "roll_min_7",
]
STATIC_FEATURES = [f for f in FORECAST_FEATURES if f not in DYNAMIC_FEATURES]

POLICY_CITY = "City-specific"
POLICY_GLOBAL = "Statewide"


# --- coefficient tables (the model artifact) -----------------------------------


def coefficient_schema() -> T.StructType:
    return T.StructType(
        [T.StructField("city", T.StringType()), T.StructField("intercept", T.DoubleType())]
        + [T.StructField(f, T.DoubleType()) for f in FORECAST_FEATURES]
    )


# Fixed demonstration model (a stand-in for a trained artifact; M10 writes the
# same table from data). Global row first (city = null), then two city models.
DEMO_GLOBAL = {
    "intercept": 0.5,
    "lag_1": 0.30,
    "lag_3": 0.10,
    "lag_7": 0.15,
    "roll_mean_7": 0.20,
    "rolling_mean_7": 0.05,
    "roll_std_7": -0.10,
    "rolling_std_7": 0.02,
    "roll_max_7": 0.05,
    "roll_min_7": 0.05,
    "day_of_week": 0.01,
    "month": -0.02,
    "quarter": 0.03,
    "day_of_year": 0.0005,
    "is_weekend": -0.5,
    "is_monday": 0.2,
    "is_friday": 0.1,
    "month_sin": 0.1,
    "month_cos": -0.1,
    "dow_sin": 0.05,
    "dow_cos": -0.05,
    "is_holiday": -0.8,
    "is_day_before_holiday": 0.3,
    "is_day_after_holiday": -0.2,
    "population": 0.00001,
    "total_officers": 0.002,
    "officers_per_1000_people": 0.05,
    "crime_rate_per_1000_people": 0.01,
}
DEMO_CITY_MODELS = {"NATION_1": 0.9, "NATION_12": 1.1}


def demo_coefficients(spark: SparkSession) -> DataFrame:
    rows = [(None, *[DEMO_GLOBAL["intercept"]], *[DEMO_GLOBAL[f] for f in FORECAST_FEATURES])]
    for city, scale in DEMO_CITY_MODELS.items():
        rows.append((city, DEMO_GLOBAL["intercept"] * scale, *[DEMO_GLOBAL[f] * scale for f in FORECAST_FEATURES]))
    return spark.createDataFrame(rows, coefficient_schema())


# --- history and its profiles ------------------------------------------------------


def origin_after_last_day(daily: DataFrame) -> Column:
    """Default origin for tests: the day after the last day of data.

    The origin is the forecast's one parameter value, so it is evaluated once
    (a single date from a global max) and passed as a literal; as a scalar
    subquery it would be re-planned at each of its many uses."""
    last = daily.select(F.max("date").alias("d")).first()["d"]
    return F.date_add(F.lit(last), 1)


def forecast_history(daily: DataFrame, origin: Column) -> DataFrame:
    """P4 + profile columns: rows strictly before the origin."""
    return with_profile_columns(daily.where(F.col("date") < origin))


def seasonal_profile(history: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """City mean, (city, month, dow) mean, (city, dow) mean."""
    city_avg = history.groupBy("city").agg(F.avg("crime_count").alias("city_avg"))
    month_dow = history.groupBy("city", "month", "day_of_week").agg(F.avg("crime_count").alias("md_avg"))
    dow = history.groupBy("city", "day_of_week").agg(F.avg("crime_count").alias("dow_avg"))
    return city_avg, month_dow, dow


def targets(cities: DataFrame, origin: Column, steps: int = FORECAST_DAYS) -> DataFrame:
    """J9 + F20: every city x the horizon days (a per-city generator)."""
    days = F.sequence(origin, F.date_add(origin, steps - 1))
    return cities.select("city", F.posexplode(days).alias("step", "date"))


def analog_profile(history: DataFrame, tgt: DataFrame) -> DataFrame:
    """J7 + A20 (without the fallback): mean count over history days whose day of
    year is within 14 (circular, base 366) of the target's.

    History is reduced to (city, day_of_year) sums first; each target expands
    its 29 candidate days of year, so the theta join becomes an equi-join.
    """
    by_doy = history.groupBy("city", "day_of_year").agg(
        F.sum("crime_count").alias("s"), F.count(F.lit(1)).alias("n")
    )
    k = F.explode(F.sequence(F.lit(-ANALOG_HALF_WINDOW), F.lit(ANALOG_HALF_WINDOW))).alias("k")
    cand = tgt.select("city", "date", F.dayofyear("date").alias("t_doy"), k)
    raw = F.col("t_doy") + F.col("k")
    wrapped = (
        F.when(raw < 1, raw + DOY_BASE).when(raw > DOY_BASE, raw - DOY_BASE).otherwise(raw).alias("day_of_year")
    )
    cand = cand.select("city", "date", wrapped)
    return (
        cand.join(by_doy, ["city", "day_of_year"])
        .groupBy("city", "date")
        .agg((F.sum("s") / F.sum("n")).alias("analog"))
    )


def _history_ranked(history: DataFrame, origin: Column, steps: int) -> DataFrame:
    """Row numbers from the end, over all history and over the seed months (P5)."""
    seed_months = F.array(F.month(origin), F.month(F.date_add(origin, steps - 1)))
    in_months = F.array_contains(seed_months, F.col("month"))
    w_all = Window.partitionBy("city").orderBy(F.desc("date"))
    w_m = Window.partitionBy("city", "in_months").orderBy(F.desc("date"))
    return (
        history.withColumn("in_months", in_months)
        .withColumn("rn_all", F.row_number().over(w_all))
        .withColumn("rn_m", F.row_number().over(w_m))
    )


def recent_and_seed(history: DataFrame, origin: Column, steps: int = FORECAST_DAYS) -> DataFrame:
    """A21 + O8 + W6 + W7 per city, one aggregation:

    recent = mean of the last 14 history rows; seed buffer = the last 14 of the
    last 30 rows in the horizon's first/last month when there are >= 7 such rows,
    else the last 14 rows of all history (which is the last 7 when fewer exist);
    latest = the last history row's staffing values (row-wise, Q6).
    """
    r = _history_ranked(history, origin, steps)
    n_m = F.sum(F.col("in_months").cast("int"))
    pick_m = F.col("in_months") & (F.col("rn_m") <= SEED_BUFFER)
    pick_all = F.col("rn_all") <= SEED_BUFFER
    item = F.struct("date", F.col("crime_count").cast("double").alias("v"))
    agg = r.groupBy("city").agg(
        F.avg(F.when(F.col("rn_all") <= RECENT_DAYS, F.col("crime_count"))).alias("recent"),
        n_m.alias("n_months"),
        F.collect_list(F.when(pick_m, item)).alias("_seed_m"),
        F.collect_list(F.when(pick_all, item)).alias("_seed_all"),
        F.max_by(F.struct(*LOOKUP_STAT_COLS), F.col("date")).alias("latest"),
    )
    seed_rows = F.when(F.col("n_months") >= SEED_MIN, F.col("_seed_m")).otherwise(F.col("_seed_all"))
    return agg.select(
        "city",
        "recent",
        F.transform(F.array_sort(seed_rows), lambda x: x["v"]).alias("seed"),
        "latest",
    )


# --- the recursion -------------------------------------------------------------------


def _mean(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x) / F.size(arr)


def _std_pop(arr: Column) -> Column:
    m = _mean(arr)
    ss = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + (x - m) * (x - m))
    return F.sqrt(ss / F.size(arr))


def _last_n(arr: Column, n: int) -> Column:
    """The last n elements (all when shorter); slice(arr, -n) would be empty then."""
    return F.slice(arr, F.greatest(F.size(arr) - (n - 1), F.lit(1)), n)


def step_prediction(buf: Column, day: Column, model_row: Column, use_city: Column, trees: bool = False) -> Column:
    """M1 + M2 + W3-W5 for one day: features from the buffer, the model (linear
    coefficients, or node arrays with ``trees``), blend with the historical signals
    unless a city model is used."""
    b7 = _last_n(buf, 7)
    n7 = F.size(b7)
    lag1 = F.when(n7 >= 1, F.try_element_at(b7, F.lit(-1))).otherwise(F.lit(0.0))
    lag3 = F.when(n7 >= 3, F.try_element_at(b7, F.lit(-3))).otherwise(lag1)
    lag7 = F.when(n7 >= 7, F.try_element_at(b7, F.lit(-7))).otherwise(F.try_element_at(b7, F.lit(1)))
    roll = F.when(n7 >= 1, _mean(b7)).otherwise(F.lit(0.0))
    std = F.when(n7 >= 2, _std_pop(b7)).otherwise(F.lit(0.0))
    mx = F.when(n7 >= 1, F.array_max(b7)).otherwise(F.lit(0.0))
    mn = F.when(n7 >= 1, F.array_min(b7)).otherwise(F.lit(0.0))
    dyn = {
        "lag_1": lag1,
        "lag_3": lag3,
        "lag_7": lag7,
        "roll_mean_7": roll,
        "rolling_mean_7": roll,
        "roll_std_7": std,
        "rolling_std_7": std,
        "roll_max_7": mx,
        "roll_min_7": mn,
    }
    if trees:
        x = F.concat(F.array(*[dyn[f] for f in DYNAMIC_FEATURES]), day["x"])
        model = TR.predict(x, model_row["base"], model_row["roots"], model_row["nodes"])
    else:
        model = day["static"]
        for f in DYNAMIC_FEATURES:
            model = model + model_row[f] * dyn[f]
    model = F.greatest(model, F.lit(0.0))
    prev7 = F.slice(buf, F.greatest(F.size(buf) - 13, F.lit(1)), 7)
    trend = F.when(
        F.size(buf) >= TREND_MIN_BUFFER, (_mean(_last_n(buf, 7)) - _mean(prev7)) * F.lit(TREND_WEIGHT)
    ).otherwise(F.lit(0.0))
    blend = (
        F.lit(BLEND_WEIGHTS["model"]) * model
        + F.lit(BLEND_WEIGHTS["analog"]) * day["analog"]
        + F.lit(BLEND_WEIGHTS["recent"]) * day["recent"]
        + F.lit(BLEND_WEIGHTS["seasonal"]) * day["seasonal"]
    )
    blend = F.greatest(blend + trend, F.lit(0.0))
    return F.when(use_city, model).otherwise(blend)


def run_recursion(per_city: DataFrame) -> DataFrame:
    """M3: fold the 30 day structs with state (buffer of <= 14 values, outputs).
    The model is in column ``coef``, or in ``trees``. An ``origin`` column stays a key."""
    trees = "trees" in per_city.columns
    keys = ["origin"] if "origin" in per_city.columns else []
    empty = F.array().cast("array<double>")
    init = F.struct(F.col("seed").alias("buf"), empty.alias("out"))

    def step(state, day):
        pred = step_prediction(state["buf"], day, F.col("trees" if trees else "coef"), F.col("use_city"), trees)
        nb = F.concat(state["buf"], F.array(pred))
        return F.struct(_last_n(nb, TREND_MIN_BUFFER).alias("buf"), F.concat(state["out"], F.array(pred)).alias("out"))

    folded = per_city.select(*keys, "city", "days", "policy", F.aggregate("days", init, step)["out"].alias("out"))
    return folded.select(
        *keys,
        "city",
        "policy",
        F.inline(F.arrays_zip(F.col("days"), F.col("out"))),
    ).select(
        *keys,
        F.col("city").alias("City"),
        F.col("days.date").alias("Date"),
        F.col("out").alias("Predicted Count"),
        F.col("days.is_holiday").alias("is_holiday"),
        "policy",
    )


# --- assembly --------------------------------------------------------------------------


def _model_per_city(cities: DataFrame, coefs: DataFrame, use_city_models: bool) -> DataFrame:
    """A city's own coefficients when present, else the global row (a scalar
    subquery returning one struct; no join against it)."""
    cols = ["intercept", *FORECAST_FEATURES]
    as_struct = F.struct(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cols])
    global_coef = coefs.where(F.col("city").isNull()).select(as_struct.alias("c")).scalar()
    if use_city_models:
        city_coef = coefs.where(F.col("city").isNotNull()).select("city", as_struct.alias("city_coef"))
        m = cities.join(city_coef, ["city"], "left")
        use_city = F.col("city_coef").isNotNull()
        return m.select("city", F.coalesce("city_coef", global_coef).alias("coef"), use_city.alias("use_city"))
    return cities.select("city", global_coef.alias("coef"), F.lit(False).alias("use_city"))


def static_features(date: Column, latest: Column, holidays: dict[str, Column] | None = None) -> dict[str, Column]:
    """M2's features that do not depend on earlier predictions (holiday flags
    from a joined flag table when given, else from the predicate)."""
    dow = C.weekday(date)
    month = F.month(date)
    m_sin, m_cos = C.cyclic(month, 12)
    d_sin, d_cos = C.cyclic(dow, 7)
    feats = {
        "day_of_week": dow,
        "month": month,
        "quarter": F.quarter(date),
        "day_of_year": F.dayofyear(date),
        **C.weekend_flags(date),
        "month_sin": m_sin,
        "month_cos": m_cos,
        "dow_sin": d_sin,
        "dow_cos": d_cos,
        **(holidays if holidays is not None else C.holiday_flags(date)),
    }
    for c in LOOKUP_STAT_COLS:
        feats[c] = latest[c]
    return feats


def forecast_inputs(
    daily: DataFrame,
    coefs: DataFrame,
    origin: Column,
    steps: int = FORECAST_DAYS,
    cities: DataFrame | None = None,
    use_city_models: bool = True,
    trees: DataFrame | None = None,
) -> DataFrame:
    """One row per city: seed, model, policy and the array of day structs. With
    ``trees`` (``trees.TREE_SCHEMA``) the model is an ensemble, and ``coefs`` isn't read."""
    history = forecast_history(daily, origin)
    per_city = recent_and_seed(history, origin, steps)
    if cities is not None:
        per_city = per_city.join(cities.select("city"), ["city"], "left_semi")
    city_avg, md, dw = seasonal_profile(history)
    tgt = targets(per_city.select("city"), origin, steps)
    analog = analog_profile(history, tgt)
    if trees is not None:
        model = TR.model_per_city(per_city.select("city"), trees, use_city_models)
    else:
        model = _model_per_city(per_city.select("city"), coefs, use_city_models)

    flags = C.holiday_flag_table(daily.sparkSession, origin, F.date_add(origin, steps - 1))
    days = (
        tgt.withColumn("month", F.month("date"))
        .join(F.broadcast(flags), ["date"], "left")
        .withColumn("day_of_week", C.weekday("date"))
        .join(md, ["city", "month", "day_of_week"], "left")
        .join(dw, ["city", "day_of_week"], "left")
        .join(city_avg, ["city"], "left")
        .join(analog, ["city", "date"], "left")
        .join(per_city, ["city"])
        .join(model, ["city"])
    )
    seasonal = F.coalesce("md_avg", "dow_avg", "city_avg")
    hol = {c: F.col(c) for c in ("is_holiday", "is_day_before_holiday", "is_day_after_holiday")}
    feats = static_features(F.col("date"), F.col("latest"), hol)
    return _with_days(days, ["city"], feats, seasonal, "coef" if trees is None else "trees")


def _with_days(days: DataFrame, keys: list[str], feats: dict[str, Column], seasonal: Column, model: str) -> DataFrame:
    """Rows of target days gathered per key (``step`` first, so that they sort by it), with what a model needs of each day:
    its static part (``coef``) or the static features in order (``trees``)."""
    if model == "coef":
        static = F.col("coef.intercept")
        for f in STATIC_FEATURES:
            static = static + F.col("coef")[f] * feats[f].cast("double")
        static = static.alias("static")
    else:
        static = F.array(*[feats[f].cast("double") for f in STATIC_FEATURES]).alias("x")
    day = F.struct(
        "step",
        "date",
        static,
        F.coalesce("analog", seasonal).alias("analog"),
        F.coalesce("recent", seasonal).alias("recent"),
        seasonal.alias("seasonal"),
        feats["is_holiday"].alias("is_holiday"),
    )
    return days.groupBy(*keys).agg(
        F.array_sort(F.collect_list(day)).alias("days"),
        F.first("seed").alias("seed"),
        F.first(model).alias(model),
        F.first("use_city").alias("use_city"),
        F.first(F.when(F.col("use_city"), F.lit(POLICY_CITY)).otherwise(F.lit(POLICY_GLOBAL))).alias("policy"),
    )


def forecast(
    daily: DataFrame,
    coefs: DataFrame,
    origin: Column,
    steps: int = FORECAST_DAYS,
    cities: DataFrame | None = None,
    use_city_models: bool = True,
) -> DataFrame:
    """M3 + M4 + U1: (City, Date, Predicted Count, is_holiday, policy) for every city."""
    return run_recursion(forecast_inputs(daily, coefs, origin, steps, cities, use_city_models))


def forecast_trees(
    daily: DataFrame,
    trees: DataFrame,
    origin: Column,
    steps: int = FORECAST_DAYS,
    cities: DataFrame | None = None,
    use_city_models: bool = True,
) -> DataFrame:
    """``forecast`` with tree ensembles in place of linear models."""
    return run_recursion(forecast_inputs(daily, None, origin, steps, cities, use_city_models, trees))


def forecast_totals(fc: DataFrame) -> DataFrame:
    """Total per city, Python-style half-to-even rounding (Q17)."""
    return fc.groupBy("City").agg(F.bround(F.sum("Predicted Count"), 0).cast("long").alias("total"))


def holiday_points(fc: DataFrame) -> DataFrame:
    """The forecast's holiday days."""
    return fc.where(F.col("is_holiday") == 1)


def forecast_missing(requested: DataFrame, fc: DataFrame) -> DataFrame:
    """Requested cities with no forecast (no history before the origin)."""
    return requested.select("city").join(fc.select(F.col("City").alias("city")).distinct(), ["city"], "left_anti")


# --- history features (training rows, W3-W5) --------------------------------------------


def history_features(daily: DataFrame) -> DataFrame:
    """W3 + W4 + W5 over the real series, with the serving rules for short buffers:
    each day sees the previous (up to) 7 and 14 counts."""
    prof = with_profile_columns(daily)
    w = Window.partitionBy("city").orderBy("date")
    prev7 = w.rowsBetween(-7, -1)
    prev14 = w.rowsBetween(-14, -8)
    x = F.col("crime_count").cast("double")
    n7 = F.count(x).over(prev7)
    lag1 = F.coalesce(F.lag(x, 1).over(w), F.lit(0.0))
    first7 = F.first(x).over(prev7)
    df = prof.select(
        "*",
        n7.alias("_n7"),
        F.count(x).over(w.rowsBetween(-14, -1)).alias("_n14"),
        lag1.alias("lag_1"),
        F.lag(x, 3).over(w).alias("_lag3"),
        F.lag(x, 7).over(w).alias("_lag7"),
        first7.alias("_first7"),
        F.avg(x).over(prev7).alias("_mean7"),
        F.stddev_pop(x).over(prev7).alias("_std7"),
        F.max(x).over(prev7).alias("_max7"),
        F.min(x).over(prev7).alias("_min7"),
        F.avg(x).over(prev14).alias("_mean_prev"),
    )
    return df.select(
        "date",
        "city",
        "crime_count",
        "lag_1",
        F.when(F.col("_n7") >= 3, F.col("_lag3")).otherwise(F.col("lag_1")).alias("lag_3"),
        F.when(F.col("_n7") >= 7, F.col("_lag7")).otherwise(F.coalesce(F.col("_first7"), F.lit(0.0))).alias("lag_7"),
        F.coalesce(F.col("_mean7"), F.lit(0.0)).alias("roll_mean_7"),
        F.when(F.col("_n7") >= 2, F.col("_std7")).otherwise(F.lit(0.0)).alias("roll_std_7"),
        F.coalesce(F.col("_max7"), F.lit(0.0)).alias("roll_max_7"),
        F.coalesce(F.col("_min7"), F.lit(0.0)).alias("roll_min_7"),
        F.when(F.col("_n14") >= 14, (F.col("_mean7") - F.col("_mean_prev")) * F.lit(TREND_WEIGHT))
        .otherwise(F.lit(0.0))
        .alias("trend"),
    )
