"""Offense-class probabilities for any number of scenarios (M5-M9, J4, J5,
F10-F12, F17, A28, W8, O4, O6, A30).

A scenario is (city, location_area, location_type or null, hour, input_date).
Features come from built-in expressions plus left joins against lookup
tables whose size is bounded by the domains (cities, locations, cities x 24
hours), never by the incident count. Classifiers are linear multinomial
models stored as coefficient tables; scoring is an Arrow-batched matrix
product and softmax, one row per scenario.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.functions import calendar as C
from blotter.functions.features import is_university, location_type
from blotter.operators import lookups as L
from blotter.session import materialize, materialize_all
from blotter.schema import (
    BROAD_CLASSES,
    DEFAULT_DIVERSITY,
    DEFAULT_LOCATION_DAILY,
    DEFAULT_LOCATION_TOTAL,
    DEFAULT_STAT,
    DEFAULT_TYPICAL_OFFENSE,
    LOCATION_TYPES,
    LOOKUP_STAT_COLS,
    OFFENSE_CLASSES,
    RISK_FEATURES,
    TOP_SPECIFIC,
)

SOURCE_CITY = "City-specific"
SOURCE_STATE = "Statewide"
CATEGORICAL = ["city", "location_area", "location_type", "hour_typical_crime"]
SCENARIO_KEYS = ["city", "location_area", "hour", "input_date"]
#: Carried from the scenarios to every result where present: scenarios of equal keys may
#: differ in the location type that was asked for, or be asked twice under two ids.
SCENARIO_IDENTITY = ["scenario_id", "location_type_in"]


def scenario_columns(df: DataFrame) -> list[str]:
    return SCENARIO_KEYS + [c for c in SCENARIO_IDENTITY if c in df.columns]


# --- context: lookups + domains ---------------------------------------------------------


class RiskContext:
    """Lookup tables and domains a scenario is scored against (the reference's
    classifier context, as DataFrames)."""

    def __init__(
        self,
        city_stats: DataFrame,
        loc_total: DataFrame,
        loc_daily: DataFrame,
        hour_typical: DataFrame,
        hour_diversity: DataFrame,
        city_cats: DataFrame,
        loc_cats: DataFrame,
        htc_cats: DataFrame,
    ):
        self.city_stats = city_stats
        self.loc_total = loc_total
        self.loc_daily = loc_daily
        self.hour_typical = hour_typical
        self.hour_diversity = hour_diversity
        self.city_cats = city_cats
        self.loc_cats = loc_cats
        self.htc_cats = htc_cats


def _ranked_domain(values: DataFrame, col: str) -> DataFrame:
    """(value, pos) in sorted order; the domain is bounded (categories)."""
    vals = values.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("value")).distinct()
    w = Window.partitionBy(F.lit(1)).orderBy("value")
    return vals.select("value", (F.row_number().over(w) - 1).alias("pos"))


def context_from_incidents(inc: DataFrame) -> RiskContext:
    """Raw path (include_legacy): every lookup aggregated from incident rows at the grain
    it needs, with map-side counts; no copy of the incidents is written.

    Each table is domain-sized (cities, locations, cities x hours) and is
    materialised once, so the scenario join reads it instead of re-deriving it."""
    hours, places, days = L.hour_counts(inc), L.place_counts(inc), L.distinct_dates(inc)
    typical = materialize(L.hour_typical(hours))
    t = materialize_all(
        {
            "city_stats": L.city_stats_last(inc),
            "loc_total": L.location_totals(places, "n"),
            "loc_daily": L.location_daily_mean(places, "n", days),
            "hour_diversity": L.hour_diversity(inc, hours, days),
            "city_cats": _ranked_domain(hours, "city"),
            "loc_cats": _ranked_domain(places, "location_area"),
            "htc_cats": _ranked_domain(typical, "hour_typical_crime"),
        }
    )
    t["hour_typical"] = typical
    return RiskContext(**t)


def context_from_bundle(
    spark: SparkSession, daily: DataFrame, location_areas: DataFrame, legacy: DataFrame | None = None
) -> RiskContext:
    """Bundle path: city stats from the daily series, the other lookups from the bundle's
    ``legacy_lookups``. Without these (Q21) they are empty, so the defaults apply, and the
    typical-offense domain is empty (code -1)."""
    if legacy is not None:

        def kind(name: str, keys: list[str], value: str, out: str) -> DataFrame:
            return legacy.where(F.col("kind") == name).select(*keys, F.col(value).alias(out))

        typical = kind("hour_typical", ["city", "hour"], "label", "hour_typical_crime")
        return RiskContext(
            city_stats=L.city_stats_latest(daily),
            loc_total=kind("loc_total", ["location_area"], "amount", "location_total_crimes"),
            loc_daily=kind("avg_loc", ["location_area"], "amount", "avg_location_daily_freq"),
            hour_typical=typical,
            hour_diversity=kind("avg_div", ["city", "hour"], "amount", "avg_crime_diversity"),
            city_cats=_ranked_domain(daily, "city"),
            loc_cats=_ranked_domain(location_areas, location_areas.columns[0]),
            htc_cats=_ranked_domain(typical, "hour_typical_crime"),
        )
    empty_loc = spark.createDataFrame([], "location_area string, v double")
    return RiskContext(
        city_stats=L.city_stats_latest(daily),
        loc_total=empty_loc.withColumnRenamed("v", "location_total_crimes"),
        loc_daily=empty_loc.withColumnRenamed("v", "avg_location_daily_freq"),
        hour_typical=spark.createDataFrame([], "city string, hour int, hour_typical_crime string"),
        hour_diversity=spark.createDataFrame([], "city string, hour int, avg_crime_diversity double"),
        city_cats=_ranked_domain(daily, "city"),
        loc_cats=_ranked_domain(location_areas, location_areas.columns[0]),
        htc_cats=spark.createDataFrame([], "value string, pos int"),
    )


# --- features (M5, J4, F10-F12) ----------------------------------------------------------


def _cyc(x: Column, n: int, name: str) -> dict[str, Column]:
    s, c = C.cyclic(x, n)
    return {f"{name}_sin": s, f"{name}_cos": c}


DATE_FEATURES = [
    "dayofweek",
    "dow_sin",
    "dow_cos",
    "month",
    "month_sin",
    "month_cos",
    "day_of_month",
    "day_of_month_sin",
    "day_of_month_cos",
    "week_of_year",
    "week_sin",
    "week_cos",
    "is_weekend",
    "is_holiday",
    "is_payday",
    "days_from_payday",
]


def date_features(dates: DataFrame, col: str) -> DataFrame:
    """Calendar features of M5 for a table of dates."""
    d = F.col(col)
    dow, month, dom, week = C.weekday(d), F.month(d), F.dayofmonth(d), C.iso_week(d)
    feats = {
        "dayofweek": dow,
        **_cyc(dow, 7, "dow"),
        "month": month,
        **_cyc(month, 12, "month"),
        "day_of_month": dom,
        **_cyc(dom, 31, "day_of_month"),
        "week_of_year": week,
        **_cyc(week, 52, "week"),
        "is_weekend": C.weekend_flags(d)["is_weekend"],
        "is_holiday": C.is_holiday(d),
        **C.payday_features(d),
    }
    return dates.select(col, *[feats[c].alias(c) for c in DATE_FEATURES])


def _encode(df: DataFrame, col: str, cats: DataFrame, fallback_pos: Column) -> DataFrame:
    """position in the ordered domain; unknown -> the fallback's position."""
    dom = cats.select(F.col("value").alias(f"_v_{col}"), F.col("pos").alias(f"_p_{col}"))
    out = df.join(dom, F.col(col).cast("string") == F.col(f"_v_{col}"), "left")
    return out.withColumn(f"{col}_code", F.coalesce(F.col(f"_p_{col}"), fallback_pos).cast("int")).drop(
        f"_v_{col}", f"_p_{col}"
    )


def risk_features(scenarios: DataFrame, ctx: RiskContext, carry: tuple[str, ...] = ()) -> DataFrame:
    """M5: the 31 classifier features per scenario, categorical ones coded (F10),
    plus the scenario keys, the uncoded labels for display and the scenarios' columns named in ``carry``.

    The scenarios are written once: their dates are read apart from them."""
    scenarios = materialize(scenarios)
    # date features once per distinct date (a calendar-sized dimension), then joined
    dates = materialize(date_features(scenarios.select("input_date").distinct(), "input_date"))
    base = scenarios.select(
        "*",
        F.lower(F.coalesce(F.nullif(F.col("location_type"), F.lit("")), location_type("location_area"))).alias("_lt"),
    ).join(dates, ["input_date"], "left")
    # lookups with defaults only when the key is absent (Q9)
    stats = ctx.city_stats.select(
        F.col("city").alias("_sc"), F.lit(True).alias("_known"), *[F.col(c).alias(f"_s_{c}") for c in LOOKUP_STAT_COLS]
    )
    typical = ctx.hour_typical.select(
        F.col("city").alias("_tc"), F.col("hour").alias("_th"), F.lit(True).alias("_t_known"), "hour_typical_crime"
    )
    div = ctx.hour_diversity.select(F.col("city").alias("_dc"), F.col("hour").alias("_dh"), "avg_crime_diversity")
    j = (
        base.join(stats, F.col("city") == F.col("_sc"), "left")
        .join(ctx.loc_total.withColumnRenamed("location_area", "_lt_a"), F.col("location_area") == F.col("_lt_a"), "left")
        .join(ctx.loc_daily.withColumnRenamed("location_area", "_ld_a"), F.col("location_area") == F.col("_ld_a"), "left")
        .join(typical, (F.col("city") == F.col("_tc")) & (F.col("hour") == F.col("_th")), "left")
        .join(div, (F.col("city") == F.col("_dc")) & (F.col("hour") == F.col("_dh")), "left")
    )
    htc_first = ctx.htc_cats.where(F.col("pos") == 0).select("value").scalar()
    htc_raw = F.when(F.col("_t_known"), F.coalesce(F.col("hour_typical_crime"), F.lit("nan"))).otherwise(
        F.lit(DEFAULT_TYPICAL_OFFENSE)
    )
    feats = {
        **_cyc(F.col("hour"), 24, "hour"),
        **{c: F.col(c) for c in DATE_FEATURES},
        "is_university": is_university("city"),
        "crime_diversity": F.coalesce(F.col("avg_crime_diversity"), F.when(F.col("_dc").isNull(), F.lit(DEFAULT_DIVERSITY))),
        "location_daily_freq": F.when(F.col("_ld_a").isNull(), F.lit(DEFAULT_LOCATION_DAILY)).otherwise(
            F.col("avg_location_daily_freq")
        ),
        "location_total_crimes": F.when(F.col("_lt_a").isNull(), F.lit(DEFAULT_LOCATION_TOTAL)).otherwise(
            F.col("location_total_crimes")
        ),
    }
    for c in LOOKUP_STAT_COLS:
        feats[c] = F.when(F.col("_known"), F.col(f"_s_{c}").cast("double")).otherwise(F.lit(DEFAULT_STAT))
    lt_checked = F.when(F.col("_lt").isin(*LOCATION_TYPES), F.col("_lt")).otherwise(F.lit("other"))
    out = j.select(
        *[c for c in ("scenario_id",) if c in scenarios.columns],
        *carry,
        "city",
        "location_area",
        F.col("location_type").alias("location_type_in"),
        "hour",
        "input_date",
        lt_checked.alias("location_type"),
        htc_raw.alias("_htc_raw"),
        *[v.alias(k) for k, v in feats.items()],
    )
    # validate the typical offense against its domain (first label, else 'Other')
    htc_dom = ctx.htc_cats.select(F.col("value").alias("_hv"))
    out = out.join(htc_dom, F.col("_htc_raw") == F.col("_hv"), "left")
    out = out.withColumn(
        "hour_typical_crime",
        F.when(F.col("_hv").isNotNull(), F.col("_htc_raw")).otherwise(F.coalesce(htc_first, F.lit(DEFAULT_TYPICAL_OFFENSE))),
    ).drop("_hv", "_htc_raw")
    # categorical codes; unknown -> first value (pos 0), empty domain -> -1
    lt_dom = _location_type_domain(scenarios.sparkSession)
    for col, cats in (
        ("city", ctx.city_cats),
        ("location_area", ctx.loc_cats),
        ("location_type", lt_dom),
        ("hour_typical_crime", ctx.htc_cats),
    ):
        if col == "location_type":
            fallback = F.lit(LOCATION_TYPES.index("other"))
        else:
            n = cats.select(F.count(F.lit(1))).scalar()
            fallback = F.when(n > 0, F.lit(0)).otherwise(F.lit(-1))
        out = _encode(out, col, cats, fallback)
    return out


def _location_type_domain(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(v, i) for i, v in enumerate(LOCATION_TYPES)], "value string, pos int")


def feature_columns(feats: DataFrame) -> list[Column]:
    """The model inputs in RISK_FEATURES order (categoricals as codes), as doubles."""
    return [(F.col(f"{f}_code") if f in CATEGORICAL else F.col(f)).cast("double") for f in RISK_FEATURES]


def feature_vector(feats: DataFrame) -> Column:
    """The model input as one array (training rows)."""
    return F.array(*feature_columns(feats))


# --- classifier tables ---------------------------------------------------------------------


MODEL_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("class_id", T.IntegerType()),
        T.StructField("label", T.StringType()),
        T.StructField("intercept", T.DoubleType()),
        T.StructField("weights", T.ArrayType(T.DoubleType())),
    ]
)

# Fixed demonstration classifiers (stand-ins for trained artifacts; M11 writes
# the same table from data). Weights follow a rule, scaled per feature.
FEATURE_SCALE = {
    "city": 0.02, "location_area": 0.05, "location_type": 0.1, "hour": 0.02,
    "hour_sin": 0.3, "hour_cos": 0.3, "dayofweek": 0.05, "dow_sin": 0.3, "dow_cos": 0.3,
    "month": 0.03, "month_sin": 0.3, "month_cos": 0.3, "day_of_month": 0.01,
    "day_of_month_sin": 0.3, "day_of_month_cos": 0.3, "week_of_year": 0.005, "week_sin": 0.3,
    "week_cos": 0.3, "is_weekend": 0.2, "is_holiday": 0.3, "is_payday": 0.1,
    "days_from_payday": 0.02, "is_university": 0.5, "crime_diversity": 0.1,
    "location_daily_freq": 0.02, "location_total_crimes": 0.0002, "population": 0.00001,
    "total_officers": 0.002, "officers_per_1000_people": 0.05, "crime_rate_per_1000_people": 0.01,
    "hour_typical_crime": 0.03,
}
DEMO_CITY_CLASSIFIERS = {"NATION_3": 2.0, "NATION_12": 3.0}


def demo_weight(phase: float, k: int, f: int) -> float:
    return round(math.sin(phase + 0.7 * k + 1.3 * f), 4) * FEATURE_SCALE[RISK_FEATURES[f]]


def demo_classifier_rows() -> list[tuple]:
    rows = []
    for model, labels, phase in (("broad", BROAD_CLASSES, 0.5), ("specific", OFFENSE_CLASSES, 1.0)):
        for k, label in enumerate(labels):
            rows.append(
                (model, None, k, label, round(0.1 * math.cos(k + phase), 4), [demo_weight(phase, k, f) for f in range(len(RISK_FEATURES))])
            )
    for city, phase in DEMO_CITY_CLASSIFIERS.items():
        for k, label in enumerate(OFFENSE_CLASSES):
            rows.append(
                ("specific", city, k, label, round(0.1 * math.cos(k + phase), 4), [demo_weight(phase, k, f) for f in range(len(RISK_FEATURES))])
            )
    return rows


def demo_classifiers(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(demo_classifier_rows(), MODEL_SCHEMA)


def _packed(models: DataFrame) -> DataFrame:
    """One row per (model, city): the classes as an array sorted by class_id (bounded)."""
    cls = F.struct("class_id", "label", "intercept", "weights")
    return models.groupBy("model", "city").agg(F.array_sort(F.collect_list(cls)).alias("classes"))


# --- scoring (M6-M8, A28, F17) -------------------------------------------------------------


def _model_arrays(models: DataFrame) -> dict:
    """The model artifact as numpy arrays: {(model, key): (b[k], W[k, f])}.

    A model table is bounded by models x classes x features (not by data);
    it is gathered once, like a fitted Spark ML model's coefficients, and
    broadcast to the executors."""
    import numpy as np

    out: dict = {}
    for r in models.select("model", "city", "class_id", "intercept", "weights").collect():
        out.setdefault((r["model"], r["city"] or ""), []).append((r["class_id"], r["intercept"], r["weights"]))
    arrays = {}
    for key, rows in out.items():
        rows.sort(key=lambda t: t[0])
        arrays[key] = (
            np.array([t[1] for t in rows], dtype="float64"),
            np.array([t[2] for t in rows], dtype="float64"),
        )
    return arrays


def _softmax_rows(z):
    import numpy as np

    z = z - z.max(axis=1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=1, keepdims=True)


def score(feats: DataFrame, models: DataFrame) -> DataFrame:
    """M8 per scenario: broad and specific probability arrays, label arrays, model source.

    Scoring is an Arrow-batched ``mapInPandas``: per batch one matrix product
    per model key and a softmax in numpy (unrolled column arithmetic over 16
    classes x 31 features exceeds the JVM method size for generated code, and
    array lambdas are interpreted). The specific model is the city's own when
    present (J5), else the statewide one. Label arrays are joined back by
    model key (a broadcast of the bounded model table).
    """
    import numpy as np
    import pandas as pd

    spark = feats.sparkSession
    arrays = _model_arrays(models)
    bc = spark.sparkContext.broadcast(arrays)
    xcols = [f"_x{i}" for i in range(len(RISK_FEATURES))]
    x = feature_columns(feats)
    keys = scenario_columns(feats)
    inp = feats.select(*keys, *[c.alias(n) for c, n in zip(x, xcols)])
    kinds = dict(feats.dtypes)
    out_schema = ", ".join(f"{c} {kinds[c]}" for c in keys)
    out_schema += ", s_key string, broad_probs array<double>, specific_probs array<double>"

    def run(batches):
        mdl = bc.value
        bb, bw = mdl[("broad", "")]
        spec_keys = {k for (m, k) in mdl if m == "specific" and k}
        for pdf in batches:
            xm = pdf[xcols].to_numpy(dtype="float64", na_value=np.nan)
            pb = _softmax_rows(xm @ bw.T + bb)
            key = np.where(pdf["city"].isin(spec_keys).to_numpy(), pdf["city"].to_numpy(dtype=object), "")
            ps = np.empty((len(pdf), len(mdl[("specific", "")][0])))
            for k in pd.unique(key):
                idx = key == k
                sb, sw = mdl[("specific", k)]
                ps[idx] = _softmax_rows(xm[idx] @ sw.T + sb)
            yield pd.DataFrame(
                {
                    **{c: pdf[c] for c in keys},
                    "s_key": key,
                    "broad_probs": list(pb),
                    "specific_probs": list(ps),
                }
            )

    scored = inp.mapInPandas(run, out_schema)
    packed = _packed(models)
    labels = F.transform("classes", lambda c: _label(c))
    broad_labels = packed.where((F.col("model") == "broad") & F.col("city").isNull()).select(labels.alias("l")).scalar()
    spec_labels = packed.where(F.col("model") == "specific").select(
        F.coalesce(F.col("city"), F.lit("")).alias("s_key"), labels.alias("specific_labels")
    )
    return scored.join(spec_labels, ["s_key"]).select(
        *keys,
        F.when(F.col("s_key") != "", F.lit(SOURCE_CITY)).otherwise(F.lit(SOURCE_STATE)).alias("model_source"),
        broad_labels.alias("broad_labels"),
        "specific_labels",
        "broad_probs",
        "specific_probs",
    )


def _label(cls: Column) -> Column:
    """class id -> label, else the id as text."""
    return F.coalesce(cls["label"], cls["class_id"].cast("string"))


def probabilities(scored: DataFrame) -> DataFrame:
    """M9: one row per (scenario, model, class) with its probability; both
    models are exploded in the same pass over the scored rows (unrolled over
    the fixed class counts, no lambdas)."""
    items = []
    for model, cls, probs, n in (
        ("broad", "broad_labels", "broad_probs", len(BROAD_CLASSES)),
        ("specific", "specific_labels", "specific_probs", len(OFFENSE_CLASSES)),
    ):
        for k in range(n):
            items.append(
                F.struct(
                    F.lit(model).alias("model"),
                    F.lit(k).alias("pos"),
                    F.element_at(F.col(cls), k + 1).alias("label"),
                    F.element_at(F.col(probs), k + 1).alias("Probability"),
                )
            )
    return scored.select(*scenario_columns(scored), F.inline(F.array(*items)))


def top_specific(scored: DataFrame, n: int = TOP_SPECIFIC) -> DataFrame:
    """W8 + O6: the n most probable specific classes of every scored row; on ties the
    later class comes first (reversed ascending argsort, Q16). Taken inside the row, so
    that a scenario given twice keeps both its lists, and nothing is shuffled."""
    classes = [
        F.struct(
            F.element_at("specific_probs", k + 1).alias("Probability"),
            F.lit(k).alias("pos"),
            F.element_at("specific_labels", k + 1).alias("label"),
        )
        for k in range(len(OFFENSE_CLASSES))
    ]
    best = F.slice(F.sort_array(F.array(*classes), asc=False), 1, n)
    keys = scenario_columns(scored)
    return scored.select(*keys, F.posexplode(best).alias("at", "best")).select(
        *keys, "best.pos", "best.label", "best.Probability", (F.col("at") + 1).alias("rank")
    )


def headline(scored: DataFrame) -> DataFrame:
    """A28 + F17: the most probable broad and specific class (first index on ties)."""

    def best(cls: str, probs: str, prefix: str) -> list[Column]:
        p = F.col(probs)
        idx = F.array_position(p, F.array_max(p))
        return [
            F.element_at(F.col(cls), idx.cast("int")).alias(f"{prefix}_label"),
            F.array_max(p).alias(f"{prefix}_probability"),
        ]

    return scored.select(
        *scenario_columns(scored),
        "model_source",
        *best("broad_labels", "broad_probs", "broad"),
        *best("specific_labels", "specific_probs", "specific"),
    )


def scenarios_from_incidents(inc: DataFrame) -> DataFrame:
    """Every recorded incident context as a what-if scenario (location type
    inferred)."""
    return (
        inc.where(F.col("city").isNotNull() & F.col("location_area").isNotNull())
        .select("city", "location_area", "hour", F.col("date").alias("input_date"))
        .distinct()
        .withColumn("location_type", F.lit(None).cast("string"))
    )
