"""Training and evaluation.

The reference trains off-repo; here every model is fit on Spark:
  * volume models: the global one with Spark ML ``LinearRegression``; one
    per city from its normal equations -- the Gram matrix X'X and X'y are
    summed per city in one aggregation (a row per city, k x k values), and
    only the small k x k solve runs in ``applyInPandas``;
  * offense classifiers: Spark ML multinomial ``LogisticRegression``;
  * rare-label folding decided on training rows only;
  * class-quality metrics as aggregates (the backtest, M13, is in
    ``backtest``, tree models in ``trees``).
Outputs are coefficient tables in the formats the forecast and risk
operators read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.operators import forecast as FC
from blotter.operators import risk as R
from blotter.schema import BROAD_CLASSES, FORECAST_FEATURES, LOOKUP_STAT_COLS, OFFENSE_CLASSES, RISK_FEATURES
from blotter.session import materialize
from blotter.functions.features import broad_class, offense_class

# --- M10: volume models ----------------------------------------------------------------


def volume_training_rows(daily: DataFrame) -> DataFrame:
    """M2 features for every real day (history windows W3-W5 + calendar + staffing)."""
    from blotter.functions import calendar as C

    hist = FC.history_features(daily)
    stats = daily.select("date", "city", *LOOKUP_STAT_COLS)
    # holiday flags from a calendar-sized table (one row a day of the range), not per row
    lo = daily.select(F.min("date")).scalar()
    hi = daily.select(F.max("date")).scalar()
    flags = C.holiday_flag_table(daily.sparkSession, lo, hi)
    rows = hist.join(stats, ["date", "city"]).join(flags, ["date"], "left")
    hol = {c: F.col(c) for c in ("is_holiday", "is_day_before_holiday", "is_day_after_holiday")}
    feats = FC.static_features(F.col("date"), F.struct(*[F.col(c) for c in LOOKUP_STAT_COLS]), hol)
    return rows.select(
        "date",
        "city",
        F.col("crime_count").cast("double").alias("label"),
        *[F.col(f).cast("double").alias(f) for f in ["lag_1", "lag_3", "lag_7", "roll_mean_7"]],
        F.col("roll_mean_7").alias("rolling_mean_7"),
        F.col("roll_std_7").cast("double").alias("roll_std_7"),
        F.col("roll_std_7").cast("double").alias("rolling_std_7"),
        F.col("roll_max_7").cast("double").alias("roll_max_7"),
        F.col("roll_min_7").cast("double").alias("roll_min_7"),
        *[feats[f].cast("double").alias(f) for f in FC.STATIC_FEATURES],
    )


def fit_global_volume(rows: DataFrame, reg: float = 1e-3) -> DataFrame:
    """Global linear model with Spark ML; returns one coefficient row (city null)."""
    vec = VectorAssembler(inputCols=FORECAST_FEATURES, outputCol="features", handleInvalid="skip")
    model = LinearRegression(featuresCol="features", labelCol="label", regParam=reg, solver="normal").fit(
        vec.transform(rows)
    )
    coefs = [float(x) for x in model.coefficients]
    spark = rows.sparkSession
    return spark.createDataFrame([(None, float(model.intercept), *coefs)], FC.coefficient_schema())


def gram_per_city(rows: DataFrame, chunk: int = 64) -> DataFrame:
    """X'X and X'y per city (with the intercept column), as partial-then-final
    sums. The ~435 sums are split into aggregations of ``chunk`` sums each (one
    aggregate over all of them outgrows the generated-code method limit) over
    the materialised training rows (days x cities), joined on city."""
    data = materialize(rows.na.drop())
    xs = [F.lit(1.0)] + [F.col(f) for f in FORECAST_FEATURES]
    k = len(xs)
    sums = []
    for i in range(k):
        for j in range(i, k):
            sums.append(F.sum(xs[i] * xs[j]).alias(f"g_{i}_{j}"))
        sums.append(F.sum(xs[i] * F.col("label")).alias(f"b_{i}"))
    out = data.groupBy("city").agg(F.count(F.lit(1)).alias("n"))
    for start in range(0, len(sums), chunk):
        out = out.join(data.groupBy("city").agg(*sums[start : start + chunk]), ["city"])
    return out


def fit_city_volume(rows: DataFrame, reg: float = 1e-3) -> DataFrame:
    """Per-city ridge solutions from the Gram matrices; one row per city."""
    k = len(FORECAST_FEATURES) + 1
    schema = FC.coefficient_schema()

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, r in pdf.iterrows():
            g = np.zeros((k, k))
            for i in range(k):
                for j in range(i, k):
                    g[i, j] = g[j, i] = r[f"g_{i}_{j}"]
            b = np.array([r[f"b_{i}"] for i in range(k)])
            g += reg * np.eye(k) * max(1.0, float(r["n"]))
            w = np.linalg.lstsq(g, b, rcond=None)[0]
            out.append([r["city"], *[float(x) for x in w]])
        return pd.DataFrame(out, columns=schema.fieldNames())

    return gram_per_city(rows).groupBy("city").applyInPandas(solve, schema)


def fit_volume_models(daily: DataFrame, train_end: Column | None = None, city_models: bool = True) -> DataFrame:
    """The global model plus per-city models, trained on days before ``train_end``."""
    rows = volume_training_rows(daily)
    if train_end is not None:
        rows = rows.where(F.col("date") < train_end)
    out = fit_global_volume(rows)
    if city_models:
        out = out.unionByName(fit_city_volume(rows))
    return out


# --- M12: rare-label folding -------------------------------------------------------------


def rare_label_map(inc: DataFrame, train_end: Column, min_share: float) -> DataFrame:
    """Labels whose share of training rows (date < train_end) is below
    ``min_share`` fold into 'Other'; decided on training rows only."""
    train = inc.where((F.col("date") < train_end) & F.col("offense_category_name").isNotNull())
    counts = train.groupBy("offense_category_name").agg(F.count(F.lit(1)).alias("train_count"))
    total = train.select(F.count(F.lit(1))).scalar()
    share = F.col("train_count") / total
    return counts.select(
        "offense_category_name",
        "train_count",
        F.when(share < F.lit(min_share), F.lit("Other")).otherwise(F.col("offense_category_name")).alias("folded"),
    )


def fold_labels(inc: DataFrame, folded: DataFrame) -> DataFrame:
    """The rows with a column ``label``: the offense folded by ``rare_label_map``, ``Other`` where training never saw
    it; a row without an offense keeps none."""
    name = F.col("offense_category_name")
    table = folded.select("offense_category_name", F.col("folded").alias("_folded"))
    out = inc.join(table, ["offense_category_name"], "left")
    return out.withColumn("label", F.when(name.isNotNull(), F.coalesce("_folded", F.lit("Other")))).drop("_folded")


# --- M11: offense classifiers ------------------------------------------------------------------


def classifier_training_rows(inc: DataFrame, ctx: R.RiskContext, lookups: DataFrame | None = None) -> DataFrame:
    """Each incident with a city, location and offense as a scored scenario + its true class. With
    ``lookups`` (per scenario key, from ``asof``) these take the place of the context's."""
    rows = inc.where(
        F.col("city").isNotNull() & F.col("location_area").isNotNull() & F.col("offense_category_name").isNotNull()
    ).select(
        "city",
        "location_area",
        "hour",
        F.col("date").alias("input_date"),
        F.lit(None).cast("string").alias("location_type"),
        offense_class("offense_category_name").alias("y13"),
    )
    # a scenario without a day or hour is no training row
    labels = rows.dropna(subset=R.SCENARIO_KEYS).groupBy(*R.SCENARIO_KEYS, "y13").agg(F.count(F.lit(1)).alias("w"))
    labels = labels.withColumn("location_type", F.lit(None).cast("string"))
    own = [c for c in lookups.columns if c not in R.SCENARIO_KEYS] if lookups is not None else []
    if lookups is not None:
        stats = [(F.coalesce(F.col(c), F.lit(R.DEFAULT_STAT)) if c in LOOKUP_STAT_COLS else F.col(c)).alias(f"_own_{c}") for c in own]
        labels = labels.join(lookups.select(*R.SCENARIO_KEYS, *stats), R.SCENARIO_KEYS)
    # features come by lookups in small tables, so every labelled row gets its own and none is joined back
    feats = R.risk_features(labels, ctx, carry=("y13", "w", *[f"_own_{c}" for c in own]))
    if lookups is not None:
        feats = feats.drop(*own, "hour_typical_crime_code").withColumnsRenamed({f"_own_{c}": c for c in own})
        feats = R._encode(feats, "hour_typical_crime", ctx.htc_cats, F.lit(0))
    # written as columns, which take a fraction of the room of arrays, for the several passes of a fit
    names = [f"_x_{f}" for f in RISK_FEATURES]
    out = materialize(feats.select(*R.SCENARIO_KEYS, "w", "y13", *[x.alias(n) for x, n in zip(R.feature_columns(feats), names)]))
    return out.select(
        *R.SCENARIO_KEYS,
        "w",
        "y13",
        broad_class("y13").alias("y3"),
        (F.array_position(F.array(*[F.lit(c) for c in OFFENSE_CLASSES]), F.col("y13")).cast("double") - F.lit(1.0)).alias(
            "label13"
        ),
        (F.array_position(F.array(*[F.lit(c) for c in BROAD_CLASSES]), broad_class("y13")).cast("double") - F.lit(1.0)).alias(
            "label3"
        ),
        F.array(*names).alias("x"),
    )


def as_of_training_rows(inc: DataFrame, ctx: R.RiskContext) -> DataFrame:
    """``classifier_training_rows`` with the lookups of the rows before each scenario's day (``asof``); only the
    categories' codes come from ``ctx``. Columns: city, input_date, label, w, x."""
    from blotter.operators import asof as AO

    rows = classifier_training_rows(inc, ctx, AO.lookups_as_of(inc, R.scenarios_from_incidents(inc)))
    return rows.select("city", "input_date", F.col("label13").cast("int").alias("label"), "w", "x")


def _fit_multinomial(rows: DataFrame, label: str, labels: list[str], model_name: str, reg: float, max_iter: int) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    data = rows.select(array_to_vector("x").alias("features"), F.col(label).alias("label"), F.col("w").cast("double").alias("w"))
    lr = LogisticRegression(family="multinomial", regParam=reg, weightCol="w", maxIter=max_iter, standardization=True)
    m = lr.fit(data)
    mat = m.coefficientMatrix.toArray()
    icpt = m.interceptVector.toArray()
    n_cls = mat.shape[0]
    out = []
    for k in range(len(labels)):
        w = [float(v) for v in mat[k]] if k < n_cls else [0.0] * mat.shape[1]
        b = float(icpt[k]) if k < n_cls else -1e9
        out.append((model_name, None, k, labels[k], b, w))
    return rows.sparkSession.createDataFrame(out, R.MODEL_SCHEMA)


def fit_risk_models(inc: DataFrame, ctx: R.RiskContext, reg: float = 0.01, max_iter: int = 50) -> DataFrame:
    """Broad (3-class) and specific (13-class) statewide classifiers."""
    rows = classifier_training_rows(inc, ctx)
    broad = _fit_multinomial(rows, "label3", BROAD_CLASSES, "broad", reg, max_iter)
    spec = _fit_multinomial(rows, "label13", OFFENSE_CLASSES, "specific", reg, max_iter)
    return broad.unionByName(spec)


# --- M14: class quality ----------------------------------------------------------------------------


#: Rows of truth that a task joins at most, where the session's partitions would hold more.
JOIN_ROWS = 500_000


def class_quality(scored: DataFrame, truth: DataFrame) -> DataFrame:
    """Accuracy, macro-F1, log loss and Brier score of the specific model on
    scenarios with known classes (truth: scenario keys, y13, w = incident count)."""
    classes = F.array(*[F.lit(c) for c in OFFENSE_CLASSES])
    truth = materialize(truth)
    scored = scored.select(*R.SCENARIO_KEYS, "specific_probs")
    parts = math.ceil(truth.count() / JOIN_ROWS)
    if parts > int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        # the session's partitions would be too large to sort in one task's memory
        scored, truth = (t.repartition(parts, *R.SCENARIO_KEYS) for t in (scored, truth))
    j = scored.join(truth, R.SCENARIO_KEYS)
    p = F.col("specific_probs")
    pred = F.element_at(classes, F.array_position(p, F.array_max(p)).cast("int"))
    true_pos = F.array_position(classes, F.col("y13")).cast("int")
    p_true = F.element_at(p, true_pos)
    brier = F.aggregate(
        F.transform(p, lambda q, i: (q - F.when(i + 1 == true_pos, F.lit(1.0)).otherwise(F.lit(0.0))) ** 2),
        F.lit(0.0),
        lambda a, b: a + b,
    )
    ll = -F.log(F.greatest(p_true, F.lit(1e-15)))
    # the confusion table, at most classes x classes rows, holds all that follows: the scored rows are read once
    rows = materialize(
        j.groupBy(F.col("y13").alias("y"), pred.alias("yhat")).agg(
            F.sum("w").alias("w"), F.sum(ll * F.col("w")).alias("ll"), F.sum(brier * F.col("w")).alias("brier")
        )
    )
    per_class = (
        rows.select("w", F.explode(F.array(
            F.struct(F.col("y").alias("c"), (F.col("y") == F.col("yhat")).cast("int").alias("tp"), F.lit(1).alias("t"), F.lit(0).alias("pp")),
            F.struct(F.col("yhat").alias("c"), F.lit(0).alias("tp"), F.lit(0).alias("t"), F.lit(1).alias("pp")),
        )).alias("e"))
        .groupBy(F.col("e.c").alias("c"))
        .agg(
            F.sum(F.col("e.tp") * F.col("w")).alias("tp"),
            F.sum(F.col("e.t") * F.col("w")).alias("support"),
            F.sum(F.col("e.pp") * F.col("w")).alias("predicted"),
        )
    )
    f1 = per_class.select(
        F.when(F.col("support") + F.col("predicted") > 0, 2.0 * F.col("tp") / (F.col("support") + F.col("predicted")))
        .otherwise(F.lit(0.0))
        .alias("f1"),
        "support",
    )
    macro = f1.where(F.col("support") > 0).select(F.avg("f1")).scalar()
    tot = rows.agg(
        F.sum("w").alias("n"),
        (F.sum(F.when(F.col("y") == F.col("yhat"), F.col("w")).otherwise(0)) / F.sum("w")).alias("accuracy"),
        (F.sum("ll") / F.sum("w")).alias("log_loss"),
        (F.sum("brier") / F.sum("w")).alias("brier"),
    )
    return tot.select("n", "accuracy", macro.alias("macro_f1"), "log_loss", "brier")


def truth_from_incidents(inc: DataFrame) -> DataFrame:
    """Scenario keys with their true 13-class label and incident count."""
    return (
        inc.where(F.col("city").isNotNull() & F.col("location_area").isNotNull() & F.col("offense_category_name").isNotNull())
        .groupBy("city", "location_area", "hour", F.col("date").alias("input_date"), offense_class("offense_category_name").alias("y13"))
        .agg(F.count(F.lit(1)).alias("w"))
    )

