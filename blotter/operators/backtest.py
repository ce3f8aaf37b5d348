"""Backtest with the origin as a key (M13): many origins and all cities in one pipeline.

Each history day belongs to the *segment* of the first origin after it. What a forecast
needs of the days before its origin are sums over segments up to the origin's own: summed once
per (key, segment), added up along the segments, and never recomputed from the history for another
origin. That holds for the seasonal and analog profiles, for the rows' numbers from which the last days
are found by equi-joins, and for the Gram matrices from which each (origin, city) gets its
own fit. The recursion then runs for every (origin, city) in the same job.

Origins are a parameter: their number sizes an array per key, not the history's shuffles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions import calendar as C
from blotter.operators import forecast as FC
from blotter.operators.daily import with_profile_columns
from blotter.schema import ANALOG_HALF_WINDOW, DOY_BASE, FORECAST_DAYS, FORECAST_FEATURES, LOOKUP_STAT_COLS, RECENT_DAYS, SEED_BUFFER, SEED_MIN
from blotter.session import materialize

#: Key of the fit over all cities; no city has a null byte in its name.
GLOBAL_KEY = "\x00global"


def segment(date: Column, origins: list[dt.date]) -> Column:
    """Position of the first origin after the day (days from the last origin on are in none: null)."""
    at = F.size(F.filter(F.array(*[F.lit(o) for o in origins]), lambda o: o <= date))
    return F.when(at < len(origins), at)


def as_of(rows: DataFrame, keys: list[str], sums: dict[str, Column], n_origins: int) -> DataFrame:
    """(origin_id, keys, sums): totals of all rows in segments up to each origin's own.

    ``rows`` has a column ``seg``. One shuffle: rows are summed per (key, segment) map-side, and a key's list
    holds at most one entry a segment. An origin before a key's first row has no row."""
    per = rows.where(F.col("seg").isNotNull()).groupBy(*keys, "seg").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    lists = per.groupBy(*keys).agg(F.collect_list(F.struct("seg", *sums)).alias("parts"), F.min("seg").alias("lo"))

    def upto(name: str, k: Column) -> Column:
        inside = F.filter("parts", lambda p: p["seg"] <= k)
        zero = F.lit(0).cast(dict(per.dtypes)[name])
        return F.aggregate(inside, zero, lambda acc, p: acc + F.coalesce(p[name], zero)).alias(name)

    ids = F.explode(F.sequence(F.col("lo"), F.lit(n_origins - 1))).alias("origin_id")
    out = lists.select(*keys, "parts", ids)
    return out.select("origin_id", *keys, *[upto(n, F.col("origin_id")) for n in sums])


def last_rows(history: DataFrame, counts: DataFrame, keys: list[str], number: str, n: int) -> DataFrame:
    """The last ``n`` rows per (origin, key): as many numbers as ``counts`` says there are, joined to the rows' own."""
    numbers = F.explode(F.sequence(F.greatest(F.col("n") - (n - 1), F.lit(1)), F.col("n"))).alias(number)
    return counts.select("origin_id", *keys, numbers).join(history, [*keys, number])


def starts(history: DataFrame, origins: list[dt.date], steps: int) -> DataFrame:
    """A21, O8, W6, W7 per (origin, city): recent level, seed buffer, the last day's staffing."""
    n_origins = len(origins)
    ranked = history.withColumn("rn", F.row_number().over(Window.partitionBy("city").orderBy("date"))).withColumn(
        "rn_m", F.row_number().over(Window.partitionBy("city", "month").orderBy("date"))
    )
    ranked = materialize(ranked.select("city", "date", "month", "crime_count", "rn", "rn_m", "seg", *LOOKUP_STAT_COLS))
    one = {"n": F.lit(1)}
    n_all = as_of(ranked, ["city"], one, n_origins)
    item = F.struct("date", F.col("crime_count").cast("double").alias("v"))
    last = last_rows(ranked, n_all, ["city"], "rn", max(RECENT_DAYS, SEED_BUFFER))
    order = F.row_number().over(Window.partitionBy("origin_id", "city").orderBy(F.desc("date")))
    by_all = (
        last.withColumn("back", order)
        .groupBy("origin_id", "city")
        .agg(
            F.avg(F.when(F.col("back") <= RECENT_DAYS, F.col("crime_count"))).alias("recent"),
            F.collect_list(F.when(F.col("back") <= SEED_BUFFER, item)).alias("seed_all"),
            F.max_by(F.struct(*LOOKUP_STAT_COLS), F.col("date")).alias("latest"),
        )
    )
    months = F.array(*[F.array(F.lit(o.month), F.lit((o + dt.timedelta(days=steps - 1)).month)) for o in origins])
    n_month = as_of(ranked, ["city", "month"], one, n_origins).where(F.array_contains(F.get(months, F.col("origin_id")), F.col("month")))
    in_months = last_rows(ranked, n_month, ["city", "month"], "rn_m", SEED_BUFFER)
    total = n_month.groupBy("origin_id", "city").agg(F.sum("n").alias("n_months"))
    by_month = (
        in_months.withColumn("back", order)
        .where(F.col("back") <= SEED_BUFFER)
        .groupBy("origin_id", "city")
        .agg(F.collect_list(item).alias("seed_m"))
        .join(total, ["origin_id", "city"])
    )
    rows = by_all.join(by_month, ["origin_id", "city"], "left")
    seed = F.when(F.col("n_months") >= SEED_MIN, F.col("seed_m")).otherwise(F.col("seed_all"))
    return rows.select("origin_id", "city", "recent", F.transform(F.array_sort(seed), lambda x: x["v"]).alias("seed"), "latest")


def _models(cities: DataFrame, coefs: DataFrame, use_city_models: bool) -> DataFrame:
    """J5 per (origin, city): coefficients as of the origin where ``coefs`` has ``origin_id``, else the same for all."""
    cols = ["intercept", *FORECAST_FEATURES]
    at = ["origin_id"] if "origin_id" in coefs.columns else []
    model = F.struct(*[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cols])
    shared = coefs.where(F.col("city").isNull()).select(*at, model.alias("shared"))
    rows = cities.join(shared, at, "left") if at else cities.withColumn("shared", shared.scalar())
    if not use_city_models:
        return rows.select("origin_id", "city", F.col("shared").alias("coef"), F.lit(False).alias("use_city"))
    own = coefs.where(F.col("city").isNotNull()).select(*at, "city", model.alias("own"))
    rows = rows.join(own, [*at, "city"], "left")
    return rows.select("origin_id", "city", F.coalesce("own", "shared").alias("coef"), F.col("own").isNotNull().alias("use_city"))


def forecasts(
    daily: DataFrame, coefs: DataFrame, origins: list[dt.date], steps: int = FORECAST_DAYS, use_city_models: bool = True
) -> DataFrame:
    """Forecasts of all origins: (origin, City, Date, Predicted Count, is_holiday, policy)."""
    origins = sorted(set(origins))
    n = len(origins)
    history = materialize(with_profile_columns(daily).withColumn("seg", segment(F.col("date"), origins)).where("seg is not null"))
    per_key = materialize(starts(history, origins, steps))
    count = {"s": F.col("crime_count"), "n": F.lit(1)}
    mean = F.col("s") / F.col("n")
    city_avg = as_of(history, ["city"], count, n).select("origin_id", "city", mean.alias("city_avg"))
    md = as_of(history, ["city", "month", "day_of_week"], count, n).select("origin_id", "city", "month", "day_of_week", mean.alias("md_avg"))
    dw = as_of(history, ["city", "day_of_week"], count, n).select("origin_id", "city", "day_of_week", mean.alias("dow_avg"))

    origin = F.get(F.array(*[F.lit(o) for o in origins]), F.col("origin_id"))
    days = F.posexplode(F.sequence(origin, F.date_add(origin, steps - 1)))
    tgt = per_key.select("origin_id", "city", days.alias("step", "date"))
    k = F.explode(F.sequence(F.lit(-ANALOG_HALF_WINDOW), F.lit(ANALOG_HALF_WINDOW))).alias("k")
    near = tgt.select("origin_id", "city", "date", k)
    raw = F.dayofyear("date") + F.col("k")
    near = near.withColumn("day_of_year", F.when(raw < 1, raw + DOY_BASE).when(raw > DOY_BASE, raw - DOY_BASE).otherwise(raw))
    analog = (
        near.join(as_of(history, ["city", "day_of_year"], count, n), ["origin_id", "city", "day_of_year"])
        .groupBy("origin_id", "city", "date")
        .agg((F.sum("s") / F.sum("n")).alias("analog"))
    )
    flags = C.holiday_flag_table(daily.sparkSession, F.lit(origins[0]), F.lit(origins[-1] + dt.timedelta(days=steps - 1)))
    key = ["origin_id", "city"]
    rows = (
        tgt.withColumn("month", F.month("date"))
        .withColumn("day_of_week", C.weekday("date"))
        .join(F.broadcast(flags), ["date"], "left")
        .join(md, [*key, "month", "day_of_week"], "left")
        .join(dw, [*key, "day_of_week"], "left")
        .join(city_avg, key, "left")
        .join(analog, [*key, "date"], "left")
        .join(per_key, key)
        .join(_models(per_key.select(*key), coefs, use_city_models), key)
        .withColumn("origin", origin)
    )
    hol = {c: F.col(c) for c in ("is_holiday", "is_day_before_holiday", "is_day_after_holiday")}
    feats = FC.static_features(F.col("date"), F.col("latest"), hol)
    seasonal = F.coalesce("md_avg", "dow_avg", "city_avg")
    return FC.run_recursion(FC._with_days(rows, ["origin", "city"], feats, seasonal, "coef"))


def backtest(
    daily: DataFrame, coefs: DataFrame, origins: list[dt.date], steps: int = FORECAST_DAYS, use_city_models: bool = True
) -> DataFrame:
    """MAE and lag-7 autocorrelation of the forecast path per (origin, city, policy) against the real counts."""
    fc = forecasts(daily, coefs, origins, steps, use_city_models)
    actual = daily.select(F.col("city").alias("City"), F.col("date").alias("Date"), F.col("crime_count").cast("double").alias("y"))
    lag7 = F.lag("Predicted Count", 7).over(Window.partitionBy("origin", "City").orderBy("Date"))
    rows = fc.withColumn("p_lag7", lag7).join(actual, ["City", "Date"])
    return rows.groupBy("origin", "City", "policy").agg(
        F.avg(F.abs(F.col("Predicted Count") - F.col("y"))).alias("mae"),
        F.corr("Predicted Count", "p_lag7").alias("lag7_autocorr"),
        F.count(F.lit(1)).alias("days"),
    )


# --- fits as of each origin ---------------------------------------------------------------


def gram_segments(rows: DataFrame, features: list[str], origins: list[dt.date]) -> DataFrame:
    """(key, seg, i, j, g): sums of products of the columns (1, features, label) over each city's and all rows of a
    segment. Tasks multiply matrices a batch; Spark adds the products up. ``i = j = 0`` is the number of rows;
    rows with a missing value are left out and counted at ``i = j = -1``."""
    schema = "key string, seg int, i int, j int, g double"
    target = pa.schema([("key", pa.string()), ("seg", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("g", pa.float64())])
    data = rows.select("city", segment(F.col("date"), origins).alias("seg"), *[F.col(c).cast("double") for c in (*features, "label")])
    upper = np.triu_indices(len(features) + 2)
    places = np.stack(upper, 1).astype(np.int32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        missing: dict[tuple[str, int], int] = {}
        for batch in batches:
            x = np.column_stack([np.ones(batch.num_rows), *(c.to_numpy(zero_copy_only=False) for c in batch.columns[2:])])
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            whole = ~np.isnan(x).any(axis=1)
            at: dict[tuple[str, int], list[int]] = {}
            for k, key in enumerate(keys):
                at.setdefault(key, []).append(k)
            for (city, seg), ks in at.items():
                mine = x[ks][whole[ks]]
                for key in ((city, seg), (GLOBAL_KEY, seg)):
                    sums[key] = sums.get(key, 0) + (mine.T @ mine)[upper]
                    missing[key] = missing.get(key, 0) + len(ks) - len(mine)
        for (key, seg), g in sums.items():
            ij = np.concatenate((places, np.full((1, 2), -1, dtype=np.int32)))
            values = np.append(g, float(missing[key, seg]))
            m = len(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * m), pa.array([seg] * m, pa.int32()), pa.array(ij[:, 0]), pa.array(ij[:, 1]), pa.array(values)], schema=target
            )

    parts = data.where("seg is not null and city is not null").mapInArrow(run, schema)
    return parts.groupBy("key", "seg", "i", "j").agg(F.sum("g").alias("g"))


def fit_as_of(rows: DataFrame, origins: list[dt.date], reg: float = 1e-3, features: list[str] = FORECAST_FEATURES) -> DataFrame:
    """M10 per (origin, city), and per origin over all cities (``city`` null): ridge fits on the rows before the origin,
    from running sums of the Gram matrices. Columns ``rows`` and ``skipped`` tell how many rows a fit used and left out."""
    origins = sorted(set(origins))
    k = len(features) + 1
    grams = as_of(gram_segments(rows, features, origins).withColumnRenamed("g", "part"), ["key", "i", "j"], {"g": F.col("part")}, len(origins))
    columns = [("origin_id", pa.int32()), ("city", pa.string()), ("rows", pa.int64()), ("skipped", pa.int64())]
    target = pa.schema([*columns, ("intercept", pa.float64()), *[(f, pa.float64()) for f in features]])
    schema = "origin_id int, city string, rows bigint, skipped bigint, intercept double, " + ", ".join(f"{f} double" for f in features)

    def solve(table: pa.Table) -> pa.Table:
        i, j, g = (table.column(c).to_numpy() for c in ("i", "j", "g"))
        full = np.zeros((k + 1, k + 1))
        inner = i >= 0
        full[i[inner], j[inner]] = full[j[inner], i[inner]] = g[inner]
        n = full[0, 0]
        a = full[:k, :k] + reg * np.eye(k) * max(1.0, n)
        w = np.linalg.lstsq(a, full[:k, k], rcond=None)[0]
        key = table.column("key")[0].as_py()
        row = {"origin_id": table.column("origin_id")[0].as_py(), "city": None if key == GLOBAL_KEY else key, "rows": int(n)}
        row |= {"skipped": int(g[~inner].sum()), "intercept": float(w[0])} | {f: float(v) for f, v in zip(features, w[1:])}
        return pa.Table.from_pylist([row], schema=target)

    return grams.groupBy("origin_id", "key").applyInArrow(solve, schema)
