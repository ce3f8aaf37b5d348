"""Tree forecasters (M3, M10): ensembles as node arrays, fitted by distributed histogram boosting.

A model is one row: ``city`` (null: the global model), ``base``, ``roots`` (each tree's first
node) and ``nodes`` (feature number or -1 for a leaf, threshold, left and right node, value).
``predict`` walks the nodes with array functions, so that a forecast's recursion calls it
within the JVM; a city without a model of its own takes the global one, as with linear models.

Fitting boosts squared error for all models together, the global one and each city's. Features become
bins once. A tree level is one aggregation: sums of residuals by (model, node,
feature, bin), added up map-side, with running sums over the bins for the gains. So what is
shuffled is bounded by models x nodes x features x bins, whatever the number of days, and no
model's rows meet in one task. Rows are written once a tree to cut their lineage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.schema import FORECAST_FEATURES
from blotter.session import materialize

NODE = "struct<feature:int,threshold:double,left:int,right:int,value:double>"
TREE_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("base", T.DoubleType()),
        T.StructField("roots", T.ArrayType(T.IntegerType())),
        T.StructField(
            "nodes",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("feature", T.IntegerType()),
                        T.StructField("threshold", T.DoubleType()),
                        T.StructField("left", T.IntegerType()),
                        T.StructField("right", T.IntegerType()),
                        T.StructField("value", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)

#: Key of the global model's rows; no city has a null byte in its name.
GLOBAL_KEY = "\x00global"
#: No deeper path is walked.
MAX_DEPTH = 8


# --- prediction ------------------------------------------------------------------------


def predict(x: Column, base: Column, roots: Column, nodes: Column, max_depth: int = MAX_DEPTH) -> Column:
    """base + the value of the leaf that ``x`` reaches in each tree. A value goes left up to the threshold; a
    missing value goes right, as nothing is known of it."""

    def step(at: Column, _: Column) -> Column:
        node = F.get(nodes, at)
        left = F.coalesce(F.get(x, node["feature"]) <= node["threshold"], F.lit(False))
        return F.when(node["feature"] < 0, at).otherwise(F.when(left, node["left"]).otherwise(node["right"]))

    levels = F.array(*[F.lit(i) for i in range(max_depth)])
    return F.aggregate(roots, base, lambda acc, root: acc + F.get(nodes, F.aggregate(levels, root, step))["value"])


def model_per_city(cities: DataFrame, trees: DataFrame, use_city_models: bool = True) -> DataFrame:
    """J5 for trees: a city's own ensemble when there is one, else the global one."""
    model = F.struct("base", "roots", "nodes")
    fallback = trees.where(F.col("city").isNull()).select(model.alias("m")).scalar()
    if not use_city_models:
        return cities.select("city", fallback.alias("trees"), F.lit(False).alias("use_city"))
    own = trees.where(F.col("city").isNotNull()).select("city", model.alias("own"))
    joined = cities.join(own, ["city"], "left")
    return joined.select("city", F.coalesce("own", fallback).alias("trees"), F.col("own").isNotNull().alias("use_city"))


# --- training --------------------------------------------------------------------------


def bin_edges(rows: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Upper edges of equal-width bins between each feature's least and greatest value; one pass, and
    two numbers a feature reach the driver. A constant feature has no edge."""
    ends = rows.agg(*[f(F.col(c)).alias(f"{n}_{c}") for c in features for n, f in (("lo", F.min), ("hi", F.max))]).first()
    out = []
    for c in features:
        lo, hi = ends[f"lo_{c}"], ends[f"hi_{c}"]
        out.append([] if lo is None or lo == hi else [lo + (hi - lo) * k / bins for k in range(1, bins)])
    return out


def binned(rows: DataFrame, features: list[str], edges: list[list[float]]) -> DataFrame:
    """(key, label, bins): each row for its city's model and for the global one; a bin is the number of edges below the value.
    A missing value has the bin after the last, so that it goes right at each split."""
    table = F.array(*[F.array(*[F.lit(e) for e in es]) if es else F.array().cast("array<double>") for es in edges])
    x = F.array(*[F.col(c).cast("double") for c in features])
    bins = F.transform(
        x,
        lambda v, i: F.when(v.isNull(), F.size(F.get(table, i)) + 1).otherwise(
            F.size(F.filter(F.get(table, i), lambda e: e < v))
        ),
    )
    keys = F.explode(F.array(F.col("city"), F.lit(GLOBAL_KEY)))
    return rows.select(F.col("label").cast("double").alias("label"), bins.alias("bins"), "city").select(keys.alias("key"), "label", "bins")


def best_splits(rows: DataFrame, reg: float, least_rows: int) -> DataFrame:
    """(key, node, feature, bin, gain) of each open node's best split, the lowest feature and bin among equals.

    ``rows`` has key, node, residual and bins; a node that no split improves, or whose children would hold
    fewer than ``least_rows``, is left out."""
    hist = (
        rows.select("key", "node", "residual", F.posexplode("bins").alias("feature", "bin"))
        .groupBy("key", "node", "feature", "bin")
        .agg(F.sum("residual").alias("g"), F.count(F.lit(1)).alias("n"))
    )
    per_feature = Window.partitionBy("key", "node", "feature")
    upto = per_feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = hist.select(
        "key", "node", "feature", "bin",
        F.sum("g").over(upto).alias("gl"), F.sum("n").over(upto).alias("nl"),
        F.sum("g").over(per_feature).alias("g"), F.sum("n").over(per_feature).alias("n"),
    )
    gr, nr = F.col("g") - F.col("gl"), F.col("n") - F.col("nl")
    part = lambda g, n: g * g / (n + F.lit(reg))
    gain = part(F.col("gl"), F.col("nl")) + part(gr, nr) - part(F.col("g"), F.col("n"))
    open_splits = sums.withColumn("gain", gain).where(
        (F.col("nl") >= least_rows) & (F.col("n") - F.col("nl") >= least_rows) & (F.col("gain") > 1e-9)
    )
    first = F.struct(-F.col("gain"), F.col("feature"), F.col("bin"))
    best = open_splits.groupBy("key", "node").agg(F.min_by(F.struct("feature", "bin", "gain"), first).alias("s"))
    return best.select("key", "node", "s.*")


def _moved(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Each row's node after a level: children of ``node`` are ``2 node + 1`` and ``2 node + 2``."""
    right = F.get("bins", F.col("feature")) > F.col("bin")
    child = F.when(F.col("feature").isNull(), F.col("node")).otherwise(F.col("node") * 2 + 1 + right.cast("int"))
    joined = rows.join(splits.select("key", "node", "feature", "bin"), ["key", "node"], "left")
    return joined.withColumn("node", child).drop("feature", "bin")


def fit_trees(
    rows: DataFrame, features: list[str] = FORECAST_FEATURES, trees: int = 20, depth: int = 3, rate: float = 0.2, bins: int = 32,
    reg: float = 1.0, least_rows: int = 20,
) -> DataFrame:
    """Boosted trees for every city and for all together, from M2 training rows (``city, label`` and the
    features). One row per model. Rows without a label are left out, and a missing feature goes right at a split."""
    if depth > MAX_DEPTH:
        raise ValueError(f"at most {MAX_DEPTH} levels")
    edges = bin_edges(rows, features, bins)
    data = materialize(binned(rows.where(F.col("label").isNotNull() & F.col("city").isNotNull()), features, edges))
    base = materialize(data.groupBy("key").agg(F.avg("label").alias("base")))
    state = data.join(base, "key").select("key", "bins", (F.col("label") - F.col("base")).alias("residual"), F.lit(0).alias("node"))
    grown = None
    for tree in range(trees):
        state = materialize(state)
        for _ in range(depth):
            # a node that found no split is offered again with its number, and finds none again
            splits = materialize(best_splits(state, reg, least_rows))
            state = _moved(state, splits)
            level = splits.withColumn("tree", F.lit(tree))
            grown = level if grown is None else grown.unionByName(level, allowMissingColumns=True)
        leaf = materialize(state.groupBy("key", "node").agg((F.sum("residual") / (F.count(F.lit(1)) + F.lit(reg)) * F.lit(rate)).alias("value")))
        values = leaf.select("key", "node", "value", F.lit(tree).alias("tree"))
        grown = grown.unionByName(values, allowMissingColumns=True)
        state = state.join(leaf, ["key", "node"]).select("key", "bins", (F.col("residual") - F.col("value")).alias("residual"), F.lit(0).alias("node"))
    return _as_arrays(base, grown, edges) if grown is not None else _as_arrays(base, None, edges)


def _as_arrays(base: DataFrame, grown: DataFrame | None, edges: list[list[float]]) -> DataFrame:
    """Models of the grown nodes: a model's nodes, bounded by its trees and levels, are numbered in order of tree and place."""
    city = F.when(F.col("key") != GLOBAL_KEY, F.col("key")).alias("city")
    if grown is None:
        return base.select(city, "base", F.array().cast("array<int>").alias("roots"), F.array().cast(f"array<{NODE}>").alias("nodes"))
    table = F.array(*[F.array(*[F.lit(e) for e in es]) if es else F.array().cast("array<double>") for es in edges])
    number = F.col("tree").cast("long") * (1 << MAX_DEPTH + 1) + F.col("node")
    node = F.struct(number.alias("number"), "node", "feature", F.get(F.get(table, F.col("feature")), F.col("bin")).alias("threshold"), "value")
    lists = grown.groupBy("key").agg(F.array_sort(F.collect_list(node)).alias("g"))
    # children have a tree's numbers 2 node + 1 and 2 node + 2, so the left one is node + 1 further on
    place = lambda x, side: F.array_position(F.col("g")["number"], x["number"] + x["node"] + side) - 1
    nodes = F.transform(
        "g",
        lambda x: F.struct(
            F.coalesce(x["feature"], F.lit(-1)).alias("feature"),
            x["threshold"].alias("threshold"),
            F.when(x["feature"].isNotNull(), place(x, 1)).cast("int").alias("left"),
            F.when(x["feature"].isNotNull(), place(x, 2)).cast("int").alias("right"),
            x["value"].alias("value"),
        ),
    )
    numbers = F.sequence(F.lit(0), F.size("g") - 1)
    roots = F.filter(F.transform(numbers, lambda i: F.when(F.get("g", i)["node"] == 0, i.cast("int"))), lambda i: i.isNotNull())
    return base.join(lists, "key").select(city, "base", roots.alias("roots"), nodes.alias("nodes"))
