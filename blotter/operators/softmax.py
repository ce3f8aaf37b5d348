"""Offense classifiers per city (M11): a grouped softmax solver, one Spark job an iteration for all cities.

Rows are (city, label, w, x): a class number, a weight and the features. One job sums each city's
Gram matrix. It gives the scaling, and with half of it as an upper bound of the curvature every step
is a solve per class; momentum, begun anew where the loss rises, makes up for the bound's caution. Each iteration's job sums the gradients and the loss of all
cities map-side, a row per task, city and value; the driver holds the models (cities x classes x features,
not data) and sends them with the next job. A city stops when its gradient is small; whether it
did is reported. Scaled weights are shrunk by ``reg``, the intercept by a hundredth of it, so that classes
a city never saw stay finite.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.operators.risk import MODEL_SCHEMA
from blotter.session import materialize

FIT_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("rows", T.DoubleType()),
        T.StructField("iterations", T.IntegerType()),
        T.StructField("converged", T.BooleanType()),
        T.StructField("loss", T.DoubleType()),
        T.StructField("gradient", T.DoubleType()),
    ]
)
_SUMS = "city string, at int, v double"
_SUMS_ARROW = pa.schema([("city", pa.string()), ("at", pa.int32()), ("v", pa.float64())])


def log_probabilities(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows of log softmax; ``w`` has the intercept last."""
    z = x @ w[:, :-1].T + w[:, -1]
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _city_sums(data: DataFrame, part) -> dict[str, np.ndarray]:
    """``part(city, x, label, w)`` summed over each city's rows: one vector a city reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            city, label, w, x = (batch.column(i) for i in range(4))
            names, at = np.unique(np.array(city.to_pylist(), dtype=object), return_inverse=True)
            n = batch.num_rows
            xs = x.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))
            labels, ws = label.to_numpy(), w.to_numpy()
            for k, name in enumerate(names):
                mine = at == k
                sums[name] = sums.get(name, 0.0) + part(name, xs[mine], labels[mine], ws[mine])
        for name, v in sums.items():
            m = len(v)
            yield pa.RecordBatch.from_arrays([pa.array([name] * m), pa.array(np.arange(m, dtype=np.int32)), pa.array(v)], schema=_SUMS_ARROW)

    rows = data.mapInArrow(run, _SUMS).groupBy("city", "at").agg(F.sum("v").alias("v")).toArrow().sort_by([("city", "ascending"), ("at", "ascending")])
    names, first = np.unique(np.array(rows.column("city").to_pylist(), dtype=object), return_index=True)
    return dict(zip(names, np.split(rows.column("v").to_numpy(), first[1:]))) if len(names) else {}


def prepared(rows: DataFrame, width: int | None = None) -> DataFrame:
    """The solver's rows, written once for all iterations; a row without a city, label or feature raises in the job
    rather than vanish. With ``width``, the number of features, each is written as a column of its own, which
    takes a fraction of the room of arrays."""
    whole = F.forall("x", lambda v: v.isNotNull()) & F.col("city").isNotNull() & F.col("label").isNotNull()
    checked = F.when(F.coalesce(whole, F.lit(False)), F.col("x")).otherwise(F.raise_error(F.lit("a training row lacks a city, label or feature")))
    head = ["city", F.col("label").cast("int").alias("label"), F.col("w").cast("double").alias("w")]
    if width is None:
        return materialize(rows.select(*head, checked.alias("x")))
    checked = F.when(F.size("x") == width, checked).otherwise(F.raise_error(F.lit(f"a training row has not {width} features")))
    kept = materialize(rows.select(*head, checked.alias("x")).select("city", "label", "w", *[F.get("x", F.lit(i)).alias(f"x{i}") for i in range(width)]))
    return kept.select("city", "label", "w", F.array(*[f"x{i}" for i in range(width)]).alias("x"))


def fit_cities(
    data: DataFrame, labels: list[str], reg: float = 0.01, max_iter: int = 60, tol: float = 1e-4, model: str = "specific"
) -> tuple[DataFrame, DataFrame]:
    """(models as ``risk.MODEL_SCHEMA``, a report row per city). ``data`` comes from ``prepared``."""
    spark, k = data.sparkSession, len(labels)

    def gram(city, x, label, w):
        z = np.column_stack([x, np.ones(len(x))])
        return np.concatenate((np.bincount(label, weights=w, minlength=k), ((z * w[:, None]).T @ z).ravel()))

    scale, curve, rows, weights = {}, {}, {}, {}
    for city, g in _city_sums(data, gram).items():
        seen, g = g[:k], g[k:]
        d = int(round(len(g) ** 0.5))
        g = g.reshape(d, d)
        n = g[-1, -1]
        mean = g[-1, :-1] / n
        sd = np.sqrt(np.maximum(np.diag(g)[:-1] / n - mean**2, 0.0))
        sd = np.where(sd > 1e-9 * np.maximum(np.abs(mean), 1.0), sd, np.inf)  # a constant feature gets no weight
        t = np.eye(d)
        t[:-1, :-1] = np.diag(1 / sd)
        t[:-1, -1] = -mean / sd
        penalty = np.append(np.full(d - 1, reg), reg / 100)
        scale[city], rows[city] = (mean, sd), n
        curve[city] = (np.linalg.inv(0.5 * t @ g @ t.T / n + np.diag(penalty)), penalty)
        weights[city] = np.zeros((k, d))  # the classes' shares to begin with
        weights[city][:, -1] = np.log((seen + 0.5) / (n + 0.5 * k))
    report = {c: [rows[c], 0, False, np.inf, 0.0] for c in weights}
    stepped = {c: (w, 0) for c, w in weights.items()}  # the last step's end, and steps since the momentum's start
    for i in range(max_iter + 1):
        live = {c: w for c, w in weights.items() if not report[c][2]}
        if not live:
            break
        sent = spark.sparkContext.broadcast((live, scale))

        def gradient(city, x, label, w, sent=sent):
            live, scale = sent.value
            mean, sd = scale[city]
            z = (x - mean) / sd
            lp = log_probabilities(z, live[city])
            miss = -np.exp(lp)
            miss[np.arange(len(x)), label] += 1.0
            g = (miss * w[:, None]).T @ np.column_stack([z, np.ones(len(z))])
            return np.append(g.ravel(), -(w * lp[np.arange(len(x)), label]).sum())

        for city, v in _city_sums(data.where(F.col("city").isin(list(live))) if len(live) < len(weights) else data, gradient).items():
            inverse, penalty = curve[city]
            w, n = weights[city], rows[city]
            g = v[:-1].reshape(w.shape) / n - penalty * w
            loss = v[-1] / n + 0.5 * float((penalty * w**2).sum())
            norm = float(np.abs(g).max())
            before, age = stepped[city]
            age = 0 if loss > report[city][3] else age + 1
            report[city] = [n, i, norm <= tol, loss, norm]
            if norm > tol and i < max_iter:
                end = w + g @ inverse
                weights[city], stepped[city] = end + age / (age + 3) * (end - before), (end, age)
        sent.unpersist()
    out = []
    for city, w in weights.items():
        mean, sd = scale[city]
        raw = w[:, :-1] / sd
        for c in range(k):
            out.append((model, city, c, labels[c], float(w[c, -1] - raw[c] @ mean), [float(v) for v in raw[c]]))
    table = [(c, float(r[0]), r[1], r[2], float(r[3]), r[4]) for c, r in report.items()]
    return spark.createDataFrame(out, MODEL_SCHEMA), spark.createDataFrame(table, FIT_SCHEMA)


def city_losses(data: DataFrame, models: DataFrame) -> DataFrame:
    """(city, rows, log_loss) of rows under their own city's model; a city without one is left out."""
    held: dict[str, dict[int, list[float]]] = {}
    for r in models.where("city is not null").collect():  # the artifact: models x classes x features
        held.setdefault(r["city"], {})[r["class_id"]] = [*r["weights"], r["intercept"]]
    arrays = {c: np.array([m[i] for i in sorted(m)]) for c, m in held.items()}
    sent = data.sparkSession.sparkContext.broadcast(arrays)

    def loss(city, x, label, w):
        if city not in sent.value:
            return np.array([0.0, 0.0])
        lp = log_probabilities(x, sent.value[city])
        return np.array([w.sum(), -(w * lp[np.arange(len(x)), label]).sum()])

    sums = _city_sums(data, loss)
    table = [(c, float(v[0]), float(v[1] / v[0])) for c, v in sums.items() if v[0] > 0]
    return data.sparkSession.createDataFrame(table, "city string, rows double, log_loss double")
