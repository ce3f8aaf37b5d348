"""Probability quality of a classifier (M14): reliability bins and weighted quantiles.

Each scored row and class is one forecast of an event ("the class is this one"), with
the row's weight. Scores are first summed on a fixed grid of ``CELLS`` cells per
class: weight, weighted probability and weight of events. These sums are mergeable (sums
of disjoint parts add up) and bounded by classes x cells, so all that follows is over a
small table: the raw scores are shuffled as partial sums only.

Bins are of equal width or, by the cells' running weight, of about equal weight: a cell goes to
the bin that the middle of its weight falls into, so a cell is never split.

Defined results: rows with a null label, probability or weight, or with no weight, are left out;
an empty table gives no bins; a class with no events has observed 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 4096


def class_events(scored: DataFrame, truth: DataFrame, keys: list[str], labels: str = "specific_labels", probs: str = "specific_probs") -> DataFrame:
    """(label, p, event, w): one row per scored row, true class (``y13``, ``w`` of ``truth``) and class."""
    pairs = F.arrays_zip(F.col(labels).alias("label"), F.col(probs).alias("p"))
    rows = scored.join(truth, keys).select("y13", "w", F.explode(pairs).alias("e"))
    return rows.select(F.col("e.label").alias("label"), F.col("e.p").alias("p"), (F.col("e.label") == F.col("y13")).alias("event"), "w")


def cell_sums(events: DataFrame) -> DataFrame:
    """Mergeable sums (label, cell, w, wp, we); several parts' sums are merged by ``merge_cells``."""
    cell = F.least(F.floor(F.col("p") * CELLS), F.lit(CELLS - 1)).cast("int")
    held = events.where(F.col("label").isNotNull() & F.col("p").isNotNull() & F.col("event").isNotNull() & (F.col("w") > 0))
    return held.groupBy("label", cell.alias("cell")).agg(
        F.sum("w").alias("w"),
        F.sum(F.col("w") * F.col("p")).alias("wp"),
        F.sum(F.when(F.col("event"), F.col("w")).otherwise(0)).alias("we"),
    )


def merge_cells(parts: DataFrame) -> DataFrame:
    """Sums of several parts as one."""
    return parts.groupBy("label", "cell").agg(F.sum("w").alias("w"), F.sum("wp").alias("wp"), F.sum("we").alias("we"))


def _binned(cells: DataFrame, at: Column) -> DataFrame:
    out = cells.groupBy("label", at.cast("int").alias("bin")).agg(
        F.sum("w").cast("long").alias("n"),
        (F.sum("wp") / F.sum("w")).alias("mean_probability"),
        (F.sum("we") / F.sum("w")).alias("observed"),
    )
    return out.withColumn("gap", F.col("mean_probability") - F.col("observed"))


def equal_width(cells: DataFrame, bins: int) -> DataFrame:
    """(label, bin, n, mean_probability, observed, gap) over bins of equal width."""
    return _binned(cells, F.floor(F.col("cell") * bins / CELLS))


def equal_weight(cells: DataFrame, bins: int) -> DataFrame:
    """The same over bins of about equal weight; the windows see at most ``CELLS`` rows a class."""
    by_label = Window.partitionBy("label")
    before = F.sum("w").over(by_label.orderBy("cell")) - F.col("w")
    ranked = cells.select("*", before.alias("before"), F.sum("w").over(by_label).alias("total"))
    # twice the middle of the cell's weight: whole numbers for whole weights
    return _binned(ranked, F.least(F.floor((2 * F.col("before") + F.col("w")) * bins / (2 * F.col("total"))), F.lit(bins - 1)))


def calibration_error(table: DataFrame) -> DataFrame:
    """(label, error): mean absolute gap, weighted by the bins' weights."""
    return table.groupBy("label").agg((F.sum(F.abs("gap") * F.col("n")) / F.sum("n")).alias("error"))


def quantiles(cells: DataFrame, shares: list[float]) -> DataFrame:
    """(label, share, p): upper edge of the first cell whose running weight reaches the share."""
    by_label = Window.partitionBy("label")
    ranked = cells.select(
        "label", "cell", F.sum("w").over(by_label.orderBy("cell")).alias("upto"), F.sum("w").over(by_label).alias("total")
    )
    wanted = ranked.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    reached = F.min(F.when(F.col("upto") >= F.col("share") * F.col("total"), F.col("cell")))
    return wanted.groupBy("label", "share").agg(((reached + 1) / F.lit(float(CELLS))).alias("p"))
