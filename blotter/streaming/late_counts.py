"""Daily city counts of a stream that keeps late rows (A1, SURVEY section 2.9).

``daily_counts`` holds counts as state and drops rows whose day its watermark has
closed. Here a micro-batch is reduced to partial counts per (day, city), one folder a
batch, which a retried batch replaces; nothing is held between batches. The sum over
batches is the batch job's count whatever the order in which rows arrive.

Which rows were late follows from the folders alone: a batch's mark is the largest
event time of the batches before it less the delay, and its rows of days that ended
by then are late. ``closed_counts`` has what was known on time, ``late_counts`` the
side table, ``merged_counts`` both. Rows without an event time belong to no day and
are left out; a null city is a key of its own; no batch yet gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.session import checkpoint_dir
from blotter.streaming.daily_counts import EVENT_SCHEMA, _epoch_day, day_start_utc

#: ``top``: the largest event time (seconds) among the rows counted; ``batch`` comes from the folder.
PARTIAL = "date date, city string, crime_count long, top long, batch long"


def run_partial_counts(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str) -> str:
    """Count the files of ``source_dir`` that ``checkpoint`` has not seen (availableNow trigger); returns ``out_dir``."""

    def sink(batch: DataFrame, epoch: int) -> None:
        rows = batch.where(F.col("ts").isNotNull()).groupBy(_epoch_day(F.col("ts")).alias("date"), "city")
        counts = rows.agg(F.count(F.lit(1)).alias("crime_count"), F.max(F.unix_seconds("ts")).alias("top"))
        counts.write.mode("overwrite").parquet(f"{out_dir}/batch={epoch}")

    events = spark.readStream.schema(EVENT_SCHEMA).parquet(source_dir)
    query = events.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return out_dir


def _parts(spark: SparkSession, out_dir: str, delay_days: int) -> DataFrame:
    """The partial counts with ``late``: whether the day had ended by the mark of the row's batch."""
    parts = spark.read.schema(PARTIAL).parquet(out_dir)
    # one row a batch: the window is bounded by the number of batches, not by rows
    before = Window.orderBy("batch").rowsBetween(Window.unboundedPreceding, -1)
    marks = parts.groupBy("batch").agg(F.max("top").alias("top"))
    marks = marks.select("batch", (F.max("top").over(before) - 86400 * delay_days).alias("mark"))
    end = (F.unix_date("date").cast("long") + 1) * 86400
    return parts.join(marks, "batch", "left").withColumn("late", F.coalesce(end <= F.col("mark"), F.lit(False)))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("date", "city").agg(F.sum("crime_count").alias("crime_count"))


def merged_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The count of every (date, city), late rows merged in."""
    return _summed(spark.read.schema(PARTIAL).parquet(out_dir))


def closed_counts(spark: SparkSession, out_dir: str, delay_days: int = 2) -> DataFrame:
    """The counts without rows that came after their day was closed."""
    return _summed(_parts(spark, out_dir, delay_days).where(~F.col("late")))


def late_counts(spark: SparkSession, out_dir: str, delay_days: int = 2) -> DataFrame:
    """The side table: rows that came after their day was closed, counted by (date, city)."""
    return _summed(_parts(spark, out_dir, delay_days).where("late"))


def stream_out_of_order(spark: SparkSession, incidents: DataFrame) -> str:
    """Land the incidents of odd months, run the stream, land those of even months and go on, so that
    most of these are late; returns the folder of partial counts."""
    base = checkpoint_dir(spark).rstrip("/")
    src, out, mark = (f"{base}/late-{kind}-{uuid.uuid4().hex}" for kind in ("src", "out", "ckpt"))
    events = incidents.where(F.col("city").isNotNull())
    for odd in (1, 0):
        rows = events.where(F.month("date") % 2 == odd).select(day_start_utc(F.col("date")).alias("ts"), "city")
        rows.write.mode("append").parquet(src)
        run_partial_counts(spark, src, out, mark)
    return out
