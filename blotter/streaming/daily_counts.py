"""Streaming form of the daily city counts (A1, SURVEY section 2.9).

Incident files arriving in a folder are counted per (1-day event-time
window, city) with a watermark, so state for days older than the watermark
is dropped and late rows beyond it are ignored. Each micro-batch's updated
counts are written to a Parquet table through ``foreachBatch``, a folder a batch; the
current count of a (day, city) is its latest (largest) value.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.session import checkpoint_dir

EVENT_SCHEMA = T.StructType([T.StructField("ts", T.TimestampType()), T.StructField("city", T.StringType())])


def day_start_utc(d):
    """A date's midnight UTC as an instant, whatever the session time zone (1-day
    windows are aligned to UTC epoch days)."""
    return F.timestamp_seconds(F.unix_date(d).cast("long") * F.lit(86400))


def _epoch_day(ts):
    """The UTC epoch day of an instant, as a date (time-zone independent)."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int"))


def daily_counts_stream(events: DataFrame, watermark: str = "2 days") -> DataFrame:
    """Windowed, watermarked count per (day, city) of a streaming (ts, city) frame."""
    return (
        events.withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 day").alias("w"), "city")
        .agg(F.count(F.lit(1)).alias("crime_count"))
        .select(_epoch_day(F.col("w.start")).alias("date"), "city", "crime_count")
    )


def run_daily_counts(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str, watermark: str = "2 days") -> str:
    """Process the files of ``source_dir`` that ``checkpoint`` has not seen (availableNow
    trigger) and write the updated counts to ``out_dir``; returns ``out_dir``.

    State and progress live in ``checkpoint``, so a later run goes on from there. A batch
    that is tried again after a failure replaces its own folder."""
    events = spark.readStream.schema(EVENT_SCHEMA).parquet(source_dir)

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir}/batch={epoch}")

    q = (
        daily_counts_stream(events, watermark)
        .writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return out_dir


def current_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """The latest count per (date, city) from the appended updates."""
    return spark.read.parquet(out_dir).groupBy("date", "city").agg(F.max("crime_count").alias("crime_count"))


def stream_incident_counts(spark: SparkSession, incidents: DataFrame, watermark: str = "2 days") -> DataFrame:
    """End to end: land incident (ts, city) rows as files, stream them, return the counts."""
    base = checkpoint_dir(spark).rstrip("/")
    src = f"{base}/stream-src-{uuid.uuid4().hex}"
    out = f"{base}/stream-out-{uuid.uuid4().hex}"
    incidents.where(F.col("city").isNotNull()).select(
        day_start_utc(F.col("date")).alias("ts"), "city"
    ).write.parquet(src)
    run_daily_counts(spark, src, out, f"{base}/stream-{uuid.uuid4().hex}", watermark)
    return current_counts(spark, out)
