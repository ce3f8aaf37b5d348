"""Session helpers: a local builder for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession


#: One scratch folder, whichever thread asks first.
_FOLDER = threading.Lock()


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "blotter") -> SparkSession:
    """Local session for tests and the bench; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BLOTTER_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` from the session. Where it is unset, a local
    session (one machine, as in tests) gets a scratch folder; on a cluster, whose
    executors would each write to their own disk, that is an error.
    """
    with _FOLDER:
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            master = spark.sparkContext.master
            if not re.fullmatch(r"local(\[[^]]*\])?", master):
                raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
            conf = tempfile.mkdtemp(prefix="blotter-ckpt-")
            spark.conf.set("spark.checkpoint.dir", conf)
        spark.sparkContext.setCheckpointDir(conf)
        return conf


#: Rows that a file of a table of known size holds at least, and the least number of files.
FILE_ROWS, FILES = 10_000, 6


def materialize(df, most: int | None = None, block: int | None = None):
    """Write a small intermediate once as a Parquet table in the shared
    ``spark.checkpoint.dir`` and read it back, so several consumers read it
    instead of re-running its lineage over the raw table. This cuts the
    lineage (a lost executor does not replay the raw scan), computes the plan
    once (an RDD checkpoint runs it a second time to write), and keeps
    columnar reads and size statistics for the planner.

    ``most`` bounds the table's rows, where that is known: a small one is then written by as few
    tasks as its rows need, however many partitions it was computed in. Each file costs
    its executor processes of its own (Hadoop sets permissions by ``chmod``). ``block`` bounds the bytes
    that the writer of a file holds before it passes them on, for wide tables."""
    spark = df.sparkSession
    if most is not None:
        df = df.coalesce(max(FILES, -(-most // FILE_ROWS)))
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/blotter-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    if block is not None:
        writer = writer.option("parquet.block.size", block)
    writer.parquet(path)
    return spark.read.parquet(path)


def materialize_all(frames: dict, max_workers: int = 8) -> dict:
    """``materialize`` several independent small intermediates as concurrent
    Spark jobs (one driver thread each), so their few tasks share the cluster
    instead of running one job after another."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        futures = {k: pool.submit(materialize, v) for k, v in frames.items()}
        return {k: f.result() for k, f in futures.items()}


def write_all(frames: dict, max_workers: int = 8) -> None:
    """Write independent frames, by path, as concurrent Spark jobs (see ``materialize_all``)."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        for f in [pool.submit(df.write.mode("overwrite").parquet, path) for path, df in frames.items()]:
            f.result()
