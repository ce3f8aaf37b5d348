"""What a worker or a written intermediate leaves behind between the stages of a job."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from blotter.llm import near_dups, spm_viterbi
from blotter.llm.common import map_docs
from blotter.session import checkpoint_dir, materialize


def _files(spark):
    return set(glob.glob(os.path.join(checkpoint_dir(spark).removeprefix("file://"), "blotter-*", "part-*")))


def test_a_small_table_of_known_size_is_written_by_few_tasks(spark):
    rows = spark.range(0, 1000, 1, 64)
    before = _files(spark)
    assert materialize(rows, 1000).count() == 1000 and len(_files(spark) - before) <= 6
    before = _files(spark)
    assert materialize(rows).count() == 1000 and len(_files(spark) - before) == 64


def test_rounds_of_connected_write_few_files(spark):
    """Each file costs an executor processes; many partitions once made 64 files a round and more."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).where("a % 30 <> 29")
        before = _files(spark)
        got = {r.id: r.label for r in near_dups.connected(edges, 290).collect()}
        assert got == {i: i - i % 30 for i in range(300)}
        new = _files(spark) - before
        assert len(new) <= 6 * len({os.path.dirname(f) for f in new})
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_worker_drops_the_coders_when_it_serves_another_operator(spark):
    docs = spark.createDataFrame([(i, f"some words {i}") for i in range(4)], "doc_id bigint, text string").coalesce(1)
    assert spm_viterbi.attach_ids(docs).where(F.size("ids") > 0).count() == 4

    def rows(_, ids, texts):
        import gc

        kinds = [type(o).__name__ for o in gc.get_objects()]
        return {"held": [kinds.count("Encoder")] * len(ids)}

    for _ in range(8):  # whichever of the workers serves it
        assert [r.held for r in map_docs(docs, ["doc_id", "text"], rows, "doc_id bigint, held bigint").collect()] == [0] * 4
