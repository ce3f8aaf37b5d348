"""A1 as a stream: late rows are told apart and merged; batches do not change the counts."""

import datetime as dt

from blotter.streaming import late_counts as LC
from blotter.streaming.daily_counts import EVENT_SCHEMA


def counts(df):
    return {(r["date"].day, r["city"]): r["crime_count"] for r in df.collect()}


def test_late_rows_are_merged(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("src", "out", "ckpt"))
    landed = [[(1, "A"), (1, "A"), (10, "B")], [(7, "A"), (1, None), (8, "B"), (11, "A")], [(9, "A"), (8, "B"), (1, "A"), (None, "A")]]
    for rows in landed:
        stamped = [(d and dt.datetime(2001, 1, d, 12), c) for d, c in rows]
        spark.createDataFrame(stamped, EVENT_SCHEMA).write.mode("append").parquet(src)
        LC.run_partial_counts(spark, src, out, ckpt)
    # marks: none, 8 January 12:00, 9 January 12:00
    assert counts(LC.late_counts(spark, out)) == {(1, None): 1, (7, "A"): 1, (8, "B"): 1, (1, "A"): 1}
    assert counts(LC.closed_counts(spark, out)) == {(1, "A"): 2, (10, "B"): 1, (8, "B"): 1, (11, "A"): 1, (9, "A"): 1}
    every = {}
    for d, c in (x for rows in landed for x in rows if x[0]):
        every[d, c] = every.get((d, c), 0) + 1
    assert counts(LC.merged_counts(spark, out)) == every
    # all files in one batch, by another checkpoint, give the same counts
    LC.run_partial_counts(spark, src, str(tmp_path / "again"), str(tmp_path / "ckpt2"))
    assert counts(LC.merged_counts(spark, str(tmp_path / "again"))) == every


def test_no_events(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    spark.createDataFrame([], EVENT_SCHEMA).write.parquet(src)
    LC.run_partial_counts(spark, src, out, str(tmp_path / "ckpt"))
    (tmp_path / "out").mkdir(exist_ok=True)
    for table in (LC.merged_counts(spark, out), LC.late_counts(spark, out)):
        assert table.isEmpty()
