"""Removal of repeated passages against a brute-force version over all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import queries, suffix_dedup


def brute(rows, span):
    texts = [(t or "").encode() for _, t in rows]
    count = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for (doc_id, _), t in zip(rows, texts):
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - span + 1):
            if count[t[i : i + span]] > 1:
                gone[i : i + span] = True
        gone = gone[:-1]
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        left = bytes(b for b, g in zip(t, gone) if not g)
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def _texts(seed, docs=60):
    """Random texts that share passages of all lengths around the span, at all offsets, copies with edits among them."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé日") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(8, 60)) for _ in range(6)]
    rows = []
    for i in range(docs):
        t = prose(rng.randint(0, 40))
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            t += p[rng.randint(0, 9) : len(p) - rng.randint(0, 9)] + prose(rng.randint(0, 5))
        rows.append((i, t))
        if i % 7 == 0:
            k = rng.randint(0, max(len(t) - 1, 0))
            rows.append((1000 + i, t[:k] + "#" + t[k + 1 :]))
    return [*rows, (2000, None), (2001, ""), (2002, "z" * 700), (2003, "xy" * 300), (None, rows[0][1]), rows[3], (2004, " " * 40)]


@pytest.mark.parametrize(("seed", "group"), [(1, suffix_dedup.GROUP), (2, suffix_dedup.GROUP), (3, 1), (4, 3)])
def test_equals_brute_force(spark, seed, group):
    """Small buckets, and tokens that are too common for one (``group`` 1 and 3)."""
    rows = _texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"h": F.lit(1), "key": F.lit("clash"), "n": F.lit(0)}).repartition(3)
    got = suffix_dedup.remove_repeats(docs, span=60, group=group)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 60)


def test_long_texts_in_slices(spark, monkeypatch):
    """A text beyond a slice gives what it gives in one."""
    rng = random.Random(5)
    passage = "".join(rng.choice("abcd ") for _ in range(5000))
    rows = [(1, passage), (2, "".join(rng.choice("abcd ") for _ in range(3000)) + passage[700:4200]), (3, passage[1000:1500] + "tail")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, suffix_dedup.remove_repeats(docs).collect()))
    assert whole == brute(rows, 200)
    ends = np.array([len(t) for _, t in rows]).cumsum()
    monkeypatch.setattr(suffix_dedup, "SLICE", 900)
    pieces = list(suffix_dedup._pieces(ends, 200))
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    windows = []
    for _, lo, hi in pieces:
        inner = ends[(ends > lo) & (ends <= hi)] - lo
        _, s0, s1, _ = suffix_dedup.anchor_runs(data[lo:hi], inner if len(inner) and inner[-1] == hi - lo else np.append(inner, hi - lo), 200)
        windows += [w + lo for a, b in zip(s0, s1) for w in range(a, b + 1)]
    begins = [0, *ends[:-1]]
    assert sorted(windows) == [w for b, e in zip(begins, ends) for w in range(b, e - 199)]  # each window once


def test_multikey_sort_finds_all_repeats():
    rng = np.random.default_rng(3)
    span, runs = 24, 300
    bodies = [rng.choice(np.frombuffer(b"ab", np.uint8), size=span + 9) for _ in range(20)]
    rows = []
    for i in range(runs):
        b = bodies[rng.integers(20)].copy()
        b[rng.integers(len(b))] = ord("c")
        rows.append(b)
    group = np.sort(rng.integers(0, 12, runs))
    start = np.arange(runs) * (span + 9)
    first = rng.integers(0, 3, runs)
    last = first + rng.integers(0, 7, runs)
    anchor = rng.integers(0, 3, runs)
    run, window = suffix_dedup.repeated_windows(np.concatenate(rows), group, start, anchor, first, last, span)
    key = lambda i, w: (group[i], w - anchor[i], rows[i][w : w + span].tobytes())
    everything = [(i, w) for i in range(runs) for w in range(first[i], last[i] + 1)]
    count = Counter(key(i, w) for i, w in everything)
    assert sorted(zip(run.tolist(), window.tolist())) == sorted((i, w) for i, w in everything if count[key(i, w)] > 1)


def test_empty_table(spark):
    out = suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0 and out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_whole_table(spark):
    """The query over the smallest table, all windows of it compared by brute force."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op12_suffix_dedup(spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute(rows, 200)
