"""Leaks against brute force: an alignment of every item with every text."""

from __future__ import annotations

import numpy as np

from blotter.llm import latent_leaks as L


def _sequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b):
            old, row[j + 1] = row[j + 1], old + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_length_by_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a = rng.integers(1, 9, rng.integers(1, 40)).astype(np.uint32)
        b = rng.integers(1, 9, rng.integers(0, 60)).astype(np.uint32)
        assert L.common_length(a, b) == _sequence(a.tolist(), b.tolist())


def test_blocks_and_projection():
    rng = np.random.default_rng(3)
    texts = [rng.integers(1, 2**32, n).astype(np.uint32) for n in (0, 1, 16, 17, 500)]
    b = L.Blocks.of([t.tobytes() for t in texts] + [None])
    table = rng.standard_normal((L.BUCKETS, 3)).astype(np.float32)
    expected = [t[a : a + 16] for t in texts for a in range(0, len(t), 16)]
    assert np.allclose(b.project(table), [table[x & (L.BUCKETS - 1)].sum(axis=0) for x in expected], atol=1e-4)


def _corpus():
    rng = np.random.default_rng(4)
    vocabulary = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 8))) for _ in range(3000)]
    prose = lambda n: " ".join(rng.choice(vocabulary, n, p=_ZIPF))
    items = [(i, prose(int(rng.integers(14, 60))) + ". " + prose(6) + ".") for i in range(30)]
    docs, planted = [], set()
    for d in range(300):
        text = prose(int(rng.integers(30, 400)))
        if d % 10 == 0:
            i = d // 10
            words = items[i][1].split()
            if d % 20 == 0:  # a paraphrase: every fifth word but for the answer is another
                words = [w if k % 5 or k >= len(words) - 6 else "other" for k, w in enumerate(words)]
            text = prose(37) + " " + " ".join(words).upper() + "*** " + text
            planted.add((d, i))
        docs.append((d, text, 1))
    return docs, items, planted


_ZIPF = 1 / np.arange(1, 3001)
_ZIPF = _ZIPF / _ZIPF.sum()


def test_planted_items_are_found_and_nothing_else(spark):
    docs, items, planted = _corpus()
    d = spark.createDataFrame(docs, "doc_id bigint, text string, item_id int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in L.leaks(d, b).collect()}
    memo, brute = L.Words(), set()
    for i, t in items:
        w = memo.of(t)
        answer = w[-6:].tobytes()
        for k, text, _ in docs:
            if L.judge(w, answer, memo.of(text))[2] and len(set(w.tolist()) & set(memo.of(text).tolist())) > len(w) // 2:
                brute.add((k, i))
    assert planted <= got
    assert got <= brute
    assert {r.doc_id for r in L.keep_clean(d, b).collect()} == {k for k, _, _ in docs} - {k for k, _ in got}


def test_a_passage_in_every_document_is_found(spark):
    docs, items, _ = _corpus()
    everywhere = items[3][1]
    d = spark.createDataFrame([(k, t + " " + everywhere, 1) for k, t, _ in docs], "doc_id bigint, text string, x int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    assert L.leaks(d, b).where("item_id = 3").select("doc_id").distinct().count() == len(docs)


def test_empty_null_repeated_and_long(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen. So it is so."
    b = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "***")], "item_id bigint, text string")
    filler = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, item), (1, item), (None, item), (4, None), (5, ""), (6, filler + " " + item + " " + filler), (7, "plain words")]
    d = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [(r.doc_id, r.item_id, r.share) for r in L.leaks(d, b).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 1.0), (1, 1, 1.0), (None, 1, 1.0), (6, 1, 1.0)], key=str)
    assert sorted(str(r.doc_id) for r in L.keep_clean(d, b).collect()) == ["4", "5", "7"]
    assert L.leaks(d.limit(0), b).count() == 0 and L.leaks(d, b.limit(0)).count() == 0
