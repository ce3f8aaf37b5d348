"""Collocations against a brute-force version that lists every phrase, and the trie against plain counts."""

import random
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import collocations


def brute(rows, top, least, inside):
    count, total = Counter(), Counter()
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(fold)):
            ws = re.findall("[^ \t]+", piece)
            total[lang] += len(ws)
            for k in range(1, 5):
                for i in range(len(ws) - k + 1):
                    count[lang, tuple(ws[i : i + k])] += 1
    cand = {p: a for p, a in count.items() if len(p[1]) > 1 and a >= least}
    out = []
    for lang in total:
        kept = []
        for (g, ws), a in cand.items():
            if g != lang:
                continue
            if any(h == g and len(q) > len(ws) and any(q[i : i + len(ws)] == ws for i in range(len(q))) and 100 * b >= inside * a for (h, q), b in cand.items()):
                continue
            cuts = [(2_000_000 * a // (count[g, ws[:k]] + count[g, ws[k:]]), k, count[g, ws[:k]], count[g, ws[k:]]) for k in range(1, len(ws))]
            score, _, left, right = min(cuts)
            kept.append((-score, -a, " ".join(ws).encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def _rows(seed):
    rng = random.Random(seed)
    vocab = ["the", "The", "of", "a", "b-c", "été", "日本", "Ärger", "x\x00y", "\x1c", "z'z"]
    rows = []
    for i in range(120):
        words = [rng.choice(vocab[: rng.randint(2, len(vocab))]) for _ in range(rng.randint(0, 30))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!? "]) for w in words)
        rows.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), text))
    return [*rows, ("en", None), ("en", ""), (None, None), ("fr", "..."), ("en", "the of a " * 400), rows[0], rows[0]]


@pytest.mark.parametrize(("seed", "shard", "top"), [(1, 200_000, 2000), (2, 7, 5), (3, 40, 12)])
def test_equals_brute_force(spark, seed, shard, top):
    """One trie and many; the ranking's ties, null and empty languages, words of several scripts."""
    rows = _rows(seed)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumns({"n": F.lit(1), "ids": F.lit("clash")}).repartition(3)
    got = collocations.collocations(docs, top=top, least=6, shard=shard)
    assert sorted(map(tuple, got.collect())) == brute(rows, top, 6, 80)


def test_ids_that_collide(spark, monkeypatch):
    """Two words of one id lead to another seed."""
    monkeypatch.setattr(collocations, "prepare", lambda spark: None)
    encoded = collocations._encoded
    seeds = []

    def first_collides(texts, seed):
        seeds.append(seed)
        out = encoded(texts, seed)
        return out.withColumn("id", F.when(F.col("id").isNotNull(), F.lit(1 << 62))) if seed == 0 else out

    monkeypatch.setattr(collocations, "_encoded", first_collides)
    rows = [("en", "a b a b a b")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, least=2)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2000, 2, 80) and seeds == [0, 1]


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_trie_counts(k):
    rng = np.random.default_rng(k)
    ids = rng.integers(1, 60, 5000) * 10**9
    ids[rng.integers(0, 5000, 300)] = 0
    phrases = {tuple(ids[i : i + k]) for i in rng.integers(0, 4990, 900) if 0 not in ids[i : i + k]}
    phrases |= {tuple(rng.integers(1, 90, k) * 10**9) for _ in range(300)}
    columns = [np.array(c, dtype=np.int64) for c in zip(*sorted(phrases, key=hash))]
    want = Counter(tuple(ids[i : i + k]) for i in range(len(ids) - k + 1))
    got = collocations.DoubleArray(columns).counts(ids)
    assert got.tolist() == [want[p] for p in zip(*(c.tolist() for c in columns))]


def test_trie_is_compact():
    """Slots follow the phrases, also where hot words have many followers; phrases come back from their slots."""
    rng = np.random.default_rng(5)
    pairs = np.unique(rng.zipf(1.2, (400_000, 2)).clip(1, 60_000) * 977 % 60_013, axis=0).astype(np.int32)
    columns = list(pairs[rng.permutation(len(pairs))].T)
    trie = collocations.DoubleArray(columns)
    assert len(trie.base) < 5 * len(pairs)
    assert all((a == b).all() for a, b in zip(trie.phrases(trie.leaf), columns))


def test_bitmap_grows_with_its_phrases():
    hashes = np.unique(np.random.default_rng(6).integers(0, 1 << collocations.KEY_BITS, 9_000_000))
    some, others = hashes[::2], hashes[1::2]
    bits = collocations._Bits(len(some))
    bits.add(some)
    assert bits.hit(some).all() and bits.hit(others[:500_000]).mean() < 0.02 and bits.bits.nbytes < 64 * len(some)


def test_candidates_of_many_phrases_take_one_pass(spark, monkeypatch):
    """All pairs of 480 words occur: more than 200,000 phrases, one trie, and no candidate that is not frequent."""
    words = [f"w{i}" for i in range(480)]
    rows = [("en", ". ".join(f"{a} {b}" for b in words)) for a in words] * 2 + [("en", " ".join(words[::-1]))]
    built, init = [], collocations.DoubleArray.__init__

    def counted(self, columns):
        built.append((len(columns), len(columns[0])))
        init(self, columns)

    monkeypatch.setattr(collocations.DoubleArray, "__init__", counted)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = collocations.collocations(docs, least=2, top=300_000)
    assert got.count() == 480 * 480 and [n for k, n in built if k == 2] == [480 * 480]


def test_scores_beyond_64_bits(spark):
    a, left, right = 9 * 10**15, 9 * 10**15 + 7, 9 * 10**18
    row = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    score = row.select(collocations._cut_score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert score == int(Decimal(2_000_000) * a // (left + right))


def test_empty_table(spark):
    out = collocations.collocations(spark.createDataFrame([], "lang string, text string"))
    assert out.count() == 0 and out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
