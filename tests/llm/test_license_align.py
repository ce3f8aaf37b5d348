"""Patience alignment against brute force, and licenses in texts."""

from __future__ import annotations

import random
from itertools import combinations

from blotter.llm.license_align import TEMPLATES, Scanner, align, increasing, licenses


def test_increasing_by_brute_force():
    rng = random.Random(1)
    for _ in range(100):
        x = rng.sample(range(30), rng.randint(0, 8))
        got = increasing(x)
        best = max(k for k in range(len(x) + 1) for c in combinations(x, k) if list(c) == sorted(c))
        assert len(got) == best and [x[i] for i in got] == sorted(x[i] for i in got) and got == sorted(got)


def test_alignment_is_a_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 20))]
        b = tuple(rng.choice("abcdefgh") for _ in range(rng.randint(0, 20)))
        pairs = align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    assert len(align(list("xxabcdefyy"), tuple("abcdef"))) == 6


def test_notices_that_lost_their_rarest_words():
    scanner = Scanner(TEMPLATES)
    for t in scanner.templates:
        # as many words as may be lost, those that lead to the template first
        lost = sorted(range(len(t.words)), key=lambda i: (list(t.keys) + [t.words[i]]).index(t.words[i]))[: t.lost]
        text = " ".join("xyz" if i in lost else w for i, w in enumerate(t.words))
        assert t.name in [f[0] for f in scanner.find(f"before {text} after")]


def test_every_template_is_found_alone_and_changed():
    scanner = Scanner(TEMPLATES)
    rng = random.Random(3)
    for name, text in TEMPLATES.items():
        assert [(f[0], f[1]) for f in scanner.find(f"Some words before.\n{text}\nAnd after")] == [(name, 1.0)]
        words = text.split()
        if len(words) > 30:
            changed = [w if rng.random() > 0.06 else "changed" for w in words]
            assert name in [f[0] for f in scanner.find(" ".join(changed).upper())]
    assert scanner.find("The licence of a poet and the general public of Apache county in version 2.0") == []


def test_table(spark):
    mit = TEMPLATES["MIT"]
    rows = [(1, f"aé {mit} b {TEMPLATES['CC-BY-NC']}", "x"), (1, "plain", "y"), (None, mit, None), (4, None, None), (5, "", ""), (6, "word " * 200_000 + mit, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, license string")
    got = sorted(((r.doc_id or 0), r.license, r.start, r.end) for r in licenses(docs).collect())
    assert [g[:2] for g in got] == [(0, "MIT"), (1, "CC-BY-NC"), (1, "MIT"), (6, "MIT")]
    assert got[2][2:] == (3, 3 + len(mit) - 1) and got[3][2] == 1_000_000
    assert licenses(docs.limit(0)).count() == 0
