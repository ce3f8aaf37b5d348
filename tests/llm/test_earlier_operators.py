"""Quality rules, token counts, near-duplicates, URL rules and secret scans against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import sentencepiece

from blotter.llm import common, near_dups, quality_gbt, secrets_markov, token_counts, url_rules
from blotter.llm.secrets_markov import base_spans


def _prose(rng, n, words=400):
    return " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, words)}" for _ in range(n))


def test_quality_counts_by_brute_force(spark):
    rng = random.Random(1)
    texts = [_prose(rng, rng.randint(0, 60), 3) + rng.choice(["", "\n", " #$ |\n"]) * rng.randint(0, 4) for _ in range(120)]
    texts += [None, "", "\n\n", "same line here\n" * 9, "a b c d e f g h " * 5]
    rows = [(i, t, True) for i, t in enumerate(texts)] + [(0, texts[0], True)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept boolean")
    got = quality_gbt.quality_scores(docs, quality_gbt.NO_TREES).collect()
    assert len(got) == len(rows)
    for r in got:
        text = texts[r.doc_id] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        twice = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        expected = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(words) < 20 or 100 * len(twice) > 30 * len(words)) and r.kept == (not r.base_failed)
    assert quality_gbt.keep_good(docs.limit(0), quality_gbt.NO_TREES).count() == 0


def test_trees_learn_and_rise():
    rng = np.random.default_rng(2)
    x = rng.random((1500, len(quality_gbt.FEATURES)))
    j = quality_gbt.FEATURES.index(quality_gbt.RISING[0])
    bad = (x[:, j] + 0.1 * rng.standard_normal(1500) > 0.6).astype(float)
    trees = quality_gbt.fit_trees(x[:1000], bad[:1000])
    assert ((trees.score(x[1000:]) > 0.5) == bad[1000:]).mean() > 0.85
    probe = np.repeat(x[:50], 20, axis=0)
    probe[:, j] = np.tile(np.linspace(0, 1, 20), 50)
    assert (np.diff(trees.score(probe).reshape(50, 20), axis=1) >= -1e-12).all()


def test_token_counts_equal_the_library(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abc thé.,\n 漢<s>▁09") for _ in range(rng.randint(0, 80))) for _ in range(200)] + [None, "", "word " * 5000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, n_tokens int")
    library = sentencepiece.SentencePieceProcessor(model_file=token_counts.tokenizer_path())
    for r in token_counts.token_counts(docs).collect():
        text = texts[r.doc_id] or ""
        n = len(library.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)


def test_components_by_brute_force(spark):
    rng = random.Random(4)
    base = [_prose(rng, rng.randint(5, 60)) for _ in range(40)]
    texts = base + [base[0]] * 60  # many copies
    for k in range(120):  # near copies of one text and of others
        words = base[1 if k < 60 else rng.randrange(40)].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"z{rng.randint(0, 99)}"
        texts.append(" ".join(words).upper() if k % 7 == 0 else "  ".join(words))
    texts += [None, "", "one", "ONE", " ", "two words"]
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets.append({tuple(w[k : k + 2]) for k in range(max(1, len(w) - 1))} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id bigint, text string, n int")
    got = {r.doc_id: r for r in near_dups.components(docs).collect()}
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), find(i), find(i) == i) for i in range(len(texts))
    }


def test_near_dups_inside_a_template_group(spark):
    """Sets that all draw on one template, below the threshold but for planted pairs: no node is small."""
    rng = np.random.default_rng(6)
    held = np.zeros((900, 180), np.int64)
    for i in range(900):
        held[i, rng.permutation(180)[:150]] = 1
    for i in range(0, 120, 2):
        held[i + 1] = held[i]
        held[i + 1, rng.permutation(np.flatnonzero(held[i] == 1))[:14]] = 0
        held[i + 1, rng.permutation(np.flatnonzero(held[i] == 0))[:14]] = 1
    both = held @ held.T
    alike = 100 * both >= 80 * (300 - both)
    assert alike.sum() < 900 + 2 * 70
    label = np.arange(900)
    while (near := np.where(alike, label[None], 900).min(axis=1)).tolist() != label.tolist():
        label = near
    texts = [" ".join(f"w{k}" for k in np.flatnonzero(row)) for row in held]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in near_dups.components(docs, width=1).collect()}
    assert got == dict(enumerate(label.tolist()))


def test_near_copies_need_few_links(spark, monkeypatch):
    """A large group of near copies is one component by few confirmed links a member, whatever its size."""
    tried, confirmed = [], near_dups._confirmed

    def counted(pairs, sets, percent):
        tried.append(pairs.count())
        return confirmed(pairs, sets, percent)

    monkeypatch.setattr(near_dups, "_confirmed", counted)
    rng = random.Random(9)
    for size in (400, 1600):
        base = [f"w{k}" for k in range(150)]
        texts = []
        for k in range(size):
            words = list(base)
            for _ in range(3):
                words[rng.randrange(150)] = f"z{k}"
            texts.append(" ".join(words))
        docs = spark.createDataFrame([*enumerate(texts), (size, "on its own"), (size + 1, None)], "doc_id bigint, text string")
        tried.clear()
        got = {r.doc_id: r.component_id for r in near_dups.components(docs).collect()}
        assert got == {**dict.fromkeys(range(size), 0), size: size, size + 1: size + 1}
        assert 1 <= sum(tried) / size < 3


def test_near_copies_make_few_candidates(spark, monkeypatch):
    """The pairs made of a large group of near copies are a few a member, before any is confirmed."""
    made, estimates = [], near_dups._estimates

    def counted(pairs, classes, least):
        made.append(pairs.count())
        return estimates(pairs, classes, least)

    monkeypatch.setattr(near_dups, "_estimates", counted)
    rng = random.Random(12)
    texts = []
    for k in range(600):
        words = [f"w{j}" for j in range(150)]
        for _ in range(3):
            words[rng.randrange(150)] = f"z{k}"
        texts.append(" ".join(words))
    got = near_dups.components(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.component_id for r in got} == {0}
    assert 600 <= sum(made) + 1 < 600 * 5


def test_many_failing_candidates_end(spark, monkeypatch):
    """Two groups of near copies, too unlike each other by a little: their many candidates fail in few rounds."""
    rounds, confirmed = [], near_dups._confirmed
    monkeypatch.setattr(near_dups, "_confirmed", lambda *a: rounds.append(1) or confirmed(*a))
    rng = random.Random(10)
    docs = []
    for k in range(160):
        words = [f"w{j}" if j < 128 or k % 2 else f"v{j}" for j in range(150)]  # 128 of 172 in both
        words[rng.randrange(128)] = f"z{k}"
        docs.append((k, " ".join(words)))
    got = near_dups.components(spark.createDataFrame(docs, "doc_id bigint, text string"), width=1).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: k % 2 for k in range(160)}
    assert len(rounds) <= 16


def test_secret_spans(spark):
    rng = random.Random(5)
    key = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(40))
    text = f"é api_key: 'abcd1234' AKIA{'A1' * 8} {'0f' * 20} plain_identifier_name_of_some_length {key}"
    docs = spark.createDataFrame([(1, text, ""), (1, text, ""), (2, None, ""), (3, "", "")], "doc_id bigint, text string, spans string")
    words = ["identifier", "length", "name", "plain", "some", "other", "thing", "value", "number", "order"]
    prose = [(i, " ".join("_".join(rng.sample(words, 3)) + " " + rng.choice(words) for _ in range(60))) for i in range(100)]
    model = secrets_markov.fit(spark.createDataFrame(prose, "doc_id bigint, text string"))
    rows = secrets_markov.secret_spans(docs, model).collect()
    assert sorted((r.doc_id, r.n_assign, r.n_access, r.n_hex) for r in rows) == [(1, 1, 1, 1), (1, 1, 1, 1), (2, 0, 0, 0), (3, 0, 0, 0)]
    at = text.index(key)
    found = [s for r in rows if r.doc_id == 1 for s in r.spans.split(",") if s.startswith("markov")]
    assert found == [f"markov:{at}:{at + 40}"] * 2
    assert [s[0] for s in base_spans(text)] == ["assign", "access", "hex"]
    clean = {r.doc_id: r.text for r in secrets_markov.redact(docs, model).collect()}
    assert key not in clean[1] and "plain_identifier_name_of_some_length" in clean[1] and clean[2] is None
    assert secrets_markov.secret_spans(docs.limit(0), secrets_markov.fit(docs.limit(0))).count() == 0


def test_url_verdicts(spark):
    urls = {
        1: ("http://a.NET/x?q", "a.net", "/x", "net/", "block"), 2: ("https://www.example.net/en/1#t", "www.example.net", "/en/1", "example.net/en/", "allow"),
        3: ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"), 4: ("x://b.org/fr/z", "b.org", "/fr/z", "org/fr/", "allow"),
        5: ("no scheme", "", "", None, "allow"), 6: (None, "", "", None, "allow"), 7: ("", "", "", None, "allow"),
        8: ("http://x.spam-farm.example/", "x.spam-farm.example", "/", None, "block"),
    }
    pages = spark.createDataFrame([(i, u[0], 1) for i, u in urls.items()], "page_id bigint, url string, host int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.url_verdicts(pages).collect()}
    assert got == {i: u[1:] for i, u in urls.items()}
    assert url_rules.url_verdicts(pages.limit(0)).count() == 0


def test_training_rows_are_bounded_and_ordinary_counts_whole(spark):
    docs = spark.createDataFrame([(None if i < 300 else 7, f"mail {i}@b.example") for i in range(600)], "doc_id bigint, text string")
    assert common.smallest(docs, 50, "doc_id", "text").count() == 50
    assert 0 < common.smallest(docs, 50, "doc_id", "text").where("doc_id IS NULL").count() < 50
    labels = spark.createDataFrame([(7, 1)], "doc_id bigint, quality int")
    ids = quality_gbt.labelled_sample(docs, labels, 20)
    assert len(ids[0]) == len(ids[1]) == 20
    # a word that one document of many holds is in the ordinary model
    prose = spark.range(4000).selectExpr("id doc_id", "if(id = 3999 OR id = 1, 'qxjzqxjz qxjzqxjz', 'some plain words') text")
    rare = secrets_markov.count_runs(b"qxjzqxjz")[3:]
    without = secrets_markov.fit(prose.where("doc_id NOT IN (1, 3999)"))
    assert (secrets_markov.fit(prose).ratio[rare] < without.ratio[rare]).all()


def test_trigram_counts_are_those_of_each_run_alone():
    import numpy as np

    from blotter.llm import secrets_markov as sm

    rng = np.random.default_rng(3)
    for n in (0, 1, 4, 50, 400):
        for least in (1, 4):
            raw = bytes(rng.choice(list(b"abXY09 -=\n!"), n).tolist())
            codes, starts, ends = sm.find_runs(raw, least)
            runs = [sm._trigrams(np.concatenate(([0, 0], codes[a:b]))) for a, b in zip(starts, ends)]
            assert sm.count_runs(raw, least).tolist() == [int(v) for r in runs for v in r]


def test_trigram_counting_takes_runs_together():
    """Work is by array, not by run: a text of many short runs makes a few calls."""
    from blotter.llm import secrets_markov as sm

    calls = []
    kept, sm._trigrams = sm._trigrams, lambda codes: calls.append(1) or kept(codes)
    try:
        assert len(sm.count_runs(b"word " * 1000)) == 4000
    finally:
        sm._trigrams = kept
    assert len(calls) <= 1
