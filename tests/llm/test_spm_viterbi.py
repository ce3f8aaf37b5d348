"""Streaming encoding against the library, and exact round trips."""

from __future__ import annotations

import random

import numpy as np
import pytest
import sentencepiece

from blotter.llm.spm_viterbi import Decoder, Encoder, attach_ids, decode, encode
from blotter.llm.token_counts import Vocabulary, tokenizer_path


@pytest.fixture(scope="module")
def coders():
    vocab = Vocabulary.load(tokenizer_path())
    return Encoder(vocab), Decoder(vocab), sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


def _texts():
    rng = random.Random(5)
    alphabet = list("aaabcdeeehinorst   \n\t.,!éß漢字😀▁09<s>") + ["tion", "the ", "  ", "\n\n"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(1500)] + [
        "", " ", "\n", "a", " a ", "aaaa" * 60, "hello  world\n\n x", "<s> </s> <unk> <0x0A>", "unbroken" * 400, "\x00a", "é" * 300,
    ]


def test_ids_equal_the_library_and_round_trip(coders):
    encoder, decoder, library = coders
    for t in _texts():
        ids = np.frombuffer(encoder.encode(t), np.int32)
        assert ids.tolist() == library.encode(t), t
        assert decoder.decode(ids) == t.replace("▁", " ")


def test_stream_over_a_long_run_keeps_a_small_window(coders):
    encoder, _, library = coders
    text = "thequickbrownfoxjumpsoverthelazydog" * 300
    seen = 0

    def chars():
        nonlocal seen
        for c in "▁" + text:
            seen += 1
            yield c

    early = next(iter(encoder.stream(chars())))
    assert early and seen <= 8 * encoder.longest
    assert [library.piece_to_id(p) for p in encoder.stream("▁" + text)] == library.encode(text)


def test_tables(spark, coders):
    library = coders[2]
    rows = [(1, "one two", 5), (1, "one two", 5), (None, None, None), (4, "", 1), (5, "x y\n" * 30_000, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    got = encode(docs)
    assert {r.doc_id: r.ids for r in got.collect()} == {i: library.encode(t or "") for i, t, _ in rows}
    assert all(r.exact for r in got.collect())
    assert {r.doc_id: r.text for r in decode(got).collect()} == {i: t or "" for i, t, _ in rows}
    kept = attach_ids(docs)
    assert kept.columns == ["doc_id", "text", "ids"] and kept.count() == 5
    assert encode(docs.limit(0)).count() == 0
