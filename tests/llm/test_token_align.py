"""Token alignment against a brute-force version that uses the libraries themselves."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blotter.llm import queries, token_align


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def _byte_level():
    """The byte of each character of a byte-level token, by the published rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(odd)}


def brute(rows, libraries):
    a, b = libraries
    to_byte = _byte_level()
    docs = []
    for doc_id, text in rows:
        s = (" " + text).encode() if text else b""
        ia = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ib = b.encode(text) if text else []
        ba = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ia]
        bb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ib)]
        if not s or b"".join(ba) != s or b"".join(bb) != s:
            docs.append((doc_id, [], [], [], []))
            continue
        span = lambda ids, parts: [(i, sum(map(len, parts[:k])), sum(map(len, parts[: k + 1]))) for k, i in enumerate(ids)]
        xa, xb = span(ia, ba), span(ib, bb)
        links = [(i, j) for i, p, q in xa for j, r, t in xb if p < t and r < q]
        ends = sorted({q for *_, q in xa} & {q for *_, q in xb})
        groups, lo = [], 0
        for e in ends:
            mine = [[str(i) for i, _, q in x if lo < q <= e] for x in (xa, xb)]
            groups.append("|".join(map(",".join, mine)))
            lo = e
        docs.append((doc_id, ia, ib, groups, links))
    count = Counter(x for d in docs for x in d[4])
    best = {}
    for (_, j), n in count.items():
        best[j] = max(best.get(j, 0), n)
    return sorted(
        (
            (i, len(ia), len(ib), len(g), len(ln), sum(count[x] == best[x[1]] for x in ln), sum(count[x] for x in ln),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
            for i, ia, ib, g, ln in docs
        ),
        key=str,
    )


TEXTS = [
    (1, "The quick  brown fox, 12345 déjà vu — naïve 日本語 text."),
    (2, None),
    (3, ""),
    (4, " "),
    (5, "holds ▁ the mark"),
    (6, "<|endoftext|> and </s> <s> <0x41> are text"),
    (7, "a" * 300 + " " + "xyz123" * 40),
    (8, "\t\n  mixed   white space \n\n\n end  "),
    (9, "🙂🙂 emoji 🇩🇪 ﬁ ligature ① é"),
    (10, "word " * 200),
    (10, "word " * 200),
    (None, "an id that is null"),
    (12, "Donaudampfschifffahrtsgesellschaft's über'll I've " * 12 + "tail"),
    (13, "plain words and ▁ far behind " + "some more words here " * 30),
]


@pytest.mark.parametrize(("chunk", "pair_rows"), [(token_align.CHUNK, 2_000_000), (40, 30), (97, 400)])
def test_equals_brute_force(spark, libraries, chunk, pair_rows):
    """Whole texts, byte ranges in many steps, and pair counts in many blocks give the same."""
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("codes", F.lit("clash")).repartition(3)
    got = token_align.alignments(docs, chunk=chunk, pair_rows=pair_rows)
    assert sorted(map(tuple, got.collect()), key=str) == brute(TEXTS, libraries)


def test_cuts_only_near_safe_points():
    s = " " + "ab cd " * 10 + "x" * 500 + " ef gh" * 10
    for c, before, after in token_align.cuts(s, 16, 20)[1:-1]:
        assert before <= c <= after and s[before] == " " == s[after]
        assert not s[before - 1].isspace() and not s[before + 1].isspace()
    assert len(token_align.cuts(s, 16, 20)) < len(s) // 16  # cuts in the long word are left out


def test_composition_is_associative(libraries):
    """Any way of putting three neighbouring fragments together leaves the same open ends and groups."""
    import tiktoken  # noqa: F401

    tables = token_align.Tables.load(token_align.tokenizer_path("byte_bpe_50k.tiktoken"), token_align.tokenizer_path())
    aligner = token_align.Aligner(tables)
    s = " Donaudampfschiffe überqueren unaufhaltsam Xyzzyplugh"
    for x in range(3, 20, 4):
        for y in range(x + 3, 40, 5):
            parts = []
            for lo, hi in ((0, x), (x, y), (y, len(s))):
                f = aligner.fragment(s, 0, lo, len(s) - hi)
                parts.append({k: list(v) if hasattr(v, "__len__") and not isinstance(v, bytes) else v for k, v in f.items()})
            ab, g1 = token_align.compose(parts[0], parts[1])
            left, g2 = token_align.compose(ab, parts[2])
            bc, h1 = token_align.compose(parts[1], parts[2])
            right, h2 = token_align.compose(parts[0], bc)
            assert left == right
            assert [g for g in (g1, g2) if g] == [g for g in (h2, h1) if g]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = token_align.alignments(docs)
    assert out.count() == 0
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_whole_table(spark, libraries):
    """The query over the smallest table; the digest, groups and links of a slice against brute force."""
    got = {r["doc_id"]: tuple(r) for r in queries.op11_token_align(spark, "/root/testdata/sf0.001").collect()}
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert len(got) == len(rows)
    few = [r for r in rows if r[1] and len(r[1]) < 1500][:40]
    for row in brute(few, libraries):
        assert got[row[0]][:5] == row[:5] and got[row[0]][7] == row[7]
