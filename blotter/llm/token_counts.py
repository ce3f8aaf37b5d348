"""Token counts of a BPE SentencePiece vocabulary by the whole-token shortcut.

The vocabulary is read once on the driver. Offline, two facts are proved from
it: (1) no piece holds a space mark after another character, so merges never
cross the start of a word and a text's count is the sum over its pre-tokens;
(2) which vocabulary strings merge back to themselves, that is, encode alone
as one token. Pre-tokens that are such strings are counted directly; only the
rest go through the merge loop, once per distinct string in a worker's memo.

Defined results: a null text counts as empty, an empty text has 0 bytes and 0
tokens, rows are independent (repeated rows repeat the result), an empty table
gives an empty result, and further input columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from blotter.llm.common import map_docs

MARK = "▁"
#: Distinct merged pre-tokens that a worker's memo holds before it starts anew.
MEMO_SIZE = 400_000
#: Longer pre-tokens are counted without being remembered.
MEMO_CHARS = 64
_NO_PAIR = float("-inf")
_RUNS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


def tokenizer_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces and scores of a SentencePiece model, and the facts proved from them."""

    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: tuple[int, ...]
    unk_id: int
    alone: frozenset[str]
    breaks: str  # characters of a text that no multi-character piece holds

    @staticmethod
    def load(path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        scores: dict[str, float] = {}
        ids: dict[str, int] = {}
        byte_ids = [-1] * 256
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                scores[piece] = sp.get_score(i)
                ids[piece] = i
        if any(MARK in p.lstrip(MARK) for p in scores):
            raise ValueError("a piece crosses a word start: pre-tokens are not independent")
        if sp.encode("\n a", out_type=str)[0] != MARK or len(sp.encode("a  b \n")) < 5:
            raise ValueError("the model's normaliser is not the identity with a dummy prefix")
        joined = {c for p in scores if len(p) > 1 for c in p}
        breaks = "\n" if "\n" not in joined else ""
        alone = frozenset(p for p in scores if len(merge(list(p), scores)) == 1)
        return Vocabulary(scores, ids, tuple(byte_ids), sp.unk_id(), alone, breaks)


def merge(symbols: list[str], scores: dict[str, float]) -> list[str]:
    """BPE merges of one pre-token: the best-scored adjacent pair first, the
    leftmost of equals, until no pair is a piece."""
    if len(symbols) > 48:
        return _merge_long(symbols, scores)
    get = scores.get
    pairs = [get(a + b, _NO_PAIR) for a, b in zip(symbols, symbols[1:])]
    while pairs:
        best = max(pairs)
        if best == _NO_PAIR:
            break
        i = pairs.index(best)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = get(symbols[i] + symbols[i + 1], _NO_PAIR)
        if i:
            pairs[i - 1] = get(symbols[i - 1] + symbols[i], _NO_PAIR)
    return symbols


def _merge_long(symbols: list[str], scores: dict[str, float]) -> list[str]:
    """The same merges with a heap over a linked list: n log n for long runs."""
    n = len(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    piece: list[str | None] = list(symbols)
    heap: list[tuple[float, int, int, str]] = []

    def push(a: int, b: int) -> None:
        joined = piece[a] + piece[b]
        s = scores.get(joined)
        if s is not None:
            heapq.heappush(heap, (-s, a, b, joined))

    for i in range(n - 1):
        push(i, i + 1)
    while heap:
        _, a, b, joined = heapq.heappop(heap)
        if piece[a] is None or right[a] != b or b >= n or piece[b] is None or piece[a] + piece[b] != joined:
            continue
        piece[a], piece[b] = joined, None
        right[a] = right[b]
        if right[b] < n:
            left[right[b]] = a
            push(a, right[b])
        if left[a] >= 0:
            push(left[a], a)
    return [p for p in piece if p is not None]


class _Memo(dict):
    """Token count by pre-token: filled with the whole-token strings, then with merged ones."""

    def __init__(self, vocab: Vocabulary, prefix: str):
        self.vocab, self.prefix = vocab, prefix
        n = len(prefix)
        self.direct = {p[n:]: 1 for p in vocab.alone if p.startswith(prefix) and MARK not in p[n:] and len(p) > n}
        super().__init__(self.direct)

    def __missing__(self, word: str) -> int:
        n = pretoken_tokens(self.prefix + word, self.vocab)
        if len(word) <= MEMO_CHARS:
            if len(self) > MEMO_SIZE:
                self.clear()
                self.update(self.direct)
            self[word] = n
        return n


def pretoken_tokens(pre: str, vocab: Vocabulary) -> int:
    """Tokens of one pre-token; a character outside the vocabulary counts its UTF-8 bytes."""
    if pre in vocab.alone:
        return 1
    known = vocab.scores
    return sum(
        1 if p in known else len(p.encode("utf-8", "surrogatepass")) for p in merge(list(pre), known)
    )


class Counter:
    """Counts whole texts: lines where a newline is a break, then words, then the memo."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.inner = _Memo(vocab, MARK)  # words after one space
        self.first = _Memo(vocab, "")  # what a line starts with
        self.newline = pretoken_tokens("\n", vocab)

    def count(self, text: str) -> int:
        if not text:
            return 0
        if MARK in text:
            text = text.replace(MARK, " ")
        lines = (" " + text).split("\n") if self.vocab.breaks else [" " + text]
        total = self.newline * (len(lines) - 1)
        for line in lines:
            if not line:
                continue
            if "  " in line or line[-1] == " ":
                total += sum(self._run(r) for r in _RUNS.findall(line.replace(" ", MARK)))
                continue
            words = line.split(" ")
            head = words[0]
            total += sum(map(self.inner.__getitem__, words[1:]))
            if head:
                total += self.first[head]
        return total

    def _run(self, run: str) -> int:
        if run[0] == MARK and len(run) > 1 and run[1] != MARK:
            return self.inner[run[1:]]
        return pretoken_tokens(run, self.vocab)


def token_counts(
    docs: DataFrame,
    vocab_path: str | None = None,
    limit: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """UTF-8 bytes, tokens and ``over_limit`` (more than ``limit`` tokens) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocab_path or tokenizer_path()))

    def rows(counter: Counter, ids: list, texts: list) -> dict:
        texts = ["" if t is None else t for t in texts]
        tokens = [counter.count(t) for t in texts]
        return {
            "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
            "n_tokens": tokens,
            "over_limit": [n > limit for n in tokens],
        }

    kind = dict(docs.dtypes)[id_col]
    return map_docs(
        docs,
        [id_col, text_col],
        rows,
        f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean",
        start=lambda: _counter(shared.value),
    )


_COUNTERS: dict[int, Counter] = {}


def _counter(vocab: Vocabulary) -> Counter:
    """One counter per worker process and vocabulary, so its memo serves later tasks."""
    key = id(vocab)
    if key not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[key] = Counter(vocab)
    return _COUNTERS[key]
