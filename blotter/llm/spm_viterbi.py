"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The text (spaces as marks, one mark in front) is read character by character.
A boundary's backpointer is the piece that ends there on the surviving path:
for a BPE vocabulary a piece may follow another only if the two, joined, merge
back to just these two, which leaves at most one surviving piece per boundary
and makes the path that reaches the end the library's own encoding. Only the
boundaries within the longest piece's length can still be extended; when the
backpointer paths of all of these pass through one boundary, the ids up to it are
committed and the rest of the window goes on, so memory does not grow with the text.

No piece crosses the start of a word (proved when the vocabulary is loaded), so
all paths meet there, and words repeat: a worker remembers the ids of up to
``MEMO_SIZE`` distinct words and joins the rest of a text from them.

Characters outside the vocabulary are their UTF-8 byte pieces. Decoding joins
pieces and runs of byte pieces, turns marks into spaces and drops the first one;
it gives the text back exactly (a mark character in the text comes back as the
space that the library makes of it).

Defined results: a null text counts as empty and has no ids; an empty list
decodes to the empty text; ids outside the vocabulary and control ids decode to
nothing; broken byte runs decode to U+FFFD; repeated rows repeat the result; an
empty table gives an empty result; further columns are ignored by ``encode`` and
carried by ``attach_ids``.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from blotter.llm.common import kept, map_docs, prepare, texts_of
from blotter.llm.token_counts import _RUNS, MARK, MEMO_CHARS, Vocabulary, merge, tokenizer_path

MEMO_SIZE = 400_000
#: Characters (with the mark) after which words share their state.
PREFIX = 6


class Encoder:
    """Streaming encoder over one vocabulary."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.pieces = vocab.alone | {p for p in vocab.scores if len(p) == 1}
        self.longest = max(map(len, self.pieces))
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, bytes] = {}
        #: True for pieces, None for what longer pieces end with
        self.kinds: dict[str, bool | None] = dict.fromkeys((p[k:] for p in self.pieces for k in range(1, len(p))), None)
        self.kinds.update(dict.fromkeys(self.pieces, True))
        self.starts: dict[str, list[str | None]] = {}
        self.codes = {p: array("i", [i]).tobytes() for p, i in vocab.ids.items()}
        self.newline = self.ids(["\n"])

    def ids(self, pieces: Iterable[str]) -> bytes:
        """The pieces' ids as int32 bytes."""
        codes = self.codes
        return b"".join([codes.get(p) or self._bytes(p) for p in pieces])

    def _bytes(self, char: str) -> bytes:
        """A character outside the vocabulary as its byte pieces."""
        return array("i", [self.vocab.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]).tobytes()

    def _follows(self, a: str, b: str) -> bool:
        """Whether ``b`` may come right after ``a``."""
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) >= MEMO_SIZE:
                self.pairs.clear()
            ok = self.pairs[a, b] = merge(list(a + b), self.vocab.scores) == [a, b]
        return ok

    def stream(self, chars: Iterable[str]) -> Iterator[str]:
        """The pieces of a stream of characters, each as soon as it is certain."""
        n = self.longest
        text = ""  # the window
        ends: list[str | None] = [""]  # the piece that ends at each boundary of the window, None: no path
        before = ""  # the piece before the window
        for c in chars:
            text += c
            self._extend(text, ends, before)
            at = len(text)
            if at >= 2 * n:
                cut = self._meeting(ends, at)
                if cut:
                    done = self._path(ends, cut)
                    yield from done
                    before, text = done[-1], text[cut:]
                    ends = ["", *ends[cut + 1 :]]
        yield from self._path(ends, len(text))

    def _extend(self, text: str, ends: list[str | None], before: str) -> None:
        """Add the piece that survives at the window's new last boundary."""
        at = len(text)
        pieces, pairs = self.pieces, self.pairs
        for start in range(at - 1, max(0, at - self.longest) - 1, -1):
            last = ends[start]
            if last is None:
                continue
            piece = text[start:]
            if piece not in pieces and start < at - 1:
                continue
            last = last or before
            if last:
                ok = pairs.get((last, piece))
                if not (self._follows(last, piece) if ok is None else ok):
                    continue
            ends.append(piece)
            return
        ends.append(None)

    def _window(self, word: str) -> list[str | None]:
        """The surviving pieces of a word that is one window. Words with the same
        ``PREFIX`` characters go on from the same state, which is remembered."""
        if len(word) <= PREFIX:
            ends: list[str | None] = [""]
        else:
            known = self.starts.get(word[:PREFIX])
            if known is None:
                if len(self.starts) >= MEMO_SIZE:
                    self.starts.clear()
                known = self.starts[word[:PREFIX]] = self._window(word[:PREFIX])
            ends = known.copy()
        kinds, pairs = self.kinds, self.pairs
        for at in range(len(ends), len(word) + 1):
            found = None
            for start in range(at - 1, -1, -1):
                piece = word[start:at]
                kind = kinds.get(piece, start == at - 1)
                if kind is False:
                    break  # no piece ends like this
                last = ends[start]
                if kind is None or last is None:
                    continue
                if last:
                    ok = pairs.get((last, piece))
                    if not (self._follows(last, piece) if ok is None else ok):
                        continue
                found = piece
                break
            ends.append(found)
        return ends

    def _meeting(self, ends: list[str | None], at: int) -> int:
        """The last boundary that every path open at ``at`` passes through.

        Open boundaries are those that a piece can still start at. The one with
        the largest index steps back until all stand on one boundary."""
        live = {b for b in range(max(0, at - self.longest + 1), at + 1) if ends[b] is not None}
        while len(live) > 1:
            top = max(live)
            live.remove(top)
            live.add(top - len(ends[top]))
        return live.pop() if live else 0

    @staticmethod
    def _path(ends: list[str | None], at: int) -> list[str]:
        out: list[str] = []
        while at > 0:
            out.append(ends[at])
            at -= len(ends[at])
        return out[::-1]

    def word(self, word: str) -> bytes:
        """The ids of one pre-token, remembered if it is short."""
        got = self.memo.get(word)
        if got is None:
            if len(word) < 2 * self.longest:  # the whole word is one window
                got = self.ids(self._path(self._window(word), len(word)))
            else:
                got = self.ids(self.stream(word))
            if len(word) <= MEMO_CHARS:
                if len(self.memo) >= MEMO_SIZE:
                    self.memo.clear()
                self.memo[word] = got
        return got

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as int32 bytes, word by word."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        out: list[bytes] = []
        # newlines stand alone where no longer piece holds one; words begin at a mark after another character
        lines = marked.split("\n") if self.vocab.breaks else [marked]
        memo, word = self.memo, self.word
        for k, line in enumerate(lines):
            if k:
                out.append(self.newline)
            if not line:
                continue
            words = line.split(MARK)
            if MARK + MARK in line or line[-1] == MARK:
                out += map(word, _runs(line))
                continue
            if words[0]:
                out.append(word(words[0]))
            for w in words[1:]:
                w = MARK + w
                out.append(memo.get(w) or word(w))
        return b"".join(out)


def _runs(line: str) -> list[str]:
    """Pre-tokens of a line with runs of marks: marks with the characters after them."""
    return _RUNS.findall(line)


class Decoder:
    def __init__(self, vocab: Vocabulary):
        size = max([*vocab.ids.values(), *vocab.byte_ids]) + 1
        self.piece = [""] * size
        for p, i in vocab.ids.items():
            self.piece[i] = p
        self.byte = {i: b for b, i in enumerate(vocab.byte_ids) if i >= 0}
        self.plain = np.ones(size, bool)
        self.plain[[i for i in self.byte]] = False

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < len(self.piece))]
        table = self.piece
        odd = np.flatnonzero(~self.plain[ids])
        if not len(odd):
            text = "".join([table[i] for i in ids.tolist()])
        else:
            parts, at = [], 0
            for run in np.split(odd, np.flatnonzero(np.diff(odd) > 1) + 1):
                a, b = int(run[0]), int(run[-1]) + 1
                parts += [table[i] for i in ids[at:a].tolist()]
                raw = bytes(self.byte[i] for i in ids[a:b].tolist())
                try:
                    parts.append(raw.decode("utf-8", "surrogatepass"))
                except UnicodeDecodeError:
                    parts.append(raw.decode("utf-8", "replace"))
                at = b
            text = "".join([*parts, *[table[i] for i in ids[at:].tolist()]])
        return text.replace(MARK, " ").removeprefix(" ")


def _coders(vocab: Vocabulary) -> tuple[Encoder, Decoder]:
    """One pair per worker process and vocabulary, so the memo serves later tasks of this kind."""
    return kept(("coders", id(vocab)), lambda: (Encoder(vocab), Decoder(vocab)))


def _lists(encoded: list[bytes]) -> pa.Array:
    """Id lists as one Arrow column, without a Python object per id."""
    offsets = np.concatenate(([0], np.cumsum([len(e) // 4 for e in encoded]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(encoded), np.int32)))


def encode(docs: DataFrame, vocab_path: str | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """id, n_tokens, ids and ``exact`` (the ids decode to the text), one row per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocab_path or tokenizer_path()))

    def rows(coders, keys, texts):
        encoder, decoder = coders
        texts = [t or "" for t in texts]
        made = [encoder.encode(t) for t in texts]
        back = [decoder.decode(np.frombuffer(e, np.int32)) for e in made]
        return {
            "n_tokens": [len(e) // 4 for e in made],
            "ids": _lists(made),
            "exact": [b == (t.replace(MARK, " ") if MARK in t else t) for b, t in zip(back, texts)],
        }

    kind = dict(docs.dtypes)[id_col]
    return map_docs(
        docs, [id_col, text_col], rows, f"`{id_col}` {kind}, n_tokens bigint, ids array<int>, exact boolean", lambda: _coders(shared.value), keeps=True
    )


def decode(encoded: DataFrame, vocab_path: str | None = None, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """id and text of id lists; a null list gives the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.load(vocab_path or tokenizer_path()))

    def rows(coders, keys, lists):
        return {"text": [coders[1].decode(np.array([i for i in x or [] if i is not None], np.int64)) for x in lists]}

    kind = dict(encoded.dtypes)[id_col]
    return map_docs(encoded, [id_col, ids_col], rows, f"`{id_col}` {kind}, text string", lambda: _coders(shared.value), keeps=True)


def attach_ids(docs: DataFrame, vocab_path: str | None = None, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The documents with all their columns and their ids in ``ids_col``; a column of that name is replaced."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    prepare(docs.sparkSession)
    docs = docs.select(*[docs[c] for c in docs.columns if c != ids_col])
    schema = StructType([*docs.schema.fields, StructField(ids_col, ArrayType(IntegerType()))])
    target, at = to_arrow_schema(schema), docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(vocab_path or tokenizer_path()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = _coders(shared.value)
        for batch in batches:
            ids = _lists([encoder.encode(t) for t in texts_of(batch.column(at))])
            arrays = [a.cast(f.type) for a, f in zip([*batch.columns, ids], target)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return docs.mapInArrow(run, schema)
