"""Collocations: the best phrases of two to four words of each language.

Texts become arrays of 64-bit word ids (0 between pieces), written once, and then of numbers of
the frequent words of 32 bits, where runs of other words are one break. Level by level,
the phrases of ``k`` words that may be frequent are found Apriori-safe: both phrases of
``k - 1`` words inside must be frequent, and so must the phrase's own hash be, whose places
are summed first. Both tests read bitmaps that grow with the frequent phrases (a wrong hit only lets one phrase
more be counted). The candidates, in shards of at most about
``SHARD``, become double-array tries that are broadcast; numpy advances the states of
all text positions of a block together, a word a step, and counts accepting states. Spark sums
the tasks' and shards' counts, which decide what is frequent. A shard is a pass over the texts, so tries are
compact and shards are large.

A double-array trie has one slot a node: the child of node ``s`` by digit ``d`` of a word is slot
``base[s] + d``, if ``check`` there names ``s``.

Word ids are hashes of language and word; two words of one id are noticed, and the texts
are read again with another seed. So all counts are exact, and scores are computed in decimals of 38 digits.

Defined results: null texts are empty, a null language is ``und``; a word or phrase counts
at each place, overlaps included; repeated rows count again; very long texts take many rows; ties are ranked by score, count, then phrase in byte order, which is total. An empty
table gives an empty result; further input columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import prepare
from blotter.session import materialize

#: Least size of a bitmap of likely phrases: 8 MB. It grows with them, to at least ``BITS_EACH`` bits for each.
BITS, BITS_EACH, PROBES = 1 << 26, 12, 4
#: Bits of a phrase's hash, and those that say which slice of a sum it belongs to.
KEY_BITS, SLICE_BITS = 42, 11
#: Different phrases that a task counts before it passes them on.
HELD_ROWS = 1_500_000
#: Phrases of a trie, on average; shards are dealt by hash. Each takes a pass over the texts, and a trie about 24 bytes a phrase.
SHARD = 2_000_000
#: Children of a node that is placed by itself; nodes of fewer are placed together.
WIDE = 8
#: Words of a row of ids (whole pieces, so that a longer piece makes a longer row): a batch of rows stays small.
ROW = 4_096
#: Bytes that a writer of rows of ids or words holds: an executor has two, beside its Python workers.
WRITTEN = 16 << 20
#: Words whose positions are worked on together.
BLOCK = 400_000
#: Distinct words that a task counts before it passes them on.
HELD_WORDS = 150_000
#: Word ids that a worker remembers.
MEMO_SIZE = 150_000
LONGEST = 4
_BREAK = b"\xff"  # no byte of UTF-8
_SPLIT = bytes(0xFF if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: list[str]) -> list[bytes]:
    """Words of texts in order, with ``_BREAK`` between pieces and texts."""
    joined = "\n".join(texts).encode().lower().translate(_SPLIT)  # bytes.lower() changes A-Z only
    return joined.replace(_BREAK, b" \xff ").split()


class _Ids(dict):
    """Ids of one language's words; 0 is the break's."""

    def __init__(self, lang: str, seed: int):
        super().__init__({_BREAK: 0})
        self.prefix, self.seed = lang.encode() + b"\x00", seed

    def __missing__(self, word: bytes) -> int:
        import xxhash

        # bit 62 set: an id is never 0, and its sign is kept free
        i = xxhash.xxh3_64_intdigest(self.prefix + word, self.seed) >> 2 | 1 << 62
        self[word] = i
        return i


def phrase_hashes(columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of ``KEY_BITS`` bits of phrases that are given word by word."""
    h = np.zeros(len(columns[0]), dtype=np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - KEY_BITS)).astype(np.int64)


class DoubleArray:
    """A trie of phrases of one length over word numbers, in two arrays of 32 bits. A word is two steps, the digits of its
    label, so that no node is wide and few slots stay empty; words in many phrases have low labels. A phrase is its
    last slot, from which ``check`` leads back to its words."""

    def __init__(self, columns: list[np.ndarray]):
        n, self.depth = len(columns[0]), len(columns)
        self.words, dense = np.unique(np.concatenate(columns), return_inverse=True)
        by_use = np.argsort(-np.bincount(dense, minlength=len(self.words)), kind="stable")
        self.words = self.words[by_use]  # of each label
        label = np.empty(len(by_use), dtype=np.int32)
        label[by_use] = np.arange(len(by_use), dtype=np.int32)
        dense = label[dense.reshape(self.depth, n)]
        self.digits = int(len(self.words) ** 0.5) + 1
        dense = np.stack([dense // self.digits, dense % self.digits], 1).reshape(2 * self.depth, n)
        order = np.lexsort(dense[::-1])
        dense = dense[:, order]
        size = 2 * n + len(self.words) + 64
        self.base, self.check = np.zeros(size, dtype=np.int32), np.full(size, -1, dtype=np.int32)
        self.check[0] = 0  # the root, which is no node's child: states start there
        self._used = np.zeros(size, dtype=bool)
        self._used[0] = True
        self._tail = 1  # no slot from here on is used
        self._rng = np.random.default_rng(n)
        node = np.zeros(n, dtype=np.int64)  # of each phrase, so far
        for d in dense:
            new = np.concatenate(([True], (node[1:] != node[:-1]) | (d[1:] != d[:-1]))) if n else np.zeros(0, bool)
            first = np.flatnonzero(new)  # one entry a child
            child = self._place(node[first], d[first].astype(np.int64))
            self.check[child] = node[first]
            node = child[np.cumsum(new) - 1]
        self.base, self.check = self.base[: self._tail].copy(), self.check[: self._tail].copy()
        self.leaf = np.empty(n, dtype=np.int64)  # each phrase's last slot
        self.leaf[order] = node
        del self._used, self._tail, self._rng

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "leaf"}

    def _grow(self, to: int) -> None:
        if to > len(self.base):
            more = max(to, len(self.base) * 5 // 4) - len(self.base)
            self.base = np.append(self.base, np.zeros(more, dtype=np.int32))
            self.check = np.append(self.check, np.full(more, -1, dtype=np.int32))
            self._used = np.append(self._used, np.zeros(more, dtype=bool))

    def _place(self, parent: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Slots of one level's children. Wide nodes take one of many tried bases where all are free, or else the end, widest
        first. Narrow ones try bases together, round by round; single children take the slots left."""
        child = np.zeros(len(parent), dtype=np.int64)
        parents, at, fan = np.unique(parent, return_index=True, return_counts=True)
        for k in np.argsort(-fan, kind="stable"):
            if fan[k] <= WIDE:
                break
            self._place_one(parents[k], label[at[k] : at[k] + fan[k]], child[at[k] : at[k] + fan[k]])
        for f in range(min(WIDE, int(fan.max(initial=0))), 1, -1):
            left = np.flatnonzero(fan == f)
            for _ in range(200):
                if not len(left):
                    break
                left = self._place_many(parents, label, child, at, left, f)
            for k in left:
                self._place_one(parents[k], label[at[k] : at[k] + f], child[at[k] : at[k] + f])
        single = np.flatnonzero(fan == 1)
        slots = np.flatnonzero(~self._used[: self._tail])[: len(single)]
        more = len(single) - len(slots)
        self._grow(self._tail + more)
        slots = np.append(slots, np.arange(self._tail, self._tail + more))
        self._used[slots] = True
        self._tail += more
        self.base[parents[single]] = slots - label[at[single]]
        child[at[single]] = slots
        return child

    def _place_one(self, parent: int, mine: np.ndarray, child: np.ndarray) -> None:
        shape = mine - mine[0]
        self._grow(self._tail + int(shape[-1]) + 1)
        low = max(1, self._tail - 8 * self.digits)
        places = np.sort(self._rng.integers(low, self._tail + 1, 256))
        for n in (8, len(shape)):  # a few children tell most of the bases that fail
            places = places[~self._used[places[:, None] + shape[:n]].any(axis=1)]
        place = int(places[0]) if len(places) else self._tail
        child[:] = place + shape
        self._used[child] = True
        self._tail = max(self._tail, int(child[-1]) + 1)
        self.base[parent] = place - mine[0]

    def _place_many(self, parents: np.ndarray, label: np.ndarray, child: np.ndarray, at: np.ndarray, left: np.ndarray, f: int) -> np.ndarray:
        """Tries one base for each of the nodes ``left``, of ``f`` children; those that could not be placed."""
        self._tail = max(self._tail, min(len(self._used), self._tail + len(left) * f // 4))
        mine = label[at[left][:, None] + np.arange(f)]
        shape = mine - mine[:, :1]
        room = self._tail - shape[:, -1]
        place = self._rng.integers(1, np.maximum(room, 2))
        slots = place[:, None] + shape
        self._grow(int(slots.max()) + 1)
        fine = (room > 1) & ~self._used[slots].any(axis=1)
        left_slots, owner = np.unique(slots[fine].ravel(), return_index=True)  # of two that want a slot, the first has it
        won = np.bincount(owner // f, minlength=int(fine.sum())) == f
        some = np.flatnonzero(fine)[won]
        self._used[slots[some]] = True
        self.base[parents[left[some]]] = place[some] - mine[some, 0]
        child[at[left[some]][:, None] + np.arange(f)] = slots[some]
        return np.delete(left, some)

    def labels(self, ids: np.ndarray) -> np.ndarray:
        """Labels of words; -1 for those of no phrase."""
        if not hasattr(self, "_label"):
            order = np.argsort(self.words, kind="stable")
            self._label = self.words[order], order.astype(np.int32)
            if len(order) and self._label[0][-1] < 1 << 28 and ids.dtype == np.int32:
                self._label = np.full(int(self._label[0][-1]) + 2, -1, dtype=np.int32), None
                self._label[0][self.words] = np.arange(len(order), dtype=np.int32)
        table, order = self._label
        if order is None:
            return table[np.minimum(ids, len(table) - 1)]
        at = np.minimum(np.searchsorted(table, ids), len(table) - 1)
        return np.where(table[at] == ids, order[at], -1)

    def slots(self, ids: np.ndarray) -> np.ndarray:
        """Last slots of the phrases at all places of a block: all positions advance together, a word a step."""
        if not len(self.words) or len(ids) < self.depth:
            return np.zeros(0, dtype=np.int64)
        word = self.labels(ids)
        at = np.flatnonzero(word[: len(ids) - self.depth + 1] >= 0)
        state = np.zeros(len(at), dtype=np.int32)
        for step in range(self.depth):
            w = word[at + step]
            high, live = w // self.digits, w >= 0
            for digit in (high, w - high * self.digits):
                slot = self.base[state] + digit
                live &= (slot > 0) & (slot < len(self.check))
                slot = np.where(live, slot, 0)
                live &= self.check[slot] == state
                state = slot
            at, state = at[live], state[live]
        return state.astype(np.int64)

    def counts(self, ids: np.ndarray) -> np.ndarray:
        """Occurrences of each phrase in a block."""
        return np.bincount(self.slots(ids), minlength=len(self.check))[self.leaf]

    def phrases(self, slots: np.ndarray) -> list[np.ndarray]:
        """The words of the phrases that end in these slots."""
        digits = []
        for _ in range(2 * self.depth):
            parent = self.check[slots]
            digits.append(slots - self.base[parent])
            slots = parent
        return [self.words[hi * self.digits + lo] for lo, hi in zip(digits[::2], digits[1::2])][::-1]


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


_ENCODED = "lang string, ids binary, id bigint, word string, n bigint"


def _encoded(docs: DataFrame, seed: int) -> DataFrame:
    """Blocks of word ids (``ids``), and each task's word counts (``id``, ``word``, ``n``), in one table."""
    target = _arrow(_ENCODED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, _Ids] = {}
        counts: dict[str, Counter] = {}

        def blocks(lang: str, ids: np.ndarray) -> pa.RecordBatch:
            breaks = np.flatnonzero(ids == 0)
            ends = breaks[np.searchsorted(breaks, np.arange(ROW, len(ids), ROW))]  # rows end with a break
            parts = np.split(ids, np.unique(ends[ends + 1 < len(ids)]) + 1)
            return pa.RecordBatch.from_pylist([{"lang": lang, "ids": p.tobytes()} for p in parts], schema=target)

        def words(lang: str) -> pa.RecordBatch:
            c = counts.pop(lang)
            c.pop(_BREAK, None)
            ids = memo.setdefault(lang, _Ids(lang, seed))
            texts = [w.decode() for w in c]
            arrays = [pa.array([lang] * len(c), pa.string()), pa.nulls(len(c), pa.binary()), pa.array([ids[w] for w in c], pa.int64()), pa.array(texts, pa.string()), pa.array(list(c.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, schema=target)

        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                ids = memo.setdefault(lang, _Ids(lang, seed))
                found = words_of(texts)
                counts.setdefault(lang, Counter()).update(found)
                found.append(_BREAK)
                yield blocks(lang, np.fromiter(map(ids.__getitem__, found), dtype=np.int64, count=len(found)))
            if sum(map(len, counts.values())) > HELD_WORDS:
                for lang in list(counts):
                    yield words(lang)
            if sum(map(len, memo.values())) > MEMO_SIZE:
                memo.clear()
        for lang in list(counts):
            yield words(lang)

    return docs.mapInArrow(run, _ENCODED)


def _gathered(batches: Iterator[pa.RecordBatch], kind: type = np.int32) -> Iterator[np.ndarray]:
    """Rows of word numbers (or ids) put together to about ``BLOCK`` words; each row ends with a break."""
    held, size = [], 0
    for batch in batches:
        for blob in batch.column(0):
            held.append(np.frombuffer(blob.as_buffer(), dtype=kind))
            size += len(held[-1])
            if size > BLOCK:
                yield np.concatenate(held)
                held, size = [], 0
    if held:
        yield np.concatenate(held)


class _Numbers:
    """Numbers of the frequent words, from 1 on in the order of their ids; 0 for all others. Ids are hashes, so their first bits lead close to them."""

    def __init__(self, ids: np.ndarray):
        self.ids = np.append(np.sort(ids), np.iinfo(np.int64).max)
        self.shift = max(0, 62 - len(ids).bit_length() - 1)
        self.start = np.searchsorted(self.ids, (np.arange(1 << 62 - self.shift) << self.shift) + (1 << 62)).astype(np.int32)

    def of(self, ids: np.ndarray) -> np.ndarray:
        at = self.start[(ids & (1 << 62) - 1) >> self.shift]
        behind = np.flatnonzero(self.ids[at] < ids)
        while len(behind):
            at[behind] += 1
            behind = behind[self.ids[at[behind]] < ids[behind]]
        return np.where(self.ids[at] == ids, at + 1, 0).astype(np.int32)


def _numbered(words: DataFrame, sent) -> DataFrame:
    """The frequent words with their numbers as ``w1``."""
    schema = "w1 int, lang string, phrase string, a bigint"
    target = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(sent.value.of(batch.column(0).to_numpy())), *batch.columns[1:]], schema=target)

    return words.select("w1", "lang", "phrase", "a").mapInArrow(run, schema)


def _renamed(blocks: DataFrame, sent) -> DataFrame:
    """Blocks of word numbers. Only frequent words are in frequent phrases: between those with such a neighbour, one break stands for all others."""
    schema = "ids binary"
    target = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids in _gathered(batches, np.int64):
            some = sent.value.of(ids)
            near = np.concatenate(([False], some != 0, [False]))
            some[~(near[:-2] | near[2:])] = 0
            some = some[(some != 0) | np.append(False, some[:-1] != 0)]  # one break after each run
            ends = np.flatnonzero(some == 0)
            ends = ends[np.searchsorted(ends, np.arange(ROW, len(some), ROW))]
            parts = np.split(some, np.unique(ends[ends + 1 < len(some)]) + 1)
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in parts], pa.binary())], schema=target)

    return materialize(blocks.mapInArrow(run, schema), block=WRITTEN)


def _names(k: int) -> list[str]:
    return [f"w{i}" for i in range(1, k + 1)]


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of word ids or keys, with the sums of their counts."""
    rows, n = np.concatenate(keys), np.concatenate(counts)
    order = np.lexsort(rows.T[::-1]) if rows.shape[1] > 2 else np.argsort(rows[:, 0] if rows.shape[1] == 1 else rows[:, 0] << 32 | rows[:, 1])
    rows, n = rows[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1)))) if len(rows) else np.zeros(0, np.int64)
    return rows[first], np.add.reduceat(n, first) if len(first) else n


class _Sums:
    """A task's counts of rows of ``width`` numbers, merged whenever many are held, and packed by slice:
    a shuffle of few rows of bytes in place of one row a phrase."""

    def __init__(self, width: int):
        self.width = width
        self.drop()

    def drop(self) -> None:
        self.keys, self.counts, self.held = [np.zeros((0, self.width), np.int64)], [np.zeros(0, np.int64)], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> bool:
        """Takes counts; true when so many rows differ that they should be passed on."""
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held <= 2 * HELD_ROWS:
            return False
        self._merge()
        return self.held > HELD_ROWS

    def _merge(self) -> None:
        keys, counts = _merged(self.keys, self.counts)
        self.keys, self.counts, self.held = [keys], [counts], len(keys)

    def packed(self, slices, mask: int = -1) -> pa.RecordBatch:
        """(slice, keys, counts) rows of what is held, which is then dropped. ``slices(keys)`` says which slice a row is in;
        the bits of a key outside ``mask`` are those of its slice."""
        self._merge()
        keys, counts = self.keys[0], self.counts[0]
        at = slices(keys)
        order = np.argsort(at, kind="stable")
        at, keys, counts = at[order], keys[order], counts[order]
        kinds, first = np.unique(at, return_index=True)
        ends = np.append(first[1:], len(at))
        self.drop()
        low = (keys & mask).astype("<u4")
        return pa.RecordBatch.from_arrays(
            [
                pa.array(kinds.astype(np.int32)),
                pa.array([low[x:y].tobytes() for x, y in zip(first, ends)], pa.binary()),
                pa.array([_small(counts[x:y]) for x, y in zip(first, ends)], pa.binary()),
            ],
            schema=_PACKED_ARROW,
        )


_PACKED = "slice int, keys binary, counts binary"
_PACKED_ARROW = pa.schema([("slice", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def _unpacked(packed: DataFrame, width: int, schema: str, emit) -> DataFrame:
    """Sums of packed rows, a slice at a time: ``emit(slice, keys, counts)`` makes a batch of each."""
    target = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, _Sums(width)
        for batch in batches:
            for s, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if at is not None and s != at:
                    sums._merge()
                    yield pa.RecordBatch.from_arrays(emit(at, sums.keys[0], sums.counts[0]), schema=target)
                    sums = _Sums(width)
                at = s
                rows = np.frombuffer(keys, dtype="<u4").reshape(-1, width).astype(np.int64)
                sums.add(rows, np.frombuffer(counts, dtype=np.int64 if len(counts) == 8 * len(rows) else "<u4").astype(np.int64))
        if at is not None:
            sums._merge()
            yield pa.RecordBatch.from_arrays(emit(at, sums.keys[0], sums.counts[0]), schema=target)

    return packed.repartition("slice").sortWithinPartitions("slice").mapInArrow(run, schema)


class _Bits:
    """A bitmap of phrases' hashes, read at ``PROBES`` places each, so that few others hit however many there are."""

    def __init__(self, n: int):
        self.bits = np.zeros(max(BITS, 1 << (BITS_EACH * n - 1).bit_length()) >> 6, dtype=np.uint64)

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        """One place of each hash after the other; the caller says which hashes still count."""
        mixed = hashes.astype(np.uint64) * _MIX
        at, step = (mixed >> np.uint64(24)).astype(np.int64), (mixed & np.uint64((1 << 24) - 1)).astype(np.int64) * 2 + 1
        some = None
        for i in range(PROBES):
            some = yield (at if some is None else at[some]) + i * (step if some is None else step[some]) & 64 * len(self.bits) - 1

    def add(self, hashes: np.ndarray) -> None:
        for at in self._places(hashes):
            np.bitwise_or.at(self.bits, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))

    def hit(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes were added, and few others."""
        places, some = self._places(hashes), np.arange(len(hashes))
        at = next(places)
        for i in range(PROBES):
            some = some[self.bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1]
            at = places.send(some) if i + 1 < PROBES else at
        out = np.zeros(len(hashes), dtype=bool)
        out[some] = True
        return out


def _safe(ids: np.ndarray, inner, k: int) -> np.ndarray:
    """Places of a block where a phrase of ``k`` words starts whose two inner phrases may be frequent."""
    word = ids != 0
    m = len(ids) - k + 1
    if m < 1:
        return np.zeros(0, dtype=np.int64)
    fine = word[:m].copy()
    for i in range(1, k):
        fine &= word[i : i + m]
    at = np.flatnonzero(fine)
    if inner is None:  # both words are frequent
        return at
    starts = np.zeros(len(ids), dtype=bool)
    starts[at] = starts[at + 1] = True
    starts = np.flatnonzero(starts)
    frequent = np.zeros(len(ids), dtype=bool)
    frequent[starts[inner.value.hit(phrase_hashes([ids[starts + i] for i in range(k - 1)]))]] = True
    return at[frequent[at] & frequent[at + 1]]


def _likely(blocks: DataFrame, inner, k: int, least: int):
    """The broadcast bitmap of Apriori-safe phrases of ``k`` words whose hash of ``KEY_BITS`` bits has at least ``least``
    places: all frequent ones, and few others. Four bytes of each come to the driver."""
    low = KEY_BITS - SLICE_BITS
    schema = "slice int, hashes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # bits of a slice's number come first in a key, so that a key packs into the low ones
        sums = _Sums(1)
        slices = lambda keys: keys[:, 0] >> low
        for ids in _gathered(batches):
            at = _safe(ids, inner, k)
            h, n = np.unique(phrase_hashes([ids[at + i] for i in range(k)]), return_counts=True)
            if sums.add(h[:, None], n):
                yield sums.packed(slices, (1 << low) - 1)
        if sums.held:
            yield sums.packed(slices, (1 << low) - 1)

    def emit(s: int, keys: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
        return [pa.array([s], pa.int32()), pa.array([keys[counts >= least, 0].astype("<u4").tobytes()], pa.binary())]

    table = _unpacked(blocks.mapInArrow(run, _PACKED), 1, schema, emit).toArrow()
    found = [(s, np.frombuffer(h, "<u4").astype(np.int64)) for s, h in zip(*(c.to_pylist() for c in table.columns))]
    bits = _Bits(sum(len(h) for _, h in found))
    for s, h in found:
        bits.add(s << low | h)
    return blocks.sparkSession.sparkContext.broadcast(bits)


def _small(counts: np.ndarray) -> bytes:
    return counts.astype("<u4").tobytes() if counts.max() < 1 << 32 else counts.tobytes()


def _candidates(blocks: DataFrame, inner, likely, k: int) -> DataFrame:
    """Distinct phrases of ``k`` words that are Apriori-safe and likely."""
    names = _names(k)
    schema = ", ".join(f"{n} int" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(k)
        slices = lambda keys: phrase_hashes(list(keys.T)) & 255
        for ids in _gathered(batches):
            at = _safe(ids, inner, k)
            at = at[likely.value.hit(phrase_hashes([ids[at + i] for i in range(k)]))]
            if sums.add(*_merged([np.stack([ids[at + i] for i in range(k)], 1).astype(np.int64)], [np.ones(len(at), np.int64)])):
                yield sums.packed(slices)
        if sums.held:
            yield sums.packed(slices)

    def emit(s: int, keys: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
        return [pa.array(c.astype(np.int32)) for c in keys.T]

    return materialize(_unpacked(blocks.mapInArrow(run, _PACKED), k, schema, emit))


def _counted(blocks: DataFrame, candidates: DataFrame, k: int, shard: int, least: int) -> DataFrame:
    """(words, a): the candidates that have ``least`` places, counted by tries that are broadcast shard by shard."""
    names = _names(k)
    schema = ", ".join(f"{n} int" for n in names) + ", a bigint"
    shards = -(-candidates.count() // shard)
    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64(*names), F.lit(shards))) if shards else candidates
    out = None
    for s in range(shards):
        table = dealt.where(F.col("shard") == s).select(*names).toArrow()
        trie = DoubleArray([table.column(n).to_numpy() for n in names])
        del table
        sent = candidates.sparkSession.sparkContext.broadcast(trie)
        del trie
        sums = _unpacked(blocks.mapInArrow(_trie_counts(sent), _PACKED), 1, schema, _phrases_of(sent, least))
        part = materialize(sums)
        sent.unpersist()
        out = part if out is None else out.unionByName(part)
    if out is None:
        return blocks.sparkSession.createDataFrame([], schema)
    return out


def _trie_counts(sent):
    """A task's counts of a shard's phrases: (last slot of the phrase, count), packed by runs of slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, sums = sent.value, _Sums(1)
        for ids in _gathered(batches):
            slots, n = np.unique(trie.slots(ids), return_counts=True)
            if sums.add(slots[:, None], n):
                yield sums.packed(lambda keys: keys[:, 0] >> 14)
        if sums.held:
            yield sums.packed(lambda keys: keys[:, 0] >> 14)

    return run


def _phrases_of(sent, least: int):
    def emit(s: int, keys: np.ndarray, counts: np.ndarray) -> list[pa.Array]:
        enough = counts >= least
        return [pa.array(c) for c in sent.value.phrases(keys[enough, 0])] + [pa.array(counts[enough])]

    return emit


def _cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 a / (left + right)), exact beyond 64 bits."""
    wide = "decimal(19,0)"
    product = F.lit(2_000_000).cast("decimal(7,0)") * a.cast(wide)
    return F.call_function("div", product, left.cast(wide) + right.cast(wide))


def _best_cut(a: Column, cuts: list[tuple[Column, Column]]) -> Column:
    """(score, k, l, r) of the lowest cut, the shortest first part of equals."""
    return F.array_min(
        F.array(*[F.struct(_cut_score(a, x, y).alias("score"), F.lit(k).alias("k"), x.alias("l"), y.alias("r")) for k, (x, y) in enumerate(cuts, 1)])
    )


def _with(rows: DataFrame, table: DataFrame, at: list[int], f: str, text: str | None = None) -> DataFrame:
    """The rows with the count ``f`` (and the phrase) of the words at the given places."""
    keys = _names(len(at))
    named = table.select(*[F.col(k).alias(f"w{p}") for k, p in zip(keys, at)], F.col("a").alias(f), *([F.col("phrase").alias(text)] if text else []))
    return rows.join(named, [f"w{p}" for p in at])


def collocations(
    docs: DataFrame, top: int = 2_000, least: int = 30, inside: int = 80, lang_col: str = "lang", text_col: str = "text", shard: int = SHARD
) -> DataFrame:
    """The ``top`` phrases of each language, with their counts, the best-balanced cut's parts, and scores.

    A phrase occurs ``least`` times at least. It is dropped where a longer one that holds it has
    ``inside`` percent of its places."""
    prepare(docs.sparkSession)
    texts = docs.select(F.coalesce(docs[lang_col], F.lit("und")).alias("lang"), docs[text_col].alias("text"))
    seed = 0
    while True:
        encoded = materialize(_encoded(texts, seed), block=WRITTEN)
        counts = encoded.where("id is not null").groupBy("lang", "id", "word").agg(F.sum("n").alias("a"))
        counts = materialize(counts)
        if counts.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
            break
        seed += 1  # two words share an id
    totals = counts.groupBy("lang").agg(F.sum("a").alias("n"))
    words = counts.where(F.col("a") >= least).select(F.col("id").alias("w1"), "lang", F.col("word").alias("phrase"), "a")
    numbers = docs.sparkSession.sparkContext.broadcast(_Numbers(words.select("w1").toArrow().column("w1").to_numpy()))
    words = materialize(_numbered(words, numbers))
    blocks = _renamed(encoded.where("ids is not null").select("ids"), numbers)
    numbers.unpersist()

    tables, likely = {1: words}, None
    for k in range(2, LONGEST + 1):
        # what was likely of k - 1 words holds all that is frequent
        inner, likely = likely, _likely(blocks, likely, k, least)
        found = _counted(blocks, _candidates(blocks, inner, likely, k), k, shard, least)
        # the first and last cut also give the phrase its text
        rows = _with(found, tables[k - 1], list(range(1, k)), "f_first", "head")
        rows = _with(rows, words, [k], "f_last", "tail")
        rows = rows.withColumn("phrase", F.concat_ws(" ", "head", "tail")).drop("head", "tail")
        tables[k] = materialize(rows)
    return _ranked(tables, totals, top, inside)


def _ranked(tables: dict[int, DataFrame], totals: DataFrame, top: int, inside: int) -> DataFrame:
    """Scores of all phrases, those inside a longer one dropped, the best of each language."""
    words = tables[1]
    parts = []
    for k in range(2, LONGEST + 1):
        rows = tables[k].select(*_names(k), "phrase", "a", "f_first", "f_last")
        if k + 1 in tables:
            longer = tables[k + 1]
            held = [
                longer.select(*[F.col(f"w{i + shift}").alias(f"w{i}") for i in range(1, k + 1)], F.col("a").alias("more")) for shift in (0, 1)
            ]
            most = held[0].unionByName(held[1]).groupBy(*_names(k)).agg(F.max("more").alias("more"))
            wide = "decimal(19,0)"
            rows = rows.join(most, _names(k), "left").where(
                F.col("more").isNull() | (F.lit(100) * F.col("more").cast(wide) < F.lit(inside) * F.col("a").cast(wide))
            )
        rows = rows.join(words.select("w1", "lang", F.col("a").alias("f1")), "w1")
        f = {(1, 1): F.col("f1"), (1, k - 1): F.col("f_first"), (k, k): F.col("f_last")}
        for lo, hi in {(1, j) for j in range(2, k - 1)} | {(j, k) for j in range(2, k)}:
            name = f"f{lo}_{hi}"
            rows = _with(rows, tables[hi - lo + 1], list(range(lo, hi + 1)), name)
            f[lo, hi] = F.col(name)
        best = _best_cut(F.col("a"), [(f[1, j], f[j + 1, k]) for j in range(1, k)])
        parts.append(rows.withColumn("best", best).select("lang", "phrase", "a", "best.l", "best.r", "best.score"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most rows: the best of each of many parts first, so that no task gets a whole language
    near = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    rows = rows.withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    long = lambda c: F.col(c).cast("bigint").alias(c)
    return rows.join(totals, "lang").select("lang", long("rank"), "phrase", long("a"), long("l"), long("r"), long("n"), long("score"))


def collocation_sql(top: int = 2_000, least: int = 30, inside: int = 80) -> str:
    """The same rows in DuckDB SQL, by listing every phrase of every piece."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    cuts = " UNION ALL ".join(
        f"SELECT c.lang, c.ws, c.a, {j} AS k, x.f AS l, y.f AS r FROM cand c JOIN f x ON x.lang = c.lang AND x.ws = c.ws[1:{j}]"
        f" JOIN f y ON y.lang = c.lang AND y.ws = c.ws[{j + 1}:] WHERE len(c.ws) > {j}"
        for j in range(1, LONGEST)
    )
    return f"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents),
    lists AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
    totals AS (SELECT lang, cast(sum(len(ws)) AS BIGINT) AS n FROM lists GROUP BY lang),
    places AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM lists WHERE len(ws) > 0),
    grams AS (SELECT lang, ws[i:i + k - 1] AS ws FROM places, (SELECT unnest(range(1, {LONGEST + 1})) AS k) WHERE i + k - 1 <= len(ws)),
    f AS (SELECT lang, ws, count(*) AS f FROM grams GROUP BY lang, ws HAVING count(*) >= {least}),
    cand AS (SELECT lang, ws, f AS a FROM f WHERE len(ws) > 1),
    cut AS ({cuts}),
    scored AS (SELECT *, (2000000::HUGEINT * a) // (l + r) AS score FROM cut),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
    inner_ AS (
        SELECT lang, ws[1:len(ws) - 1] AS ws, a FROM cand WHERE len(ws) > 2 UNION ALL
        SELECT lang, ws[2:] AS ws, a FROM cand WHERE len(ws) > 2),
    most AS (SELECT lang, ws, max(a) AS more FROM inner_ GROUP BY lang, ws),
    kept AS (SELECT b.*, array_to_string(b.ws, ' ') AS phrase FROM best b LEFT JOIN most m ON m.lang = b.lang AND m.ws = b.ws
             WHERE m.more IS NULL OR 100 * m.more < {inside} * b.a),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase COLLATE "C") AS rank FROM kept)
    SELECT lang, cast(rank AS BIGINT) AS rank, phrase, cast(a AS BIGINT) AS a, cast(l AS BIGINT) AS l, cast(r AS BIGINT) AS r, n,
           cast(score AS BIGINT) AS score
    FROM ranked JOIN totals USING (lang) WHERE rank <= {top}"""
