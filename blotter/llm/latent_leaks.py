"""Benchmark decontamination by latent semantic retrieval.

Texts become word hashes (words lower-cased, marks around them dropped), cut
into blocks of ``BLOCK`` words. Over all blocks Spark counts the document
frequencies of ``BUCKETS`` hashed features and sums, task by task, the sketch
A'(A R) of the TF-IDF matrix A for a random matrix R: a randomised SVD in one pass
(Nystroem form), of which only BUCKETS x RANK numbers reach the driver. A passage
is two neighbouring blocks, one block further each time. Passages and benchmark
items are projected on the leading singular vectors, scaled by the singular values,
and those with a cosine of ``LEAST_COSINE`` or more are candidates.

A candidate is a leak if the longest common subsequence of the item's words and
the text around the passage holds ``DIRECT`` of the item, or ``PARAPHRASE`` of it
while the item's answer (its last sentence, or its last ``ANSWER`` words if that is shorter) stands
there word for word.

Items are read in blocks of about ``ITEM_BLOCK``, each against all texts. Defined
results: null and empty texts hold no leak, null and empty items leak nowhere; an empty
benchmark or empty documents give no rows; repeated rows repeat their pairs
once a row; rows without an id are judged like others; further columns are ignored by ``leaks`` and carried by ``keep_clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import map_docs, prepare, rewrite_docs
from blotter.session import materialize

BLOCK = 16
BUCKETS = 1 << 14
SKETCH = 64
RANK = 48
LEAST_COSINE = 0.25
#: Items of fewer than SHORT words fill a passage less, so their cosines spread wider.
SHORT = 24
LEAST_COSINE_SHORT = 0.1
#: Features of more than this share of the blocks (and COMMON_BLOCKS of them) have weight 0.
COMMON = 0.01
COMMON_BLOCKS = 50
#: Bits of the word filter that goes before the alignment; it only ever says yes too often.
FILTER = 1024
DIRECT = 0.8
PARAPHRASE = 0.6
ANSWER = 4
#: Share of a passage's (or shorter item's) words that must be words of the other before sequences are aligned.
LEAST_SHARED = 0.5
ITEM_BLOCK = 20_000
#: Words and cosines handled at a time, which bounds a worker's memory on texts of any length.
STEP_BLOCKS = 4_096
STEP_CELLS = 2_000_000
STEP_PAIRS = 100_000
MEMO_WORDS = 400_000
SLABS = 256

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_SENTENCE = re.compile(r"[.!?…]+\s+")


class Words(dict):
    """32-bit hash of each word without the marks around it (0: nothing left), remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        bare = word if word.isalnum() else _EDGES.sub("", word)
        h = self[word] = (xxhash.xxh32_intdigest(bare.encode("utf-8", "surrogatepass")) or 1) if bare else 0
        return h

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        out = np.fromiter(map(self.__getitem__, words), np.uint32, len(words))
        return out[out != 0] if len(out) and not out.all() else out


@dataclass
class Blocks:
    """The blocks of a batch of texts: text and range of words of each."""

    words: np.ndarray
    text: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @staticmethod
    def of(raw: list[bytes | None]) -> Blocks:
        sizes = np.array([len(r or b"") // 4 for r in raw], np.int64)
        words = np.frombuffer(b"".join(r or b"" for r in raw), np.uint32)
        offset = np.cumsum(sizes) - sizes
        count = -(-sizes // BLOCK)
        text = np.repeat(np.arange(len(raw)), count)
        within = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        start = offset[text] + BLOCK * within
        return Blocks(words, text, start, np.minimum(start + BLOCK, (offset + sizes)[text]))

    def steps(self) -> Iterator[slice]:
        for a in range(0, len(self.text), STEP_BLOCKS):
            yield slice(a, min(a + STEP_BLOCKS, len(self.text)))

    def project(self, table: np.ndarray) -> np.ndarray:
        """Sum of the table's rows over each block's words."""
        out = np.empty((len(self.text), table.shape[1]), np.float32)
        padded = np.concatenate((table, np.zeros((1, table.shape[1]), np.float32)))
        for s in self.steps():
            out[s] = sums(padded, self.cells(s))
        return out

    def cells(self, s: slice) -> np.ndarray:
        """BLOCK x blocks of a step: the feature of each block's k-th word, BUCKETS beyond its end."""
        out = np.full((len(self.text[s]), BLOCK), BUCKETS, np.int64)
        size = self.end[s] - self.start[s]
        out[np.arange(BLOCK) < size[:, None]] = self.words[self.start[s][0] : self.end[s][-1]] & (BUCKETS - 1)
        return np.ascontiguousarray(out.T)


def sums(padded: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Per block the sum of its words' rows; the table's last row is 0."""
    out = padded[cells[0]]
    for k in range(1, BLOCK):
        out += padded.take(cells[k], axis=0)
    return out


def spread(total: np.ndarray, feature: np.ndarray, block: np.ndarray, rows: np.ndarray) -> None:
    """Add each block's row to its features' rows of ``total``: features in turns of
    distinct ones, so that no addition of a turn meets another."""
    order = np.argsort(feature, kind="stable")
    feature, block = feature[order], block[order]
    first = np.flatnonzero(np.concatenate(([True], feature[1:] != feature[:-1])))
    count = np.diff(np.append(first, len(feature)))
    by_count = np.argsort(-count, kind="stable")
    first, left = first[by_count], -np.sort(-count)
    for turn in range(int(left[0])):
        at = first[: np.searchsorted(-left, -turn, side="left")] + turn
        total[feature[at]] += rows.take(block[at], axis=0)


def _hashed(docs: DataFrame, text_col: str) -> DataFrame:
    """doc_id and the whole text's word hashes, written once for the passes below."""

    def rows(words, ids, texts):
        return {"words": [words.of(t).tobytes() for t in texts]}

    kind = dict(docs.dtypes)["doc_id"]
    return materialize(map_docs(docs, ["doc_id", text_col], rows, f"doc_id {kind}, words binary", Words))


def _summed(parts: DataFrame, kind: type) -> np.ndarray:
    """The sum of all tasks' arrays, which come as slabs: combined in two steps by
    Spark, so that a task reads a share of one slab, and the driver gets one array."""

    def add(batches: list[bytes]) -> bytes:
        total = np.frombuffer(batches[0], kind).copy()
        for b in batches[1:]:
            total += np.frombuffer(b, kind)
        return total.tobytes()

    def by_share(key, table):
        return pa.table({"slab": [key[0].as_py()], "part": [add(table.column("part").to_pylist())]}, schema=_SLAB)

    once = parts.withColumn("share", F.pmod(F.spark_partition_id(), F.lit(64)))
    once = once.groupBy("slab", "share").applyInArrow(by_share, "slab int, part binary")
    got = once.groupBy("slab").applyInArrow(by_share, "slab int, part binary").collect()
    return np.concatenate([np.frombuffer(r["part"], kind) for r in sorted(got, key=lambda r: r["slab"])]) if got else np.zeros(0, kind)


_SLAB = pa.schema([("slab", pa.int32()), ("part", pa.binary())])


def _slabs(total: np.ndarray) -> pa.RecordBatch:
    parts = [p.tobytes() for p in np.split(total, SLABS)]
    return pa.RecordBatch.from_arrays([pa.array(range(SLABS), pa.int32()), pa.array(parts, pa.binary())], schema=_SLAB)


def _frequencies(hashed: DataFrame) -> np.ndarray:
    """Blocks that hold each feature; the last element is the number of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + SLABS, np.int64)
        for batch in batches:
            b = Blocks.of(batch.column(0).to_pylist())
            for s in b.steps():
                cells = b.cells(s).T.astype(np.int32, order="C")
                cells.sort(axis=1)
                cells[:, 1:][cells[:, 1:] == cells[:, :-1]] = BUCKETS
                total[: BUCKETS + 1] += np.bincount(cells.ravel(), minlength=BUCKETS + 1)
            total[-1] += len(b.text)
        total[BUCKETS] = 0
        yield _slabs(total)

    got = _summed(hashed.select("words").mapInArrow(run, "slab int, part binary"), np.int64)
    return got if len(got) else np.zeros(BUCKETS + SLABS, np.int64)


def _random() -> np.ndarray:
    return np.random.default_rng(17).standard_normal((BUCKETS, SKETCH), np.float32)


def _sketch(hashed: DataFrame, idf: np.ndarray) -> np.ndarray:
    """A'(A R) over all blocks."""
    shared = hashed.sparkSession.sparkContext.broadcast(idf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight = shared.value
        padded = np.concatenate((_random() * weight[:, None], np.zeros((1, SKETCH), np.float32)))
        weighted = np.append(weight > 0, False)
        total = np.zeros((BUCKETS, SKETCH), np.float64)
        for batch in batches:
            b = Blocks.of(batch.column(0).to_pylist())
            for s in b.steps():
                cells = b.cells(s)
                place, block = np.nonzero(weighted[cells])
                if len(place):
                    spread(total, cells[place, block].astype(np.uint16), block, sums(padded, cells))
        yield _slabs((total * weight[:, None]).astype(np.float32).ravel())

    got = _summed(hashed.select("words").mapInArrow(run, "slab int, part binary"), np.float32)
    return got.reshape(-1, SKETCH).astype(np.float64)


def singular_table(sketch: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Feature table that takes word counts to scaled latent coordinates."""
    core = _random().astype(np.float64).T @ sketch
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > max(values.max(), 0) * 1e-9
    if not good.any():
        return np.zeros((BUCKETS, RANK), np.float32)
    half = sketch @ (vectors[:, good] / np.sqrt(values[good]))
    left, s, _ = np.linalg.svd(half, full_matrices=False)  # s: the singular values of A
    keep = s > s[0] * 1e-6
    left, s = left[:, keep][:, :RANK], s[keep][:RANK]
    out = np.zeros((BUCKETS, RANK), np.float32)
    out[:, : len(s)] = idf[:, None] * left * (s[0] / s)
    return out


def fit(hashed: DataFrame) -> np.ndarray:
    """The latent table of all texts."""
    counts = _frequencies(hashed)
    blocks = max(1, int(counts[-1]))
    idf = np.log((1 + blocks) / (1 + counts[:BUCKETS])).astype(np.float32)
    idf[counts[:BUCKETS] > COMMON_BLOCKS + COMMON * blocks] = 0
    sketch = _sketch(hashed, idf)
    return singular_table(sketch, idf) if sketch.size else np.zeros((BUCKETS, RANK), np.float32)


@dataclass
class Items:
    """A block of benchmark items: words, answers and unit vectors (very long items have one for each passage too)."""

    ids: list
    words: list[np.ndarray]
    answers: list[bytes]
    owner: np.ndarray
    vectors: np.ndarray
    least: np.ndarray  # the cosine each vector asks for
    filter: np.ndarray  # items x FILTER: whether the item may have such a word
    folded: np.ndarray  # the filter folded to a quarter, 64 places a number, one row per such number
    bits: np.ndarray  # items x longest item: each word's place in the filter, -1 beyond the end
    shared: np.ndarray  # words a passage must share with each item

    @staticmethod
    def of(rows: list[tuple], table: np.ndarray) -> Items:
        memo, ids, words, answers, owner, parts, least = Words(), [], [], [], [], [], []
        weighted = np.abs(table).sum(axis=1) > 0
        for key, text in rows:
            w = memo.of(text)
            if not len(w):
                continue
            last = memo.of(_SENTENCE.split((text or "").strip())[-1])
            size = min(len(w), max(len(last), ANSWER))
            # an item that no passage can hold half of is looked for by its parts too
            spans = [(0, len(w))] + [(a, a + 2 * BLOCK) for a in range(0, len(w) - 2 * BLOCK + 1, BLOCK) if len(w) > 4 * BLOCK]
            common = 4 * weighted[w & (BUCKETS - 1)].sum() < len(w)
            least += [-1.0 if common else LEAST_COSINE_SHORT if len(w) < SHORT else LEAST_COSINE] * len(spans)
            owner += [len(ids)] * len(spans)
            parts += [table[w[a:b] & (BUCKETS - 1)].sum(axis=0) for a, b in spans]
            ids.append(key)
            words.append(w)
            answers.append(w[-size:].tobytes())
        vectors = _unit(np.array(parts, np.float32).reshape(-1, RANK))
        filter_ = np.zeros((len(ids), FILTER), bool)
        bits = np.full((len(ids), max(map(len, words), default=0)), -1, np.int64)
        for i, w in enumerate(words):
            filter_[i, _bits(w)] = True
            bits[i, : len(w)] = _bits(w)
        folded = _folded(np.packbits(filter_, axis=1, bitorder="little").view("<u8"))
        shared = np.array([LEAST_SHARED * min(len(w), 2 * BLOCK) for w in words])
        return Items(ids, words, answers, np.array(owner, np.int64), vectors, np.array(least, np.float32), filter_, folded, bits, shared)


def _bits(words: np.ndarray) -> np.ndarray:
    return ((words >> np.uint32(20)) & np.uint32(FILTER - 1)).astype(np.int64)


def _folded(places: np.ndarray) -> np.ndarray:
    """Filters folded to a quarter of their places: one row per 64 of these."""
    return np.ascontiguousarray(np.bitwise_or.reduce(places.reshape(len(places), 4, FILTER // 256), axis=1).T)


def _unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def common_length(item: np.ndarray, text: np.ndarray) -> int:
    """Length of the longest common subsequence, a bit per word of the item."""
    at: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    v = full
    for w in text.tolist():
        here = at.get(w)
        if here:
            u = v & here
            v = (v + u | v - u) & full
    return len(item) - v.bit_count()


def judge(item: np.ndarray, answer: bytes, text: np.ndarray) -> tuple[float, bool, bool]:
    """Share of the item in the text, whether its answer stands there, and whether that is a leak."""
    share = common_length(item, text) / len(item)
    raw, at, found = text.tobytes(), -1, False
    if share >= PARAPHRASE:
        while (at := raw.find(answer, at + 1)) >= 0 and not found:
            found = at % 4 == 0
    return share, found, share >= DIRECT or share >= PARAPHRASE and found


def find_leaks(raw: list[bytes | None], items: Items, table: np.ndarray) -> list[list[tuple[int, float, float, bool]]]:
    """Per text: (item, cosine, share, answer) of its leaks, the best passage of each item."""
    out: list[dict[int, tuple]] = [{} for _ in raw]
    b = Blocks.of(raw)
    if not len(b.text) or not len(items.owner):
        return [[] for _ in raw]
    one = b.project(table)
    more = np.flatnonzero(b.text[1:] == b.text[:-1])
    end = b.end.copy()
    one[more] += one[more + 1]  # rows are added in order of the old values: numpy copies the right side first
    end[more] = b.end[more + 1]
    first = np.flatnonzero(np.concatenate(([True], b.text[1:] != b.text[:-1])))
    last_of = np.maximum.reduceat(b.end, first)
    lo_of = dict(zip(b.text[first].tolist(), zip(b.start[first].tolist(), last_of.tolist())))
    # the last block alone is part of the passage before it
    alone = np.concatenate((b.text[1:] == b.text[:-1], [False])) | np.isin(np.arange(len(b.text)), first)
    chosen = np.flatnonzero(alone)
    step = max(1, STEP_CELLS // len(items.owner))
    for a in range(0, len(chosen), step):
        pairs: list[tuple[int, int, float]] = []
        rows = chosen[a : a + step]
        cosine = _unit(one[rows]) @ items.vectors.T
        r, c = np.nonzero(cosine >= items.least)
        owner = items.owner[c]
        width = end[rows] - b.start[rows]
        cells = b.start[rows][:, None] + np.minimum(np.arange(2 * BLOCK), width[:, None] - 1)
        bits = _bits(b.words[cells])
        passage = np.zeros((len(rows), FILTER // 64), np.uint64)
        for k in range(2 * BLOCK):
            at = np.arange(len(rows))
            passage[at, bits[:, k] >> 6] |= np.uint64(1) << (bits[:, k] & 63).astype(np.uint64)
        folded = _folded(passage)
        for k in range(0, len(r), STEP_PAIRS):
            part = slice(k, k + STEP_PAIRS)
            few = np.minimum(items.shared[owner[part]], LEAST_SHARED * width[r[part]])
            # every place of the folded filter that only the passage has is a word, at least, that the item lacks
            lacks = np.zeros(len(few), np.int64)
            for mine, theirs in zip(folded, items.folded):
                lacks += np.bitwise_count(mine[r[part]] & ~theirs[owner[part]])
            good = np.flatnonzero(width[r[part]] - lacks >= few)
            # the passage's words that the item may have, counted one by one
            hit = items.filter[owner[part][good][:, None], bits[r[part][good]]]
            hit &= np.arange(2 * BLOCK) < width[r[part][good]][:, None]
            good = good[hit.sum(axis=1) >= few[good]]
            # and the other way round: words of the item that the passage may have
            theirs = items.bits[owner[part][good]]
            hit = (passage[r[part][good][:, None], theirs >> 6] >> (theirs & 63).astype(np.uint64)) & np.uint64(1)
            hit[theirs < 0] = 0
            good = good[hit.sum(axis=1) >= few[good]]
            pairs += zip(rows[r[part][good]].tolist(), owner[part][good].tolist(), cosine[r[part][good], c[part][good]].tolist())
        # the best cosine of an item's first, so that most others are settled
        for block, item, near in sorted(pairs, key=lambda p: -p[2]):
            t, w = int(b.text[block]), items.words[item]
            old = out[t].get(item)
            if old and old[2] == 1 and old[3]:
                continue
            lo, hi = lo_of[t]
            around = b.words[max(lo, b.start[block] - len(w)) : min(hi, end[block] + len(w))]
            share, found, leak = judge(w, items.answers[item], around)
            if leak and (old is None or (share, found) > (old[2], old[3])):
                out[t][item] = (item, near, share, found)
    return [sorted(x.values()) for x in out]


def item_blocks(benchmark: DataFrame, table: np.ndarray, item_col: str, item_text: str) -> Iterator[Items]:
    """The items, about ITEM_BLOCK at a time, however many there are; at least one block."""
    items = benchmark.select(F.col(item_col).alias("i"), F.col(item_text).alias("t")).where("t IS NOT NULL")
    blocks = max(1, -(-items.count() // ITEM_BLOCK))
    for k in range(blocks):
        block = [(r["i"], r["t"]) for r in items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).collect()]
        yield Items.of(sorted(set(block), key=lambda r: (r[0] is None, r)), table)


def leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item id, cosine, share of the item found and whether its answer is, per leak."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    hashed = _hashed(docs.select("doc_id", F.col(text_col).alias("_text")), "_text")
    table = fit(hashed)
    shared = spark.sparkContext.broadcast(table)
    doc_kind = dict(hashed.dtypes)["doc_id"]
    item_kind = dict(benchmark.dtypes)[item_col]
    found = None
    for part in item_blocks(benchmark, table, item_col, item_text):
        mine = spark.sparkContext.broadcast(part)

        def rows(_, ids, words, mine=mine):
            part = mine.value
            return {
                "x": [
                    [{"item": part.ids[i], "cosine": c, "share": s, "answer": a} for i, c, s, a in x]
                    for x in find_leaks(words, part, shared.value)
                ]
            }

        kind = f"doc_id {doc_kind}, x array<struct<item:{item_kind},cosine:double,share:double,answer:boolean>>"
        one = (
            map_docs(hashed, ["doc_id", "words"], rows, kind)
            .select("doc_id", F.explode("x").alias("x"))
            .select("doc_id", F.col("x.item").alias(item_col), "x.cosine", "x.share", "x.answer")
        )
        found = one if found is None else found.unionByName(one)
    return found


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The documents that no benchmark item leaks into, with all their columns.

    Each row is judged where it is read: no text is shuffled."""
    spark = docs.sparkSession
    table = fit(_hashed(docs.select("doc_id", F.col(text_col).alias("_text")), "_text"))
    shared = spark.sparkContext.broadcast(table)
    for part in item_blocks(benchmark, table, item_col, item_text):
        mine = spark.sparkContext.broadcast(part)

        def change(words, batch: pa.RecordBatch, texts: list[str], mine=mine) -> pa.RecordBatch:
            found = find_leaks([words.of(t).tobytes() for t in texts], mine.value, shared.value)
            return batch.filter(pa.array([not x for x in found], pa.bool_()))

        docs = rewrite_docs(docs, text_col, change, Words)
    return docs
