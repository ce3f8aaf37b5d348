"""Exact removal of repeated passages by a sparse, range-partitioned suffix array.

Every ``span``-byte window of a text has an *anchor*: the place of its smallest hashed
leading token, a string of ``TOKEN`` bytes, the leftmost of equals. The choice depends on the
window's bytes alone, so equal windows have equal leading tokens at the same offset. The
suffixes that start at anchors (about one in 85) stand for all: a neighbouring run of windows
shares one anchor, and a window can only repeat among the windows of the anchors with the
same leading token.

1. Anchors are counted by the hash of their leading token; an anchor whose token starts no
   other one is dropped with all its windows. If all runs of a token hold the same bytes, they
   repeat whole, and no byte has to be moved.
2. Of the others, one suffix of every distinct run is fetched from its document with the bytes
   before its anchor, and the suffixes are range-partitioned by their leading bytes with splitters that Spark
   samples. Suffixes with equal leading tokens never fall into two buckets, so that no
   window is parted from its likes by a boundary. Each bucket sorts its windows by
   multikey quicksort, eight bytes a step: only classes whose next bytes differ are
   sorted on, and windows left alone in their class are dropped.
3. A token with more than ``group`` different runs (a short common line amid ever other text)
   would make a bucket too large: its windows are counted over the cluster by 128-bit hashes.
4. Intervals of repeated windows are gathered per document, and their bytes taken out.

Exact but for collisions of 128-bit hashes (of runs, of windows in step 3, and of rows by id and text).

Defined results: null texts are empty; texts below ``span`` bytes keep all; a text's own
overlapping repeats count; repeated rows repeat each other and have equal results; very long
texts are scanned in slices of ``SLICE`` bytes; bytes left need not be valid UTF-8, so only their hash is
returned here. An empty table gives an empty result; further input columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import prepare
from blotter.session import materialize

#: Bytes of a leading token.
TOKEN = 32
#: Bytes scanned at once.
SLICE = 2_000_000
#: Different runs of one leading token that a bucket compares itself.
GROUP = 8_192
#: Runs that a bucket gathers before it sorts.
GATHERED = 4_096
#: Ways in which the rows of one run are dealt out.
SALTS = 16
_MIX = np.random.default_rng(11).integers(1, 2**63, size=(2, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE = np.random.default_rng(12).integers(0, 2**64, size=256, dtype=np.uint64)
_RUN = "h bigint, fp bigint, key bigint, n int, q int, s0 int, s1 int"


def token_hashes(data: np.ndarray, token: int, seed: int = 0) -> np.ndarray:
    """64-bit hashes of all strings of ``token`` bytes, joined from those of half their length."""
    h, size = _BYTE[data], 1
    if seed:
        h = h * _MIX[1, 7]
    parts = [(h, 1)]
    while size * 2 <= token:
        g = h[:-size] * _MIX[seed, size.bit_length() % 8]
        g ^= g >> np.uint64(29)
        h = g + h[size:]
        size *= 2
        parts.append((h, size))
    out, done = parts[-1]
    for h, size in reversed(parts[:-1]):  # the rest of a length that is no power of two
        while token - done >= size:
            n = len(data) - done - size + 1
            g = out[:n] * _MIX[seed, (size.bit_length() + 3) % 8]
            g ^= g >> np.uint64(31)
            out, done = g + h[done : done + n], done + size
    out = out * _MIX[seed, 6]
    return out ^ (out >> np.uint64(32))


def anchor_runs(data: np.ndarray, ends: np.ndarray, span: int, token: int = TOKEN) -> tuple[np.ndarray, ...]:
    """Anchors, first and last window of each run, and the anchors' hashes.

    ``data`` holds texts that end at ``ends``; windows lie inside one text."""
    n = len(data) - span + 1
    if n <= 0:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3)) + (np.zeros(0, dtype=np.uint64),)
    h = token_hashes(data, token)
    bits = np.uint64(max(len(h) - 1, 1).bit_length())
    low = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)  # equal hashes: the leftmost wins
    width = span - token + 1
    size = 1
    while size * 2 <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < width:
        low = np.minimum(low[: n], low[width - size : width - size + n])
    at = (low[:n] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    text = np.searchsorted(ends, np.arange(n), "right")
    whole = np.arange(n) + span <= ends[text]
    new = np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new & whole)
    stop = np.concatenate(([False], new[1:] | (whole[:-1] & ~whole[1:])))
    stops = np.append(np.flatnonzero(stop), n)
    last = stops[np.searchsorted(stops, first, "right")] - 1
    return at[first], first, last, h[at[first]]


def repeated_windows(
    data: np.ndarray, group: np.ndarray, start: np.ndarray, anchor: np.ndarray, first: np.ndarray, last: np.ndarray, span: int
) -> tuple[np.ndarray, np.ndarray]:
    """(run, window) of all windows that occur in two runs of a group at the same offset from the anchor.

    Run ``i`` has its bytes from ``start[i]`` in ``data``, its anchor there at ``anchor[i]`` and windows
    ``first[i]`` to ``last[i]``, all counted from ``start[i]``; runs come in order of ``group``."""
    data = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    words = np.ndarray(shape=(len(data) - 7,), dtype="<u8", buffer=np.ascontiguousarray(data), strides=(1,))
    sizes = last - first + 1
    run = np.repeat(np.arange(len(start)), sizes)
    window = np.arange(len(run)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[run]
    offset = window - anchor[run]
    order = np.lexsort((offset, group[run]))
    run, window = run[order], window[order]
    g, o = group[run], offset[order]
    new = np.concatenate(([True], (g[1:] != g[:-1]) | (o[1:] != o[:-1])))
    for step in [*range(0, span - 7, 8), *([span - 8] if span % 8 else [])]:
        alone = new & np.append(new[1:], True)  # a class of one: nothing like it
        if alone.any():
            run, window, new = run[~alone], window[~alone], new[~alone]
        if not len(run):
            break
        word = words[start[run] + window + step]
        differs = np.concatenate(([False], (word[1:] != word[:-1]) & ~new[1:]))
        if not differs.any():
            continue
        cls = np.cumsum(new) - 1
        mixed = np.zeros(cls[-1] + 1, dtype=bool)
        mixed[cls[differs]] = True
        at = np.flatnonzero(mixed[cls])  # only classes that differ here are sorted on
        order = at[np.lexsort((word[at], cls[at]))]
        run[at], window[at] = run[order], window[order]
        word[at] = word[order]
        new[at] |= np.concatenate(([True], word[at][1:] != word[at][:-1]))
    alone = new & np.append(new[1:], True) if len(run) else np.zeros(0, dtype=bool)
    return run[~alone], window[~alone]


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes in one array, and each text's end there; null is empty."""
    column = column.fill_null("").cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]]
    return data, ends[1:] - ends[0]


def _pieces(ends: np.ndarray, span: int) -> Iterator[tuple[int, int, int]]:
    """(first text, first byte, end) of stretches of about ``SLICE`` bytes; a longer text's overlap by a window."""
    k, lo = 0, 0
    while k < len(ends):
        if ends[k] - lo > SLICE:
            for at in range(lo, int(ends[k]) - span + 1, SLICE):
                yield k, at, min(at + SLICE + span - 1, int(ends[k]))
            k, lo = k + 1, int(ends[k])
            continue
        to = int(np.searchsorted(ends, lo + SLICE, "right"))
        yield k, lo, int(ends[to - 1])
        k, lo = to, int(ends[to - 1])


def _runs(rows: DataFrame, span: int) -> DataFrame:
    """A row per run of windows with one anchor: its token's hash, its fingerprint, and where it lies."""
    target = _arrow(_RUN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            data, ends = _bytes_of(batch.column(2))
            keys, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            begins = np.concatenate(([0], ends[:-1]))
            for _, lo, hi in _pieces(ends, span):
                part = data[lo:hi]
                inner = ends[(ends > lo) & (ends <= hi)] - lo
                q, s0, s1, h = anchor_runs(part, inner if len(inner) and inner[-1] == hi - lo else np.append(inner, hi - lo), span)
                if not len(q):
                    continue
                raw, digest = part.tobytes(), xxhash.xxh3_64_intdigest
                fp = np.fromiter(
                    (digest(raw[a : b + span], (c - a) << 16 | (b - a)) for a, b, c in zip(s0.tolist(), s1.tolist(), q.tolist())),
                    dtype=np.uint64,
                    count=len(q),
                )
                doc = np.searchsorted(ends, s0 + lo, "right")
                move = lo - begins[doc]
                arrays = [h.view(np.int64), fp.view(np.int64), keys[doc], sizes[doc], *((x + move).astype(np.int32) for x in (q, s0, s1))]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], schema=target)

    return rows.mapInArrow(run, _RUN)


_SUFFIX = "lead bigint, h bigint, fp bigint, once boolean, key bigint, n int, q int, s0 int, s1 int, body binary"


def _suffixes(rows: DataFrame, span: int) -> DataFrame:
    """The bytes of the runs listed beside each text, with the first eight of the anchor as a number in their order."""
    target = _arrow(_SUFFIX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {f.name: [] for f in target}
            for key, n, text, runs in zip(*(batch.column(i) for i in range(4))):
                raw = text.as_buffer().to_pybytes()
                for r in runs.as_py():
                    body = raw[r["s0"] : r["s1"] + span]
                    at = r["q"] - r["s0"]
                    lead = int.from_bytes(body[at : at + 8], "big") - (1 << 63)
                    for k, v in (("lead", lead), ("key", key.as_py()), ("n", n.as_py()), ("body", body), *r.items()):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=target)

    return rows.mapInArrow(run, _SUFFIX)


_FOUND = "key bigint, n int, s0 int, s1 int"


def _bucket_windows(suffixes: DataFrame, span: int) -> DataFrame:
    """Repeated windows of runs that stand alone, from buckets in order of ``lead, h, fp``."""
    target = _arrow(_FOUND)
    names = ["lead", "h", "fp", "once", "key", "n", "q", "s0", "s1", "body"]

    def found(table: pa.Table) -> pa.RecordBatch:
        c = {k: table.column(k).combine_chunks() for k in names}
        h, fp = c["h"].to_numpy(), c["fp"].to_numpy()
        keep = np.concatenate(([True], (h[1:] != h[:-1]) | (fp[1:] != fp[:-1])))  # rows that repeat bring a run twice
        c = {k: v.filter(pa.array(keep)) for k, v in c.items()}
        h = c["h"].to_numpy()
        bodies = c["body"].to_pylist()
        start = np.cumsum([0, *map(len, bodies)])[:-1]
        s0, s1, q = (c[k].to_numpy().astype(np.int64) for k in ("s0", "s1", "q"))
        once = c["once"].to_numpy(zero_copy_only=False)
        group = np.cumsum(np.concatenate(([True], h[1:] != h[:-1])))
        run, window = repeated_windows(np.frombuffer(b"".join(bodies), np.uint8), group, start, q - s0, np.zeros_like(s0), s1 - s0, span)
        mine = once[run]
        run, window = run[mine], window[mine]
        order = np.lexsort((window, run))
        run, window = run[order], window[order]
        new = np.concatenate(([True], (run[1:] != run[:-1]) | (window[1:] != window[:-1] + 1))) if len(run) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(run)) - 1 if len(run) else first
        who = run[first]
        arrays = [c["key"].to_numpy()[who], c["n"].to_numpy()[who], (s0[who] + window[first]).astype(np.int32), (s0[who] + window[last]).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], schema=target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < GATHERED:
                continue
            table = pa.Table.from_batches(held)
            h = table.column("h").to_numpy()
            cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if (h != h[-1]).any() else 0  # the last token may go on
            if cut:
                yield found(table.slice(0, cut))
            rest = table.slice(cut)
            held, rows = rest.combine_chunks().to_batches(), rest.num_rows
        if rows:
            yield found(pa.Table.from_batches(held))

    return suffixes.select(*names).mapInArrow(run, _FOUND)


def _hashed_windows(suffixes: DataFrame, span: int) -> DataFrame:
    """Repeated windows of runs of very common tokens, counted over the cluster by offset and 128-bit hash."""
    schema = "h bigint, o int, w1 bigint, w2 bigint, once boolean, key bigint, n int, s int"
    target = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data = np.frombuffer(r["body"], np.uint8)
                m = len(data) - span + 1
                w1, w2 = (token_hashes(data, span, seed).view(np.int64) for seed in (0, 1))
                s = np.arange(r["s0"], r["s1"] + 1, dtype=np.int32)
                same = [pa.array(np.full(m, r[k])) .cast(target.field(k).type) for k in ("h", "once", "key", "n")]
                yield pa.RecordBatch.from_arrays(
                    [same[0], pa.array(s - r["q"]), pa.array(w1), pa.array(w2), same[1], same[2], same[3], pa.array(s)], schema=target
                )

    windows = materialize(suffixes.select("h", "once", "key", "n", "q", "s0", "s1", "body").mapInArrow(run, schema))
    by = ["h", "o", "w1", "w2"]
    twice = materialize(windows.groupBy(*by).agg(F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    return windows.where("once").join(twice, by, "left_semi").select("key", "n", F.col("s").alias("s0"), F.col("s").alias("s1"))


def repeated_intervals(rows: DataFrame, span: int, group: int = GROUP) -> DataFrame:
    """(key, n, s0, s1): windows ``s0`` to ``s1`` of the text ``key, n`` occur elsewhere too."""
    runs = materialize(_runs(rows.where(F.col("n") >= span), span))
    # sums are written before rows are joined to them: a join straight on an aggregate's shuffle can't split a hot token
    tokens = materialize(
        runs.groupBy("h")
        .agg(F.count(F.lit(1)).alias("c"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
        .where("c > 1")
        .select("h", (F.col("lo") == F.col("hi")).alias("whole"))
    )
    shared = materialize(runs.join(tokens, "h"))
    mixed = shared.where("not whole")
    kinds = materialize(
        mixed.groupBy("h", "fp").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("key", "n", "q", "s0", "s1")).alias("at"))
    )
    whole = shared.where("whole").select("key", "n", "s0", "s1")
    # a passage may be a third of all rows: the rows of one run are dealt out by their text, too
    again = kinds.where("c > 1").select("h", "fp", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dealt = mixed.withColumn("salt", F.pmod("key", F.lit(SALTS)).cast("int"))
    twice = dealt.join(again, ["h", "fp", "salt"], "left_semi").select("key", "n", "s0", "s1")

    # runs that occur once may still share some windows with other runs of their token
    per_token = materialize(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("runs"), F.min("c").alias("least")).where("least = 1"))
    wanted = kinds.join(per_token, "h").select("h", "fp", (F.col("c") == 1).alias("once"), "at.*", (F.col("runs") > group).alias("large"))
    listed = wanted.groupBy("key", "n").agg(F.collect_list(F.struct("h", "fp", "once", "q", "s0", "s1")).alias("runs"))
    suffixes = _suffixes(rows.join(listed, ["key", "n"]).select("key", "n", "text", "runs"), span)
    suffixes = materialize(suffixes)
    large = wanted.where("large").select("h").distinct()
    parts = max(8, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    small = suffixes.join(large, "h", "left_anti").repartitionByRange(parts, "lead", "h").sortWithinPartitions("lead", "h", "fp")
    out = whole.unionByName(twice).unionByName(_bucket_windows(small, span))
    if not large.isEmpty():
        common = suffixes.join(large, "h", "left_semi").dropDuplicates(["h", "fp"])
        out = out.unionByName(_hashed_windows(common, span))
    return out


def remove_repeats(
    docs: DataFrame, span: int = 200, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP
) -> DataFrame:
    """A row per document: bytes, bytes removed, removed stretches, and the hash of what is left."""
    if span < TOKEN:
        raise ValueError(f"span must be at least {TOKEN} bytes")
    spark = docs.sparkSession
    prepare(spark)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(
        F.xxhash64(docs[id_col], docs[text_col], F.lit(1)).alias("key"),
        F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).alias("n"),
        docs[text_col].alias("text"),
        docs[id_col].alias("id"),
    )
    found = repeated_intervals(rows.select("key", "n", "text"), span, group)
    per_text = found.groupBy("key", "n").agg(F.collect_list("s0").alias("s0"), F.collect_list("s1").alias("s1"))
    schema = f"`{id_col}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    target = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _bytes_of(batch.column(1))
            begins = np.concatenate(([0], ends[:-1]))
            removed, spans, digests = [], [], []
            for lo, hi, s0, s1 in zip(begins, ends, batch.column(2), batch.column(3)):
                text = data[lo:hi]
                if s0.is_valid:
                    edge = np.zeros(len(text) + 1, dtype=np.int64)
                    np.add.at(edge, s0.values.to_numpy(), 1)
                    np.add.at(edge, s1.values.to_numpy() + span, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    removed.append(int(gone.sum()))
                    spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
                    text = text[~gone]
                else:
                    removed.append(0)
                    spans.append(0)
                digests.append(hashlib.sha256(text.tobytes()).hexdigest())
            arrays = [batch.column(0).cast(target.field(0).type), ends - begins, removed, spans, digests]
            yield pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a, f.type) for a, f in zip(arrays, target)], schema=target)

    joined = rows.join(per_text, ["key", "n"], "left").select("id", "text", "s0", "s1")
    return joined.mapInArrow(run, schema)
