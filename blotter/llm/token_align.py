"""Alignment of two tokenizers' tokens over the same bytes, by composing fragments.

Tokenizer A is a byte-level BPE over ``" " + text``, tokenizer B a SentencePiece BPE
over ``text`` (whose dummy prefix is that space). Offsets where tokens of both end cut
the bytes into groups. A byte range of a document yields a *fragment*: the tokens up to
its first shared end (open prefix), the groups between its first and last shared end
(closed), and the tokens after (open suffix). Fragments compose associatively: one's open
suffix and the next one's open prefix make a group as soon as the next one holds a
shared end. A text of at most ``chunk`` code points is one fragment. Longer ones are cut
into byte ranges, which are spread over the tasks, and whose open ends are composed by a
tree of grouped jobs (``FAN`` fragments a step); closed groups stay where they are.

A chunk is tokenized with context up to the next *safe point* on either side, a single
space between two characters that aren't white space: both tokenizers start a token
there whatever comes before (A's splitting pattern never lets a space follow within a
token; no piece of B holds its space mark after another character, which
``Tables.load`` proves). A token belongs to the range in which it ends. Where no safe
point is near, the cut is left out, so that a chunk may be longer than ``chunk``.

Corpus-wide pair counts are summed from each fragment's distinct pairs, and looked up in
blocks of at most ``PAIR_ROWS`` pairs and one B id's, each broadcast in its own pass
over the fragments; usually there is one block.

Defined results: texts that are null or empty, or whose joined tokens of A or B differ
from ``" " + text`` (such as those that hold U+2581), have no tokens: zeros and an empty
hash. Repeated rows are documents of their own, each counting in the pair counts. A null
id is kept. Ties for the highest count all count as best. An empty table gives an
empty result; further input columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import prepare
from blotter.llm.token_counts import MARK, tokenizer_path
from blotter.session import materialize

#: Code points of a byte range of a long document.
CHUNK = 32_768
#: How far from a cut a safe point is looked for, in code points.
CONTEXT = 1_024
#: Fragments composed in one step of the tree.
FAN = 16
#: Pairs of ids in a block that is broadcast (a B id's pairs are never split: at most A's vocabulary more).
PAIR_ROWS = 2_000_000
#: Entries of pair counts that a task holds before it passes them on.
HELD_PAIRS = 4_000_000
_SAFE = re.compile(r"(?<=\S) (?=\S)")

_STATS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"
_OPEN = ", ".join(f"{p}{x} array<bigint>" for p in ("p", "s") for x in ("a", "ae", "b", "be"))


@dataclass(frozen=True)
class Tables:
    """Both vocabularies: token lengths in bytes, joined bytes, and decimal texts."""

    ranks: dict[bytes, int]
    pattern: str
    model: bytes
    bytes_a: tuple[bytes, ...]
    bytes_b: tuple[bytes, ...]

    @staticmethod
    def load(ranks_path: str, model_path: str) -> Tables:
        import public_tokenizers
        import sentencepiece

        ranks = {}
        with open(ranks_path, "rb") as f:
            for line in f:
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
        with open(model_path, "rb") as f:
            model = f.read()
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        whole = [p for i, p in enumerate(pieces) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        if any(MARK in p.lstrip(MARK) for p in whole):
            raise ValueError("a piece holds a space mark after another character: chunks can't be cut at spaces")
        a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            a[rank] = token
        b = [
            bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else p.replace(MARK, " ").encode()
            for i, p in enumerate(pieces)
        ]
        return Tables(ranks, public_tokenizers.PATTERN, model, tuple(a), tuple(b))


class Aligner:
    """One task's tokenizers, and the arrays that make groups, links and digests."""

    def __init__(self, tables: Tables):
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding(
            "a", pat_str=tables.pattern, mergeable_ranks=tables.ranks, special_tokens={}
        )
        self.b = sentencepiece.SentencePieceProcessor(model_proto=tables.model)
        self.n_a = len(tables.bytes_a)
        self.bytes_a, self.bytes_b = (np.array(t, dtype=object) for t in (tables.bytes_a, tables.bytes_b))
        self.len_a, self.len_b = (
            np.array([len(x) for x in t], dtype=np.int64) for t in (tables.bytes_a, tables.bytes_b)
        )
        self.code = np.dtype("<u4" if self.n_a * len(tables.bytes_b) < 1 << 32 else "<u8")
        most = max(self.n_a, len(tables.bytes_b))
        width = len(str(most))
        # decimal texts, right-padded, with room for one separator
        self.digits = np.zeros((most, width + 1), dtype=np.uint8)
        self.width = np.array([len(str(i)) for i in range(most)], dtype=np.int64)
        for i in range(most):
            s = str(i).encode()
            self.digits[i, : len(s)] = np.frombuffer(s, np.uint8)

    def tokens(self, part: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
        """Ids and ends in bytes of A and B over a part that starts with a space, and whether both join to it."""
        raw = part.encode()
        a = np.array(self.a.encode_ordinary(part), dtype=np.int64)
        b = np.array(self.b.encode(part[1:]) if len(part) > 1 else [], dtype=np.int64)
        same = b"".join(self.bytes_a[a]) == raw and b"".join(self.bytes_b[b]) == raw
        return a, np.cumsum(self.len_a[a]), b, np.cumsum(self.len_b[b]), same

    def links(self, a, ae, b, be) -> np.ndarray:
        """Codes (B's id times A's size, plus A's id) of all overlapping pairs of whole groups:
        each stretch between neighbouring ends lies in one token of either."""
        ends = np.union1d(ae, be)
        i, j = np.searchsorted(ae, ends), np.searchsorted(be, ends)
        return b[j] * self.n_a + a[i]

    def text(self, a, ae, b, be) -> tuple[bytes, int]:
        """``a1,a2|b1;a3|b2,b3`` of whole groups, and how many there are."""
        cuts = np.intersect1d(ae, be, assume_unique=True)
        ga, gb = np.searchsorted(cuts, ae), np.searchsorted(cuts, be)  # each token's group
        per_a, per_b = np.bincount(ga, minlength=len(cuts)), np.bincount(gb, minlength=len(cuts))
        before_b = np.concatenate(([0], np.cumsum(per_b)[:-1]))
        place_a = np.arange(len(a)) + before_b[ga]
        place_b = np.arange(len(b)) + np.cumsum(per_a)[gb]
        n = len(a) + len(b)
        ids, sep = np.empty(n, dtype=np.int64), np.full(n, ord(","), dtype=np.uint8)
        ids[place_a], ids[place_b] = a, b
        sep[place_a[np.cumsum(per_a) - 1]] = ord("|")
        sep[place_b[np.cumsum(per_b) - 1]] = ord(";")
        table, width = self.digits[ids], self.width[ids]
        table[np.arange(n), width] = sep
        return table[np.arange(table.shape[1]) <= width[:, None]].tobytes(), len(cuts)

    def pairs(self, codes: np.ndarray) -> tuple[bytes, bytes]:
        """Distinct codes with their numbers as single bytes; a larger number takes several entries."""
        kinds, n = np.unique(codes, return_counts=True)
        times = (n + 254) // 255
        if len(times) and times.max() > 1:
            kinds, n = np.repeat(kinds, times), np.repeat(n, times)
            last = np.zeros(len(n), dtype=bool)
            last[np.cumsum(times) - 1] = True
            n = np.where(last, n - np.repeat((times - 1) * 255, times), 255)
        return kinds.astype(self.code).tobytes(), n.astype(np.uint8).tobytes()

    def closed(self, a, ae, b, be) -> dict:
        """Figures of whole groups."""
        if not len(a):
            return {"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "codes": b"", "times": b"", "groups": b""}
        codes = self.links(a, ae, b, be)
        text, n = self.text(a, ae, b, be)
        kinds, times = self.pairs(codes)
        return {"n_a": len(a), "n_b": len(b), "n_groups": n, "n_links": len(codes), "codes": kinds, "times": times, "groups": text}

    def fragment(self, part: str, at: int, pre: int, post: int) -> dict:
        """The fragment of ``part`` without ``pre`` and ``post`` code points of context; ``at`` is its first byte's place."""
        a, ae, b, be, same = self.tokens(part)
        if not same:
            return {"ok": False, "has": False, "end": at} | dict.fromkeys(_open_names(), np.zeros(0, np.int64)) | self.closed([], [], [], [])
        total = len(part.encode())
        lo, hi = len(part[:pre].encode()), total - (len(part[len(part) - post :].encode()) if post else 0)
        x = slice(np.searchsorted(ae, lo, "right"), np.searchsorted(ae, hi, "right"))
        y = slice(np.searchsorted(be, lo, "right"), np.searchsorted(be, hi, "right"))
        a, ae, b, be = a[x], ae[x] + at, b[y], be[y] + at
        shared = np.intersect1d(ae, be, assume_unique=True)
        first, last = (shared[0], shared[-1]) if len(shared) else (hi + at, hi + at)
        i0, i1 = np.searchsorted(ae, [first, last], "right")
        j0, j1 = np.searchsorted(be, [first, last], "right")
        return {
            "ok": True, "has": len(shared) > 0, "end": int(last),
            "pa": a[:i0], "pae": ae[:i0], "pb": b[:j0], "pbe": be[:j0],
            "sa": a[i1:], "sae": ae[i1:], "sb": b[j1:], "sbe": be[j1:],
        } | self.closed(a[i0:i1], ae[i0:i1], b[j0:j1], be[j0:j1])


def _open_names() -> list[str]:
    return [f"{p}{x}" for p in ("p", "s") for x in ("a", "ae", "b", "be")]


_ALIGNERS: dict[int, Aligner] = {}


def _aligner(tables: Tables) -> Aligner:
    """One aligner per worker process."""
    if id(tables) not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[id(tables)] = Aligner(tables)
    return _ALIGNERS[id(tables)]


def cuts(s: str, chunk: int = CHUNK, context: int = CONTEXT) -> list[tuple[int, int, int]]:
    """(place, safe point before, safe point after) of each cut of a long text."""
    out = [(0, 0, 0)]
    for c in range(chunk, len(s), chunk):
        base = max(c - context, 1) - 1
        near = [base + m.start() for m in _SAFE.finditer(s[base : c + context + 1])]
        before, after = [p for p in near if p <= c], [p for p in near if p >= c]
        if before and after:
            out.append((c, before[-1], after[0]))
    return [*out, (len(s), len(s), len(s))]


def compose(f: dict, g: dict) -> tuple[dict, dict | None]:
    """``f`` followed by ``g``, and the group that closes between them, if one does."""
    joined = {x: [*f[("s" if f["has"] else "p") + x], *g["p" + x]] for x in ("a", "ae", "b", "be")}
    out = {"has": f["has"] or g["has"]}
    if not g["has"]:  # what was open stays open
        for x, v in joined.items():
            out["p" + x], out["s" + x] = (f["p" + x], v) if f["has"] else (v, [])
        return out, None
    for x, v in joined.items():
        out["p" + x], out["s" + x] = f["p" + x] if f["has"] else v, g["s" + x]
    return out, joined if f["has"] and len(joined["a"]) else None


def _fold(table: pa.Table, schema: pa.Schema, aligner: Aligner, root: bool) -> pa.Table:
    """Composes the fragments of one group in order; closed groups become rows of their own."""
    rows = table.sort_by("idx").to_pylist()
    out, done = [], []
    state = rows[0]
    for g in rows[1:]:
        state_open, group = compose(state, g)
        state = {"key": state["key"], "idx": state["idx"]} | state_open
        if group:
            done.append(group)
    if root and len(state["pa"]):  # the text's start is shared
        done.insert(0, {x: state["p" + x] for x in ("a", "ae", "b", "be")})
    if not root:
        out.append({"key": rows[0]["key"], "idx": rows[0]["idx"] // FAN, "open": True} | {k: state[k] for k in ("has", *_open_names())})
    for group in done:
        arrays = [np.array(group[x], dtype=np.int64) for x in ("a", "ae", "b", "be")]
        out.append({"key": rows[0]["key"], "idx": -1, "open": False, "end": int(arrays[1][-1])} | aligner.closed(*arrays))
    return pa.Table.from_pylist(out, schema=schema)


def _folder(target: pa.Schema, shared, root: bool):
    def fold(table: pa.Table) -> pa.Table:
        return _fold(table, target, _aligner(shared.value), root)

    return fold


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _map(df: DataFrame, make, schema: str) -> DataFrame:
    """``make(rows as dicts) -> dicts`` a batch, through Arrow."""
    target = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(make(batch.to_pylist()))
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=target)

    return df.mapInArrow(run, schema)


def alignments(
    docs: DataFrame,
    ranks_path: str | None = None,
    model_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    pair_rows: int = PAIR_ROWS,
) -> DataFrame:
    """A row per document: tokens, groups, links, links of the B id's highest pair count, the sum of the links'
    counts, and the digest of its groups."""
    spark = docs.sparkSession
    prepare(spark)
    tables = Tables.load(ranks_path or tokenizer_path("byte_bpe_50k.tiktoken"), model_path or tokenizer_path())
    shared = spark.sparkContext.broadcast(tables)
    kind = dict(docs.dtypes)[id_col]
    body = f"{_STATS}, codes binary, times binary, groups binary"
    base = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.monotonically_increasing_id().alias("key"))

    # 1. short documents are done at once; long ones leave as chunks with context
    head = f"id {kind}, key bigint, idx int, part string, at bigint, pre int, post int, sha string, {body}"

    def first(rows: list[dict]) -> Iterator[dict]:
        aligner = _aligner(shared.value)
        for r in rows:
            text = r["text"] or ""
            row = {"id": r["id"], "key": r["key"], "idx": -1}
            if len(text) < chunk:
                whole = aligner.tokens(" " + text) if text else ([],) * 4 + (True,)
                row |= aligner.closed(*(whole[:4] if whole[4] else ([],) * 4))
                groups = row.pop("groups")
                yield row | {"sha": hashlib.sha256(groups[:-1]).hexdigest() if groups else ""}
                continue
            s = " " + text
            places = cuts(s, chunk)
            at, last = 0, 0
            for k, ((lo, before, _), (hi, _, after)) in enumerate(zip(places, places[1:])):
                at, last = at + len(s[last:before].encode()), before
                yield row | {"idx": k, "part": s[before:after], "at": at, "pre": lo - before, "post": after - hi}

    made = materialize(_map(base, first, head))
    short = made.where("idx < 0").select("id", "key", F.lit(0).cast("bigint").alias("end"), *_names(_STATS), "codes", "times", "sha")

    # 2. chunks of long documents, spread over the tasks
    most = made.agg(F.max("idx")).first()[0]
    if most is not None and most >= 0:
        rows = short.unionByName(_long(made, shared, most, body, kind), allowMissingColumns=True)
    else:
        rows = short.withColumn("groups", F.lit(None).cast("binary"))
    if most is not None and most >= 0:
        rows = materialize(rows)
    rows = rows.withColumns({"n_best": F.lit(0).cast("bigint"), "count_sum": F.lit(0).cast("bigint")})

    # 3. pair counts over the corpus, looked up in blocks
    counts = materialize(_pair_counts(rows, shared))
    blocks = _blocks(counts, len(tables.bytes_a), pair_rows)
    for k, (lo, hi) in enumerate(blocks):
        rows = _looked_up(rows, counts, shared, lo, hi)
        if k % 4 == 3 and k + 1 < len(blocks):
            rows = materialize(rows)

    # 4. long documents are put together in order of their bytes, their digest as a stream
    names = [*_names(_STATS), "n_best", "count_sum"]
    out = rows.where("sha is not null").select(F.col("id").alias(id_col), *names, F.col("sha").alias("groups_sha256"))
    if most is not None and most >= 0:
        out = out.unionByName(_joined(rows.where("sha is null"), names, kind, id_col))
    return out


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _long(made: DataFrame, shared, most: int, body: str, kind: str) -> DataFrame:
    """Rows of closed groups of the long documents, each with its place, and a head row a document (``end`` -1,
    negative ``n_a`` if its tokens don't join to its text)."""
    chunks = made.where("idx >= 0").select("id", "key", "idx", "part", "at", "pre", "post")
    schema = f"id {kind}, key bigint, idx int, ok boolean, has boolean, end bigint, {_OPEN}, {body}"

    def cut(rows: list[dict]) -> Iterator[dict]:
        aligner = _aligner(shared.value)
        for r in rows:
            yield {k: r[k] for k in ("id", "key", "idx")} | aligner.fragment(r["part"], r["at"], r["pre"], r["post"])

    # a document's chunks go to tasks by key and place, so that one document isn't one task
    frags = materialize(_map(chunks.repartition("key", "idx"), cut, schema))
    bad = frags.where("not ok").select("key").distinct()
    good = frags.join(bad, "key", "left_anti")
    opens = good.select("key", "idx", "has", *_open_names())
    closed = [good.where("n_groups > 0").select("key", "end", *_names(body))]
    steps = 1
    while FAN**steps <= most:
        steps += 1
    for step in range(steps):
        root = step == steps - 1
        out = f"key bigint, idx int, open boolean, has boolean, {_OPEN}, end bigint, {body}"
        level = materialize(opens.groupBy("key", F.floor(F.col("idx") / FAN).alias("up")).applyInArrow(_folder(_arrow(out), shared, root), out))
        closed.append(level.where("not open").select("key", "end", *_names(body)))
        opens = level.where("open").select("key", "idx", "has", *_open_names())
    heads = (
        frags.groupBy("key")
        .agg(F.first(F.when(F.col("idx") == 0, F.struct("id")), ignorenulls=True).alias("h"), F.min("ok").alias("ok"))
        .select(F.col("h.id").alias("id"), "key", F.lit(-1).cast("bigint").alias("end"), F.when(F.col("ok"), 0).otherwise(-1).cast("bigint").alias("n_a"))
    )
    for part in closed:
        heads = heads.unionByName(part, allowMissingColumns=True)
    return heads.fillna(0, _names(_STATS))


def _pair_counts(rows: DataFrame, shared) -> DataFrame:
    """(code, n): links of each pair of ids over the corpus, summed up in each task first."""
    target = _arrow("code bigint, n bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _aligner(shared.value).code
        codes, n = [], []
        held = 0

        def summed() -> tuple[np.ndarray, np.ndarray]:
            kinds, at = np.unique(np.concatenate(codes), return_inverse=True)
            return kinds, np.bincount(at, weights=np.concatenate(n), minlength=len(kinds)).astype(np.int64)

        for batch in batches:
            c, t = (batch.column(i).drop_null() for i in (0, 1))
            codes.append(np.frombuffer(b"".join(c.to_pylist()), dtype=kind))
            n.append(np.frombuffer(b"".join(t.to_pylist()), dtype=np.uint8))
            held += len(codes[-1])
            if held > HELD_PAIRS:
                kinds, sums = summed()
                if len(kinds) > HELD_PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int64)), pa.array(sums)], schema=target)
                    kinds, sums = kinds[:0], sums[:0]
                codes, n, held = [kinds], [sums], len(kinds)
        if codes:
            kinds, sums = summed()
            yield pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int64)), pa.array(sums)], schema=target)

    return rows.select("codes", "times").mapInArrow(run, target_ddl(target)).groupBy("code").agg(F.sum("n").alias("n"))


def target_ddl(schema: pa.Schema) -> str:
    from pyspark.sql.pandas.types import from_arrow_type

    return ", ".join(f"{f.name} {from_arrow_type(f.type).simpleString()}" for f in schema)


def _blocks(counts: DataFrame, size_a: int, most: int) -> list[tuple[int, int]]:
    """Ranges of codes of at most ``most`` pairs, whole B ids each: at most B's vocabulary of rows comes here."""
    per = counts.groupBy(F.floor(F.col("code") / size_a).alias("b")).agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("b")
    blocks, held, lo = [], 0, 0
    for b, n in zip(per["b"], per["n"]):
        if held and held + n > most:
            blocks.append((lo * size_a, int(b) * size_a))
            lo, held = int(b), 0
        held += n
    return [*blocks, (lo * size_a, 1 << 62)] if held else []


def _looked_up(rows: DataFrame, counts: DataFrame, shared, lo: int, hi: int) -> DataFrame:
    """Adds one block's share of ``n_best`` and ``count_sum`` to the rows."""
    block = counts.where((F.col("code") >= lo) & (F.col("code") < hi)).toArrow().sort_by("code")
    codes, n = (block.column(c).to_numpy() for c in ("code", "n"))
    size_a = len(shared.value.bytes_a)
    starts = np.flatnonzero(np.diff(codes // size_a, prepend=-1))
    best = np.repeat(np.maximum.reduceat(n, starts), np.diff(np.append(starts, len(n)))) == n
    sent = rows.sparkSession.sparkContext.broadcast((codes, n, best))
    target = _arrow(target_ddl_of(rows))
    at = {name: rows.columns.index(name) for name in ("codes", "times", "n_best", "count_sum")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _aligner(shared.value).code
        codes, n, best = sent.value
        for batch in batches:
            texts = batch.column(at["codes"]).fill_null(b"").to_pylist()
            doc = np.repeat(np.arange(len(texts)), [len(t) // kind.itemsize for t in texts])
            mine = np.frombuffer(b"".join(texts), dtype=kind).astype(np.int64)
            times = np.frombuffer(b"".join(batch.column(at["times"]).fill_null(b"").to_pylist()), dtype=np.uint8)
            if lo or hi < 1 << 62:
                inside = (mine >= lo) & (mine < hi)
                doc, mine, times = doc[inside], mine[inside], times[inside]
            place = np.searchsorted(codes, mine)
            first = np.searchsorted(doc, np.arange(len(texts) + 1))
            arrays = list(batch.columns)
            for name, part in (("n_best", times * best[place]), ("count_sum", times * n[place])):
                run_sum = np.concatenate(([0], np.cumsum(part, dtype=np.int64)))
                more = run_sum[first[1:]] - run_sum[first[:-1]]
                arrays[at[name]] = pa.array(batch.column(at[name]).to_numpy() + more)
            yield pa.RecordBatch.from_arrays(arrays, schema=target)

    return rows.mapInArrow(run, rows.schema)


def target_ddl_of(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def _joined(parts: DataFrame, names: list[str], kind: str, id_col: str) -> DataFrame:
    """Long documents from their parts in order: figures are summed, and the digest takes the groups as they come."""
    schema = f"`{id_col}` {kind}, {', '.join(f'{n} bigint' for n in names)}, groups_sha256 string"
    target = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, doc, sums, sha, held, bad = None, None, None, None, b"", False

        def done() -> pa.RecordBatch:
            sha.update(held[:-1])
            row = {id_col: doc, "groups_sha256": "" if bad else sha.hexdigest()} | dict(zip(names, [0] * len(names) if bad else sums))
            return pa.RecordBatch.from_pylist([row], schema=target)

        for batch in batches:
            for r in batch.to_pylist():
                if r["end"] < 0:  # a document's head comes first
                    if key is not None:
                        yield done()
                    key, doc, bad = r["key"], r["id"], r["n_a"] < 0
                    sums, sha, held = [0] * len(names), hashlib.sha256(), b""
                    continue
                sums = [x + r[n] for x, n in zip(sums, names)]
                sha.update(held)
                held = r["groups"]
        if key is not None:
            yield done()

    cols = ["id", "key", "end", *names, "groups"]
    return parts.select(*cols).repartition("key").sortWithinPartitions("key", "end").mapInArrow(run, schema)
