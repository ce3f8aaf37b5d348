"""Secret scans: character Markov models of random strings and of ordinary identifiers.

Both are trigram models over the 67 characters of ``[A-Za-z0-9+/_=.-]`` and the
word edge. The ordinary model is counted over the words of all
documents outside the spans that the base patterns label as secrets; the
random model over those labelled spans and generated keys of common alphabets.
A run of such characters whose log-likelihood ratio is high enough, in total
and a character, is a span of kind ``markov``.

Offsets are code points, end exclusive. Defined results: a null text counts as
empty and holds no span; a run inside a base span is not reported again;
repeated rows repeat the result; an empty table gives an empty result and a
model of generated keys alone; further columns are ignored by ``secret_spans``
and carried by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import map_docs, prepare, replace_column, rewrite_docs, span_text, texts_of

#: Characters of text counted at once.
COUNT_CHARS = 1 << 20
MIN_RUN = 20
MIN_RATIO = 15.0
MIN_RATIO_PER_CHAR = 0.6
KINDS = ("assign", "access", "hex", "markov")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_ASSIGN_HINT = ("passw", "secret", "token", "api")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=.-"
N = len(ALPHABET) + 1  # 0 is the edge
_CODE = np.zeros(256, np.int64)
_CODE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, N)
_DIGIT = np.array([False] + [c.isdigit() for c in ALPHABET])
_MARK = np.array([False] + [not c.isalnum() for c in ALPHABET])


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the three fixed patterns, by start, then kind as listed."""
    spans = []
    if (":" in text or "=" in text) and any(h in (low := text.lower()) for h in _ASSIGN_HINT):
        spans += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    spans += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _trigrams(codes: np.ndarray) -> np.ndarray:
    """Index of each character's trigram; ``codes`` begins with two edges."""
    return (codes[:-2] * N + codes[1:-1]) * N + codes[2:]


def count_runs(raw: bytes, least: int = 4) -> np.ndarray:
    """Trigram indexes of the runs of at least ``least`` characters."""
    codes, starts, ends = find_runs(raw, least)
    step = np.zeros(len(codes) + 1, np.int8)
    step[starts], step[ends] = 1, -1
    padded = np.concatenate(([0, 0], codes))
    first, second = padded[:-2], padded[1:-1]
    # what comes before a run's edge belongs to another run
    index = (np.where(second > 0, first, 0) * N + second) * N + codes
    return index[np.cumsum(step[:-1], dtype=np.int8) > 0]


def find_runs(raw: bytes, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = _CODE[np.frombuffer(raw, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], codes > 0, [False]))))
    starts, ends = edge[::2], edge[1::2]
    long = ends - starts >= least
    return codes, starts[long], ends[long]


def generated_keys(n: int = 3_000, seed: int = 7) -> list[str]:
    """Random strings of the alphabets that keys come in."""
    rng = np.random.default_rng(seed)
    kinds = ("0123456789abcdef", "0123456789ABCDEF", ALPHABET[:62], ALPHABET[:64], ALPHABET[:26] + "0123456789", ALPHABET[26:62])
    return ["".join(rng.choice(list(kinds[i % len(kinds)]), int(rng.integers(20, 64)))) for i in range(n)]


@dataclass(frozen=True)
class Markov:
    """Log-likelihood ratio (random against ordinary) of each trigram."""

    ratio: np.ndarray

    @staticmethod
    def fit(ordinary: np.ndarray, random: np.ndarray) -> Markov:
        """Trigram counts into a ratio, each model backed off to its bigrams.
        Marks between the parts of an identifier tell nothing and count 0."""

        def logs(counts: np.ndarray) -> np.ndarray:
            c = counts.reshape(N, N, N).astype(float)
            two = c.sum(axis=0)
            one = two.sum(axis=0) + 1.0
            two = (two + 8.0 * one / one.sum()) / (two.sum(axis=1, keepdims=True) + 8.0)
            return np.log((c + 8.0 * two[None]) / (c.sum(axis=2, keepdims=True) + 8.0))

        ratio = logs(random) - logs(ordinary)
        ratio[:, :, _MARK] = 0.0
        ratio[:, _MARK, :] = 0.0
        return Markov(np.clip(ratio, -6.0, 6.0).astype(np.float32).ravel())

    def spans(self, raws: list[bytes]) -> list[list[tuple[int, int]]]:
        """Byte spans of each text's runs that look random, in one pass over the batch."""
        found: list[list[tuple[int, int]]] = [[] for _ in raws]
        first = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raws]))).astype(np.int64)
        codes, starts, ends = find_runs(b"\n".join(raws), MIN_RUN)
        for a, b in zip(starts.tolist(), ends.tolist()):
            run = codes[a:b]
            if _DIGIT[run].all() or not (_DIGIT | _MARK)[run].any() and self._plain(run):
                continue
            ratio = float(self.ratio[_trigrams(np.concatenate(([0, 0], run)))].sum())
            if ratio >= MIN_RATIO and ratio >= MIN_RATIO_PER_CHAR * (b - a):
                k = int(np.searchsorted(first, a, side="right")) - 1
                found[k].append((a - int(first[k]), b - int(first[k])))
        return found

    @staticmethod
    def _plain(run: np.ndarray) -> bool:
        """A word of one case, or with a capital: keys of letters alone mix the cases."""
        upper = (run > 26) & (run <= 52)
        return not upper[1:].any() or upper.all()


def fit(docs: DataFrame, text_col: str = "text") -> Markov:
    """Counts of the ordinary model come from all documents, summed in each
    task and then by Spark; the driver gets one count per trigram."""

    def run(batches):
        total = np.zeros((2, N**3), np.int64)
        parts, held = ([], []), 0  # plain, secret

        def count():
            for i, p in enumerate(parts):
                total[i] += np.bincount(count_runs("\n".join(p).encode("utf-8", "surrogatepass")), minlength=N**3)
                p.clear()

        for batch in batches:
            for t in texts_of(batch.column(0)):
                spans, at = base_spans(t), 0
                for _, a, b in sorted(spans, key=lambda s: s[1]):
                    parts[0].append(t[at:a] if a > at else "")
                    at = max(at, b)
                parts[0].append(t[at:])
                parts[1].extend(t[a:b] for k, a, b in spans if k != "assign")
                held += len(t)
                if held > COUNT_CHARS:
                    count()
                    held = 0
        count()
        for i in range(2):
            some = np.flatnonzero(total[i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array(np.full(len(some), i == 1)), pa.array(total[i][some], pa.int64())], names=["g", "s", "k"]
            )

    prepare(docs.sparkSession)
    counts = docs.select(text_col).mapInArrow(run, "g bigint, s boolean, k bigint").groupBy("g", "s").agg(F.sum("k").alias("k")).toArrow()
    at, of, k = (counts[c].to_numpy() for c in ("g", "s", "k"))
    ordinary, random = np.zeros(N**3), np.zeros(N**3)
    ordinary[at[~of]], random[at[of]] = k[~of], k[of]
    for key in generated_keys():
        np.add.at(random, count_runs(key.encode()), 1)
    # the same words in capitals, and plain numbers, are ordinary too
    cube = ordinary.reshape(N, N, N)
    up = np.arange(N)
    up[1:27] += 26
    capitals = np.zeros_like(cube)
    np.add.at(capitals, (up[:, None, None], up[None, :, None], up[None, None, :]), 0.2 * cube)
    rng = np.random.default_rng(11)
    numbers = "\n".join("".join(rng.choice(list("0123456789"), int(rng.integers(4, 20)))) for _ in range(2_000))
    ordinary = (cube + capitals).ravel()
    np.add.at(ordinary, count_runs(numbers.encode()), 1)
    return Markov.fit(ordinary, random)


def all_spans(model: Markov, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Base and model spans of each text, by start, then kind as listed."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    out = []
    for text, raw, extra in zip(texts, raws, model.spans(raws)):
        spans = base_spans(text)
        for a, b in extra:
            start = a if text.isascii() else len(raw[:a].decode("utf-8", "surrogatepass"))
            end = start + b - a
            if all(end <= x or start >= y for _, x, y in spans if _ != "markov"):
                spans.append(("markov", start, end))
        out.append(sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))))
    return out


def secret_spans(docs: DataFrame, model: Markov, text_col: str = "text") -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans, per document."""

    def rows(_, ids, texts):
        found = all_spans(model, [t or "" for t in texts])
        base = [[s for s in f if s[0] != "markov"] for f in found]
        out = {f"n_{k}": [sum(s[0] == k for s in f) for f in found] for k in KINDS}
        out["base_sha256"] = [hashlib.sha256(span_text(b).encode()).hexdigest() for b in base]
        out["spans"] = [span_text(f) for f in found]
        return out

    kind = dict(docs.dtypes)["doc_id"]
    return map_docs(
        docs,
        ["doc_id", text_col],
        rows,
        f"doc_id {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_markov bigint",
    )


def redact(docs: DataFrame, model: Markov, mark: str = "[SECRET]", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with every span replaced by ``mark`` and their length
    column, where there is one, set anew; untouched texts keep both."""

    def change(_, batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        found = all_spans(model, texts)
        if not any(found):
            return batch
        old = batch.column(batch.schema.names.index(text_col)).to_pylist()
        new = [cut_out(t, f, mark) if f else o for o, t, f in zip(old, texts, found)]
        out = replace_column(batch, text_col, new)
        if length_col in batch.schema.names:
            sizes = batch.column(batch.schema.names.index(length_col)).to_pylist()
            out = replace_column(out, length_col, [len(n) if f else s for n, f, s in zip(new, found, sizes)])
        return out

    return rewrite_docs(docs, text_col, change)


def cut_out(text: str, spans: list[tuple[str, int, int]], mark: str) -> str:
    """The text with the union of the spans replaced, overlapping ones by one mark."""
    out, at = [], 0
    merged: list[list[int]] = []
    for _, a, b in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])
