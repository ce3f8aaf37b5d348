"""Quality rules: gradient-boosted trees over document statistics.

A binary classifier (bad against good) is boosted in numpy on histogram bins
from a bounded sample of labelled documents. On the features of ``RISING`` the
chance of being bad may only rise (monotonic constraints). The trees are flattened into complete binary arrays, so a
batch of documents is scored by a few gathers per level.

Words are runs of anything but ``\\x20 \\x09-\\x0D``. Defined results: a null or
empty text has no words and fails the base rule; repeated rows repeat the
result; with no labels, or labels of one kind, the model rejects nothing; an
empty table gives an empty result; further columns are ignored by
``quality_scores`` and carried by ``keep_good``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import map_docs, rewrite_docs, smallest

#: Labelled rows the trees are fitted on, at most.
SAMPLE_ROWS = 6_000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "upper",
    "distinct", "stutter", "line_words", "shouts", "digits", "stops",
)
#: Features with which the chance of being bad may only rise.
RISING = ("symbols", "dup_lines", "repeats", "stutter", "shouts")

_KIND = np.zeros(256, np.uint8)  # 1 upper, 2 lower or other letter byte, 3 digit, 4 '!', 5 '.'
_KIND[65:91], _KIND[97:123], _KIND[128:], _KIND[48:58], _KIND[33], _KIND[46] = 1, 2, 2, 3, 4, 5


@dataclass
class Stats:
    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    features: np.ndarray

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words


def document_stats(text: str) -> Stats:
    """Base counts and model features of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at exactly \x20 and \x09-\x0D
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    dup = len(lines) - len(set(lines))
    ids = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    repeats = repeated_words(ids)
    f = np.zeros(len(FEATURES))
    if n:
        kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=6)
        letters = max(1, int(kinds[1] + kinds[2]))
        f[:] = (
            np.log1p(n), chars / n, symbols / n, dup / max(1, len(lines)), repeats / n, kinds[1] / letters,
            len(set(words)) / n, float((ids[1:] == ids[:-1]).mean()) if n > 1 else 0.0,
            np.log1p(n / max(1, len(lines))), kinds[4] / n, kinds[3] / max(1, chars), kinds[5] / n,
        )
    return Stats(n, chars, symbols, dup, repeats, f)


def repeated_words(ids: np.ndarray) -> int:
    """Words covered by a ``WINDOW``-word window that occurs twice or more.

    ``ids`` are 64-bit word hashes; windows compare by a 64-bit mix of them."""
    m = len(ids) - WINDOW + 1
    if m < 2:
        return 0
    mixed = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + (ids[k : k + m] ^ (ids[k : k + m] >> np.uint64(29)))
            mixed ^= mixed >> np.uint64(32)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(m, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:m] += twice
    edge[WINDOW : WINDOW + m] -= twice
    return int((np.cumsum(edge)[:-1] > 0).sum())


@dataclass(frozen=True)
class Trees:
    """Boosted trees as complete binary arrays: node i has children 2i+1 and 2i+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes
    leaf: np.ndarray  # trees x leaves
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of being bad of each row of ``x``."""
        total = np.full(len(x), self.start)
        if self.feature.size:
            rows, trees = np.arange(len(x))[:, None], np.arange(len(self.feature))[None, :]
            node = np.zeros((len(x), len(self.feature)), np.int64)
            for _ in range(self.depth):
                right = x[rows, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            total += self.leaf[trees, node - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-total))


#: A model that rejects nothing.
NO_TREES = Trees(np.zeros((0, 0), int), np.zeros((0, 0)), np.zeros((0, 0)), -30.0, 0)


def fit_trees(
    x: np.ndarray,
    bad: np.ndarray,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 48,
    ridge: float = 1.0,
    rising: tuple[str, ...] = RISING,
) -> Trees:
    """Second-order boosting of the logistic loss. A split on a rising feature
    must give its right child no smaller a value, and both children then stay
    on their side of the middle."""
    if len(bad) == 0 or bad.min() == bad.max():
        return NO_TREES
    up = np.array([f in rising for f in FEATURES[: x.shape[1]]] + [False] * max(0, x.shape[1] - len(FEATURES)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    coded = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    start = float(np.log(bad.mean() / (1 - bad.mean())))
    score = np.full(len(bad), start)
    inner = 2**depth - 1
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = bad - p, p * (1 - p)
        node = np.zeros(len(bad), np.int64)
        low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
        for i in range(inner):
            mine = np.flatnonzero(node == i)
            best = _best_split(coded[mine], g[mine], h[mine], cuts, up, ridge, low[i], high[i])
            a, b = 2 * i + 1, 2 * i + 2
            low[a], high[a], low[b], high[b] = low[i], high[i], low[i], high[i]
            if best is None:
                node[mine] = a
                continue
            j, cut, left, right = best
            feature[t, i], threshold[t, i] = j, cuts[j][cut]
            node[mine] = np.where(coded[mine, j] > cut, b, a)
            if up[j]:
                high[a] = low[b] = (left + right) / 2
        for k in range(inner + 1):
            mine = node == inner + k
            value = g[mine].sum() / (h[mine].sum() + ridge)
            leaf[t, k] = rate * min(max(value, low[inner + k]), high[inner + k])
        score += leaf[t, node - inner]
    return Trees(feature, threshold, leaf, start, depth)


def _best_split(coded, g, h, cuts, up, ridge, low, high):
    """(feature, cut, left value, right value) of the largest gain, or None."""
    best, gain = None, 1e-6
    if len(g) < 20:
        return None
    total_g, total_h = g.sum(), h.sum()
    for j, c in enumerate(cuts):
        if not len(c):
            continue
        gs = np.cumsum(np.bincount(coded[:, j], g, len(c) + 1))[:-1]
        hs = np.cumsum(np.bincount(coded[:, j], h, len(c) + 1))[:-1]
        lv = np.clip(gs / (hs + ridge), low, high)
        rv = np.clip((total_g - gs) / (total_h - hs + ridge), low, high)
        made = gs**2 / (hs + ridge) + (total_g - gs) ** 2 / (total_h - hs + ridge) - total_g**2 / (total_h + ridge)
        made[(hs < 1) | (total_h - hs < 1)] = 0
        if up[j]:
            made[lv > rv] = 0
        k = int(made.argmax())
        if made[k] > gain:
            gain, best = made[k], (j, k, lv[k], rv[k])
    return best


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, text_col: str = "text"):
    """Features and labels of at most ``rows`` labelled documents, those of the
    smallest hash of their id, so the choice is the same on every run. A
    document labelled twice counts as bad if any label says so."""
    clean = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    there = clean.count()
    share = min(1.0, rows / max(1, there))
    marked = clean.withColumn("_mark", F.expr("pmod(xxhash64(doc_id), 1000000)"))
    chosen = (
        marked.where(F.col("_mark") < int(share * 1_000_000))
        .groupBy("doc_id")
        .agg((1 - F.min("quality")).alias("_bad"))
    )
    # at most ``rows`` rows, whatever the input's size and however often an id is there
    texts = smallest(docs.select("doc_id", F.col(text_col).alias("_text")).join(F.broadcast(chosen), "doc_id"), rows, "doc_id", "_text")

    def features(_, ids, texts_, bad):
        made = [document_stats(t or "").features.tolist() for t in texts_]
        return {"bad": bad, "x": made}

    got = map_docs(
        texts, ["doc_id", "_text", "_bad"], features, "doc_id bigint, bad int, x array<double>"
    ).collect()
    got = sorted(got, key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in got]) if got else np.zeros((0, len(FEATURES)))
    return x, np.array([r["bad"] for r in got], float)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, **settings) -> Trees:
    return fit_trees(*labelled_sample(docs, labels, rows), **settings)


def quality_scores(docs: DataFrame, model: Trees, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """Base counts, ``base_failed``, ``kept`` and the model's chance of being bad, per document."""

    def rows(_, ids, texts):
        stats = [document_stats(t or "") for t in texts]
        chance = model.score(np.array([s.features for s in stats]).reshape(len(stats), -1))
        out = {n: [getattr(s, n) for s in stats] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")}
        out["kept"] = [not s.base_failed and p < threshold for s, p in zip(stats, chance.tolist())]
        out["bad_chance"] = chance.tolist()
        return out

    kind = dict(docs.dtypes)["doc_id"]
    return map_docs(
        docs,
        ["doc_id", text_col],
        rows,
        f"doc_id {kind}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean, bad_chance double",
    )


def keep_good(docs: DataFrame, model: Trees, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents that neither the base rule nor the model rejects, with all their columns."""

    def change(_, batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        stats = [document_stats(t) for t in texts]
        chance = model.score(np.array([s.features for s in stats]).reshape(len(stats), -1))
        return batch.filter(pa.array([not s.base_failed and p < threshold for s, p in zip(stats, chance.tolist())], pa.bool_()))

    return rewrite_docs(docs, text_col, change)
