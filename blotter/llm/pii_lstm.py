"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

Both are bound to four kinds: email, ip, card, phone. The network reads
character classes; its weights and the CRF's transitions are trained in numpy
from labelled spans: windows around the patterns' spans in a bounded sample of
documents, and generated spans in further notations (phone numbers without a
plus sign, cards with dots) among generated numbers that are nothing personal.

Texts are cut into tiles of ``CORE`` characters; a window is a tile with
``CONTEXT`` characters on either side. Windows are decoded on their own, every
character takes its tag from the window in whose tile it is, and spans are read
from the joined tags, so a span may cross tiles. Every kind needs a digit or an
``@``: tiles without one nearby cannot hold part of a span and are skipped. A
span of the model is kept if it passes its kind's check and overlaps no span of
the patterns.

Offsets are code points, end exclusive. Defined results: a null text counts as
empty and holds no span; repeated rows repeat the result; without documents to
learn from the generated spans alone train the model; an empty table gives an empty result;
further columns are ignored by ``personal_spans`` and carried by ``redact``.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import code_points, map_docs, replace_column, rewrite_docs, smallest, span_text

KINDS = ("email", "ip", "card", "phone")
#: Documents that labelled windows are taken from, at most so many, and windows of each.
SAMPLE_DOCS = 2_000
SAMPLE_WINDOWS = 3
CORE, CONTEXT = 64, 32
WINDOW = CORE + 2 * CONTEXT
#: Windows that go through the network at a time.
STEP_WINDOWS = 1_024
HIDDEN, EMBED = 20, 12
TAGS = 1 + 2 * len(KINDS)  # outside, then first and further characters of each kind

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HINT = re.compile(r"[0-9@]")
_NOT_DIGIT = re.compile(r"[^0-9]")

#: Character classes: one per mark that matters, one per kind of letter.
_MARKS = "@.-+()_% \n,:/#*$&=\"'"
_CLASS = np.full(128, 4, np.int64)  # other marks
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123], _CLASS[:32] = 1, 2, 3, 5
for _i, _c in enumerate(_MARKS):
    _CLASS[ord(_c)] = 7 + _i
CLASSES = 7 + len(_MARKS)  # 0: beyond the text, 6: outside ASCII


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _emails(text: str) -> list[tuple[str, int, int]]:
    """From each ``@`` outwards, so that long words without one cost nothing."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind as listed, then start."""
    if not _HINT.search(text):
        return []
    spans = _emails(text)
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(len(g.lstrip("0")) < 4 and int(g.lstrip("0") or 0) <= 255 for g in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return spans


def classes(text: str) -> np.ndarray:
    points = code_points(text)
    return np.where(points < 128, _CLASS[np.minimum(points, 127)], 6)


# --- the network -----------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Network:
    """Weights by name: E (classes x embed), per direction W and b (gates i f o g), V and c (tag scores), T (transitions)."""

    w: dict[str, np.ndarray]

    @staticmethod
    def fresh(seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        w = {"E": draw(CLASSES, EMBED) * 2, "V": draw(2 * HIDDEN, TAGS), "c": np.zeros(TAGS, np.float32), "T": np.zeros((TAGS, TAGS), np.float32)}
        for d in "fb":
            w["W" + d] = draw(EMBED + HIDDEN, 4 * HIDDEN)
            w["b" + d] = np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN))).astype(np.float32)
        return Network(w)

    def _direction(self, x: np.ndarray, d: str, keep: bool = False):
        """Hidden states of one direction over (time, window, embed); with ``keep`` also what the gradient needs."""
        w, b = self.w["W" + d], self.w["b" + d]
        steps, n = x.shape[:2]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        out = np.empty((steps, n, HIDDEN), np.float32)
        ready = x.reshape(-1, EMBED) @ w[:EMBED] + b
        ready = ready.reshape(steps, n, 4 * HIDDEN)
        saved = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = ready[t] + h @ w[EMBED:]
            gates = _sigmoid(z[:, : 3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            before, old = h, c
            c = f * c + i * g
            tc = np.tanh(c)
            h = out[t] = o * tc
            if keep:
                saved.append((t, i, f, o, g, before, old, tc))
        return out, saved

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (time, window, tag) of windows of classes (window, time)."""
        e = self.w["E"][x.T]
        both = np.concatenate((self._direction(e, "f")[0], self._direction(e, "b")[0]), axis=2)
        return both @ self.w["V"] + self.w["c"]

    def tags(self, x: np.ndarray) -> np.ndarray:
        """Most likely tags (window, time) under the CRF."""
        s, trans = self.scores(x), self.w["T"] + _FORBIDDEN
        steps, n = s.shape[:2]
        best, back = s[0] + _FORBIDDEN_FIRST, np.empty((steps, n, TAGS), np.int8)
        for t in range(1, steps):
            all_ = best[:, :, None] + trans
            back[t] = all_.argmax(axis=1)
            best = all_.max(axis=1) + s[t]
        out = np.empty((n, steps), np.int8)
        out[:, -1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            out[:, t - 1] = back[t][np.arange(n), out[:, t]]
        return out

    def gradient(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log-likelihood of tags ``y`` and its gradient."""
        n, steps = x.shape
        rows = np.arange(n)
        e = self.w["E"][x.T]
        hf, sf = self._direction(e, "f", True)
        hb, sb = self._direction(e, "b", True)
        both = np.concatenate((hf, hb), axis=2)
        s = (both @ self.w["V"] + self.w["c"]).astype(np.float64)
        trans = (self.w["T"] + _FORBIDDEN).astype(np.float64)
        alpha, beta = np.empty_like(s), np.zeros_like(s)
        alpha[0] = s[0]
        for t in range(1, steps):
            alpha[t] = s[t] + _logsum(alpha[t - 1][:, :, None] + trans, 1)
        for t in range(steps - 2, -1, -1):
            beta[t] = _logsum(trans[None] + (s[t + 1] + beta[t + 1])[:, None, :], 2)
        z = _logsum(alpha[-1], 1)
        gold = s[0][rows, y[:, 0]].copy()
        dt = np.zeros((TAGS, TAGS))
        for t in range(1, steps):
            gold += s[t][rows, y[:, t]] + trans[y[:, t - 1], y[:, t]]
            both_ = alpha[t - 1][:, :, None] + trans + (s[t] + beta[t])[:, None, :] - z[:, None, None]
            dt += np.exp(both_).sum(axis=0)
            np.subtract.at(dt, (y[:, t - 1], y[:, t]), 1)
        ds = np.exp(alpha + beta - z[None, :, None])
        ds[np.arange(steps)[:, None], rows[None], y.T] -= 1
        ds = (ds / n).astype(np.float32)
        g = {"T": (dt / n).astype(np.float32) * (_FORBIDDEN == 0), "V": both.reshape(-1, 2 * HIDDEN).T @ ds.reshape(-1, TAGS), "c": ds.sum(axis=(0, 1))}
        dh = ds @ self.w["V"].T
        de = np.zeros_like(e)
        for d, saved, part in (("f", sf, dh[:, :, :HIDDEN]), ("b", sb, dh[:, :, HIDDEN:])):
            w = self.w["W" + d]
            dz_all = np.empty((steps, n, 4 * HIDDEN), np.float32)
            h_all = np.empty((steps, n, HIDDEN), np.float32)
            later_h, later_c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
            for t, i, f, o, gg, before, old, tc in reversed(saved):
                up = part[t] + later_h
                dc = later_c + up * o * (1 - tc * tc)
                dz_all[t] = np.concatenate((dc * gg * i * (1 - i), dc * old * f * (1 - f), up * tc * o * (1 - o), dc * i * (1 - gg * gg)), axis=1)
                h_all[t] = before
                later_h = dz_all[t] @ w[EMBED:].T
                later_c = dc * f
            flat = dz_all.reshape(-1, 4 * HIDDEN)
            g["W" + d] = np.concatenate((e.reshape(-1, EMBED).T @ flat, h_all.reshape(-1, HIDDEN).T @ flat))
            g["b" + d] = flat.sum(axis=0)
            de += (flat @ w[:EMBED].T).reshape(de.shape)
        g["E"] = np.zeros_like(self.w["E"])
        np.add.at(g["E"], x.T.ravel(), de.reshape(-1, EMBED))
        return float((z - gold).mean()), g


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


#: A span's further characters follow its first or further ones only.
_FORBIDDEN = np.zeros((TAGS, TAGS), np.float32)
for _k in range(len(KINDS)):
    _FORBIDDEN[:, 2 + 2 * _k] = -1e4
    _FORBIDDEN[[1 + 2 * _k, 2 + 2 * _k], 2 + 2 * _k] = 0
#: A window may begin inside a span.
_FORBIDDEN_FIRST = np.zeros(TAGS, np.float32)


def train(x: np.ndarray, y: np.ndarray, steps: int = 360, size: int = 48, rate: float = 0.02, seed: int = 5) -> Network:
    """Adam on random batches; deterministic for the same windows."""
    net, rng = Network.fresh(seed), np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.w.items()}
    second = {k: np.zeros_like(v) for k, v in net.w.items()}
    for step in range(1, steps + 1):
        rows = rng.integers(0, len(x), min(size, len(x)))
        _, g = net.gradient(x[rows], y[rows])
        norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, v in g.items():
            v = v * min(1.0, 5 / (norm + 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * v
            second[k] = 0.99 * second[k] + 0.01 * v * v
            net.w[k] = net.w[k] - (now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


# --- labelled windows ------------------------------------------------------


def tag_row(length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    y = np.zeros(length, np.int64)
    for kind, a, b in spans:
        k = KINDS.index(kind)
        y[a:b] = 2 + 2 * k
        y[a] = 1 + 2 * k
    return y


def generated(n: int = 2_400, seed: int = 9) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Texts with labelled spans in many notations, and numbers that are nothing personal."""
    rng = np.random.default_rng(seed)
    digits = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    letters = lambda a, b: "".join(rng.choice(list("abcdefghijklmnoprstuvéß"), rng.integers(a, b)))

    def card() -> str:
        body = digits(15)
        whole = next(body + str(d) for d in range(10) if luhn(body + str(d)))
        sep = rng.choice([" ", "-", "", "."])
        return sep.join(whole[k : k + 4] for k in (0, 4, 8, 12))

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        forms = (f"+1 ({a}) {b}-{c}", f"+{digits(2)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"+{digits(11)}")
        return forms[rng.integers(0, len(forms))]

    def email() -> str:
        name = letters(2, 9).replace("é", "e").replace("ß", "s")
        return f"{name}{rng.choice(['', '.', '_', '+'])}{digits(int(rng.integers(0, 4)))}@{'mail' + digits(1)}.example.{rng.choice(['com', 'org', 'co.uk'])}".replace(".@", "@")

    def ip() -> str:
        return ".".join(str(v) for v in rng.integers(0, 256, 4))

    def plain() -> str:
        y, m, d = rng.integers(1900, 2100), rng.integers(1, 13), rng.integers(1, 29)
        forms = (
            f"{y}-{m:02}-{d:02}", f"{d}.{m}.{y}", f"{m}/{d}/{y}", f"{m:02}:{d:02}", digits(int(rng.integers(1, 9))), f"{digits(2)},{digits(3)}", f"v{m}.{d}.{digits(1)}",
            f"${digits(3)}.{digits(2)}", f"{y}-{y + 1}", "".join(rng.choice(list("0123456789abcdef"), 40)), digits(int(rng.integers(10, 24))), f"ISBN {digits(3)}-{digits(1)}-{digits(5)}-{digits(3)}-{digits(1)}",
            f"#{digits(5)}", f"{digits(1)}.{digits(1)}.{digits(1)}", f"@{letters(3, 8)}", f"{letters(2, 5)}{digits(3)}-{digits(3)}", f"+{digits(2)}", f"{digits(4)}-{digits(4)}", f"{digits(3)}-{digits(2)}",
            f"AKIA{digits(3)}{letters(5, 8).upper()}{digits(4)}", f"{digits(8)}-{digits(4)}-{digits(4)}", f"{digits(3)} {digits(3)} {digits(4)}",
        )
        return forms[rng.integers(0, len(forms))]

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    marks = ["", ".", ",", ":", "!", "###", "***", "%%%", "$$$", "&&&", "!!"]
    out = []
    for _ in range(n):
        text, spans = "", []
        noise = rng.choice(marks) if rng.random() < 0.4 else ""
        while len(text) < WINDOW + 16:
            r = rng.random()
            if r < 0.16:
                kind = KINDS[rng.integers(0, 4)]
                made = makers[kind]()
                spans.append((kind, len(text), len(text) + len(made)))
                text += made
            elif r < 0.34:
                text += plain()
            else:
                word = letters(1, 10)
                text += word.upper() if rng.random() < 0.15 else word
            text += noise if rng.random() < 0.8 else str(rng.choice(marks[:5]))
            text += "\n" if rng.random() < 0.05 else " "
        out.append((text, spans))
    return out


def _window(text_classes: np.ndarray, tags: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
    x, y = np.zeros(WINDOW, np.int64), np.zeros(WINDOW, np.int64)
    part = slice(max(0, at), min(len(text_classes), at + WINDOW))
    x[part.start - at : part.stop - at], y[part.start - at : part.stop - at] = text_classes[part], tags[part]
    return x, y


def fit(docs: DataFrame, sample: int = SAMPLE_DOCS, text_col: str = "text") -> Network:
    """Train on generated spans and on labelled windows of at most ``sample`` documents, those of the smallest hash."""
    chosen = smallest(docs.select(F.col("doc_id").alias("_id"), F.col(text_col).alias("_t")), sample, "_id", "_t")

    def run(_, ids, texts):
        found = []
        for t in texts:
            t = t or ""
            spans, rows = base_spans(t), []
            if spans or _HINT.search(t):
                x, y = classes(t), tag_row(len(t), _apart(spans))
                marks = [m.start() for _, m in zip(range(64), _HINT.finditer(t))]
                for at in sorted({s[1] for s in spans} | set(marks[:1]))[:SAMPLE_WINDOWS]:
                    a, b = _window(x, y, at - 40)
                    rows.append((a.tolist(), b.tolist()))
            found.append([{"x": a, "y": b} for a, b in rows])
        return {"w": found}

    kind = dict(chosen.dtypes)["_id"]
    got = map_docs(chosen, ["_id", "_t"], run, f"_id {kind}, w array<struct<x:array<bigint>,y:array<bigint>>>")
    # bounded by sample x SAMPLE_WINDOWS windows
    rows = sorted(tuple(map(tuple, r["w"])) for r in got.select(F.explode("w").alias("w")).collect())
    return train(*labelled(rows))


def _apart(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans without those that overlap an earlier one."""
    out: list[tuple[str, int, int]] = []
    for s in sorted(spans, key=lambda s: (s[1], -s[2])):
        if not out or s[1] >= out[-1][2]:
            out.append(s)
    return out


def labelled(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(1)
    made = [_window(classes(t), tag_row(len(t), s), int(rng.integers(-40, len(t) - WINDOW + 40))) for t, s in generated()]
    made += [(np.array(x), np.array(y)) for x, y in rows]
    y = np.stack([m[1] for m in made])
    # a window that begins inside a span: its first tag is taken as the span's first
    inside = (y[:, 0] > 0) & (y[:, 0] % 2 == 0)
    y[inside, 0] -= 1
    return np.stack([m[0] for m in made]), y


# --- decoding --------------------------------------------------------------


def model_spans(net: Network, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans of the network in each text, from the tags of all windows joined."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    waiting: list[tuple[int, int]] = []
    coded: dict[int, np.ndarray] = {}
    tags: dict[int, np.ndarray] = {}

    def go() -> None:
        if not waiting:
            return
        x = np.stack([coded[k][CORE * t : CORE * t + WINDOW] for k, t in waiting])
        y = net.tags(x)[:, CONTEXT : CONTEXT + CORE]
        for (k, t), row in zip(waiting, y):
            tags[k][CORE * t : CORE * (t + 1)] = row
        waiting.clear()

    for k, text in enumerate(texts):
        if not _HINT.search(text):
            continue
        c = classes(text)
        tiles = -(-len(c) // CORE)
        near = np.flatnonzero((c == 1) | (c == 7))  # digits and @
        active = np.unique(np.concatenate([np.clip((near + d) // CORE, 0, tiles - 1) for d in (-48, 0, 48)]))
        padded = np.zeros(CORE * tiles + 2 * CONTEXT, np.int64)
        padded[CONTEXT : CONTEXT + len(c)] = c
        coded[k], tags[k] = padded, np.zeros(CORE * tiles, np.int8)
        for t in active.tolist():
            waiting.append((k, t))
            if len(waiting) == STEP_WINDOWS:
                go()
    go()
    for k, y in tags.items():
        some = np.flatnonzero(y[: len(texts[k])])
        if not len(some):
            continue
        # a span goes on while the kind stays and no first tag comes
        kind = (y[some] + 1) // 2
        fresh = np.concatenate(([True], (np.diff(some) > 1) | (kind[1:] != kind[:-1]) | (y[some][1:] % 2 == 1)))
        first = np.flatnonzero(fresh)
        last = np.concatenate((first[1:], [len(some)])) - 1
        out[k] = [(KINDS[kind[a] - 1], int(some[a]), int(some[b]) + 1) for a, b in zip(first, last)]
    return out


_SHAPES = {
    "email": re.compile(r"[^\s@]+@[^\s@]+\.[A-Za-z]{2,}"),
    "ip": re.compile(r"[0-9]{1,3}(?:[.:-][0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9]{4}(?:[ .-]{1,2}[0-9]{4}){3}"),
    "phone": re.compile(r"(?:1[ .-])?\(?[0-9]{3}\)?[ .-]{1,2}[0-9]{3}[ .-][0-9]{4}"),
}


def plausible(kind: str, found: str) -> bool:
    """The check that a span of the model must pass: the kind's shape, and its digits."""
    if not _SHAPES[kind].fullmatch(found):
        return False
    digits = _NOT_DIGIT.sub("", found)
    return kind != "card" or luhn(digits)


def all_spans(net: Network, texts: list[str]) -> tuple[list, list]:
    """Base spans, and base and model spans, of each text, by kind as listed, then start."""
    base, every = [], []
    for text, more in zip(texts, model_spans(net, texts)):
        mine = base_spans(text)
        extra = [
            (k, a, b) for k, a, b in more if plausible(k, text[a:b]) and _whole(text, a, b) and all(b <= x or a >= y for _, x, y in mine)
        ]
        base.append(mine)
        every.append(sorted(mine + extra, key=lambda s: (KINDS.index(s[0]), s[1])))
    return base, every


def _whole(text: str, a: int, b: int) -> bool:
    """No letter or digit goes on where the span begins or ends."""
    return not (a and text[a - 1].isalnum() or b < len(text) and text[b].isalnum())


def personal_spans(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """Counts by base kind, a digest of the base spans, and all spans, per document."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def rows(_, ids, texts):
        base, every = all_spans(shared.value, [t or "" for t in texts])
        out = {f"n_{k}": [sum(s[0] == k for s in f) for f in base] for k in KINDS}
        out["base_sha256"] = [hashlib.sha256(span_text(f).encode()).hexdigest() for f in base]
        out["spans"] = [span_text(f) for f in every]
        out["n_model"] = [len(e) - len(f) for e, f in zip(every, base)]
        return out

    kind = dict(docs.dtypes)["doc_id"]
    counts = ", ".join(f"n_{k} bigint" for k in KINDS)
    return map_docs(docs, ["doc_id", text_col], rows, f"doc_id {kind}, {counts}, base_sha256 string, spans string, n_model bigint")


def redact(docs: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; untouched texts stay as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def change(_, batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        _, every = all_spans(shared.value, texts)
        old = batch.column(batch.schema.names.index(text_col)).to_pylist()
        return replace_column(batch, text_col, [cut_out(t, f) if f else o for o, t, f in zip(old, texts, every)])

    return rewrite_docs(docs, text_col, change)


def cut_out(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the first one's kind."""
    out, at, end = [], 0, 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = end = max(end, b)
    return "".join([*out, text[at:]])
