"""Base patterns against plain regular expressions; the network on held-out spans."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from blotter.llm import pii_lstm as P


def _plain(text):
    """The contract's patterns, as written."""
    number = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(number(m[0])) <= 19 and P.luhn(number(m[0])):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(number(m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def test_base_spans_by_plain_patterns():
    rng = random.Random(4)
    parts = list("ab.@@+-() 0123456789%é\n") + ["a@b.c", "1.2.3.4", "+1 (743) 555-3824", "4111 1111 1111 1111", "4111-1111-1111-1111", "256.1.1.1", ".."]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert P.base_spans(text) == _plain(text), text
    for text, _ in P.generated(200, seed=3):
        assert P.base_spans(text) == _plain(text)
    assert len(P.base_spans("9" * 200_000 + " " + "x" * 200_000 + "@")) == 0


def test_gradient_by_differences():
    net = P.Network.fresh()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x, y = P.labelled([])
    x, y = x[:4, :12], np.where((np.arange(12) == 0) & (y[:4, :12] % 2 == 0) & (y[:4, :12] > 0), y[:4, :12] - 1, y[:4, :12])
    _, g = net.gradient(x, y)
    rng = np.random.default_rng(0)
    for name in net.w:
        for _ in range(3):
            at = tuple(int(rng.integers(0, n)) for n in net.w[name].shape)
            if name == "T" and P._FORBIDDEN[at]:
                continue
            old, step = net.w[name][at], 1e-2
            net.w[name][at] = old + step
            up = net.gradient(x, y)[0]
            net.w[name][at] = old - step
            down = net.gradient(x, y)[0]
            net.w[name][at] = old
            assert abs((up - down) / (2 * step) - g[name][at]) < 5e-3 + 0.05 * abs(g[name][at]), name


@pytest.fixture(scope="module")
def net():
    return P.train(*P.labelled([]))


def test_held_out_spans(net):
    held = P.generated(300, seed=77)
    _, every = P.all_spans(net, [t for t, _ in held])
    right = wrong = all_ = 0
    for (_, spans), got in zip(held, every):
        right += len(set(spans) & set(got))
        wrong += len(set(got) - set(spans))
        all_ += len(spans)
    assert right >= 0.95 * all_ and wrong <= 0.03 * all_


def test_window_edges_do_not_matter(net):
    """A span is found wherever it stands in the tiles."""
    for shift in range(0, 140, 7):
        text = "word " * 40 + "x" * shift + " call (743) 555-3824 now " + "word " * 40
        a = text.index("(743)")
        _, every = P.all_spans(net, [text])
        assert every[0] == [("phone", a, a + 14)]


def test_table(spark):
    rows = [
        (1, "mail ab.c@mail.example.com or +1 (743) 555-3824", "x"), (1, "mail ab.c@mail.example.com or +1 (743) 555-3824", "x"),
        (None, "10.0.0.1", None), (4, None, None), (5, "", ""), (6, "plain words only " * 50_000, "y"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, spans string")
    model = P.fit(docs)
    got = P.personal_spans(docs, model).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in got) == [(0, 0, 1, 0, 0), (1, 1, 0, 0, 1), (1, 1, 0, 0, 1), (4, 0, 0, 0, 0), (5, 0, 0, 0, 0), (6, 0, 0, 0, 0)]
    assert {r.spans for r in got if r.doc_id == 1} == {"email:5:26,phone:30:47"}
    out = {r.doc_id: r.text for r in P.redact(docs, model).collect()}
    assert out[1] == "mail [EMAIL] or [PHONE]" and out[None] == "[IP]" and out[4] is None and out[6] == rows[5][1]
    assert P.personal_spans(docs.limit(0), P.fit(docs.limit(0))).count() == 0
