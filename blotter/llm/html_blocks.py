"""HTML extraction: line-block distribution.

Markup is stripped into lines, one per block element; ``br`` and white space
inside a block are one space. Lines of containers that hold no article text
(menus, headers, footers, sidebars, notices, adverts, forms, comments) are left
out. A main element is text whatever form is around it, and whatever named container
is if no other is marked; containers inside it still count. Text lengths are summed over sliding windows of ``WINDOW`` lines; a
surge is where the sum rises from 0, a dive where it falls back to 0, and the
lines between a surge and its dive form one region, and every region is kept.
Text of links has length 0, but for headings, so that lines of links alone (unmarked menus and
footers) are in no region, unless one or two of them stand between lines of text. Where the page marks its main element,
all text in it counts, and lines outside it, which are neither in it nor in a container, have their length where they are as dense: where
a window of them sums up to half the main element's median window. So the distribution of the whole page decides
which of them are text; short ones alone (a copyright line) are not. A marked element without text marks nothing.

Defined results: null and empty pages give an empty text; a page without any
text gives an empty text; an unclosed element ends with its parent, a
truncated tag at the end is dropped; repeated rows repeat the result; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import html as references
import re

import numpy as np
from pyspark.sql import DataFrame

from blotter.llm.common import map_docs

WINDOW = 3

#: Elements whose content is never text.
RAW = frozenset("script style noscript template textarea title iframe object svg math canvas select option button audio video".split())
#: Containers without article text; a form may also hold a whole page.
AROUND = frozenset("nav header footer aside menu dialog head fieldset".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements inside a line.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark meter output progress q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr br".split()
)
#: Words of class, id and role that name such containers.
NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs header "
    "masthead footer comment comments commentlist disqus respond reply replies related share sharing social toolbar "
    "pagination pager widget contentinfo complementary search login signup".split()
)
#: Words that such a name may also have; with any other ("has-sidebar", "share-enabled") it says something else.
BESIDE = frozenset("site main top bottom global list bar box block area wrapper container".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</?[A-Za-z][^>]*(?:>|\Z)",
    re.S,
)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS = re.compile(r"[a-z]+")
_RAW_END = {t: re.compile(rf"</{t}\s*[^>]*>|\Z", re.I) for t in RAW}
_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_LINK = re.compile(r"(?:^|\s)href\s*=", re.I)
_HEADING = re.compile(r"h[1-6]")


def _is_named(word: str) -> bool:
    parts = set(_WORDS.findall(word))
    return bool(parts & NAMES) and parts <= NAMES | BESIDE


def _around(tag: str, attributes: str) -> int | None:
    """Which count of containers the element adds to: 0 fixed, 1 named, 2 forms."""
    if tag in AROUND:
        return 0
    if tag in ("html", "body", "article", "main"):
        return None
    if any(_is_named(w) for m in _NAMED.findall(attributes) for w in m.lower().strip("\"'").split()):
        return 1
    return 2 if tag == "form" else None


def lines_of(page: str) -> tuple[list[str], np.ndarray, int, np.ndarray]:
    """The page's lines, whether each may be article text, the kind of the main element's lines (0: not marked), and
    the lines' lengths outside links (of a line with a link, the letters and digits; a link ends with its line).

    A line is (text, kind): kind 0 in a container without article text, 1 plain, 2 in the main element,
    3 in a main element inside a named container."""
    lines: list[str] = []
    kinds: list[int] = []
    part: list[str] = []
    stack: list[tuple[str, tuple[int, int, int], int]] = []  # tag, containers around, kind of the main element
    around, main, marked, at = (0, 0, 0), 0, False, 0
    outside: list[int] = []
    links: list[list[int]] = []  # from and to which parts of the line

    def flush() -> None:
        if part:
            text = _SPACE.sub(" ", references.unescape("".join(part))).strip(" ")
            if text:
                lines.append(text)
                kinds.append(0 if any(around) else main or 1)
                if links:
                    linked = {i for a, b in links for i in range(a, len(part) if b < 0 else b)}
                    rest = references.unescape("".join(t for i, t in enumerate(part) if i not in linked))
                    outside.append(sum(map(str.isalnum, rest)))
                else:
                    outside.append(len(text))
            part.clear()
        links.clear()

    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            part.append(page[at:])
            break
        if m.start() > at:
            part.append(page[at : m.start()])
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if tag not in INLINE:
                flush()
            elif tag == "a" and links and links[-1][1] < 0:
                links[-1][1] = len(part)
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            # an inline end tag does not close the blocks opened since
            if depth is not None and not (tag in INLINE and any(t not in INLINE for t, _, _ in stack[depth + 1 :])):
                _, around, main = stack[depth]
                del stack[depth:]
            continue
        if tag in RAW:
            at = _RAW_END[tag].search(page, at).end() if not m[3].endswith("/") else at
            continue
        if tag == "br":
            part.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID or m[3].endswith("/") and tag not in ("p", "div"):
            continue
        if tag in ("p", "li") and tag not in INLINE:
            # a new paragraph or item ends the one that was left open beside it
            k = len(stack) - 1
            while k >= 0 and (stack[k][0] in INLINE or stack[k][0] == tag):
                if stack[k][0] == tag:
                    _, around, main = stack[k]
                    del stack[k:]
                    break
                k -= 1
        if tag == "a" and _LINK.search(m[3]) and not any(_HEADING.fullmatch(t) for t, _, _ in stack):
            if links and links[-1][1] < 0:
                links[-1][1] = len(part)
            links.append([len(part), -1])
        stack.append((tag, around, main))
        kind = _around(tag, m[3])
        if kind is not None:
            if not any(around):
                flush()
            around = tuple(n + (i == kind) for i, n in enumerate(around))
        if tag in ("article", "main") and not around[0]:
            if not around[1]:
                around, main = (0, 0, 0), main or 2
                marked = marked or main == 2
            elif not main:
                around, main = (0, 0, 0), 3
    flush()
    return lines, np.array(kinds, np.int64), 2 if marked else 3 if 3 in kinds else 0, np.array(outside, np.int64)


def _window_sums(lengths: np.ndarray, window: int) -> np.ndarray:
    """For each line, the text of the window that starts there."""
    total = np.concatenate(([0], np.cumsum(lengths)))
    return total[np.minimum(np.arange(len(lengths)) + window, len(lengths))] - total[:-1]


def regions(lengths: np.ndarray, window: int = WINDOW) -> list[tuple[int, int]]:
    """(surge, dive) line ranges: maximal runs whose window sums stay above 0,
    trimmed to their lines with text. A window spans ``window`` lines forward."""
    if not len(lengths):
        return []
    high = _window_sums(lengths, window) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], high, [False])).astype(np.int8)))
    out = []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        some = np.flatnonzero(lengths[a:b])
        if len(some):
            out.append((a + int(some[0]), a + int(some[-1]) + 1))
    return out


def _weighed(lengths: np.ndarray, main: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The lengths, 0 for lines beside the main element that are in no window half as full as its median one."""
    if main.all() or not main.any():
        return lengths
    full = _window_sums(np.where(main, 0, lengths), window) * 2 >= np.median(_window_sums(lengths[main], window))
    near = np.concatenate((np.zeros(window - 1, bool), full))
    dense = np.any([near[i : i + len(full)] for i in range(window)], axis=0)  # of the windows that hold the line
    return np.where(main | dense, lengths, 0)


def main_text(page: str | None) -> str:
    """The blocks between surge and dive points, joined by two newlines."""
    lines, kinds, marked, outside = lines_of(page or "")
    if not lines:
        return ""
    some = np.flatnonzero((kinds == 1) | (kinds == marked) if marked else kinds > 0)
    main = kinds[some] == marked
    lengths = np.where(main, np.fromiter((len(lines[i]) for i in some), np.int64, len(some)), outside[some])
    return "\n\n".join(lines[some[i]] for a, b in regions(_weighed(lengths, main)) for i in range(a, b))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page id, url, main text and its code points, one row per input row, without a shuffle."""

    def rows(_, ids, urls, htmls):
        texts = [main_text(h) for h in htmls]
        return {url_col: urls, "text": texts, "n_chars": [len(t) for t in texts]}

    kinds = dict(pages.dtypes)
    return map_docs(
        pages, [id_col, url_col, html_col], rows, f"`{id_col}` {kinds[id_col]}, `{url_col}` {kinds[url_col]}, text string, n_chars bigint"
    )
