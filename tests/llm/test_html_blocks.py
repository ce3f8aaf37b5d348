"""HTML extraction on small pages with known main text."""

from __future__ import annotations

import numpy as np

from blotter.llm.html_blocks import extract, main_text, regions

PAGE = (
    '<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head><body>'
    '<header>Site</header><nav><ul><li><a href="/x">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy now</div>'
    "<article><h1>Head &amp; line</h1><p><b>First<br><p>Second  \n one.</p><p>Téxt &lt;3</p>"
    '<aside>Side</aside><section class="comments"><p>Nice!</p></section><p>End.</p></article>'
    '<div id="cookie-notice">We use cookies</div><form><p>Mail</p></form><footer>&copy; me</footer></body>'
)


def test_article_without_its_surroundings():
    assert main_text(PAGE) == "Head & line\n\nFirst\n\nSecond one.\n\nTéxt <3\n\nEnd."


def test_page_without_article_element_keeps_the_long_region():
    body = "".join(f"<p>{'word ' * 40}{i}</p>" for i in range(6))
    menu = "<div class=menu>" + "".join(f"<a href=/{i}>item {i}</a><br>" for i in range(20)) + "</div>"
    text = main_text(f"<body>{menu}{body}<div class='footer'>bye</div>")
    assert text.count("word") == 240 and "item" not in text and "bye" not in text


def test_unmarked_page_keeps_short_sections():
    ads = "<div class=ad>Buy</div>" * 4
    body = "".join(f"<p>{'word ' * 40}{i}</p>" for i in range(6))
    text = main_text(f"<body><p>Lead.</p>{ads}{body}{ads}<p>End.</p>")
    assert text.startswith("Lead.\n\nword") and text.endswith("5\n\nEnd.") and "Buy" not in text


def test_wrappers_around_the_main_element():
    inside = '<article><p>Text.</p><div class="ad">Buy</div><form>Mail</form><section class="comments"><article>Nice!</article></section><p>End.</p></article>'
    for start, end in (
        ("<div class='content has-sidebar'>", "</div>"),
        ("<div class='page no-comments'><div id=share-enabled>", "</div></div>"),
        ("<form action=/x>", "</form>"),
        ("<main><form>", "</form></main>"),
        ("<div class='page sidebar'>", "</div>"),
    ):
        assert main_text(f"<body><nav>Menu</nav>{start}{inside}{end}<footer>me</footer>") == "Text.\n\nEnd."
    assert main_text(f"<body>{inside}<div class=related><article>Other</article></div><aside><article>Side</article></aside>") == "Text.\n\nEnd."
    assert main_text("<body><div class='post share-enabled'><p>Plain</p></div><div id='cookie-notice'>Cookies</div>") == "Plain"


def test_empty_null_and_truncated():
    assert main_text(None) == main_text("") == main_text("<html><body></body>") == ""
    assert main_text("<article><p>a</p><p>b &am") == "a\n\nb &am"
    assert main_text("<article><p>a</p><p cla") == "a"


def test_regions_by_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(200):
        x = rng.integers(0, 3, 20) * rng.integers(0, 2, 20)
        expected, run = [], []
        for i, v in enumerate(x):
            if v:
                if run and i - run[-1] > 3:
                    expected.append((run[0], run[-1] + 1))
                    run = []
                run.append(i)
        if run:
            expected.append((run[0], run[-1] + 1))
        got = regions(x)
        assert got == expected


def test_regions_decide_on_unmarked_pages(monkeypatch):
    link = "<div><a href=/{0}>{0}</a></div>".format
    menu = "".join(map(link, ("Home", "News", "Sport")))
    foot = "<div><a href=/t>Terms</a> | <a href=/p>Privacy</a></div>"
    body = f"<h1><a href=/self>Title</a></h1><p>First <a href=/x>text</a> here.</p>{link('Alone')}<p>Second.</p>{menu}<p>Third.</p>"
    expected = ["Title", "First text here.", "Alone", "Second.", "Third."]
    assert main_text(f"<body><div>{menu}</div>{body}{foot}").split("\n\n") == expected
    assert main_text(f"<body>{menu}") == "" and main_text("<body><p><a href=/x>open<p>Text.") == "Text."
    assert main_text(f"<main>{menu}<p>x</p></main>") == "Home\n\nNews\n\nSport\n\nx"  # what is marked is kept whole
    monkeypatch.setattr("blotter.llm.html_blocks.regions", lambda x: [(0, len(x))])
    assert main_text(f"<body>{menu}{body}{foot}").split("\n\n") != expected


def test_regions_decide_on_marked_pages(monkeypatch):
    """Dense text beside the main element is text too, short lines and lines of links there are not."""
    long = ["word " * 30 + str(i) for i in range(5)]
    menu = "".join(f"<div><a href=/{i}>item {i}</a></div>" for i in range(4))
    page = (
        f"<body>{menu}<div>Site</div><p>{long[0]}</p><p>{long[1]}</p><article><p>{long[2]}</p><div class=ad>Buy</div><p>Short.</p></article>"
        f"<p>{long[3]}</p>{menu}<div>Terms</div>{menu}<p>{long[4]}</p><div>me 2024</div></body>"
    )
    got = main_text(page).split("\n\n")
    assert set(long) <= set(got) and got.index(long[2]) + 1 == got.index("Short.")
    assert not {"Buy", "Terms", "item 0"} & set(got)
    assert main_text(f"<main><p>{long[0]}</p></main><div>me 2024</div><div>Terms</div>") == long[0]
    assert main_text(f"<main></main><p>{long[0]}</p>") == long[0]  # nothing is in the marked element
    monkeypatch.setattr("blotter.llm.html_blocks.regions", lambda x: [(0, len(x))])
    assert main_text(page).split("\n\n") != got


def test_table(spark):
    rows = [(1, "http://a/", PAGE, 9), (1, "http://a/", PAGE, 9), (None, None, None, 9), (3, "u", "<article>" + "<p>xy</p>" * 50_000, 9)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = sorted(extract(df).collect(), key=lambda r: (r.page_id is not None, r.page_id))
    assert [r.n_chars for r in got] == [0, len(main_text(PAGE)), len(main_text(PAGE)), 50_000 * 4 - 2]
    assert extract(df.limit(0)).count() == 0
