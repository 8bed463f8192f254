"""Main text of pages of many layouts."""

import time

import pytest

from turnstone.llm import html_text

P = "<p>" + "Article words that go on for a while, with commas and more text in every sentence. " * 4 + "</p>"
NAV = "<nav><ul><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul></nav>"
FOOT = "<footer>Copyright 2020 nobody</footer>"
JUNK = ("Home", "Copyright", "Side", "cookies", "Sign up", "Buy", "Reader")
LAYOUTS = {
    "has-sidebar": (f'<body>{NAV}<div class="site has-sidebar"><h1>T</h1>{P * 3}</div>{FOOT}', 3),
    "share-price": (f'<body>{NAV}<div class="story share-price"><h1>T</h1>{P * 3}</div>{FOOT}', 3),
    "widget": (f'<body>{NAV}<div class="page widget"><h1>T</h1>{P * 3}</div>{FOOT}', 3),
    "form around": (f"<body><form action=x>{NAV}<div><h1>T</h1>{P * 3}</div>{FOOT}</form>", 3),
    "siblings": (f"<body>{NAV}<h1>T</h1><div>{P * 5}</div><div class=ad>Buy</div><div>{P * 5}</div>{FOOT}", 10),
    "sections": (f"<body>{NAV}<div><h1>T</h1><section><h2>A</h2>{P * 3}</section><section><h2>B</h2>{P * 3}</section></div>{FOOT}", 6),
    "short paragraphs": (f"<body>{NAV}<div><h1>T</h1>{P * 2}<p>Short.</p>{P}</div><div class=sidebar><p>Side text here is long enough.</p></div>{FOOT}", 3),
    "unclosed svg": (f'<body>{NAV}<svg><path d="x"><article><h1>T</h1>{P * 3}</article>{FOOT}', 3),
    "comments": (f"<body>{NAV}<article><h1>T</h1>{P * 2}<h2>3 Comments</h2><div><p>Reader says a lot of things here.</p></div></article>{FOOT}", 2),
    "comment articles": (f"<body>{NAV}<div class=post><h1>T</h1>{P}</div><div id=comments><article>{P.replace('Article', 'Reader') * 4}</article></div>{FOOT}", 1),
    "table": (f"<body><table><tr><td>{NAV}</td><td><h1>T</h1>{P * 3}</td></tr></table>{FOOT}", 3),
    "notice": (f'<body><div class="cookie-banner"><p>We use cookies and more to track you.</p></div><div id=content><h1>T</h1>{P * 2}</div>{FOOT}', 2),
    "sign-up inside": (f'<body><article><h1>T</h1>{P}<div class="newsletter-signup"><form><p>Sign up now</p></form></div>{P}</article>', 2),
    "comments-open": (f'<body>{NAV}<div class="post comments-open"><h1>T</h1>{P * 3}</div>{FOOT}', 3),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_layouts(layout):
    page, paragraphs = LAYOUTS[layout]
    text = html_text.extract(page)
    blocks = text.split("\n\n")
    assert blocks[0] == "T" and sum(b.startswith("Article words") for b in blocks) == paragraphs
    assert not [w for w in JUNK if w in text]


def test_density_chooses_where_names_say_nothing():
    side = "<div>" + "".join(f"<a href=/{i}>A link with words {i}</a> " for i in range(40)) + "</div>"
    page = f"<body>{side}<div><div>{P * 2}</div></div>{side}<div>tiny</div>"
    assert html_text.extract(page).count("Article words") == 8 and "link" not in html_text.extract(page)


def test_rows(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><a href=/>Home</a></nav><div class='sidebar'><p>Side text that is long enough to look like content.</p></div>"
        "<article><h1>Head &amp; line</h1><p>First paragraph,\n with <b>bold</b> words and more.<p>Second one<br>goes on for a while.</article>"
        "<section id=comments><p>A reader says something at length here, with many words.</p></section><script>var x='<p>no</p>'</script><footer>&copy; us</footer>"
    )
    rows = [(1, "u", page, 1), (2, None, None, 1), (3, "u", "", 1), (4, "u", "<nav><a>x</a></nav>", 1), (None, "u", "<p>plain", 1), (5, "u", "no tags at all", 1), (6, "u", "<div " * 50, 1), (7, "u", "<script>x", 1), (8, "u", "<p>" + "long text " * 200_000, 1), (1, "u", page, 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = html_text.main_text(frame).collect()
    assert len(got) == len(rows) and [r.text for r in got if r.page_id == 1] == ["Head & line\n\nFirst paragraph, with bold words and more.\n\nSecond one goes on for a while."] * 2
    by_id = {r.page_id: r for r in got}
    assert all(r.n_chars == len(r.text) for r in got) and by_id[2].text == by_id[3].text == by_id[7].text == "" and by_id[None].text == "plain" and by_id[5].text == "no tags at all"
    assert by_id[8].n_chars == 10 * 200_000 - 1
    assert html_text.main_text(frame.limit(0)).count() == 0


def test_articles_of_the_data(spark):
    """Every word of the page's article and none of the rest, on pages that are built alike."""
    import html
    import re

    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        article = re.search("<article>(.*)</article>", r.html, re.S)[1]
        want = html.unescape(re.sub(r"<[^>]+>", " ", article)).split()
        assert html_text.extract(r.html).split() == want


def test_deep_nesting_is_linear():
    def seconds(n):
        t = time.process_time()
        html_text.extract("<b>" * n + "x</i></u></p>" * n + "<table><tr><td>" + "<i>" * n + "x</b></u><p>" * n)
        return time.process_time() - t

    seconds(1000)
    assert seconds(16_000) < 40 * max(seconds(1000), 0.01)
