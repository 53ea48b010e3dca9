import re

import pytest

from gaugeworks.llm import pages

PAGE = """<!DOCTYPE html><html><head><title>Head line</title><style>p{margin:0}</style><script>var t="</p>";</script></head>
<body><header><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="ad">Buy this now, really.</div><!-- <p>not this</p> -->
%s
<aside>Other things to read</aside><form><label>Mail</label><input name=m><button>Send</button></form>
<div id="comments"><p>First! A comment by a reader which is quite long, longer than the article itself, so to speak.</p></div>
<footer>&copy; Site</footer></body></html>"""
BODY = "<h1>Head &amp; line</h1><p>First paragraph with <b>bold</b> words\n and   space.<p>Second&nbsp;one &lt;here&gt;.</p><p>Bit.</p>"
WANT = "Head & line\nFirst paragraph with bold words and space.\nSecond one <here>.\nBit."


@pytest.mark.parametrize("holder", ["article", "main", "div"])
def test_article_without_the_rest(holder):
    assert pages.main_text(PAGE % f"<{holder}>{BODY}</{holder}>") == WANT


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", ""),
        ("plain text", "plain text"),
        ("<p>a<p>b", "a\nb"),
        ("<html><body><nav>only <a href=x>menu</a></nav></body></html>", ""),
        ("<script>x</script>", ""),
        ("<article><p>&#233;&eacute;&#x65;</article>", "éée"),
        ("<article>a<br>b</article>", "ab"),
    ],
)
def test_odd_pages(html, want):
    got = pages.main_text(html)
    assert re.sub(r"\s", "", got) == re.sub(r"\s", "", want)


def test_line_breaks_are_white_space():
    assert pages.main_text("<article><p>a<br>b<br/> c<wbr>d</p></article>") == "a b cd"
    assert pages.main_text("<p>a<br>b</p>") == "a b"


STORY = "<h1>Head</h1>" + "".join(f"<p>Sentence {i} of a story that goes on for some words, as they do.</p>" for i in range(4))
STORY_TEXT = "Head\n" + "\n".join(f"Sentence {i} of a story that goes on for some words, as they do." for i in range(4))


@pytest.mark.parametrize("name", ["social", "widget", "related", "alert", "notice", "nav-list", "story"])
def test_density_overrules_the_name_of_a_wrapper(name):
    """Where a page has no article or main element; a nested wrapper too."""
    assert pages.main_text(f'<body><div class="{name}">{STORY}</div></body>') == STORY_TEXT
    assert pages.main_text(f'<body><div id="{name}"><div class="widget">{STORY}</div></div><div class="share">Tell all</div></body>') == STORY_TEXT


@pytest.mark.parametrize("name", ["comments", "cookie", "ad", "notice", "related"])
def test_names_stand_beside_an_article(name):
    """Also with more text than the article, where there is one."""
    aside = f'<div class="{name}"><p>One short line.</p><p>{"Many more words than that. " * 30}</p></div>'
    assert pages.main_text(f"<body><article>{STORY}</article>{aside}</body>") == STORY_TEXT
    short = '<div class="notice">We have moved.</div><div class="nav"><a href=x>One</a> <a href=y>Two</a></div>'
    assert pages.main_text(f"<body><div>{STORY}</div>{short}</body>") == STORY_TEXT
    if name in pages.NEVER_MAIN:
        assert pages.main_text(f"<body>{aside}</body>") == ""


def test_links_and_single_notices_stay_apart():
    menu = "".join(f"<p><a href={i}>Entry {i} of the list</a></p>" for i in range(9))
    assert pages.main_text(f'<body><div class="related">{menu}</div></body>') == ""
    assert pages.main_text('<body><div class="notice">We have moved.</div></body>') == ""


def test_deep_and_long_pages():
    assert pages.main_text("<article>" + "<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert pages.main_text("<article><p>" + "<b>" * 20_000 + "x<p>y") == "x\ny"
    long = " ".join(f"word{i}" for i in range(30_000))
    assert pages.main_text(f"<body><article><h1>t</h1><p>{long}</p></article>") == f"t\n{long}"


def test_query(spark):
    rows = [(1, "u", PAGE % f"<article>{BODY}</article>"), (2, None, None), (3, "v", ""), (1, "u", "<p>again"), (None, "w", "<p>x")]
    table = spark.createDataFrame([(*r, "m") for r in rows], "page_id long, url string, html string, main_text string")
    got = sorted(map(tuple, pages.texts(table).collect()), key=repr)
    want = [(1, "u", WANT, len(WANT)), (2, None, "", 0), (3, "v", "", 0), (1, "u", "again", 5), (None, "w", "x", 1)]
    assert got == sorted(want, key=repr)
    assert pages.extract(table).columns == table.columns and pages.texts(table.limit(0)).count() == 0


def test_all_pages_of_the_smallest_tables():
    """The main text of a generated page is its article element."""
    import html
    import os

    import pyarrow.parquet as pq

    path = "/root/testdata/sf0.001/pages.parquet"
    if not os.path.exists(path):
        pytest.skip("test tables not present")
    for page in pq.read_table(path, columns=["html"])["html"].to_pylist():
        inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
        parts = (html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", p))) for p in re.split(r"</?(?:p|h1)>", inner))
        want = "\n".join(x for x in (" ".join(p.split()) for p in parts) if x)
        assert pages.main_text(page) == want
