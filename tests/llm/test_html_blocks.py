import html
import re

import pyarrow.parquet as pq
import pytest

from holdfast.llm.html_blocks import extract, main_text

LONG = "This is a sentence of the article that goes on for a while, with commas. "


def page(body):
    return f"<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>x='</p>'</script></head><body>{body}</body></html>"


CASES = {
    "null": (None, ""),
    "empty": ("", ""),
    "no markup": ("just text &amp; more", "just text & more"),
    "article": (
        page('<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad --><div class="ad">Buy now, it is cheap and good.</div>'
             f"<article><h1>Er.</h1><p><b>Er.<br><p>{LONG}</p><p>To.</p></article><footer>&copy; all</footer>"),
        f"Er.\nEr.\n{LONG.strip()}\nTo.",
    ),
    "short article": (page('<div class="ad">A long advert text that is longer than all.</div><article><p>A.</p></article>'), "A."),
    "empty article": (page("<nav>x</nav><article></article><footer>foot text that is long enough to count</footer>"), ""),
    "no marks": (
        page(f'<div><a href="/a">One</a> <a href="/b">Two</a></div><div><h1>Title</h1><p>{LONG}</p><p>x</p><p>{LONG * 3}</p></div><div>tiny</div>'),
        f"Title\n{LONG.strip()}\nx\n{(LONG * 3).strip()}",
    ),
    "inside an article": (
        page(f'<main><article><header><h1>T</h1></header><div><p>{LONG}</p></div><aside>side</aside><div class="share-box">Share</div><section><p>a <a href="#">b</a></p>'
             '</section><form>in<input></form><section id="comments"><article class="comment"><p>Nice post, I liked reading it a lot.</p></article></section>'
             f"<p>End &lt;b&gt; &amp\nof\tit&nbsp;!</p></article></main>"),
        f"T\n{LONG.strip()}\na b\nEnd <b> & of it !",
    ),
    "sidebar and notice": (
        page(f'<header><p>{LONG}</p></header><div class="sidebar"><p>{LONG}</p></div><div role="alert">{LONG}</div><div id="cookie-notice">{LONG}</div><div class="sideBar2">{LONG}</div><ul id=userComments><li>{LONG}</ul>'
             f'<div class="content with-sidebar"><p>{LONG}</p></div><p class="notice">{LONG}<p>{LONG}'),
        f"{LONG.strip()}\n{LONG.strip()}",
    ),
    "never ending": (f"<nav>menu<p>{LONG}</p><!-- {LONG}", f"menu\n{LONG.strip()}"),
    "quotes and stray signs": (f'<p title="a>b">1 < 2 {LONG}</p><p data-x=\'>\'>3 > 2 {LONG}<script>"</p>"', f"1 < 2 {LONG.strip()}\n3 > 2 {LONG.strip()}"),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(name):
    source, text = CASES[name]
    assert main_text(source) == text


def test_generated_pages():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()
    for row in pages:
        inner = re.search(r"<article>(.*?)</article>", row["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:h1|p)>", inner)]
        assert main_text(row["html"]) == "\n".join(b for b in blocks if b), row["page_id"]


def test_very_long_page():
    body = f"<p>{LONG}</p>" * 20_000
    assert main_text(page(f"<div>{body}</div>")).count("\n") == 19_999
    main_text("<" * 20_000 + '<p a="' * 3000)


def test_table(spark):
    rows = [(1, "u", CASES["article"][0], 5), (1, "u", CASES["article"][0], 5), (None, None, None, None), (2, "v", "", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted(map(tuple, extract(pages).collect()), key=str)
    want = CASES["article"][1]
    assert got == sorted([(1, "u", want, len(want))] * 2 + [(None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract(pages.limit(0)).count() == 0
