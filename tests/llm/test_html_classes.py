"""Class names are a hint: they drop side matter, not the text of a page. Ends of elements are found in one pass."""

import random
import time

import pytest

from holdfast.llm import html_blocks

SENTENCES = [f"The council met on day {k} and spoke at length about the new bridge over the river." for k in range(6)]
BODY = "".join(f"<p>{x}</p>" for x in SENTENCES)
SIDE = '<div class="comments"><p>' + "I like it very much. " * 60 + '</p></div><footer><p>Copyright</p></footer>'


@pytest.mark.parametrize(
    "start",
    [
        '<div class="legal-news">', '<div id="notice-body">', '<div class="elementor-widget">', '<div class="social-science">',
        '<section class="related">', '<div class="ad-free"><div class="widget-inner">', '<section class="promo"><div class="sidebar">',
    ],
)
def test_a_class_name_does_not_drop_the_text(start):
    ends = "".join(f"</{x.split()[0]}>" for x in reversed(start[1:].split("<")))
    page = f'<html><body><nav><a href="#">Home</a></nav><h1>Bridge</h1>{start}{BODY}{ends}{SIDE}</body></html>'
    text = html_blocks.main_text(page)
    assert all(x in text.split("\n") for x in SENTENCES) and "I like it" not in text and "Copyright" not in text


def test_side_matter_of_that_class_goes_where_there_is_a_text():
    for start in ['<div class="legal-news">', '<section class="related">', '<div class="ad-slot">', '<div class="cookie-notice">']:
        end = f"</{start[1:].split()[0]}>"
        side = f"{start}<p>{'We use cookies to show adverts. ' * 4}</p>{end}"
        text = html_blocks.main_text(f"<body><h1>Bridge</h1>{BODY}{side}</body>")
        assert "cookies" not in text and SENTENCES[0] in text
        short = html_blocks.main_text(f"<body><p>A short note on the bridge.</p>{side}</body>")
        assert "cookies" not in short and "short note" in short


def test_many_elements_of_one_class_hold_the_text_together():
    page = "".join(f'<div class="elementor-widget" data-id="{k}"><p>{x}</p></div>' for k, x in enumerate(SENTENCES))
    assert html_blocks.main_text(f"<body>{page}</body>") == "\n".join(SENTENCES)


def test_comments_alone_are_no_text():
    assert html_blocks.main_text(f"<body>{SIDE}</body>") == ""


def test_an_article_that_is_one_link():
    link = '<p><a href="x">One paragraph that is all a link to another page of the site</a></p>'
    assert html_blocks.main_text(f"<article>{link}</article>") == "One paragraph that is all a link to another page of the site"
    assert html_blocks.main_text(f"<nav>{link}</nav>") == ""


def _end(names, at):
    """Brute force: walk on from the element, counting."""
    name, depth = names[at][1], 1
    for k in range(at + 1, len(names)):
        end, other = names[k]
        if name in html_blocks._SELF_ENDING and other in html_blocks._BLOCKS and (other != name or not end):
            return k - 1
        if other == name:
            depth += -1 if end else 1
            if not depth:
                return k
    return at


def test_ends_against_brute_force():
    rng = random.Random(5)
    for _ in range(2000):
        names = [(rng.random() < 0.4, rng.choice("div p li a span td tr section b".split())) for _ in range(rng.randint(0, 25))]
        tokens = list(html_blocks._TOKEN.finditer("".join(f"<{'/' if e else ''}{n}>x" for e, n in names)))
        ends = html_blocks._ends(tokens)
        assert all(ends[k] == _end(names, k) for k in range(len(names)) if not names[k][0])


@pytest.mark.parametrize("tag", ['<div class="ad">', '<div class="ad-x"><div class="ad-y">t', '<li class="ad">', '<div class="ad">x</div>'])
def test_time_grows_with_the_page(tag):
    """1 MB of such tags took a quarter of an hour when each looked for its own end."""
    began = time.process_time()
    html_blocks.main_text(tag * (1_000_000 // len(tag)))
    assert time.process_time() - began < 20
