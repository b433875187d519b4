"""Main text of web pages by line-block distribution.

Method. Markup is stripped to lines, one per block of text; the borders of containers leave empty lines. Each line weighs as
much as its text outside links (inside an article: all its text). The weights are summed over sliding windows of ``WINDOW``
lines. Text starts where the sum surges to a threshold and ends where it dives to zero; the start reaches back over the lines
that the surging window holds. What lies between, short lines included, is the main text. The threshold is ``SURGE`` characters,
or a share of the page's largest sum if that is less, so that short pages have a text too.

What is no text at all weighs nothing: scripts, styles, forms, menus, headers, footers, sidebars, notices, adverts and reader
comments, by element, role and class. Class names are only a hint: elements of a class that hold nearly all unlinked text of the page
keep their weight, whatever they are called (``legal-news``, ``notice-body``); reader comments never do. If a page marks its articles
(or else its main part), lines outside weigh nothing, and containers inside leave no empty lines, so an article is never cut in two.

Defined results: null or empty html has an empty text. A page that repeats gives repeated rows. An element that never ends is
stripped to its tag; comments, scripts and the like that never end reach to the end of the page. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3  # lines
SURGE = 80  # characters in a window
SHARE = 0.3  # of the largest sum

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|svg|math|canvas|object|textarea|select|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attributes>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([\w:-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3"
    " h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_CONTAINERS = frozenset("article aside body details dialog div dl fieldset footer form header main menu nav ol section table ul".split())
_SELF_ENDING = frozenset("p li dd dt td th tr".split())  # their end tags may be left out
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_NO_TEXT = frozenset("nav footer aside form button menu dialog".split())
_NEVER = frozenset("html body article main".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words in class names and ids of what is no main text.
_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu sidebar footer header masthead"
    " topbar breadcrumb breadcrumbs cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription"
    " signup login search social share sharing related recommended recommendations comment comments commentlist disqus respond reply replies widget toolbar"
    " pagination pager copyright legal adbox adslot adsense adunit cookiebar cookiebanner sidenav topnav subnav navlinks sponsorship disclaimer".split()
)
_COMMENTS = frozenset("comment comments commentlist disqus respond reply replies".split())
_WEAK, _STRONG, _SURE = 1, 2, 3  # a class name with other words beside; one of such words alone; elements, roles, reader comments
_CONTENT = frozenset("content article main post entry story text body".split())


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): v.strip("\"'") for k, v in _ATTRIBUTE.findall(text)}


def _parts(name: str) -> list[str]:
    """Words of a class name or id, as in side-bar, side_bar, sideBar and sidebar2."""
    return [w.lower() for w in re.findall(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+", name)] or [name]


def _boilerplate(name: str, text: str, in_article: bool) -> int:
    """How surely an element is no main text, 0 if nothing says so."""
    if name in _NEVER and not (name == "article" and text.strip()):
        return 0
    if name in _NO_TEXT or (name == "header" and not in_article):
        return _SURE
    if not text.strip():
        return 0
    found = _attributes(text)
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", found.get("style", "").lower()):
        return 0 if name in _NEVER else _SURE
    if found.get("role", "").lower() in _ROLES:
        return _SURE
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    if name == "article":
        return _SURE if any(_parts(n)[0] in ("comment", "comments", "reply") for n in names) else 0
    if in_article and name in ("h1", "h2", "header"):
        return 0
    parts = [_parts(n) for n in names]
    if any(set(p) & _CONTENT and not set(p) & _WORDS for p in parts):
        return 0
    hits = [p for p in parts if {p[0], p[-1], "".join(p)} & _WORDS and p[0] not in ("has", "with", "no")]
    if any({p[0], p[-1]} & _COMMENTS for p in hits):
        return _SURE
    return max((_STRONG if set(p) <= _WORDS or "".join(p) in _WORDS else _WEAK for p in hits), default=0)


def _ends(tokens: list) -> list[int]:
    """Per token the place of the tag that ends the element which starts there; its own place if none does."""
    ends = list(range(len(tokens)))
    open_tags: dict[str, list[int]] = {}
    for k, token in enumerate(tokens):
        name = (token["name"] or "").lower()
        if not name or name in _SELF_ENDING:
            continue
        if not token["end"]:
            open_tags.setdefault(name, []).append(k)
        elif open_tags.get(name):
            ends[open_tags[name].pop()] = k
    block = None  # the next block tag
    for k in range(len(tokens) - 1, -1, -1):
        name = (tokens[k]["name"] or "").lower()
        if name in _SELF_ENDING and block is not None:  # its own end tag or the next block ends it
            own = tokens[block]["end"] and tokens[block]["name"].lower() == name
            ends[k] = block if own else block - 1
        if name in _BLOCKS:
            block = k
    return ends


class _Page:
    """The tags of a page, the unlinked text before each, and which classes keep their weight in spite of their names."""

    def __init__(self, text: str):
        self.text = text
        self.tokens = list(_TOKEN.finditer(text))
        self.ends = _ends(self.tokens)
        self.before = [0]  # unlinked characters before each tag, and in all
        in_link, at, total = False, 0, 0
        for token in self.tokens:
            if not in_link:
                total += len("".join(text[at : token.start()].split()))
            self.before.append(total)
            at = token.end()
            if (token["name"] or "").lower() == "a":
                in_link = not token["end"]
        self.before.append(total + (0 if in_link else len("".join(text[at:].split()))))
        del self.before[0]
        self.spared = self._spared()

    def size(self, k: int) -> int:
        return self.before[max(k, self.ends[k])] - self.before[k]

    def verdict(self, k: int, in_article: bool) -> int:
        """How surely the element that starts at ``k`` is no main text; 0 also where it has no end."""
        token = self.tokens[k]
        name = token["name"].lower()
        if token["end"] or name in _VOID or not (self.ends[k] > k or name in _SELF_ENDING):
            return 0
        return _boilerplate(name, token["attributes"], in_article)

    def group(self, k: int) -> tuple[str, str]:
        found = _attributes(self.tokens[k]["attributes"])
        return self.tokens[k]["name"].lower(), found.get("class") or found.get("id", "")

    def _spared(self) -> set[tuple[str, str]]:
        groups: dict[tuple[str, str], list[int]] = {}
        rest, paragraphs, in_article, k = self.before[-1], 0, 0, 0
        while k < len(self.tokens):
            name = (self.tokens[k]["name"] or "").lower()
            if name and (sure := self.verdict(k, in_article > 0)):
                rest -= self.size(k)
                if sure < _SURE:
                    group = groups.setdefault(self.group(k), [sure, 0])
                    group[1] += self.size(k)
                k = self.ends[k] + 1
                continue
            if name in ("article", "main"):
                in_article = max(0, in_article - 1) if self.tokens[k]["end"] else in_article + 1
            paragraphs += name == "p" and not self.tokens[k]["end"]
            k += 1
        spared = set()
        for key, (sure, size) in sorted(groups.items(), key=lambda g: (g[1][0], -g[1][1])):
            if _holds_the_text(sure, size, rest, paragraphs):
                spared.add(key)
                rest += size
        return spared


def _holds_the_text(sure: int, size: int, rest: int, paragraphs: int) -> bool:
    """Whether ``size`` characters are the text of a page (or part of one) that has ``rest`` others, in some paragraphs."""
    if sure == _STRONG:
        return not paragraphs and rest < min(SURGE, SHARE * size)
    return sure == _WEAK and rest < (0.1 if paragraphs else SHARE) * size


class _Line:
    __slots__ = ("text", "linked", "inside", "soft")

    def __init__(self, text: str, linked: int, inside: bool, soft: bool = False):
        self.text, self.linked, self.inside, self.soft = text, linked, inside, soft

    @property
    def unlinked(self) -> int:
        return max(0, len(self.text.replace(" ", "")) - self.linked)


def lines_of(page: str) -> tuple[list[_Line], bool]:
    """Lines in page order (empty ones at borders), and whether the article or main elements that are not dropped hold most of
    the unlinked text, so that they mark the main part. Articles mark it also where the page has no unlinked text at all."""
    parsed = _Page(page)
    marks = {(t["name"] or "").lower() for t in parsed.tokens if t["name"] and not t["end"]}
    for mark in ("article", "main"):
        if mark in marks:
            lines = _lines(parsed, mark)
            total = sum(x.unlinked for x in lines)
            if 2 * sum(x.unlinked for x in lines if x.inside) > total or (mark == "article" and not total and any(x.inside for x in lines)):
                return lines, True
    return _lines(parsed, None), False


def _lines(parsed: _Page, mark: str | None) -> list[_Line]:
    page, tokens = parsed.text, parsed.tokens
    around: list[int] = []  # elements that are read in spite of their class
    lines: list[_Line] = []
    parts: list[str] = []
    links: list[str] = []
    in_link, depth, in_article, k, at = False, 0, 0, 0, 0

    def take(until: int) -> None:
        if until > at:
            piece = html.unescape(page[at:until])
            parts.append(piece)
            if in_link:
                links.append(piece)

    def close(border: bool, soft: bool = False) -> None:
        text = " ".join("".join(parts).split())
        if text:
            lines.append(_Line(text, len("".join("".join(links).split())), depth > 0))
        parts.clear()
        links.clear()
        if border and not depth:
            lines.extend(_Line("", 0, False, soft) for _ in range(WINDOW))

    while k < len(tokens):
        token = tokens[k]
        take(token.start())
        at = token.end()
        name = (token["name"] or "").lower()
        if not name:
            k += 1
            continue
        ends = bool(token["end"])
        while around and parsed.ends[around[-1]] < k:
            around.pop()
        sure = parsed.verdict(k, in_article > 0)
        if sure and sure < _SURE:
            # inside an element that is read, only its own text is compared
            inner = around and _holds_the_text(sure, parsed.size(k), parsed.size(around[-1]) - parsed.size(k), 0)
            if inner or (not around and parsed.group(k) in parsed.spared):
                around.append(k)
                sure = 0
        if sure:
            last = parsed.ends[k]
            close(True)
            stop = tokens[last]
            ended = stop["name"] and stop["name"].lower() == name and stop["end"]
            at = stop.end() if ended else (tokens[last + 1].start() if last + 1 < len(tokens) else len(page))
            k = last + 1
            continue
        if name == "a":
            in_link = not ends
        elif name == "br":
            parts.append(" ")
        if name in _BLOCKS:
            close(name in _CONTAINERS, True)
            if name == mark:
                depth = max(0, depth - 1) if ends else depth + 1
            if name in ("article", "main"):
                in_article = max(0, in_article - 1) if ends else in_article + 1
        k += 1
    take(len(page))
    close(True)
    return lines


def _soft(lines: list[_Line], weights: list[int], start: int, first: int) -> bool:
    """Whether only soft borders lie between line ``first`` and the last line with weight from ``start`` on before it."""
    k = first - 1
    while k > start and not weights[k]:
        if lines[k].text or not lines[k].soft:
            return False
        k -= 1
    return True


def main_text(page: str | None) -> str:
    if not page:
        return ""
    lines, marked = lines_of(page)
    if marked:
        weights = [len(x.text) if x.inside else 0 for x in lines]
    else:
        weights = [x.unlinked for x in lines]
    sums, total = [], 0
    for k in range(len(weights) + WINDOW - 1):  # sums[k]: the window that ends at line k
        total += weights[k] if k < len(weights) else 0
        total -= weights[k - WINDOW] if k >= WINDOW else 0
        sums.append(total)
    threshold = min(SURGE, SHARE * max(sums, default=0))
    blocks, start, surged = [], None, False  # (first line, line after the last, whether it surged)
    for k, size in enumerate([*sums, 0]):
        if size == 0:  # a dive
            if start is not None:
                blocks.append((start, min(k, len(lines)), surged))
            start, surged = None, False
            continue
        if start is None:
            start = k
        surged |= size >= threshold
    kept, waiting, joined = [], [], False
    for n, (first, end, surged) in enumerate(blocks):
        if n and not _soft(lines, weights, blocks[n - 1][0], first):
            waiting, joined = [], False
        if surged:
            kept.extend(waiting)
            kept.extend(lines[first:end])
            waiting, joined = [], True
        elif joined:  # stays if a surge follows and only borders of lists, tables or inner containers lie between
            waiting.extend(lines[first:end])
    if marked:
        kept = [x for x in kept if x.inside]
    return "\n".join(x.text for x in kept if x.text)


_PAGE = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=_PAGE
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages`` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
