"""Main text of web pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass labels blocks by rules:

* inside menus, headers and footers of the page, sidebars, notices, adverts, forms,
  comments or hidden parts (by tag, role, class or id): bad;
* outside of ``article`` or ``main`` where the page has one with text: bad;
* more than ``MAX_LINKS`` of the characters in links, but for paragraphs and headings of an
  article: bad;
* at least ``MIN_LENGTH`` characters, with a share of stop words of ``MIN_STOPS`` (from
  ``LONG_LENGTH`` on ``LONG_STOPS``, inside an article ``ARTICLE_STOPS``) or more: good; as
  long, with fewer and with links, outside: bad;
* all others - short blocks, headings, plain ones with few stop words - are left open.

A class or id tells what an element is only if it is not that of a layout (``has-sidebar``); an
article around which all is named otherwise is the page's article nevertheless.

The second pass gives open blocks the label of the nearest decided block before or after;
if both are as near, the good one; where no block is decided, bad. Inside an article only
its own blocks decide, and an open block is bad only between two bad ones.

Blocks of the text are in page order, joined by a line feed; character references are
decoded and white space within a block is one space. Null, empty and markup-only pages
have an empty text. A page may end anywhere: an unfinished tag at the end is dropped, an
unclosed script or comment reaches to the end. All rows are kept as they come.
"""

from __future__ import annotations

import html as html_module
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverloom.session import map_arrow

MIN_LENGTH = 70
MIN_STOPS = 0.2
#: a long block without links needs fewer stop words
LONG_LENGTH, LONG_STOPS = 200, 0.1
ARTICLE_STOPS = 0.05
MAX_LINKS = 0.5

STOP_WORDS = frozenset(
    """the of and to in a is that it for was on are as with his they at be this from have or by had not but
    what all were when we there can an your which their if will each about how up out them then she many some
    der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als auch es an er hat aus bei
    le la les de des et à un une du en que qui dans est pour par sur pas plus au avec ce se ne sont il
    el los las y en del que por con una para se no al lo como más su es""".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?(?P<odd>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|</[^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SKIPPED = frozenset("script style noscript template iframe object svg math title textarea select audio video canvas".split())
_BLOCK = frozenset(
    """address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li link main menu meta
    nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul button""".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HOLDS = frozenset(
    "article main section div nav header footer aside form menu dialog button ul ol dl table figure details fieldset span".split()
)
_BAD_TAGS = frozenset("nav footer aside form menu dialog button".split())
_BAD_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split()
)
_BAD_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|popup|"
    r"modal|overlay|newsletter|subscribe|subscription|sidebar|side-bar|widgets?|menu|nav|navbar|navigation|"
    r"breadcrumbs?|header|masthead|footer|comments?|commentlist|discussion|disqus|repl(?:y|ies)|related|recommended|share|"
    r"sharing|social|login|signup|search|pagination|pager|toolbar|skip|hidden|legal|copyright)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: names that tell how a page is laid out, not what the element is
_MODIFIER = re.compile(r"^(?:has|no|with|without)[_-]|[_-](?:enabled|disabled|fixed|open|closed|on|off)$", re.IGNORECASE)
#: an article's own head is part of it
_HEAD = re.compile(r"(?:^|(?<=[_-]))(?:header|masthead)(?=$|[_-])", re.IGNORECASE)
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre dt dd".split())
_LETTERS = re.compile(r"[^\W\d_]+")
_COMMENT = re.compile(r"(?:^|[\s_-])(?:comments?|repl(?:y|ies))(?:$|[\s_-])", re.IGNORECASE)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Block:
    text: str
    link_chars: int
    heading: bool
    bad: bool
    #: number of the article it lies in, 0 for none
    article: int
    #: whether it is a paragraph or heading, not a list entry or the like
    paragraph: bool = False


#: what an element is by its attributes or tag: part of the text, named otherwise, surely otherwise
FINE, NAMED, WRONG = 0, 1, 2


def _boilerplate(tag: str, attributes: str, in_article: bool) -> int:
    if tag in _BAD_TAGS or tag == "header" and not in_article:
        return WRONG
    if not attributes or attributes.isspace():
        return FINE
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
        return WRONG
    if found.get("role", "").lower() in _BAD_ROLES:
        return WRONG
    names = f"{found.get('class', '')} {found.get('id', '')}".split()
    if tag in ("article", "main"):
        return WRONG if tag == "article" and any(map(_COMMENT.search, names)) else FINE
    if tag == "header":  # of an article
        return FINE
    names = [_HEAD.sub("", n) if in_article else n for n in names if not _MODIFIER.search(n)]
    return NAMED if any(map(_BAD_NAMES.search, names)) else FINE


def cut_blocks(page: str) -> list[Block]:
    """Blocks with text, in page order.

    An article that only stands in elements that are named otherwise (and of which there is no
    other) is the page's article: such a name is that of a layout.
    """
    blocks, hidden = _cut_blocks(page, False)
    return _cut_blocks(page, True)[0] if hidden and not any(b.article and not b.bad for b in blocks) else blocks


def _cut_blocks(page: str, forgiving: bool) -> tuple[list[Block], bool]:
    """The blocks, and whether an article stands in elements that are only named otherwise."""
    blocks: list[Block] = []
    parts: list[str] = []
    link_chars = 0
    in_link = heading = False
    stack: list[tuple[str, int, int]] = []  # tag, bad, article
    open_tags: Counter = Counter()
    bad, article, articles = FINE, 0, 0
    paragraph = hidden = False
    own_bad = False  # of a paragraph or the like
    skip = None

    def close() -> None:
        nonlocal link_chars
        text = " ".join("".join(parts).split())
        if text:
            blocks.append(Block(text, link_chars, heading, bool(bad or own_bad), article, paragraph))
        parts.clear()
        link_chars = 0

    at, end = 0, len(page)
    while at < end:
        if skip:
            # raw text: nothing but the closing tag ends it
            found = re.compile(rf"</{skip}(?=[\s/>]|\Z)", re.IGNORECASE).search(page, at)
            at, skip = (found.start() if found else end), None
            continue
        m = _TOKEN.match(page, at)
        at = m.end()
        if m["text"] is not None:
            text = html_module.unescape(m["text"])
            parts.append(text)
            if in_link:
                link_chars += len(" ".join(text.split()))
            continue
        tag = (m["tag"] or m["odd"] or "").lower()
        if not tag:
            continue
        closing = bool(m["close"]) or m["odd"] is not None and m[0].startswith("</")
        if tag in _SKIPPED and not closing:
            if not (m["attributes"] or "").endswith("/"):
                skip = tag
            if tag in _BLOCK:
                close()
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag in _BLOCK:
            close()
            heading = tag in ("h1", "h2", "h3", "h4", "h5", "h6") and not closing
            paragraph = tag in _PARAGRAPHS and not closing
            own_bad = tag not in _HOLDS and not closing and _boilerplate(tag, m["attributes"] or "", article > 0)
            if not closing and tag in ("p", "li", "div", "section", "article", "td"):
                in_link = False  # a link that was never closed
        if tag not in _HOLDS or tag in _VOID:
            continue
        if not closing:
            if (m["attributes"] or "").endswith("/") and tag == "span":
                continue
            wrong = _boilerplate(tag, m["attributes"] or "", article > 0)
            if tag == "span" and wrong:
                close()
            stack.append((tag, bad, article))
            open_tags[tag] += 1
            if tag in ("article", "main") and not wrong and not article:
                hidden |= bad == NAMED
                if bad == NAMED and forgiving and not articles:
                    bad = FINE
                if not bad:
                    articles += 1
                    article = articles
            bad = max(bad, wrong)
        elif open_tags[tag]:  # else nothing to be closed
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag == "span" and bad != stack[i][1]:
                        close()
                    _, bad, article = stack[i]
                    open_tags.subtract(t for t, _, _ in stack[i:])
                    del stack[i:]
                    break
    close()
    return blocks, hidden


def classify(blocks: list[Block]) -> list[bool]:
    """Whether each block belongs to the main text."""
    framed = any(b.article and not b.bad for b in blocks)
    labels: list[bool | None] = []
    for b in blocks:
        length = len(b.text)
        linked = b.link_chars > MAX_LINKS * length and not (b.article and b.paragraph)
        if b.bad or framed and not b.article or linked:
            labels.append(False)
            continue
        if length < MIN_LENGTH or b.heading:
            labels.append(None)
            continue
        words = _LETTERS.findall(b.text.lower())
        stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
        least = ARTICLE_STOPS if b.article else LONG_STOPS if length >= LONG_LENGTH else MIN_STOPS
        if stops >= least:
            labels.append(True)
        else:
            labels.append(None if b.article or not b.link_chars else False)

    def decides(i: int, article: int) -> bool:
        return labels[i] is not None and (not article or blocks[i].article == article and not blocks[i].bad)

    out = []
    before: dict[int, int | None] = {}
    after: list[int | None] = [None] * len(blocks)
    nearest: dict[int, int] = {}
    for i in range(len(blocks) - 1, -1, -1):
        after[i] = nearest.get(blocks[i].article)
        for a in {0, blocks[i].article}:
            if decides(i, a):
                nearest[a] = i
    for i, b in enumerate(blocks):
        label = labels[i]
        if label is None:
            near = [(k, labels[k]) for k in (before.get(b.article), after[i]) if k is not None]
            if not near:
                label = b.article > 0
            elif b.article:
                label = len(near) < 2 or any(good for _, good in near)
            else:
                least = min(abs(k - i) for k, _ in near)
                label = any(good for k, good in near if abs(k - i) == least)
        for a in {0, b.article}:
            if decides(i, a):
                before[a] = i
        out.append(bool(label))
    return out


def main_text(page: str | None) -> str:
    blocks = cut_blocks(page or "")
    return "\n".join(b.text for b, good in zip(blocks, classify(blocks)) if good)


def _extract(batches):
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch["html"]]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"].cast(pa.int64()), batch["url"].cast(pa.string()), pa.array(texts, pa.string())],
            ["page_id", "url", "text"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of pages (page_id, url, html)."""
    return map_arrow(pages.select("page_id", "url", "html"), _extract, "page_id long, url string, text string")
