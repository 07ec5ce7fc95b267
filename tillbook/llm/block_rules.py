"""Main text of web pages by two-pass block rules.

A page is read as a stream of tags and text and cut into blocks at block-level
tags.  Pass one decides each block alone from its place (menus, headers,
footers, sidebars, forms, adverts, notices and comments by tag, role or
class), its share of linked characters, its length and its density of
function words.  Pass two decides the ambiguous rest: a short block, and a
low-density block inside the page's article element, takes the label of its
nearest decided neighbour in the same part of the page.

Marks are class names, ids and roles, each taken as a whole: ``tag-sports`` or
``with-sidebar`` say nothing of an article, ``site-footer`` or ``ad-300`` do of
what bears them, paragraphs, list items and inline elements included.

Defined results: null, empty or tag-only html gives the empty string; broken
markup is read as far as it can be (an unclosed comment, script or style ends
with the page, a ``<`` without any ``>`` behind it is text), in time linear in
the page, however long; repeated pages give repeated rows; null ids and urls
pass through; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Frequent function words of the four languages.
STOP_WORDS = frozenset("""
a an and are as at be been but by for from had has have he her his i if in is it its not of on or our she so that the their
there they this to was we were which who will with would you your
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour qu que
qui sa se ses son sont sur un une vous
als am an auch auf aus bei das dass dem den der des die ein eine einen einer es für haben hat ich im ist mit nach nicht sich
sie sind so und von vor war wie wird wir zu zum zur
al como con de del el ella en es esta este fue ha la las le lo los más no o para pero por que se si sin sobre su sus un una y
""".split())

MAX_LINKED = 0.2      # share of linked characters
SHORT = 70            # characters; below, a block is ambiguous
LONG = 200
LOW_STOP = 0.15       # share of function words
HIGH_STOP = 0.30

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small
span strike strong sub sup time tt u var wbr img""".split())
_SPACED = frozenset("br td th".split())
_DROPPED = frozenset("nav footer aside form button select option dialog menu svg iframe object audio video canvas".split())
_NOT_TEXT = frozenset("script style noscript template textarea title svg math".split())
_RAW = frozenset("script style textarea title".split())      # without an end they go to the end of the page
_ARTICLE = frozenset("article main".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_LOOSE = frozenset("p li dt dd tr td th thead tbody tfoot option".split())      # often left unclosed: only kept in mind if marked
_UNTRACKED = _VOID | _INLINE | _LOOSE | frozenset("html body head".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in _NOT_TEXT}
_MARKS = re.compile(r"""(class|id|role|aria-label|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_CONTENT = re.compile(r"""(?:^|[-_\s"'])(?:article|articlebody|content|post|entry|story|main|text)(?:[-_]?(?:body|content|text))?(?=$|[\s"'])""", re.I)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[^\W\d_A-Z]+|\d\w*")
# Names of what isn't main text; a class name or id counts if it is one of them, ends in one, or begins with one that only
# words of place and kind follow.
_AWAY = frozenset("""ad ads advert adverts advertisement advertising adsense adbox banner sponsor sponsored promo promotion cookie cookies consent gdpr
notice notices alert alerts newsletter subscribe subscription popup modal overlay sidebar side widget menu nav navbar navigation breadcrumb
breadcrumbs footer comment comments commentlist disqus reply replies respond social share sharing related recommended recommendations login
signin signup search pagination pager toolbar legal copyright disclaimer contentinfo complementary skip tag tags""".split())
_KINDS = frozenset("""area articles bar block body bottom box boxes button buttons card cards center cloud col column container content details
entry footer form frame group header heading holder icons inner input item items label layer left link links list main meta news outer panel
post posts row right section slot small space stories text thread title to top topics this unit us wrap wrapper list""".split())
_NOT_OF_ITS_OWN = frozenset("with has no without hide show".split())
_TWO_WORDS = frozenset({("author", "bio"), ("byline", "box")})
_HEAD = frozenset("header masthead topbar banner".split())


class BlockOfText(NamedTuple):
    text: str
    linked: int         # characters inside links
    away: bool          # stands in a menu, advert, comment section, ...
    article: int        # number of the enclosing article element, 0 if none
    heading: bool = False


class Element(NamedTuple):
    tag: str
    parent: int         # its number, -1 for the page
    dropped: bool       # by its tag, or hidden
    named_away: bool    # by a class name, id or role
    named_head: bool
    content: bool       # by another class name or id


def _is_name_of(name: str, words: frozenset[str]) -> bool:
    parts = tuple(w.lower() for w in _WORDS.findall(name))
    if not parts or parts[0] in _NOT_OF_ITS_OWN:
        return False
    if parts[-1] in words and (parts[-1] != "side" or len(parts) == 1):
        return True
    return parts[0] in words and all(p in _KINDS or p in words or p[0].isdigit() for p in parts[1:])


def _element(tag: str, parent: int, attributes: str) -> Element:
    """What an element's tag and marks say of it, each class name taken as a whole."""
    names: list[str] = []
    for kind, value in _MARKS.findall(attributes) if attributes else ():
        value = value.strip("\"'")
        names += [value] if kind.lower() == "aria-label" else value.split()
    away = [n for n in names if _is_name_of(n, _AWAY) or tuple(w.lower() for w in _WORDS.findall(n)) in _TWO_WORDS]
    return Element(tag, parent, tag in _DROPPED or bool(attributes and _HIDDEN.search(attributes)), bool(away),
                   any(_is_name_of(n, _HEAD) for n in names), any(_CONTENT.search(n) for n in names if n not in away))


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """``(kind, name or text, attributes)`` with kind text, open, close or gap, in one pass that never goes back.

    A ``<`` without a ``>`` behind it is text; a quote without its end doesn't
    hold the tag's end up. What can't be found once isn't looked for again, so
    the time is linear in the page whatever is broken in it.
    """
    at, n, missing = 0, len(page), set()

    def find(what: str, start: int) -> int:
        i = -1 if what in missing else page.find(what, start)
        if i < 0:
            missing.add(what)
        return i

    start = page.find("<")
    while start >= 0:
        found = _NAME.match(page, start + 1 + (page[start + 1:start + 2] == "/"))
        after = start + 1
        if page.startswith("<!--", start):
            end = find("-->", start + 4)
            end = n if end < 0 else end + 3
            yield "text", page[at:start], ""
            at = after = end
        elif found:
            closing, name = page[start + 1] == "/", found[0].lower()
            end = found.end()
            while True:
                stop = _STOP.search(page, end) if ">" not in missing else None
                if stop is None or stop[0] == ">":
                    break
                close = find(stop[0], stop.end())
                end = close + 1 if close >= 0 else stop.end()
            if stop is None:
                if find(">", found.end()) < 0:
                    break                                      # no tag ends any more: the rest is text
                stop = _GT.search(page, found.end())           # a quote swallowed all ends: the first one counts
            yield "text", page[at:start], ""
            attributes = page[found.end():stop.start()]
            at = after = stop.end()
            if not closing and name in _NOT_TEXT and not (attributes.endswith("/") and name not in _RAW):
                end = None if name in missing else _END[name].search(page, at)
                if end is None:
                    missing.add(name)
                if end is not None or name in _RAW:
                    at = after = end.end() if end else n
                yield "gap", "", ""
            else:
                yield ("close" if closing else "open"), name, attributes
        elif page[start + 1:start + 2] in ("!", "?", "/") and start + 1 < n:
            end = find(">", start)
            if end >= 0:
                yield "text", page[at:start], ""
                at = after = end + 1
        start = page.find("<", after)
    yield "text", page[at:], ""


_GT = re.compile(">")


def _read(page: str) -> tuple[list[tuple[str, int, int, bool]], list[Element]]:
    """Blocks as (text, linked characters, number of the innermost element, heading), and all tracked elements."""
    out: list[tuple[str, int, int, bool]] = []
    elements: list[Element] = []
    stack: list[int] = []
    open_tags: dict[str, int] = {}
    parts: list[str] = []
    linked: list[str] = []
    in_link, heading, unseen = False, False, ""         # unseen: the inline element whose text doesn't count

    def close_block() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append((text, len(" ".join(entities.unescape("".join(linked)).split())), stack[-1] if stack else -1, heading))
            parts.clear()
            linked.clear()

    def pop(depth: int) -> None:
        for i in stack[depth:]:
            open_tags[elements[i].tag] -= 1
        del stack[depth:]

    def push(element: Element) -> None:
        elements.append(element)
        stack.append(len(elements) - 1)
        open_tags[element.tag] = open_tags.get(element.tag, 0) + 1

    for kind, tag, attributes in tokens(page):
        if kind == "text":
            if tag and not unseen:
                parts.append(tag)
                if in_link:
                    linked.append(tag + " ")
            continue
        if kind == "gap":
            parts.append(" ")
            continue
        closing = kind == "close"
        if tag == "a":
            in_link = not closing
        if tag in _SPACED:
            parts.append(" ")
        elif tag not in _INLINE:
            close_block()
            in_link, unseen = False, ""
            heading = tag in _HEADINGS and not closing
        if tag in _INLINE:
            if closing and tag == unseen:
                unseen = ""
            elif not closing and not unseen and tag not in _VOID and attributes:
                marked = _element(tag, -1, attributes)
                unseen = tag if marked.dropped or marked.named_away else ""
            continue
        if not closing and stack and elements[stack[-1]].tag in _LOOSE:
            if elements[stack[-1]].tag == tag or elements[stack[-1]].tag == "p":     # a paragraph ends where a block begins
                pop(len(stack) - 1)
        if closing:
            if open_tags.get(tag):
                depth = len(stack) - 1
                while elements[stack[depth]].tag != tag:
                    depth -= 1
                pop(depth)
            continue
        if tag in _UNTRACKED:
            if tag in _LOOSE and attributes:
                marked = _element(tag, stack[-1] if stack else -1, attributes)
                if marked.dropped or marked.named_away:
                    push(marked)
            continue
        if attributes.endswith("/") and tag not in _ARTICLE:
            continue
        push(_element(tag, stack[-1] if stack else -1, attributes))
    close_block()
    return out, elements


def read_blocks(page: str) -> list[BlockOfText]:
    """All text blocks of a page, in page order, white space settled.

    A name that speaks against an article or main element, or against one that
    another name calls content, counts only if the element holds no more than
    half of the page's text.
    """
    found, elements = _read(page)
    size = [0] * len(elements)
    for text, _, at, _ in found:
        if at >= 0:
            size[at] += len(text)
    total = sum(len(text) for text, *_ in found)
    for i in range(len(elements) - 1, -1, -1):              # children come after their parents
        if elements[i].dropped:
            total -= size[i]
        elif elements[i].parent >= 0:
            size[elements[i].parent] += size[i]
    state: list[tuple[bool, int]] = []                      # away, article number
    count = 0
    for i, e in enumerate(elements):
        away, article = state[e.parent] if e.parent >= 0 else (False, 0)
        main = e.tag in _ARTICLE
        unwanted = e.dropped or e.named_away and not ((main or e.content) and 2 * size[i] > total)
        if main and not unwanted and not (away and article):
            count += 1                                      # also ends a menu or the like that was never closed
            away, article = False, count
        elif unwanted or not article and not (e.content and 2 * size[i] > total) and (e.tag == "header" or e.named_head):
            away = True
        elif not article and not away and e.content:
            count += 1
            article = count
        state.append((away, article))
    return [BlockOfText(text, linked, *(state[at] if at >= 0 else (False, 0)), heading) for text, linked, at, heading in found]


def label_alone(block: BlockOfText, has_article: bool) -> bool | None:
    """Pass one: kept, not kept, or None if undecided."""
    n = len(block.text)
    if block.away or has_article and not block.article or block.linked > MAX_LINKED * n:
        return False
    if n < SHORT:
        if not block.article and (block.linked or "©" in block.text):
            return False
        return None
    words = block.text.lower().split()
    density = sum(map(STOP_WORDS.__contains__, words)) / len(words)
    if density >= HIGH_STOP or density >= LOW_STOP and (n >= LONG or block.article):
        return True
    return None if block.article or density >= LOW_STOP else False


def label_all(blocks: list[BlockOfText]) -> list[bool]:
    """Pass two: undecided blocks follow their nearest decided neighbour.

    A heading follows what it heads, the next decided block.  At equal
    distance a neighbour in favour wins inside an article element and
    loses outside.  Only neighbours in the same article element count; where
    it has no decided block, its undecided ones are kept.
    """
    has_article = any(b.article and not b.away for b in blocks)
    first = [label_alone(b, has_article) for b in blocks]

    def decided(order: Iterator[int]) -> list[tuple[int, bool] | None]:
        """For each block the last decided one before it in this order."""
        near: list[tuple[int, bool] | None] = [None] * len(blocks)
        last: tuple[int, bool] | None = None
        part = -1
        for i in order:
            if blocks[i].away:
                if not blocks[i].article and not has_article:
                    last = (i, False)
                continue
            if blocks[i].article != part:
                part, last = blocks[i].article, None
            near[i] = last
            if first[i] is not None:
                last = (i, first[i])
        return near

    before, after = decided(iter(range(len(blocks)))), decided(iter(range(len(blocks) - 1, -1, -1)))
    out = []
    for i, block in enumerate(blocks):
        label = first[i]
        if label is None:
            near = (after[i] or before[i],) if block.heading else (before[i], after[i])
            sides = sorted((abs(i - s[0]), s[1] != bool(block.article), s[1]) for s in near if s)
            label = sides[0][2] if sides else bool(block.article)
        out.append(label)
    return out


def main_text(page: str | None) -> str:
    blocks = read_blocks(page) if page else []
    return "\n\n".join([b.text for b, keep in zip(blocks, label_all(blocks)) if keep])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = [main_text(h) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, type=pa.string()), pa.array([len(t) for t in texts], type=pa.int64())],
                names=["page_id", "url", "text", "n_chars"])


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page; each page stands alone, so nothing is shuffled."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
