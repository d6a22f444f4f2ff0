"""Main text of HTML pages by line-block distribution.

Markup is stripped so that every block of a page becomes a line.  Scripts, styles and elements whose kind or name says
that they are no article (menus, footers, sidebars, adverts, notices, forms, readers' comments) leave no line.  The
text lengths of the lines, links not counted, are summed over a sliding window of lines.  Where the sum surges over a
threshold the text begins, where it dives to nothing the text ends, and all that lies between is kept.

A name is a role, or a token of class or id.  A token of nothing but such words (``sidebar``, ``cookie-notice``) names a use.  One
that has other words too (``share-buttons``) does so unless the elements with its words hold most of the page's
unlinked text, or all its text.  One that tells a state (``no-comments``, ``has-sidebar``) names none.  ``html`` and ``body`` are never
skipped, and neither is an ``article`` or ``main`` inside the looked-at part that holds most of the unlinked text.

If the page marks its article (``article``, ``main``), its lines alone are looked at, links count and any text is a surge; of several
articles the one with most text counts, and one named for another use only if no other has text.  Otherwise the whole body is looked at with ``SURGE`` characters as threshold,
and if nothing surges there, every line with text is kept.

Character references are decoded, white space inside a block becomes one space, blocks are joined by one space.
Null, empty and markup-only pages give an empty text.  Broken markup is read as far as it goes: an element that is
never closed ends with the page, a menu or the like that is never closed is not skipped.  Pages are read whole and one by
one; repeated pages give equal results, an empty table an empty result.  Other columns are kept, those named like
the outputs replaced.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shelflight.llm.common import arrow_pass, batch

#: Lines of a window, and characters in it at which text begins on pages that mark no article.
WINDOW, SURGE = 3, 80

# Kinds of elements, and words in class and id that tell what an element is for.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "select", "button"}
SKIPPED = {"nav", "footer", "aside", "form", "menu", "dialog", "head"}
ARTICLE = ("article", "main")
BLOCKS = {"address", "article", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt", "fieldset",
          "figcaption", "figure", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "ol", "p", "pre",
          "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"} | SKIPPED | RAW
OTHER_USE = {"ad", "ads", "adbox", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo",
             "promotion", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "masthead",
             "topbar", "toolbar", "footer", "sidebar", "aside", "widget", "related", "recommended", "share", "sharing", "social",
             "comment", "comments", "commentlist", "reply", "replies", "respond", "disqus", "notice", "notices", "alert",
             "cookie", "cookies", "consent", "gdpr", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
             "signup", "login", "search", "skip", "paywall"}
STATES = {"no", "not", "has", "have", "with", "without", "off", "open", "closed", "enabled", "disabled"}
WRAPPERS = ("html", "body")
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}

TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@dataclass
class Line:
    """A block: its text, and the characters that lie outside links."""

    text: str
    plain: int


def named(attributes: str) -> tuple[bool, list[tuple[str, ...]]]:
    """Whether class, id or role name another use than the article, and the words of tokens that may name one."""
    sure, maybe = False, []
    if "=" not in attributes:
        return sure, maybe
    for kind, *values in NAMED.findall(attributes):
        value = html.unescape("".join(values))
        if kind.lower() == "role":
            sure |= value.strip().lower() in ROLES
            continue
        for token in value.split():
            words = tuple(w.lower() for w in WORDS.findall(token))
            if OTHER_USE.isdisjoint(words) or not STATES.isdisjoint(words):
                continue
            if OTHER_USE.issuperset(words):
                sure = True
            else:
                maybe.append(words)
    return sure, maybe


def _tags(page: str) -> list[tuple[int, int, bool, str, str]]:
    """Start, end, whether it closes, name and attributes of every tag; comments have no name, raw text is part of its tag."""
    out = []
    at = 0
    while (m := TAG.search(page, at)) is not None:
        close, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        end = m.end()
        name = (name or "").lower()
        if name in RAW and not close and not attributes.endswith("/"):
            shut = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, end)
            if shut is not None:
                end = shut.end()
            elif name in ("script", "style"):
                end = len(page)
        out.append((m.start(), end, bool(close), name, attributes or ""))
        at = end
    return out


def _closes(tags: list[tuple[int, int, bool, str, str]]) -> list[int | None]:
    """For every opening tag the tag that closes it, by counting tags of its name."""
    out: list[int | None] = [None] * len(tags)
    unclosed: dict[str, list[int]] = {}
    for k, (_, _, closing, name, _) in enumerate(tags):
        if not closing:
            unclosed.setdefault(name, []).append(k)
        elif unclosed.get(name):
            out[unclosed[name].pop()] = k
    return out


@dataclass
class Names:
    """Tags that names refuse for sure, all that names refuse, and articles in order: those without such names or with most text."""

    sure: set[int]
    refused: set[int]
    articles: list[int]
    large: set[int]


def _names(page: str, tags: list[tuple[int, int, bool, str, str]], closes: list[int | None]) -> Names:
    """What the names of a page's elements say."""
    found = {k: n for k, (_, _, closing, name, attributes) in enumerate(tags)
             if not closing and name not in WRAPPERS and any(n := named(attributes))}
    sure = {k for k, n in found.items() if n[0]}
    articles = [k for k, t in enumerate(tags) if t[3] in ARTICLE and not t[2] and k not in found]
    out = Names(sure, set(sure), articles, set())
    if not any(maybe or tags[k][3] in ARTICLE for k, (_, maybe) in found.items()):
        return out
    # Unlinked text before every tag, without what is skipped for sure.
    before, at, links, skipped = [0], 0, 0, -1
    for k, (start, end, closing, name, _) in enumerate(tags):
        counts = k > skipped and not links
        before[-1] += len(page[at:start].strip()) if counts else 0
        before.append(before[-1])
        at = end
        shut = closes[k]
        if k > skipped and shut is not None and name not in ARTICLE and (name in SKIPPED or k in sure) and not _holds(articles, k, shut):
            skipped = shut
        if name == "a":
            links = 0 if closing else 1
        elif name in BLOCKS:
            links = 0
    before[-1] += 0 if links else len(page[at:].strip())
    held: dict[tuple[str, ...], int] = {}
    until: dict[tuple[str, ...], int] = {}
    for k, (_, maybe) in found.items():
        shut = len(tags) if closes[k] is None else closes[k]
        text = before[shut] - before[k]
        if tags[k][3] in ARTICLE and 2 * text > before[-1]:
            out.large.add(k)
        for words in set(maybe):
            if k > until.get(words, -1):
                held[words] = held.get(words, 0) + text
                until[words] = shut
    out.articles = sorted([*articles, *out.large])
    out.refused |= {k for k, (_, maybe) in found.items() if any(2 * held[words] <= before[-1] for words in maybe)}
    return out


def _holds(articles: list[int], k: int, shut: int) -> bool:
    """Whether one of the articles begins between two tags."""
    return bisect_left(articles, shut) > bisect_right(articles, k)


def _lines(page: str, tags: list[tuple[int, int, bool, str, str]], closes: list[int | None], names: Names, first: int, last: int) -> list[Line]:
    """Lines of the text between two tags."""
    lines: list[Line] = []
    block: list[str] = []
    plain = links = 0

    def end_line() -> None:
        nonlocal plain
        text = " ".join(html.unescape("".join(block)).split())
        if text or (lines and lines[-1].text):
            lines.append(Line(text, plain))
        block.clear()
        plain = 0

    at = tags[first][1] if first >= 0 else 0
    k = first + 1
    while k <= last:
        start, end, closing, name, attributes = tags[k] if k < len(tags) else (len(page), len(page), True, "", "")
        piece = page[at:start]
        if piece:
            block.append(piece)
            if not links:
                plain += len(piece.strip())
        at = end
        if k < last and not closing:
            shut = closes[k]
            if name in ARTICLE:
                skip = k in names.refused and k not in names.large
            else:
                # An element that holds the article is no menu, whatever its name.
                skip = ((name in SKIPPED or k in names.refused or first < 0 and name == "header")
                        and shut is not None and not _holds(names.articles, k, shut))
            if skip and shut is not None and shut <= last:
                end_line()
                at = tags[shut][1]
                k = shut + 1
                continue
        if name == "a":
            links = 0 if closing else 1
        elif name == "br":
            block.append(" ")
        elif name in BLOCKS:
            end_line()
            links = 0
        k += 1
    end_line()
    return lines


def between(lines: list[Line], surge: int) -> list[str]:
    """Text of the lines between surge and dive points."""
    n = len(lines)
    sums = [sum(x.plain for x in lines[i:i + WINDOW]) for i in range(n)]
    kept: list[str] = []
    i = 0
    while i < n:
        if sums[i] >= surge and lines[i].plain:
            # The text lasts until a whole window holds nothing but links or blanks.
            while i < n and sums[i] > 0:
                kept.append(lines[i].text)
                i += 1
        i += 1
    return [x for x in kept if x]


def main_text(page: str | None) -> str:
    """The main text of a page."""
    if not page:
        return ""
    tags = _tags(page)
    closes = _closes(tags)
    names = _names(page, tags, closes)
    for other_use in (False, True):
        for kind in ARTICLE:
            best: list[str] = []
            k = 0
            while k < len(tags):
                if tags[k][3] == kind and not tags[k][2] and (k in names.refused) == other_use:
                    shut = closes[k]
                    last = len(tags) if shut is None else shut
                    found = between([Line(x.text, len(x.text)) for x in _lines(page, tags, closes, names, k, last)], 1)
                    if sum(map(len, found)) > sum(map(len, best)):
                        best = found
                    k = last
                k += 1
            if best:
                return " ".join(best)
    lines = _lines(page, tags, closes, names, -1, len(tags))
    if not any(x.text for x in lines):
        names.refused = names.sure
        lines = _lines(page, tags, closes, names, -1, len(tags))
    return " ".join(between(lines, SURGE) or [x.text for x in lines if x.text])


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` without that column, with ``text`` and ``n_chars``."""
    kept = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    fields = [pages.schema[c] for c in kept] + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

    def step(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(x.as_py()) for x in b.column(0)]
            yield batch([*b.columns[1:], texts, [len(x) for x in texts]], schema)

    return arrow_pass(pages.select(column, *kept), step, T.StructType(fields))
