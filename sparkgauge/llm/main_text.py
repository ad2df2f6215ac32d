"""Main text of web pages by tag-path ratios.

A page is read as a sequence of text nodes, each with its path of tags from the root. Per
path the text length and the punctuation of all its nodes are added up and set in relation
to the number of nodes; the two ratios are smoothed along the page, fused by their product
and compared with a threshold of the page itself (its standard deviation). Paths above it
are content. Containers that cannot be content (menus, headers, footers, sidebars, notices,
adverts, forms, comments, scripts) are left out before; a path within an article or main
element has the page's highest ratio added to its own, so its short headings and paragraphs
stay, while text outside is judged by the same threshold. A container (the
innermost div, section, table cell, article or main around a block) most of whose text is content is
content whole, with its headings and lists, on pages without an article too. Classes and ids are read
as whole tokens. Text under one that can also stand on a wrapper (sidebar, widget, share, notice) is
left out where the page has an article or main outside it and all such text together is not most of
the page; else paths below it are counted apart, get nothing added, and the ratios decide. The others
drop an element unless it holds a main element, the page's longest article, or, on a page with no
article or main outside it, most of the page's text; one named after readers' comments stays only
for a main element, or if it holds most of the page's text and at most one article. Runs page by page on Arrow batches.

Defined results
  - null, empty or markup-only pages have an empty text;
  - a page's paths are judged with or without an article; everything in an article or main
    that is not left out is content, and so is the path of the highest ratio, wherever it is;
  - unclosed and crossed tags are closed by their containers; cut pages end where they end;
  - repeated pages and null ids or urls give one row each; empty tables give an empty
    result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

# Fixed values of HTML: elements without content, without shown text, and those that begin a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style noscript template head title iframe object svg math canvas audio video select datalist button textarea".split()
)
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
# What an open element of the first kind is closed by.
CLOSED_BY = {
    "p": BLOCK - {"br"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "option": frozenset({"option", "optgroup"}),
}
# Elements that say their text is the page's own.
BODY_TAGS = frozenset({"article", "main"})
# Elements, roles and words of class or id that mark what is not content.
ASIDE_TAGS = frozenset("nav footer aside menu dialog".split())
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr masthead menu modal nav navbar navigation newsletter pager pagination popup promoted related reply replies "
    "respond sponsored subscribe".split()
)
# Words that also stand on wrappers of the body: the ratios decide.
DOUBTFUL_WORDS = frozenset(
    "banner discussion notice notices promo share sharing sidebar signup social sponsor subscription toolbar widget".split()
)
# Of the first kind, those that name what readers wrote.
READER_WORDS = frozenset("comment comments disqus reply replies respond".split())
# Whole tokens that mark the frame of a site; a header or footer of another name may be an article's own.
SITE_TOKENS = frozenset("site-header site-footer site-masthead page-footer global-header global-footer".split())
# Elements that lay a page out; the innermost one around a block is its container.
LAYOUT = frozenset("article div main section td".split())
# Words that may stand beside one of the above in a token with hyphens or underscores (top-menu, cookie-box).
PLAIN_WORDS = frozenset(
    "area bar block bottom box buttons container global left links list main primary right secondary section site slot top wrap wrapper".split()
)
_PUNCTUATION = re.compile(r"[.,;:!?()\"'…。，、；：！？«»“”„¿¡-]")
_PARTS = re.compile(r"[-_]+")


def word_kind(value: str) -> str:
    """Of a class or id: 'readers', 'aside', 'doubtful' or '', by tokens all of whose parts are known words."""
    kind = ""
    for token in value.lower().split():
        if token.replace("_", "-") in SITE_TOKENS:
            return "aside"
        parts = [x for x in _PARTS.split(token) if x]
        own = [x for x in parts if x not in PLAIN_WORDS]
        if own and all(x in ASIDE_WORDS or x in DOUBTFUL_WORDS for x in own):
            if any(x in READER_WORDS for x in own):
                return "readers"
            if any(x in ASIDE_WORDS for x in own):
                return "aside"
            kind = "doubtful"
    return kind


class _Open(NamedTuple):
    """An open element and what holds below it."""

    tag: str
    name: str  # the tag in paths, marked if the paths below are counted apart
    out: bool
    body: bool  # within article or main
    asides: tuple[int, ...]  # numbers of the enclosing elements that are dropped unless they hold the body
    articles: tuple[int, ...]
    container: int  # number of the innermost layout element, 0 if there is none


class _Block(NamedTuple):
    path: str
    body: bool
    asides: tuple[int, ...]
    articles: tuple[int, ...]
    in_main: bool
    container: int
    pieces: list[str]


_ROOT = _Open("", "", False, False, (), (), 0)


class _Page(HTMLParser):
    """Collects text nodes with their path and the elements that may drop them; a block is one node."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = []
        self.blocks: list[_Block] = []
        self.articles: list[tuple[int, ...]] = []  # per article the asides around it
        self.n_asides = 0
        self.readers: set[int] = set()  # asides of what readers wrote
        self.doubtful: set[int] = set()
        self.n_containers = 0
        self.with_main: set[int] = set()  # asides that hold a main element
        self.fresh = True

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        for kind, closers in CLOSED_BY.items():
            if tag in closers:
                self._close_within(kind)
        if tag in BLOCK:
            self.fresh = True
        if tag in VOID:
            return
        above = self.open[-1] if self.open else _ROOT
        name, body, asides, articles = tag, above.body, above.asides, above.articles
        out = above.out or tag in SILENT or tag in ASIDE_TAGS or self._hidden(tag, attrs)
        if not out:
            kind = self._marked(tag, attrs) or ("aside" if tag == "form" or (tag == "header" and not articles) else "")
            if kind:
                name, body = f"{tag}.{kind}", False
                asides = (*asides, self.n_asides)
                if kind == "readers":
                    self.readers.add(self.n_asides)
                elif kind == "doubtful":
                    self.doubtful.add(self.n_asides)
                self.n_asides += 1
            if tag == "article":
                articles = (*articles, len(self.articles))
                self.articles.append(asides)
            elif tag == "main":
                self.with_main.update(asides)
            body = body or tag in BODY_TAGS
        container = above.container
        if tag in LAYOUT:
            self.n_containers += 1
            container = self.n_containers
        self.open.append(_Open(tag, name, out, body, asides, articles, container))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.fresh = True
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        above = self.open[-1] if self.open else _ROOT
        if above.out:
            return
        if self.fresh or not self.blocks:
            path = "/".join(e.name for e in self.open)
            in_main = any(e.tag == "main" for e in self.open)
            self.blocks.append(_Block(path, above.body, above.asides, above.articles, in_main, above.container, [data]))
            self.fresh = False
        else:
            self.blocks[-1].pieces.append(data)

    def _close_within(self, kind: str) -> None:
        """Close the innermost open element of the kind if no other container lies between."""
        for i in range(len(self.open) - 1, -1, -1):
            tag = self.open[i].tag
            if tag == kind:
                del self.open[i:]
                return
            if tag in BLOCK:
                return

    @staticmethod
    def _hidden(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        """Whether the element is not shown or its role says that it is no content."""
        if tag in ("html", "body", "article", "main"):
            return False
        for name, value in attrs:
            value = (value or "").lower()
            if name == "role" and value in ASIDE_ROLES:
                return True
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True
            if name == "style" and "display:none" in value.replace(" ", ""):
                return True
        return False

    @staticmethod
    def _marked(tag: str, attrs: list[tuple[str, str | None]]) -> str:
        if tag in ("html", "body", "article", "main"):
            return ""
        kinds = {word_kind(value or "") for name, value in attrs if name in ("class", "id")}
        return next((kind for kind in ("readers", "aside", "doubtful") if kind in kinds), "")

    def shown(self) -> list[tuple[str, bool, str, int]]:
        """(path, within article or main, text, container) of the blocks with text that no aside drops."""
        blocks = [(b, text) for b in self.blocks if (text := " ".join("".join(b.pieces).split()))]
        if self.n_asides:
            sizes, held = [0] * len(self.articles), [0] * self.n_asides
            total = doubted = 0
            for b, text in blocks:
                total += len(text)
                doubted += len(text) * (not self.doubtful.isdisjoint(b.asides))
                for i in b.articles:
                    sizes[i] += len(text)
                for i in b.asides:
                    held[i] += len(text)
            kept = set(self.with_main)
            if 2 * doubted > total or not any((b.articles or b.in_main) and self.doubtful.isdisjoint(b.asides) for b, _ in blocks):
                kept |= self.doubtful
            remarks = {i for i in self.readers if 2 * held[i] <= total or sum(i in asides for asides in self.articles) > 1}
            longest = [(n, asides) for n, asides in zip(sizes, self.articles, strict=True) if remarks.isdisjoint(asides)]
            most = max((n for n, _ in longest), default=0)
            kept.update(i for n, asides in longest if n == most for i in asides)
            for i, n in enumerate(held):
                if 2 * n > total and i not in remarks and not any((b.articles or b.in_main) and i not in b.asides for b, _ in blocks):
                    kept.add(i)
            blocks = [(b, text) for b, text in blocks if kept.issuperset(b.asides)]
        return [(b.path, b.body, text, b.container) for b, text in blocks]


def _smooth(values: list[float]) -> list[float]:
    """Gaussian window of two neighbours on each side."""
    weights = (0.0545, 0.2442, 0.4026, 0.2442, 0.0545)
    out = []
    for i in range(len(values)):
        part = [(weights[d + 2], values[i + d]) for d in range(-2, 3) if 0 <= i + d < len(values)]
        out.append(sum(w * v for w, v in part) / sum(w for w, _ in part))
    return out


def content_paths(blocks: list[tuple[str, bool, str]]) -> set[tuple[str, bool]]:
    """The content paths among (path, within article or main, text) in page order, by smoothed and fused ratios."""
    totals: dict[tuple[str, bool], list[int]] = {}
    for path, body, text in blocks:
        t = totals.setdefault((path, body), [0, 0, 0])
        t[0] += len(text)
        t[1] += len(_PUNCTUATION.findall(text))
        t[2] += 1
    keys = [(path, body) for path, body, _ in blocks]
    length = _smooth([totals[k][0] / totals[k][2] for k in keys])
    marks = _smooth([totals[k][1] / totals[k][2] for k in keys])
    fused = [a * math.log1p(b) for a, b in zip(length, marks, strict=True)]
    # The deviation is at most half the range, so neither the highest ratio nor one with the highest added can be below it.
    highest = max(fused, default=0.0)
    fused = [x + highest if body else x for (_, body), x in zip(keys, fused, strict=True)]
    mean = sum(fused) / max(len(fused), 1)
    threshold = math.sqrt(sum((x - mean) ** 2 for x in fused) / max(len(fused), 1))
    best: dict[tuple[str, bool], float] = {}
    for key, value in zip(keys, fused, strict=True):
        best[key] = max(best.get(key, 0.0), value)
    return {k for k, v in best.items() if v >= threshold * (1 - 1e-9)}


def main_text(html: str | None) -> str:
    """The content blocks of a page, white space within each made single, joined by one space."""
    if not html:
        return ""
    page = _Page()
    page.feed(html)
    page.close()
    blocks = page.shown()
    paths = content_paths([b[:3] for b in blocks])
    chosen = [(path, body) in paths for path, body, _, _ in blocks]
    shares: dict[int, int] = {}
    for (_, _, text, container), content in zip(blocks, chosen):
        shares[container] = shares.get(container, 0) + (len(text) if content else -len(text))
    mostly = {c for c, n in shares.items() if c and n > 0}
    return " ".join(b[2] for b, content in zip(blocks, chosen) if content or b[3] in mostly)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(x.as_py()) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    return pages.selectExpr("CAST(page_id AS BIGINT) page_id", "url", "html").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
