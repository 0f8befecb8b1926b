"""Main text of web pages by tag-path ratios.

A page is read into blocks: the text of one block element between its block children.
Each block has a root-to-leaf path of block elements, by tag and class.  Over all blocks
of a path, text length, punctuation and link text are summed and set against the number
of blocks; so they are for the element that holds the block among others (its
container).  The ratios are fused, each path's is smoothed over its container and the
containers over their neighbours, and blocks whose score falls short of a share of the
page's best are not content.  Blocks within what HTML sets apart (menus, footers, forms)
count in the sums, but are never content, and so are those within what its usual class
names set apart: prose of a reader's comment has the ratios of an article.  A name is a
weaker sign than an element: what holds most of a page's prose is not set apart by one.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.common import per_text, unused

#: Elements of HTML by what they do to the text.
RAW = frozenset(("script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp"))
UNSHOWN = frozenset(("head", "template", "noscript", "svg", "math", "object", "canvas", "video", "audio", "select"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"))
APART = frozenset(("nav", "footer", "aside", "form", "button", "dialog", "menu"))
INLINE = frozenset(("a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"))
CONTAINERS = frozenset(("html", "body", "main", "article", "section", "div", "td", "header"))
#: An element of these ends an open one of the same list (the start of ``p`` ends ``p``, and so on).
ENDS = {"p": ("p",), "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
ENDS_P = frozenset(("address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul"))
#: Words of class, id or role that set apart what isn't the article.
MARKS = frozenset(("ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "captcha", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disqus", "footer", "gdpr", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget"))
#: Of these words, the ones of readers' comments, which may outweigh the article; and words after which a mark says what a page has, not what it is.
COMMENTS = frozenset(("comment", "comments", "disqus", "replies"))
HAVING = frozenset(("has", "have", "hide", "no", "not", "show", "with", "without"))
PUNCTUATION = frozenset(".,;:!?。，；：！？、…")

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)|<[A-Za-z][^>]*(?:>|\Z)""", re.S)
_MARKED = re.compile(r"""(?:^|[\s"'])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORD = re.compile(r"[A-Za-z]+")
_CLASS = re.compile(r"""(?:^|[\s"'])class\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HREF = re.compile(r"""(?:^|[\s"'])href\s*=""", re.I)
_NONE, _LISTS = frozenset(), CONTAINERS | {"table", "ul", "ol", "dl"}


@dataclass(slots=True, eq=False)
class Container:
    """An element that can hold blocks.  ``number`` counts them in page order, ``path`` numbers equal paths; ``top``: the page or its body."""

    number: int
    path: int
    top: bool
    up: Container | None


@dataclass(slots=True, eq=False)
class Mark:
    """An element whose name may set it apart; ``pure``: all its words are marks."""

    names: str
    pure: bool
    comments: bool
    up: Mark | None
    apart: bool = True
    prose: int = 0


@dataclass(slots=True)
class Block:
    path: int
    container: Container
    prime: bool
    apart: bool
    text: str
    link_chars: int
    mark: Mark | None = None


@dataclass(slots=True, frozen=True)
class _Open:
    """An open element and what its text inherits; those of an inline element are its block's."""

    tag: str
    path: int
    container: Container
    unshown: bool = False
    apart: bool = False
    prime: bool = False
    link: bool = False
    mark: Mark | None = None


def _marked(attributes: str, up: Mark | None) -> Mark | None:
    """The mark that an element's names give it, else that of the element around."""
    if "class" not in attributes and "id" not in attributes and "role" not in attributes and attributes.islower():
        return up
    found, other, names = set(), False, []
    for m in _MARKED.finditer(attributes):
        before = ""
        for w in _WORD.findall(m[1].lower()):
            if w in MARKS and before not in HAVING:
                found.add(w)
            else:
                other = True
            before = w
            names.append(w)
    return Mark(" ".join(names), not other, not found.isdisjoint(COMMENTS), up) if found else up


def _set_apart(found: list[Block], marks: list[Mark]) -> None:
    """Which blocks their marks set apart: those within a marked element, unless elements of its names hold most of the page's prose.

    That is text outside links that HTML doesn't set apart, in ``article`` and ``main`` if
    there is any.  Pure marks of comments always hold.  Marks within others come later.
    """
    firm: dict[Mark, bool] = {}
    for m in marks:
        firm[m] = (m.pure and m.comments) or (m.up is not None and firm[m.up])
    pool = [b for b in found if not b.apart and not (b.mark is not None and firm[b.mark])]
    pool = [b for b in pool if b.prime] or pool
    total, by_name = 0, Counter()
    for b in pool:
        prose = len(b.text) - b.link_chars
        total += prose
        if b.mark is not None:
            b.mark.prose += prose
    for m in reversed(marks):
        by_name[m.names] += m.prose
        if m.up is not None and m.up.names != m.names:  # what lies in two elements of one name counts once
            m.up.prose += m.prose
    for m in marks:
        m.apart = firm[m] or 2 * by_name[m.names] <= total or (m.up is not None and m.up.apart)
    for b in found:
        b.apart = b.apart or (b.mark is not None and b.mark.apart)


class _Reader:
    """The open elements of a page and the blocks read so far."""

    def __init__(self) -> None:
        self.out: list[Block] = []
        self.stack = [_Open("", 0, Container(0, 0, True, None))]
        self.open: Counter[str] = Counter()  # how many of a tag are open: what isn't needn't be looked for
        self.paths: dict[tuple[int, str], int] = {}
        self.marks: list[Mark] = []
        self.containers = 0
        self.parts: list[str] = []
        self.link_chars = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join(unescape("".join(self.parts)).split())
            self.parts.clear()
            if text:
                at = self.stack[-1]
                self.out.append(Block(at.path, at.container, at.prime, at.apart, text, min(self.link_chars, len(text)), at.mark))
        self.link_chars = 0

    def text(self, piece: str) -> None:
        at = self.stack[-1]
        if piece and not at.unshown:
            self.parts.append(piece)
            if at.link:
                self.link_chars += len(piece)

    def marked(self, tag: str, attributes: str) -> Mark | None:
        """The innermost mark within the new element; ``article`` and ``main`` are marked by nothing but pure marks."""
        up = self.stack[-1].mark
        mark = up if tag in ("html", "body") else _marked(attributes, up)
        if mark is up or (tag in ("article", "main") and not mark.pure):
            return up
        self.marks.append(mark)
        return mark

    def push(self, tag: str, attributes: str) -> None:
        up = self.stack[-1]
        if tag in INLINE:
            new = replace(up, tag=tag, mark=self.marked(tag, attributes), link=up.link or (tag == "a" and _HREF.search(attributes) is not None))
        else:
            named = _CLASS.search(attributes)
            path = self.paths.setdefault((up.path, f"{tag} {named[1].lower()}" if named else tag), len(self.paths) + 1)
            container = up.container
            if tag in CONTAINERS:
                self.containers += 1
                container = Container(self.containers, path, tag in ("html", "body"), up.container)
            apart = up.apart or tag in APART or (tag == "header" and not up.prime)
            new = _Open(tag, path, container, up.unshown or tag in UNSHOWN, apart, up.prime or tag in ("article", "main"), up.link, self.marked(tag, attributes))
        self.stack.append(new)
        self.open[tag] += 1

    def pop(self, depth: int) -> None:
        for x in self.stack[depth:]:
            self.open[x.tag] -= 1
        del self.stack[depth:]

    def close(self, names: tuple[str, ...], stop: frozenset) -> None:
        """Ends the innermost open element of ``names`` and all within it, unless one of ``stop`` stands between."""
        if not any(self.open[n] for n in names):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in names:
                self.flush()
                self.pop(i)
                return
            if self.stack[i].tag in stop:
                return

    def close_inline(self, tag: str) -> None:
        """An inline element may close over others, but not over a block."""
        if self.open[tag]:
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i].tag == tag:
                    self.pop(i)
                    return
                if self.stack[i].tag not in INLINE:
                    return


def blocks(html: str) -> list[Block]:
    """The blocks of a page, in page order."""
    page, at = _Reader(), 0
    while m := _TAG.search(html, at):
        page.text(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in INLINE:
                page.close_inline(tag)
            elif tag not in VOID:
                page.close((tag,), _NONE if tag in CONTAINERS or tag in APART or tag in UNSHOWN else CONTAINERS)
        elif tag in RAW:
            end = re.compile(f"</{tag}", re.I).search(html, at)
            at = len(html) if end is None else end.start()
        elif tag in VOID:
            if tag == "hr":
                page.flush()
            elif tag == "br":
                page.text(" ")
        elif tag in INLINE:
            page.push(tag, m[3])
        else:
            if tag in ENDS:
                page.close(ENDS[tag], _LISTS)
            elif tag in ENDS_P:
                page.close(("p",), _LISTS)
            page.flush()
            if not m[3].endswith("/") or tag in CONTAINERS:
                page.push(tag, m[3])
    page.text(html[at:])
    page.flush()
    _set_apart(page.out, page.marks)
    return page.out


def content(found: list[Block], *, threshold: float = 0.52, inner: float = 0.6, outside: float = 0.25) -> list[bool]:
    """Whether each block has the ratios of content; what is set apart isn't considered here.

    A path's ratio is per block, lowered by the block's own share of link text.  A
    container's is of all its blocks, smoothed with the mean of the containers of its
    path and at least ``inner`` of the ratio of the one around it with all that this
    holds.  Roots of characters and of marks are added up, halves of both ratios (each
    by the page's best) too; ``threshold`` is the least sum.  It is above a half: a
    block of link text isn't content in the best container either.  ``outside`` weighs
    blocks outside ``article`` and ``main`` where a page has these.
    """
    by_path: dict[int, list[int]] = defaultdict(lambda: [0, 0, 0])
    blocks_of: dict[Container, list[int]] = defaultdict(lambda: [0, 0, 0])
    prime = any(b.prime and not b.apart for b in found)
    weights = [1.0 if b.prime or not prime else outside for b in found]
    for b in found:
        marks = sum(map(b.text.count, PUNCTUATION))
        for totals in (by_path[b.path], blocks_of[b.container]):
            for i, v in enumerate((len(b.text), marks)):
                totals[i] += v
        by_path[b.path][2] += 1
        blocks_of[b.container][2] += b.link_chars
    # All that a container holds: containers within others have higher numbers.
    subtree = {c: list(t) for c, t in blocks_of.items()}
    for c in list(blocks_of):
        while c.up is not None and c.up not in subtree:
            c = c.up
            subtree[c] = [0, 0, 0]
    for c in sorted(subtree, key=lambda c: -c.number):
        if c.up is not None:
            subtree[c.up] = [x + y for x, y in zip(subtree[c.up], subtree[c], strict=True)]

    def ratio(chars: int, marks: int, links: int) -> float:
        return (chars**0.5 + marks**0.5) * (1 - links / chars)

    own = {p: (chars / n) ** 0.5 + (marks / n) ** 0.5 for p, (chars, marks, n) in by_path.items()}
    alone = {c: ratio(*t) for c, t in blocks_of.items()}
    like: dict[int, list[float]] = defaultdict(list)
    for c, r in alone.items():
        like[c.path].append(r)
    mean = {p: sum(r) / len(r) for p, r in like.items()}
    whole = {}
    for c, r in alone.items():
        around = inner * ratio(*subtree[c.up]) if c.up is not None and not c.up.top else 0.0
        whole[c] = max(0.75 * r + 0.25 * mean[c.path], around)
    scores = [(w * own[b.path] * (1 - b.link_chars / len(b.text)), w * whole[b.container]) for b, w in zip(found, weights, strict=True)]
    best = [max((s[i] for s, b in zip(scores, found, strict=True) if not b.apart), default=0) or 1 for i in (0, 1)]
    return [0.5 * o / best[0] + 0.5 * c / best[1] >= threshold for o, c in scores]


def main_text(html: str, **options: float) -> str:
    """The blocks of content that nothing sets apart, one on a line; empty if there is none."""
    found = blocks(html)
    return "\n".join(b.text for b, good in zip(found, content(found, **options), strict=True) if good and not b.apart)


def extract(pages: DataFrame, *, keys: tuple[str, ...] = ("page_id", "url"), html_column: str = "html") -> DataFrame:
    """The ``keys``, ``text`` and ``n_chars`` (code points) of every page; no shuffle.

    Null html counts as empty and has empty text; pages that repeat or have null keys
    each get a row; an empty table gives an empty result; other columns are not read.
    """
    kinds, html = dict(pages.dtypes), unused("html", keys)

    def function(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(h) for h in part.column(html).to_pylist()]
        return pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keys, "text", "n_chars"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from per_text(function, html)(batches)

    return pages.select(*keys, F.coalesce(html_column, F.lit("")).alias(html)).mapInArrow(run, "".join(f"`{k}` {kinds[k]}, " for k in keys) + "text string, n_chars long")
