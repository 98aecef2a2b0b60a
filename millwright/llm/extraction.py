"""Main text of a web page as a maximum-scoring subsequence of its words and tags.

A page is read as a sequence of words and tags. Words score above zero and tags below, each by
what they are and where they stand; one linear scan finds the contiguous region of the highest
sum, and the blocks that reach into it are the article. Words inside elements that are never
part of an article (menus, side bars, forms, adverts, comments and so on) score a little below
zero, so that a region may run past them, and are left out of its text. A form, and an element
that only its class, id or role names so, is spared and scored like any other where it holds most
of the page's words and no first heading and paragraph stand elsewhere, where it holds these
itself, or where its id is only the anchor of its heading.

Weights are log odds counted on labelled pages: those that mark their article with an
``article`` or ``main`` element. The sample is bounded (``SAMPLE`` pages of at most
``SAMPLE_CHARS`` characters, by a hash of their id); kinds that it does not hold keep the
weight of their group. Extraction itself reads whole pages, and never looks for the label.

Null or empty pages, and pages without words in a region, give an empty text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import map_rows

SAMPLE = 200
SAMPLE_CHARS = 50_000

# Element names by the part they play in HTML.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style noscript template textarea title iframe object svg math select".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp"
    " small span strike strong sub sup time tt u var wbr img".split()
)
OUTSIDE = set("nav footer aside form head button dialog menu".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# Words in class, id and role that mark parts beside the article.
BESIDE = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment"
    " comments complementary consent contentinfo cookie cookies copyright dialog disqus footer"
    " gdpr login masthead menu modal nav navbar navigation newsletter notice notices pager"
    " pagination popup promo promoted promotion recommended related replies respond search share"
    " sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget".split()
)
# Words that stay beside the article where they are also the heading of their part.
ANSWERS = set("comment comments disqus replies respond".split())
LAYOUT = set("has with no without is".split())  # "has-sidebar" is about the page, not a part

TAG = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)>?")
ATTRIBUTE = re.compile(r"(?i)\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
HIDDEN = re.compile(r"(?i)(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*.?true")


def beside(name: str, attributes: str) -> str:
    """Whether an element is "never" part of an article, or only "named" so, or else empty."""
    if name in OUTSIDE and name != "form":
        return "never"
    if not attributes or name in ("html", "body", "article", "main"):
        return "named" if name == "form" else ""
    if HIDDEN.search(attributes):
        return "never"
    if name == "form":
        return "named"
    for m in ATTRIBUTE.finditer(attributes):
        for token in (m[2] or m[3] or m[4] or "").lower().split():
            words = re.split(r"[^a-z]+", token)
            if words[0] not in LAYOUT and not BESIDE.isdisjoint(words):
                return "named"
    return ""


def slug(value: str) -> str:
    return "-".join(re.findall(r"[^\W_]+", value.lower()))


def anchor(attributes: str) -> str:
    """The id of an element whose class and role do not name it beside the article."""
    found = ""
    for m in ATTRIBUTE.finditer(attributes):
        if m[1].lower() == "id":
            found = slug(m[2] or m[3] or m[4] or "")
        elif beside("div", m[0]):
            return ""
    return "" if not ANSWERS.isdisjoint(found.split("-")) else found


@dataclass
class Block:
    """Text between two block borders, and whether it stands in an article mark."""

    first: int  # number of its first token
    pieces: list[str] = field(default_factory=list)
    out: bool = False
    marked: bool = False
    last: int = 0


@dataclass
class Page:
    kinds: list[str] = field(default_factory=list)  # kind of each token
    sizes: list[int] = field(default_factory=list)  # words that the token stands for
    marks: list[bool] = field(default_factory=list)  # inside an article mark
    blocks: list[Block] = field(default_factory=list)


class Reader:
    """Reads a page once, left to right; markup may be broken or cut off."""

    def __init__(self, source: str, spared: frozenset[int] = frozenset()):
        self.source, self.page = source, Page()
        self.spared = spared  # numbers of elements that are not left out for their names
        self.started = 0
        self.never = 0  # open elements that are never part of an article
        self.words = Counter()  # so far, outside those: all, and in links
        self.heads: list[str] = []
        self.named: dict[int, tuple] = {}  # by depth: open elements that are named beside
        self.held: list[tuple] = []  # what closed ones hold
        self.stack: list[tuple[str, tuple[bool, bool]]] = []  # open elements, and whether beside or never inside
        self.open = Counter()
        self.beside = 0
        self.block: Block | None = None

    def read(self) -> Page:
        s, at, n = self.source, 0, len(self.source)
        while at < n:
            cut = s.find("<", at)
            if cut < 0:
                cut = n
            if cut > at:
                self.text(s[at:cut])
            if cut == n:
                break
            if s.startswith("<!--", cut):
                end = s.find("-->", cut + 4)
                at = n if end < 0 else end + 3
                continue
            if s.startswith(("<!", "<?"), cut):
                end = s.find(">", cut)
                at = n if end < 0 else end + 1
                continue
            m = TAG.match(s, cut)
            if not m:
                self.text("<")
                at = cut + 1
                continue
            at = m.end()
            name = m[2].lower()
            if m[1]:
                self.end(name)
            elif name in RAW and not m[3].endswith("/"):
                close = re.compile(rf"(?i)</{name}\b[^>]*>?").search(s, at)
                at = close.end() if close else n
                self.token("t:raw", 0)
            else:
                self.start(name, m[3])
        while self.stack:
            self.pop()
        return self.page

    def to_spare(self) -> frozenset[int]:
        """Numbers of the named elements that hold the article or a part of it."""
        every = self.words
        return frozenset(
            number for number, id_, words, links, h1, p, head in self.held
            if (2 * words > every["all"] and (h1 == every["h1"] or p == every["p"])) or (h1 and p)
            or (id_ and id_ == slug(head) and 2 * links < words)
        )

    def token(self, kind: str, size: int) -> None:
        self.page.kinds.append(kind)
        self.page.sizes.append(size)
        self.page.marks.append(bool(self.open["article"] or self.open["main"]))

    def border(self, name: str) -> None:
        if name == "br":
            if self.block:
                self.block.pieces.append(" ")
        elif name not in INLINE:
            self.block = None

    def start(self, name: str, attributes: str) -> None:
        self.border(name)
        how = beside(name, attributes)
        if name == "header" and not self.in_article():
            how = "never"
        self.started += 1
        number = self.started
        out = bool(how) and not (how == "named" and number in self.spared)
        self.token("t:beside" if out or self.beside else "t:" + name, 0)
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and self.open[name]:
            self.close_item(name)
        elif name not in INLINE and name not in VOID and self.open["p"]:
            self.close_item("p")
        if name == "body" and self.open["head"]:
            self.end("head")
        if name in VOID or attributes.endswith("/"):
            return
        if how == "named":
            self.named[len(self.stack)] = (
                number, anchor(attributes), self.words["all"], self.words["links"],
                self.words["h1"], self.words["p"], len(self.heads),
            )
        self.push(name, out, how == "never")
        if name in HEADINGS:
            self.heads.append("")
        if name in ("h1", "p") and not self.never:
            self.words[name] += 1

    def in_article(self) -> bool:
        return bool(self.open["article"] or self.open["main"])

    def push(self, name: str, out: bool, never: bool) -> None:
        self.stack.append((name, (out, never)))
        self.open[name] += 1
        self.beside += out
        self.never += never

    def pop(self) -> str:
        name, (out, never) = self.stack.pop()
        self.open[name] -= 1
        self.beside -= out
        self.never -= never
        if since := self.named.pop(len(self.stack), None):
            number, id_, *counts, head = since
            now = [self.words[k] for k in ("all", "links", "h1", "p")]
            heading = self.heads[head] if head < len(self.heads) else ""
            self.held.append((number, id_, *(b - a for a, b in zip(counts, now)), heading))
        return name

    def close_item(self, name: str) -> None:
        """A new item ends the last one of its kind, unless a container lies between."""
        holders = ("ul", "ol", "dl", "table", "div", "article", "section", "blockquote", "main")
        for open_name, _ in reversed(self.stack[-32:]):
            if open_name == name:
                while self.pop() != name:
                    pass
                return
            if open_name in holders:
                return

    def end(self, name: str) -> None:
        self.border(name)
        self.token("t:beside" if self.beside else "t:" + name, 0)
        if self.open[name]:
            while self.pop() != name:
                pass

    def text(self, raw: str) -> None:
        value = entities.unescape(raw) if "&" in raw else raw
        words = len(value.split())
        if not words:
            if self.block:
                self.block.pieces.append(" ")
            return
        if not self.never:
            self.words["all"] += words
            self.words["links"] += words if self.open["a"] else 0
        if self.heads and any(self.open[h] for h in HEADINGS):
            self.heads[-1] += value
        self.token(self.word_kind(), words)
        here = len(self.page.kinds) - 1
        out = self.beside > 0
        if self.block is None or self.block.out != out:
            marked = self.in_article()
            self.block = Block(here, out=out, marked=marked)
            self.page.blocks.append(self.block)
        self.block.pieces.append(value)
        self.block.last = here

    def word_kind(self) -> str:
        if self.beside:
            return "w:beside"
        if self.open["a"]:
            return "w:a"
        for name, _ in reversed(self.stack[-16:]):
            if name not in INLINE:
                return "w:h" if name in HEADINGS else "w:" + name
        return "w:body"


def read_page(source: str) -> Page:
    """The page, read again where elements are to be spared."""
    reader = Reader(source)
    page = reader.read()
    spared = reader.to_spare()
    return Reader(source, spared).read() if spared else page


# Weights before any page is seen, by group.
PRIOR = {"w:beside": -0.1, "t:beside": -0.1, "w:a": 0.05, "w": 0.3, "t": -0.3}
MILD = set("p br b i em strong span a h1 h2 h3 h4 h5 h6 blockquote ul ol li pre code img".split())
LEAST_WORD, LEAST_TAG, MOST = 0.02, -0.02, 2.0


@dataclass
class Weights:
    known: dict[str, float] = field(default_factory=dict)

    def of(self, kind: str) -> float:
        if kind in self.known:
            return self.known[kind]
        if kind in PRIOR:
            return PRIOR[kind]
        if kind.startswith("t:") and kind[2:] in MILD:
            return -0.05
        return PRIOR[kind[0]]


def train(pages: list[str]) -> Weights:
    """Log odds of each kind of token inside an article mark against outside."""
    inside, outside = Counter(), Counter()
    for source in pages:
        page = read_page(source)
        for kind, size, mark in zip(page.kinds, page.sizes, page.marks):
            (inside if mark else outside)[kind] += max(size, 1)
    weights = Weights()
    for kind in inside.keys() | outside.keys():
        if kind in PRIOR or inside[kind] + outside[kind] < 20:
            continue
        odds = math.log((inside[kind] + 1) / (outside[kind] + 1))
        if kind.startswith("w:"):
            weights.known[kind] = min(MOST, max(LEAST_WORD, odds))
        else:
            weights.known[kind] = max(-MOST, min(LEAST_TAG, odds))
    return weights


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last token of the region with the highest sum; empty where none is above 0."""
    best, begin, end = 0.0, 0, -1
    total, start = 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, begin, end = total, start, i
    return begin, end


def main_text(source: str | None, weights: Weights) -> str:
    if not source:
        return ""
    page = read_page(source)
    of = {kind: weights.of(kind) for kind in set(page.kinds)}
    begin, end = best_region([of[k] * (n or 1) for k, n in zip(page.kinds, page.sizes)])
    blocks = (
        " ".join("".join(b.pieces).split())
        for b in page.blocks if not b.out and b.last >= begin and b.first <= end
    )
    return "\n".join(filter(None, blocks))


def labelled_sample(pages: DataFrame, sample: int = SAMPLE) -> list[str]:
    """Different pages that mark their article, in the order of a hash; a bounded number.

    Hashes alone are put in order first; then only the pages of the least ones travel.
    """
    marked = pages.where(F.col("html").rlike("(?i)<(article|main)[ >]")).where(
        F.char_length("html") <= SAMPLE_CHARS
    ).select(F.xxhash64("html").alias("h"), "html")
    least = [r.h for r in marked.select("h").distinct().orderBy("h").limit(sample).collect()]
    if not least:
        return []
    rows = marked.where(F.col("h") <= least[-1]).groupBy("h").agg(F.min("html").alias("html"))
    return [r.html for r in sorted(rows.collect(), key=lambda r: r.h)]


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """One row per page: page_id, url, its main text and the text's number of characters."""

    def make():
        def work(ids, urls, sources):
            texts = [main_text(s, weights) for s in sources]
            return {"page_id": ids, "url": urls, "text": texts, "n_chars": [*map(len, texts)]}

        return work

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_rows(
        pages, ["page_id", "url", "html"],
        f"page_id {kind}, url string, text string, n_chars bigint", make,
    )
