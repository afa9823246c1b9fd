"""Main text of web pages as a maximum-scoring subsequence of words and tags.

A page is read as a sequence of words and tags. Words score positive and tags negative;
one linear scan finds the contiguous region of highest sum. The weights come from labelled
pages: those of the table that mark their article themselves (one ``article`` element),
all of which are counted, and a few fixed pages of other layouts. A token's feature is its
tag, or the block and link a word stands in, together with the kind of part around it
(menu, header, footer, side part, advert, notice, form, comments, or none) and whether it
stands in an ``article`` or ``main`` element, so the same tag may be cheap in prose and dear
in a menu. Blocks of such parts inside the region are left out.

Only counts of features, a few hundred rows, come to the driver; texts never do.
"""

from __future__ import annotations

import html as markup
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the markup language: elements within a line, without content, whose
# content is not prose, whose content has no tags, and the open ones that others end.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr img picture source br".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    "script style template noscript iframe object svg math canvas audio video select button textarea datalist"
    " head title option map".split()
)
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
KNOWN = frozenset(
    "p div section article main h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tr td th pre blockquote figure"
    " figcaption nav header footer aside form fieldset details summary body html hr address center".split()
) | INLINE

# Parts of a page that are not its article: by element, and by words of class, id or role.
PART_OF_TAG = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "side", "form": "form", "fieldset": "form", "dialog": "notice"}
PART_WORDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar tabs skip sitemap",
    "header": "masthead banner topbar",
    "footer": "footer colophon copyright contentinfo",
    "side": "sidebar aside complementary related recommended recommendations widget widgets share sharing social",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promoted promotion",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog paywall disclaimer",
    "form": "form search newsletter subscribe subscription signup login register",
    "comments": "comment comments commentlist replies reply respond disqus discussion",
}
PART_OF_WORD = {word: part for part, words in PART_WORDS.items() for word in words.split()}
HIDDEN = "hidden"

TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|(?P<cut>\Z)))"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)>"
    r"|<[!?/][^>]*>",
    re.S,
)
CUT_TAG = re.compile(r"<[a-zA-Z/!?]")
ATTRIBUTE = re.compile(
    r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?![\w-])(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I
)

#: Bounds of the weights and of the log odds they are made from.
WORD_LEAST, WORD_MOST, TAG_LEAST, TAG_MOST = 0.05, 3.0, 0.1, 4.0

#: Fixed labelled pages of other layouts; the element with ``data-main`` is the article.
LABELLED_PAGES = [
    "<body><header><a href=#>Home</a><p>The daily paper of the town</p></header><div class=menu><a href=#>News</a> <a href=#>Sport</a></div>"
    "<div data-main><h1>Bridge closed</h1><p>The old bridge over the river is closed from today until the end of the month.</p>"
    "<ul><li>Buses take the northern road.</li><li>Trains are not affected by the works.</li></ul>"
    "<p>Walkers can use the <a href=#>ferry</a>, which runs every hour.</p></div>"
    "<div class=sidebar><h3>Most read</h3><ul><li><a href=#>Rain</a></li><li><a href=#>Market</a></li></ul></div>"
    "<section id=comments><p>I walk there every day.</p></section><footer><p>All rights reserved</p></footer></body>",
    "<body><div class=cookie><p>We use cookies.</p><button>Accept</button></div><nav><ul><li><a href=#>Start</a></li></ul></nav>"
    "<main data-main><h2>How to bake bread</h2><div>Mix flour, water and salt and let the dough rest for one night.</div>"
    "<div>Bake it in a hot oven until the crust is brown.</div><table><tr><td>Flour</td><td>500 g of wheat</td></tr></table>"
    "<blockquote>Good bread needs time and little else.</blockquote><ol><li>Knead the dough again.</li></ol></main>"
    "<form><label>Your mail</label><input><button>Send</button></form><div class=ad>Buy new ovens here</div></body>",
    "<body><table><tr><td><a href=#>Home</a></td><td><a href=#>Links</a></td></tr></table><div data-main><h3>Field notes</h3>"
    "<p>We saw two herons near the weir, and a kingfisher later in the day.</p><pre>count 2 1 0</pre>"
    "<p>The water was high after the rain of the week.</p></div><div><a href=#>Next</a> <a href=#>Previous</a></div>"
    "<aside><p>Join the club of watchers</p></aside></body>",
]


@dataclass
class Block:
    """Text between two block borders, and what lies around it."""

    pieces: list[str] = field(default_factory=list)
    feature: str = ""
    part: str = ""
    marked: bool = False
    inline: list[str] = field(default_factory=list)
    before: list[tuple[str, bool]] = field(default_factory=list)
    text: str = ""
    words: int = 0


@lru_cache(maxsize=4096)
def _part_of_attributes(attributes: str) -> tuple[str, bool]:
    """The part that class, id, role or visibility name, and whether the article is marked."""
    part = ""
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), next((v for v in values if v), "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            part = HIDDEN
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                part = HIDDEN
        elif not part:
            part = next((PART_OF_WORD[w] for w in re.split(r"[^a-z]+", value) if w in PART_OF_WORD), "")
    return part, "data-main" in attributes


class Open(NamedTuple):
    """An element that is not closed yet, with what it inherits."""

    name: str
    part: str
    marked: bool
    block: str
    link: bool
    inside: str


class Page:
    """Blocks of one page in order; ``parts=False`` ignores parts named by attributes."""

    def __init__(self, source: str, parts: bool = True) -> None:
        self.blocks: list[Block] = []
        self.parts = parts
        self.open = [Open("", "", False, "body", False, "")]
        self.names: Counter = Counter()
        self.tags: list[tuple[str, bool]] = []
        self.current: Block | None = None
        self._read(source)
        self._flush()

    def _read(self, source: str) -> None:
        # No tag ends after the last ">", so each "<" before it finds an end soon.
        at, tags_end = 0, source.rfind(">") + 1
        while True:
            token = TOKEN.search(source, at, tags_end)
            rest = source[at : token.start() if token else len(source)]
            if token is None and (unfinished := CUT_TAG.search(rest)):
                rest = rest[: unfinished.start()]
            if rest:
                self._text(rest)
            if token is None or token["cut"] is not None:
                return
            at = token.end()
            if not token["name"]:
                continue
            name = token["name"].lower()
            if token["end"]:
                self._end(name)
                continue
            self._start(name, token["attributes"])
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(source, at)
                at = close.start() if close else len(source)

    def _text(self, raw: str) -> None:
        top = self.open[-1]
        if top.part == HIDDEN:
            return
        if self.current is None:
            if not raw.strip():
                return
            block = top.block if top.block in KNOWN else "other"
            self.current = Block(feature=f"w {block}{'/a' if top.link else ''} {top.part} {top.inside}", part=top.part, marked=top.marked)
        self.current.pieces.append(markup.unescape(raw))

    def _flush(self) -> None:
        block, self.current = self.current, None
        words = "".join(block.pieces).split() if block else []
        if words:
            block.text, block.words, block.before = " ".join(words), len(words), self.tags
            self.tags = []
            self.blocks.append(block)

    def _tag(self, name: str, label: str, part: str, marked: bool, inside: str) -> None:
        feature = f"t {label if name in KNOWN else 'other'} {part} {inside}"
        if name in INLINE and self.current is not None:
            self.current.inline.append(feature)
            if name == "br":
                self.current.pieces.append(" ")
            return
        if name not in INLINE:
            self._flush()
        self.tags.append((feature, marked))

    def _pop_to(self, index: int) -> None:
        for left in self.open[index:]:
            self.names[left.name] -= 1
        del self.open[index:]

    def _close(self, names: set[str]) -> None:
        """Close the innermost blocks as long as they are among ``names``."""
        while any(self.names[n] for n in names):
            index = len(self.open) - 1
            while self.open[index].name in INLINE:
                index -= 1
            if self.open[index].name not in names:
                return
            self._pop_to(index)

    def _part_of(self, name: str, named: str) -> str:
        outer = self.open[-1].part
        if name in SILENT or HIDDEN in (named, outer):
            return HIDDEN
        if name == "main":
            return ""
        if name == "article":
            # A menu, header, form, advert or notice that was never closed ends here.
            return named or (outer if outer in ("side", "footer", "comments") else "")
        if outer == "header" and name in HEADINGS and (self.names["article"] or self.names["main"]):
            return ""
        if outer or name in ("body", "html"):
            return outer
        if name in INLINE:
            return named if named in ("advert", "comments", "notice", "menu") else ""
        return PART_OF_TAG.get(name) or named

    def _start(self, name: str, attributes: str) -> None:
        if name not in INLINE:
            self._close({"p"})
            self._close(CLOSES.get(name, set()))
        named, main = _part_of_attributes(attributes) if attributes.strip() else ("", False)
        if not self.parts and named != HIDDEN:
            named = ""
        top, part = self.open[-1], self._part_of(name, named)
        marked = top.marked or main or name == "article"
        inside = name if name in ("article", "main") else top.inside
        self._tag(name, name, part, marked, inside)
        if name not in VOID:
            self.names[name] += 1
            self.open.append(Open(name, part, marked, top.block if name in INLINE else name, top.link or name == "a", inside))

    def _end(self, name: str) -> None:
        if name in VOID:
            return self._start("br", "") if name == "br" else None
        if name not in INLINE:
            self._flush()
        if not self.names[name]:
            return
        for index in range(len(self.open) - 1, 0, -1):
            closed = self.open[index]
            if closed.name == name:
                self._tag(name, f"/{name}", closed.part, closed.marked, closed.inside)
                return self._pop_to(index)
            if name in INLINE and closed.name not in INLINE:
                return


def feature_counts(source: str) -> Counter:
    """``(feature, inside the article)`` counts of a labelled page; each tag and word counts one.

    What stands in an ``article`` or ``main`` element counts with and without saying so.
    """
    page, counts = Page(source), Counter()

    def add(feature: str, inside: bool, n: int = 1) -> None:
        counts[feature, inside] += n
        if not feature.endswith(" "):
            counts[feature[: feature.rindex(" ") + 1], inside] += n

    for block in page.blocks:
        inside = block.marked and not block.part
        for feature, marked in block.before:
            add(feature, marked)
        for feature in block.inline:
            add(feature, inside)
        add(block.feature, inside, block.words)
    for feature, marked in page.tags:
        add(feature, marked)
    return counts


class Weights(dict):
    """Weights of features; those never seen take that of the feature elsewhere, or a default."""

    def __missing__(self, feature: str) -> float:
        kind, _, part, inside = feature.split(" ")
        word = kind == "w"
        if inside:
            elsewhere = self[feature[: feature.rindex(" ") + 1]]
            weight = elsewhere if word and part else max(elsewhere, 2.0 if word else -TAG_LEAST)
        elif part:
            weight = WORD_LEAST if word else -2.0
        else:
            weight = 0.5 if word else -1.0
        return self.setdefault(feature, weight)


def weights_from(counts: dict[tuple[str, bool], int]) -> Weights:
    """Weights of all features: log odds of standing in an article, words above and tags below zero."""
    weights = Weights()
    for feature in {f for f, _ in counts}:
        odds = math.log((counts.get((feature, True), 0) + 1) / (counts.get((feature, False), 0) + 1))
        if feature.startswith("w "):
            weights[feature] = min(max(odds, WORD_LEAST), WORD_MOST)
        else:
            weights[feature] = -min(max(1 - odds, TAG_LEAST), TAG_MOST)
    return weights


def best_region(blocks: list[Block], weights: Weights) -> tuple[int, int]:
    """First and past-last block of the contiguous region with the highest sum.

    One scan: a region goes on while its sum with the tags up to the next block is
    positive. Equal sums give the earlier region.
    """
    best, found, total, start = -math.inf, (0, 0), -math.inf, 0
    for index, block in enumerate(blocks):
        own = block.words * weights[block.feature] + sum(weights[f] for f in block.inline)
        carried = total + sum(weights[f] for f, _ in block.before)
        if carried > 0:
            total = carried + own
        else:
            total, start = own, index
        if total > best:
            best, found = total, (start, index + 1)
    return found


def main_text(source: str | None, weights: Weights) -> str:
    """The blocks of the best region outside other parts, joined by line feeds."""
    for parts in (True, False):
        page = Page(source or "", parts)
        if any(not b.part for b in page.blocks):
            break
    first, last = best_region(page.blocks, weights)
    return "\n".join(b.text for b in page.blocks[first:last] if not b.part)


def learned_weights(pages: DataFrame, html: str = "html") -> Weights:
    """Weights from every page with exactly one ``article`` element and the fixed pages."""
    marks = F.regexp_count(F.col(html), F.lit(r"(?i)<article[\s>]"))
    labelled = pages.filter(marks == 1).select(F.col(html).alias("_html"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Counter()
        for batch in batches:
            for value in batch.column(0):
                total.update(feature_counts(value.as_py()))
        rows = list(total.items())
        yield pa.RecordBatch.from_arrays(
            [pa.array([f for (f, _), _ in rows], pa.string()), pa.array([m for (_, m), _ in rows], pa.bool_()), pa.array([n for _, n in rows], pa.int64())],
            ["feature", "inside", "n"],
        )

    sums = labelled.mapInArrow(count, "feature string, inside boolean, n bigint").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    counts = Counter({(r["feature"], r["inside"]): r["n"] for r in sums.collect()})
    for page in LABELLED_PAGES:
        counts.update(feature_counts(page))
    return weights_from(counts)


def extract_main_text(
    pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html", weights: Weights | None = None
) -> DataFrame:
    """One row per page: ``page_id``, ``url``, ``text`` and ``n_chars`` (code points).

    Without ``weights`` they are learned from the pages themselves. Character references
    are decoded, white space of any kind inside a block becomes one blank, and blocks are
    joined by one line feed. A null or empty page, and one without words, gives an empty
    text; null keys and urls stay null; repeated rows give repeated results; an empty table
    gives none. Pages are read whole, whatever their length. Other columns are not read.
    """
    learned = learned_weights(pages, html) if weights is None else weights
    source = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("_html"))
    kinds = dict(source.dtypes)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py(), learned) for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return source.mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
