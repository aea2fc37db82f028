"""Main text of HTML pages: parser events to lines, text-to-tag ratio, smoothing, clustering.

Standard-library parser events cut a page into lines (blocks).  A line knows its text, its
tags and the element that contains it.  Lines inside menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts and styles are marked as they are read.  A class, id
or role word, a form or a header marks an element only if it does not hold most of the page's
text or articles, as where a whole page is a form or a header is never closed; inside an
article, the id of a part is an anchor and marks it only by an unmistakable word.  The text-to-tag ratios of the other lines are smoothed with a Gaussian and split into two clusters
by a threshold, on every page.  Text of content lines adds up from a region to all regions
around it; the smallest region that covers the content is the article, together with the content
of sibling regions of the same tag and class; all its lines stay but lists of links without content.  Text in an ``article`` or ``main`` element weighs more, and
such an element is not cut further.

Null and empty pages give an empty text.  Whole pages are read, of any length, in time in
proportion to it; markup that is never closed ends with its container, and end tags without a
start are dropped.  Rows are read one by one, so nulls in other columns, ties and repeated rows
change nothing; a column of the output's name is replaced, an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewatch.llm.common import pieces

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
SKIPPED = frozenset(
    "head title script style noscript template nav footer aside button select textarea input iframe object svg canvas menu dialog audio video".split()
)
#: left out as well, unless they hold the page
SOFT = frozenset(["form", "header"])
REGIONS = frozenset("article main section div td body center".split())
#: class, id or role words of parts that are not the article
SURE = (
    r"ads?|adverts?|advertisement|advertising|sponsor(ed)?|navbar|nav(igation)?|menu|breadcrumbs?|sidebar|footer|masthead|comments?|commentlist|disqus|replies|cookies?|consent"
    r"|gdpr|popup|modal|overlay|newsletter|subscribe|widget|toolbar|pagination|pager|login|signup|complementary|contentinfo"
)
LIKELY = r"promo(tion)?|banner|header|notice|subscription|share|sharing|social|related|recommended|search|alert"
ASIDE = re.compile(rf"(?<![a-z])({SURE}|{LIKELY})(?![a-z])")
SURE_ASIDE = re.compile(rf"(?<![a-z])({SURE})(?![a-z])")
CLOSES = {"p": frozenset(["p"]), "li": frozenset(["li", "p"]), "tr": frozenset(["tr", "td", "th", "p"]), "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]), "option": frozenset(["option"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"])}
WALLS = frozenset("article main section div td th body ul ol dl table nav header footer aside form blockquote".split())
SIGMA = 1.0
#: characters a tag from which a line is text, however long it is
DENSE = 100.0
#: share of the content's weight that a region has to hold to be the article
COVER = 0.9
#: weight of content in an article or main element
HINT = 2.0
#: share of a page's text from which a form or header is the page
WHOLE = 0.8


class Lines(HTMLParser):
    """Blocks of one page in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, bool, int]] = []  # tag, skipped, region, in a link, aside
        self.at: dict[str, list[int]] = {}  # places of the open elements of a tag
        self.walls: list[int] = []  # places of the open containers
        self.parts: list[str] = []
        self.tags = self.links = 0
        self.regions = [("page", -1, "")]  # tag, parent, class
        self.named = [False]  # whether a region is an article or main element, or in one
        self.asides = [(-1, False)]  # parent of each marked element (0 is none), and whether its tag alone marks it
        self.lines: list[tuple[str, int, int, int, int]] = []  # text, tags, region, characters in links, aside

    def state(self) -> tuple[bool, int, bool, int]:
        return self.open[-1][1:] if self.open else (False, 0, False, 0)

    def flush(self) -> None:
        skipped, region, _, aside = self.state()
        if self.parts and not skipped and (line := " ".join("".join(self.parts).split())):
            self.lines.append((line, self.tags, region, self.links, aside))
        self.parts, self.tags, self.links = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.parts.append("\n")
            return
        if tag not in INLINE:
            self.flush()
            shut = CLOSES.get(tag) or (CLOSES["p"] if tag in WALLS or tag[0] == "h" and tag[1:].isdigit() else None)
            if shut:
                self.shut(shut)
        self.tags += 1
        skipped, region, link, aside = self.state()
        skipped = skipped or tag in SKIPPED or self.hidden(tag, attrs)
        if tag in VOID:
            return
        beside = not skipped and self.beside(tag, attrs, self.named[region])
        soft = not skipped and not beside and tag in SOFT
        if beside or soft:
            self.asides.append((aside, soft))
            aside = len(self.asides) - 1
        if not skipped and (tag in REGIONS or beside or soft):
            self.regions.append((tag, region, next((v for k, v in attrs if k == "class" and v), "")))
            self.named.append(self.named[region] or tag in ("article", "main"))
            region = len(self.regions) - 1
        self.at.setdefault(tag, []).append(len(self.open))
        if tag in WALLS:
            self.walls.append(len(self.open))
        self.open.append((tag, skipped, region, link or tag == "a", aside))

    def plain(self, tag: str, attrs: list) -> bool:
        """Not to be marked: inline, the page itself, an article that is no comment."""
        return tag in INLINE or tag in ("html", "body", "article", "main") and not any(k == "class" and v and "comment" in v.lower() for k, v in attrs)

    def hidden(self, tag: str, attrs: list) -> bool:
        return not self.plain(tag, attrs) and any(k == "hidden" or k == "aria-hidden" and v == "true" for k, v in attrs)

    def beside(self, tag: str, attrs: list, in_article: bool) -> bool:
        if self.plain(tag, attrs):
            return False
        hints = " ".join(v for k, v in attrs if k in ("class", "role") and v).lower()
        anchors = " ".join(v for k, v in attrs if k == "id" and v).lower()
        return ASIDE.search(hints) is not None or (SURE_ASIDE if in_article else ASIDE).search(anchors) is not None

    def cut(self, place: int) -> None:
        """End the open elements from a place on; each is ended once, so this is linear in all."""
        while len(self.open) > place:
            self.at[self.open.pop()[0]].pop()
        while self.walls and self.walls[-1] >= place:
            self.walls.pop()

    def shut(self, tags: frozenset) -> None:
        """End the nearest open element of ``tags``, if no container lies between."""
        place = max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)
        if place >= 0 and not (self.walls and self.walls[-1] > place):
            self.cut(place)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag not in INLINE:
            self.flush()
        self.tags += 1
        places = self.at.get(tag)
        if places and not (tag in INLINE and self.walls and self.walls[-1] > places[-1]):
            self.cut(places[-1])

    def handle_data(self, data: str) -> None:
        skipped, _, link, _ = self.state()
        if not skipped:
            self.parts.append(data)
            self.links += len(data.strip()) if link else 0


def content_lines(lines: list[tuple]) -> np.ndarray:
    """Cluster lines by their smoothed text-to-tag ratio; True for content.

    Ratios count up to DENSE, and clusters are of logarithms, so that a very long block does not put others below the cut.
    """
    ratio = np.array([min(len(line[0]) / max(line[1], 1), DENSE) for line in lines])
    reach = np.arange(-3, 4)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    smooth = np.log1p(np.convolve(np.pad(ratio, 3, mode="edge"), kernel / kernel.sum(), mode="valid"))
    low, high = smooth.min(), smooth.max()
    for _ in range(20):  # two clusters, split halfway between their means
        cut = (low + high) / 2
        above = smooth >= cut
        new = (smooth[~above].mean() if (~above).any() else low, smooth[above].mean())
        if new == (low, high):
            break
        low, high = new
    return smooth >= (low + high) / 2


def added_up(parents: list[int], values: np.ndarray) -> np.ndarray:
    """Per region, the values of itself and of all regions inside it; parents come first."""
    total = values.copy()
    for k in range(len(parents) - 1, 0, -1):
        total[parents[k]] += total[k]
    return total


def unmarked(page: Lines) -> list[tuple]:
    """The lines outside of marked elements; one that holds most of the text, or of the articles' text, is a wrapper and marks nothing.

    What a page has only in marked elements stays.
    """
    if len(page.asides) == 1:
        return page.lines
    named, parents = page.named, [parent for parent, _ in page.asides]
    size, article, count = (np.zeros(len(page.asides)) for _ in range(3))
    for text, _, region, _, aside in page.lines:
        size[aside] += len(text)
        count[aside] += 1
        article[aside] += len(text) * named[region]
    size, article, count = (added_up(parents, x) for x in (size, article, count))
    marked = np.zeros(len(page.asides), dtype=bool)
    for k, (parent, soft) in enumerate(page.asides[1:], 1):
        other = article[0] - article[k]  # is not outweighed by a long notice
        much = size[k] >= WHOLE * size[0] if soft else 2 * size[k] > size[0]
        wrapper = article[k] > other or much and (not other or 4 * other < size[0] and count[k] > 2)
        marked[k] = marked[parent] or not wrapper
    return [line for line in page.lines if not marked[line[4]]] or page.lines


def covering(regions: list[tuple[str, int, str]], mass: np.ndarray) -> int:
    """The smallest region that holds the content; an article stays whole, a main element unless one article has it all.

    A region is not entered if a sibling of the same tag and class has content too: both are parts of one text.
    """
    within: list[list[int]] = [[] for _ in regions]
    for k, (_, parent, _) in enumerate(regions[1:], 1):
        within[parent].append(k)
    enough = COVER * mass[0]
    articles = np.array([tag == "article" and mass[k] >= enough for k, (tag, _, _) in enumerate(regions)], dtype=float)
    holds = added_up([parent for _, parent, _ in regions], articles) > 0
    at, in_main = 0, False
    while regions[at][0] != "article":
        in_main = in_main or regions[at][0] == "main"
        inner = [k for k in within[at] if mass[k] >= enough and (holds[k] or not in_main)]
        if not inner:
            break
        tag, _, name = regions[inner[0]]
        if tag not in ("article", "main") and any(k != inner[0] and mass[k] and (regions[k][0], regions[k][2]) == (tag, name) for k in within[at]):
            break
        at = inner[0]
    return at


def main_text(html: str) -> str:
    """The article of one page, one block a line."""
    page = Lines()
    page.feed(html)
    page.close()
    page.flush()
    if not page.lines:
        return ""
    lines = unmarked(page)
    parents = [parent for _, parent, _ in page.regions]
    named = page.named
    mass, size, links = (np.zeros(len(parents)) for _ in range(3))
    for (text, _, region, linked, _), good in zip(lines, content_lines(lines)):
        mass[region] += len(text) * good * (HINT if named[region] else 1.0)
        size[region] += len(text)
        links[region] += linked
    mass, size, links = (added_up(parents, x) for x in (mass, size, links))
    best = covering(page.regions, mass)
    kept = np.zeros(len(parents), dtype=bool)
    kept[best] = True
    for k, parent in enumerate(parents):
        if k and kept[parent]:
            kept[k] = named[k] or mass[k] > 0 or 2 * links[k] <= size[k]
    return "\n".join(line[0] for line in lines if kept[line[2]])


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """The rows without their HTML, with a further column: the main text."""
    rest = [c for c in pages.columns if c not in (html, text)]
    schema = ", ".join([*[f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in rest], f"`{text}` string"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, html):
            texts = [main_text(x) if x else "" for x in piece.column(piece.schema.get_field_index(html)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[piece.column(piece.schema.get_field_index(c)) for c in rest], pa.array(texts, pa.string())], [*rest, text])

    return pages.select(*rest, html).mapInArrow(task, schema)
