"""Main text of HTML pages by text-to-tag ratios.

The standard library's parser streams its events into lines, one for each
stretch of text between block boundaries. A line's text-to-tag ratio is
smoothed with a Gaussian over its neighbours; lines above a threshold (the
standard deviation of the smoothed ratios) form the content clusters. The
region to extract is the container that holds the clusters: from the root,
down into the child that has nearly all of their text, to an article or main
element at the latest. All lines of that region are kept, short ones too,
except menus and other furniture, which elements and their class, id or role
name. Outside it, headings and the cluster lines that are not links alone are
kept as well, clustered once more without the region, whose long lines would
raise the threshold; outside an article or main, only those of other such
elements.

A form, or an element of which only a part of a name says furniture (such as
``social-science``), is dropped unless it has nearly all of the text of a page
without article and main; an element that holds the page's only article or main is
never dropped.
A header goes with its headings, also inside an article: what a page calls
its header is no part of the main text here. The parser's work is linear in
the page, however deep and unclosed its elements are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import pieces

SIGMA = 1.0
#: Share of the clusters' text that leads down into a container.
HOLDS = 0.9
# Elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br canvas caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split())
CONTAINER = frozenset("article body center div html main section table tbody td tr".split())
LEAF_REGION = frozenset(("article", "main"))
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
DROPPED = frozenset(
    "aside audio button canvas datalist dialog footer head header iframe input menu nav noscript object script "
    "search select style svg template textarea title video".split())
KEPT = frozenset(("html", "body", "main"))
# Words of class, id and role that name furniture.
FURNITURE = frozenset(
    "ad adbox ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disqus dropdown footer form gdpr header masthead menu modal nav "
    "navbar navigation newsletter notice notices notification popup promo promoted promotion recommended related replies "
    "reply respond search share sharing sidebar skip social sponsor sponsored subscribe teaser toolbar widget".split())
CLASS_WORD = re.compile(r"[a-z0-9]+")


class _Lines(HTMLParser):
    """Parser events -> lines: [text, tags, container, heading, links alone, suspect]."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, int, bool, bool, int]] = []  # element, dropped, container, heading, link, suspect
        self.places: dict[str, list[int]] = {}  # of the open elements of a name
        self.blocks: list[int] = []  # places of the open block elements
        self.parents, self.kinds = [-1], ["root"]
        #: Elements that may be furniture: the one around it, whether a part of
        #: a name or a form says so, and whether an article or main is inside.
        self.suspects: list[list] = [[-1, False, False]]
        self.free = False  # an article or main outside all of them
        self.regions = False  # an article or main at all
        self.lines: list[list] = []
        self.parts: list[str] = []
        self.tags = 0
        self.linked = True  # all of the parts so far

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """A marked section of no known kind is skipped up to its end."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.rawdata.find(">", i) + 1 or len(self.rawdata)

    def here(self) -> tuple[bool, int, bool, bool, int]:
        return self.open[-1][1:] if self.open else (False, 0, False, False, 0)

    def end_line(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                _, container, heading, _, suspect = self.here()
                self.lines.append([text, self.tags, container, heading, self.linked, suspect])
                self.tags = 0
            self.parts, self.linked = [], True

    def close_from(self, place: int) -> None:
        """Close the open elements from this place on."""
        for name, *_ in self.open[place:]:
            self.places[name].pop()
        del self.open[place:]
        while self.blocks and self.blocks[-1] >= place:
            self.blocks.pop()

    def close_implied(self, tag: str) -> None:
        """A block ends an open paragraph; an item or cell ends its sibling."""
        ends = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",)}.get(tag, ())
        while self.blocks:
            name = self.open[self.blocks[-1]][0]
            if name == "p" and tag != "br" or name in ends:
                self.close_from(self.blocks[-1])
            else:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
            self.close_implied(tag)
        if tag in VOID:
            return
        dropped, container, heading, link, suspect = self.here()
        dropped = dropped or self.hidden(tag, attrs)
        if not dropped:
            doubt = self.furniture(tag, attrs)
            if doubt is not None:
                self.suspects.append([suspect, doubt, False])
                suspect = len(self.suspects) - 1
            elif tag in LEAF_REGION:
                self.regions = True
                self.free = self.free or not suspect
                around = suspect
                while around and not self.suspects[around][2]:
                    self.suspects[around][2] = True
                    around = self.suspects[around][0]
        if tag in CONTAINER and not dropped:
            self.parents.append(container)
            self.kinds.append(tag)
            container = len(self.kinds) - 1
        self.places.setdefault(tag, []).append(len(self.open))
        if tag in BLOCK:
            self.blocks.append(len(self.open))
        self.open.append((tag, dropped, container, heading or tag in HEADING, link or tag == "a", suspect))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.end_line()
        if self.places.get(tag):
            self.close_from(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        dropped, _, _, link, _ = self.here()
        if not dropped:
            self.parts.append(data)
            if not link and self.linked and not data.isspace():
                self.linked = False

    @staticmethod
    def hidden(tag: str, attrs: list) -> bool:
        return tag in DROPPED or any(
            name == "hidden" or name == "aria-hidden" and value == "true"
            or name == "style" and value and "display:none" in value.replace(" ", "").lower() for name, value in attrs if tag not in KEPT)

    @staticmethod
    def furniture(tag: str, attrs: list) -> bool | None:
        """None: not furniture. Else whether that is in doubt: a form, or only a
        part of a name says so (of an article, such a part says nothing)."""
        if tag in KEPT:
            return None
        names = [token for name, value in attrs if value and name in ("class", "id", "role") for token in value.lower().split()
                 if not token.startswith(("has-", "no-", "with-"))]
        if not FURNITURE.isdisjoint(names):
            return False
        parts = tag != "article" and any(not FURNITURE.isdisjoint(CLASS_WORD.findall(token)) for token in names)
        return True if parts or tag == "form" else None

    def kept_lines(self) -> list[list]:
        """The lines outside furniture."""
        mass = [0] * len(self.suspects)
        for line in self.lines:
            mass[line[5]] += len(line[0])
        total = sum(mass)
        for k in range(len(mass) - 1, 0, -1):  # inner elements have larger numbers
            mass[self.suspects[k][0]] += mass[k]
        gone = [False] * len(mass)
        for k in range(1, len(mass)):
            around, doubt, holds = self.suspects[k]
            gone[k] = gone[around] or not (holds and not self.free or doubt and not self.regions and mass[k] >= HOLDS * total)
        return [line for line in self.lines if not gone[line[5]]]


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing of the ratios over neighbouring lines."""
    reach = int(np.ceil(3 * sigma))
    weights = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma ** 2))
    return np.convolve(ratios, weights / weights.sum())[reach:len(ratios) + reach]


def clustered(ratios: np.ndarray) -> np.ndarray:
    """Which lines, by their ratios, belong to a content cluster."""
    ratio = smoothed(ratios)
    return ratio >= min(ratio.std(), ratio.max())


def main_text(html: str) -> str:
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    lines = parser.kept_lines()
    if not lines:
        return ""
    length = np.array([len(x[0]) for x in lines], float)
    plain = length / np.maximum(1, [x[1] for x in lines])
    content = clustered(plain)
    # text of the clusters under each container; children have larger numbers
    mass = np.zeros(len(parser.kinds))
    np.add.at(mass, [x[2] for x in lines], length * content)
    children: dict[int, list[int]] = {}
    for c in range(len(mass) - 1, 0, -1):
        mass[parser.parents[c]] += mass[c]
        children.setdefault(parser.parents[c], []).append(c)
    region = 0
    while parser.kinds[region] not in LEAF_REGION:
        best = max(children.get(region, ()), key=lambda c: mass[c], default=None)
        if best is None or mass[best] < HOLDS * mass[region]:
            break
        region = best
    inside, leaves = {region}, set()
    for c in range(1, len(mass)):
        if parser.parents[c] in inside:
            inside.add(c)
        if parser.kinds[c] in LEAF_REGION or parser.parents[c] in leaves:
            leaves.add(c)
    outside = leaves if parser.kinds[region] in LEAF_REGION else range(len(mass))
    kept = np.array([x[2] in inside for x in lines])
    rest = np.flatnonzero([x[2] in outside and x[2] not in inside for x in lines])
    if len(rest):
        again = content[rest] | clustered(plain[rest])
        kept[rest] = [lines[i][3] or of_cluster and not lines[i][4] for i, of_cluster in zip(rest.tolist(), again.tolist(), strict=True)]
    return " ".join(x[0] for x, k in zip(lines, kept.tolist(), strict=True) if k)


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text.

    Null or empty html, and pages of furniture alone, give an empty text.
    Markup may be cut off, unclosed or wrongly nested. Repeated rows and null
    ids or URLs come back as they are; no rows: no rows.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch, 2):
                out = [main_text(t.decode("utf-8", "replace")) for t in texts]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string())], names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(task, "page_id long, url string, text string")
