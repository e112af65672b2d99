"""HTML extraction: parser events, text-to-tag ratios, smoothing and clustering."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.llm.common import one_name, ready, texts

# What HTML and common page designs call things.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu "
    "nav ol p pre search section summary table tbody tfoot thead title tr ul".split())
SPACED = frozenset("br td th img input button select".split())  # white space where they stand
REGIONS = frozenset("article main section div td body html".split())
TEXTS = frozenset(("article", "main"))
SKIPPED = frozenset(
    "script style noscript template head title nav footer aside fieldset button select option "
    "textarea label input iframe object canvas svg menu dialog search".split())
PARTING = frozenset("script style noscript template title".split())  # skipped between two blocks
OPEN_ENDED = frozenset(("label", "button"))  # often not ended; blocks other than div end them
SKIPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "toolbar status".split())
SKIPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox banner banners sponsor sponsored "
    "sponsors promo promos promotion nav navbar navigation menu menus breadcrumb breadcrumbs sidebar "
    "sidebars footer footnav header masthead topbar toolbar notice notices cookie cookies consent gdpr "
    "popup modal overlay newsletter subscribe subscription signup login share sharing social related "
    "recommended comment comments commentlist disqus respond reply replies reaction reactions response "
    "responses widget widgets pagination pager skiplink".split())
# Names of what readers write, which may be longer than what they write about.
READERS_NAMES = frozenset("comment comments commentlist disqus respond reply replies reaction reactions "
                          "response responses".split())
# Words that say of a name's other words only where or in what they stand.
FILLERS = frozenset(
    "site page main global top bottom left right center upper lower primary secondary mobile desktop "
    "sticky fixed box wrap wrapper container inner outer area block section row col column columns "
    "bar list item items links link content contents text icons buttons button posts articles stories "
    "unit slot zone panel form policy message user users reader readers visitor visitors post article "
    "entry blog thread leave".split())
CLOSES = {  # a start tag that ends an open element of these kinds
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"},
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
LISTS = frozenset("ul ol dl table select article section div".split())  # they shield what is outside

SIGMA = 1.0
SPREAD = 3  # lines on each side that smoothing reaches
CONTRAST = 2.0  # times that the ratios of content exceed those of the rest at least
SHARE = 0.9  # of the selected text that an article or main holds where it is taken for the content


@dataclass(slots=True)
class Element:
    """An open element, and the numbers of the innermost region and mark it is or is in.

    A mark is a name that says an element is no content; 0 is none.
    """

    tag: str
    region: int
    skipped: bool
    mark: int
    mute: bool = False  # skipped inside of a block: its text is left out, the block goes on


@dataclass(slots=True)
class Line:
    """A block of text: its innermost region and mark, and how many tags were met in it.

    ``heading`` tells whether it is in a heading, ``own`` how many of the tags are not
    those of regions, which only hold blocks.
    """

    text: str
    tags: int
    skipped: bool
    region: int
    mark: int
    heading: bool
    own: int


class Events(HTMLParser):
    """Turns a stream of tags and text into lines."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.regions: list[tuple[str, int]] = [("page", -1)]  # tag, region around it
        # Mark around it, whether it is in a text, whether it is the readers'.
        self.marks: list[tuple[int, bool, bool]] = [(0, True, False)]
        self.open: list[Element] = [Element("page", 0, False, 0)]
        self.depth: Counter[str] = Counter()  # open elements by tag
        self.pieces: list[str] = []
        self.tags = self.own = self.mute = 0
        self.ending = False

    def parse_comment(self, i: int, report: bool = True) -> int:
        """A comment that nothing ends goes on to the end of the page."""
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 and self.ending else end

    def flush(self) -> None:
        if self.mute:
            return
        text = " ".join("".join(self.pieces).split())
        if text:
            here = self.open[-1]
            self.lines.append(Line(text, self.tags, here.skipped, here.region, here.mark,
                                   any(self.depth[t] for t in HEADINGS), self.own))
        if self.pieces:
            self.pieces, self.tags, self.own = [], 0, 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCKS:
            if tag != "div":
                for ended in OPEN_ENDED:
                    self._close(ended, LISTS)
            self.flush()
            self._close("p", LISTS)
        if tag in CLOSES:
            for ended in CLOSES[tag]:
                self._close(ended, LISTS - {"div", "section", "article"} if ended == tag else LISTS)
        if tag in SPACED:
            self.pieces.append(" ")
        self.tags += 1
        self.own += tag not in REGIONS
        if tag in VOID:
            return
        skipped, region, mark = self._skips(tag, attrs), self.open[-1].region, self.open[-1].mark
        if not skipped and (named := self._marked(tag, attrs)):
            self.marks.append((mark, any(self.depth[t] for t in TEXTS), named == "readers"))
            mark = len(self.marks) - 1
        mute = skipped and tag not in BLOCKS and tag not in PARTING and not self.open[-1].skipped
        if not mute and (skipped, mark) != (self.open[-1].skipped, self.open[-1].mark):
            self.flush()  # text before is not of the same kind
        if tag in REGIONS:
            self.regions.append((tag, region))
            region = len(self.regions) - 1
        self.depth[tag] += 1
        self.open.append(Element(tag, region, skipped, mark, mute))
        self.mute += mute

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if tag in SPACED:
            self.pieces.append(" ")
        self.tags += 1
        self.own += tag not in REGIONS
        self._close(tag, frozenset() if tag in BLOCKS else BLOCKS)

    def handle_data(self, data: str) -> None:
        if not self.mute:
            self.pieces.append(data)

    def _close(self, tag: str, shields: frozenset) -> None:
        """End the innermost open ``tag``, with what is open in it, unless a shield is in between."""
        if not self.depth[tag]:
            return
        at = len(self.open) - 1
        while self.open[at].tag != tag:
            if self.open[at].tag in shields:
                return
            at -= 1
        self.mute -= sum(e.mute for e in self.open[at:])
        first = next((i for i in range(at, len(self.open)) if self.open[i].mute), len(self.open))
        inner = self.open[first - 1]  # what is muted has nothing to flush
        if (inner.skipped, inner.mark) != (self.open[at - 1].skipped, self.open[at - 1].mark):
            self.flush()
        self.depth.subtract(e.tag for e in self.open[at:])
        del self.open[at:]

    def _skips(self, tag: str, attrs: list) -> bool:
        if tag == "body" or tag == "html":
            return False
        if self.open[-1].skipped or tag in SKIPPED:
            return True
        if tag == "header" and not any(self.depth[t] for t in TEXTS):
            return True
        values = {name: value or "" for name, value in attrs}
        return "hidden" in values or values.get("aria-hidden") == "true" \
            or "display:none" in values.get("style", "").replace(" ", "").lower() \
            or values.get("role", "").lower() in SKIPPED_ROLES

    def _marked(self, tag: str, attrs: list) -> str:
        """Whether an element is a form or one of its class names or its id is no content's:
        ``readers``, ``other`` or nothing."""
        if tag in TEXTS or tag == "body" or tag == "html":
            return ""
        values = {name: value or "" for name, value in attrs}
        found = {no_content(n) for n in f"{values.get('class', '')} {values.get('id', '')}".split()}
        if "readers" in found:
            return "readers"
        form = tag == "form" or values.get("role", "").lower() == "form"
        return "other" if form or "other" in found else ""


@lru_cache(maxsize=1 << 14)
def no_content(name: str) -> str:
    """Whether a class name or id as a whole is one of ``SKIPPED_NAMES`` or a compound of them:
    ``readers`` if it names what readers write, ``other`` or nothing.

    All its words are, but for ``FILLERS`` beside them: "cookie-notice", "sideBar" and
    "ad_box_2" are; "has-sidebar" and "ad-free" say something else.
    """
    words = [w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) if w]
    known = [w for w in words if w in SKIPPED_NAMES]
    if "".join(words) in SKIPPED_NAMES:
        known = words = ["".join(words)]
    if not known or not all(w in SKIPPED_NAMES or w in FILLERS for w in words):
        return ""
    return "readers" if READERS_NAMES.issuperset(known) else "other"


def lines_of(html: str) -> tuple[list[Line], list[tuple[str, int]], list[tuple[int, bool, bool]]]:
    """The lines of a page in order, and the regions and marks that ``Events`` has met."""
    events = Events()
    last = html.rfind("<")
    if last > html.rfind(">") and re.match("[/!?a-zA-Z]", html[last + 1:]):
        html = html[:last]  # the page breaks off inside a tag
    events.feed(html)
    events.ending = True
    events.close()
    events.mute = 0
    events.flush()
    return events.lines, events.regions, events.marks


def ratios(lines: list[Line]) -> np.ndarray:
    """Text length per tag of each line, smoothed by a Gaussian over its neighbours."""
    raw = np.array([len(line.text) / max(line.tags, 1) for line in lines], "f8")
    reach = np.exp(-0.5 * (np.arange(-SPREAD, SPREAD + 1) / SIGMA) ** 2)
    weight = np.convolve(np.ones(len(raw)), reach)[SPREAD:SPREAD + len(raw)]
    return np.convolve(raw, reach)[SPREAD:SPREAD + len(raw)] / weight


def threshold(values: np.ndarray) -> float:
    """The middle between two clusters of the values (two means, from the extremes).

    Clusters whose means are less than ``CONTRAST`` times apart count as one: the
    threshold is then the lowest value.
    """
    low, high = values.min(), values.max()
    for _ in range(50):
        upper = np.abs(values - high) <= np.abs(values - low)
        if not upper.any():  # means of equal values, rounded
            break
        means = values[~upper].mean() if not upper.all() else low, values[upper].mean()
        if means == (low, high):
            break
        low, high = means
    return (low + high) / 2 if high >= CONTRAST * low else values.min()


def believed(marks: list[tuple[int, bool, bool]], lines: list[Line], above: np.ndarray,
             regions: list[tuple[str, int]]) -> list[bool]:
    """For each mark whether its text is set aside, by it or by one around it.

    A mark around more than half of the text in the upper cluster (``above``) is
    wrong: what it is on is the page's content. Only where an article or main has
    such text outside of marks, marks beside it are always right; and a mark that names
    what readers write is, however much they write, if anything else is left.
    """
    in_text = [False] * len(regions)
    for number, (tag, parent) in enumerate(regions):
        in_text[number] = tag in TEXTS or parent >= 0 and in_text[parent]
    outside = [False] * len(marks)
    for number, (parent, inside, _) in enumerate(marks):
        outside[number] = outside[parent] or not inside
    theirs = [False] * len(marks)
    for number, (parent, _, readers) in enumerate(marks):
        theirs[number] = theirs[parent] or readers
    if not any(not line.skipped and not theirs[line.mark] for line in lines):
        theirs = [False] * len(marks)
    held, sure = [0] * len(marks), False
    for line, high in zip(lines, above):
        if high and not line.skipped and not theirs[line.mark]:
            held[line.mark] += len(line.text)
            sure = sure or in_text[line.region] and not outside[line.mark]
    for number in range(len(marks) - 1, 0, -1):
        held[marks[number][0]] += held[number]
    aside = [False] * len(marks)
    for number, (parent, inside, _) in enumerate(marks[1:], 1):
        aside[number] = aside[parent] or theirs[number] or 2 * held[number] <= held[0] \
            or sure and not inside
    return aside


def smallest(chosen: list[Line], regions: list[tuple[str, int]], share: float = 1) -> int:
    """The smallest region that holds a share of the chosen lines' text."""
    held = [0] * len(regions)
    for line in chosen:
        held[line.region] += len(line.text)
    for number in range(len(regions) - 1, 0, -1):  # what a region holds, its parent does
        held[regions[number][1]] += held[number]
    return max(r for r, n in enumerate(held) if n >= share * held[0])


def firm(lines: list[Line], smooth: np.ndarray, cut: float, aside: list[bool]) -> list[Line]:
    """The usable lines that their own ratio puts in the upper cluster, with their headings."""
    low = smooth[smooth < cut]
    least = CONTRAST * low.mean() if len(low) else 0
    found, follows = [], False
    for line, near in zip(reversed(lines), reversed(smooth)):
        if line.skipped or aside[line.mark]:
            continue
        ratio = len(line.text) / max(line.own, 1)
        follows = ratio >= cut or near >= cut and ratio >= least or follows and line.heading
        if follows:
            found.append(line)
    return found


def main_text(html: str) -> str:
    """The main text of a page, a line for each block.

    Lines inside menus, headers, footers, sidebars, notices, adverts, forms,
    comments, scripts and styles (by element, role, class or id) are set aside; a
    class, an id or a form sets nothing aside that is an article or main or holds
    most of the text in the upper cluster (see below). Of the others, those whose smoothed text-to-tag ratio lies in the upper
    cluster of all lines show where the content is: the whole article or main that
    holds nearly all of their text, or else the smallest region (section, div, cell
    or body) that holds all of them and the headings before them. There a line counts
    by its own ratio too, without the tags of regions: one that reaches the upper
    cluster is in, one like the lower cluster that only its neighbours lift is not.
    All lines of that region that are not set aside are the
    text, short ones too. If no line is in the upper cluster, all of them count.
    """
    lines, regions, marks = lines_of(html)
    if all(line.skipped for line in lines):
        return ""
    smooth = ratios(lines)
    cut = threshold(smooth)
    above = smooth >= cut
    aside = believed(marks, lines, above, regions)
    usable = [line for line in lines if not line.skipped and not aside[line.mark]]
    if not usable:
        return ""
    chosen = [line for line, high in zip(lines, above)
              if high and not line.skipped and not aside[line.mark]] or usable
    region = around = smallest(chosen, regions, SHARE)
    while around >= 0 and regions[around][0] not in TEXTS:
        around = regions[around][1]
    if around < 0:
        region = smallest(firm(lines, smooth, cut, aside) or chosen, regions)
    while around >= 0:
        region = around if regions[around][0] in TEXTS else region
        around = regions[around][1]
    wanted = {region}
    if regions[region][0] in TEXTS:  # and others beside it that hold content, a second article say
        for line in firm(lines, smooth, cut, aside):
            outermost, at = -1, line.region
            while at >= 0:
                outermost = at if regions[at][0] in TEXTS else outermost
                at = regions[at][1]
            wanted.add(outermost)
    inside = [False] * len(regions)
    for number, (_, parent) in enumerate(regions):
        inside[number] = number in wanted or parent >= 0 and inside[parent]
    return "\n".join(line.text for line in usable if inside[line.region])


def extract(spark: SparkSession, pages: DataFrame, html: str = "html",
            text: str = "text", keep_html: bool = False) -> DataFrame:
    """``pages`` with the main text of each whole page and its code points, ``n_chars``.

    A null or empty page, and one without any main text, has the empty text.
    Character references are decoded, white space inside a block becomes one
    blank, and blocks are joined by a line feed. Pages that break off are read as
    far as they go. Repeated rows give the same text. Columns named like the new
    ones are replaced; an empty table gives no rows.
    """
    ready(spark)
    reads = one_name(pages, "read")
    kept = [c for c in pages.columns
            if c.lower() not in (text.lower(), "n_chars") and (keep_html or c != html)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(page or "") for page in texts(batch, reads)]
            yield batch.drop_columns([reads]).append_column(text, pa.array(found, pa.string())) \
                .append_column("n_chars", pa.array(list(map(len, found)), pa.int64()))

    schema = pages.select(*kept).withColumns({
        text: F.lit(None).cast("string"), "n_chars": F.lit(None).cast("bigint")}).schema
    return pages.select(*kept, F.col(html).alias(reads)).mapInArrow(run, schema)
