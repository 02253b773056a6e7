"""Main text of HTML pages from the text-to-tag ratio of their lines.

The standard library's parser streams events over a page; block elements cut its text into lines. A line's
ratio is its text, without that of links, over the tags in it. Ratios are smoothed with a Gaussian over
neighbouring lines, and lines are clustered by a threshold, the spread of the smoothed ratios. Content
region is the smallest container that holds all lines above it, with what is nested in it: among articles where
a page marks any, else among those whose names say so, else among all; where no article holds all of them, the
outermost ones that hold any are. A chosen region is taken whole, so that short paragraphs, headings and lists of
links between long ones stay; menus, page headers and footers, sidebars, notices, adverts, forms, scripts
and reader comments are left out, whether marked by their element, role, class or id, or hidden. Names are evidence only:
an element that a name marks, or a form, stays if it holds more than half of the page's text; names that tell a state
(`has-sidebar`, `share-enabled`) mark nothing. Where the whole page is the region, blocks of links before and after its text go.
Open elements are kept by place and kind, so that broken pages take time in proportion to their length.

Character references are decoded, white space in a block becomes one space, blocks are joined by a newline.
A null or empty page, or one without content, has the empty text. Any broken markup gives a text: what is
never closed ends with what holds it. Rows are independent; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.llm.batches import each_text, give_back, ship_code

#: Lines on each side and width of the Gaussian.
REACH, WIDTH = 4, 2.0
#: Characters fed to the parser at once.
FED = 1 << 16

# Names of HTML elements: fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style noscript template iframe object svg math head title button select textarea option canvas audio video map".split())
ASIDE = frozenset("nav aside footer dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that a next one of their kind closes, and the elements within which that holds.
CLOSED = {"li": "ul ol menu", "dt": "dl", "dd": "dl", "tr": "table", "td": "tr table", "th": "tr table", "option": "select", "thead": "table", "tbody": "table", "tfoot": "table"}
REGIONS = frozenset("article main".split())
CONTAINERS = frozenset("article main section div td body center".split())
#: Words in a class, an id or a role that mark what is no article.
MARKS = frozenset(
    "ad ads advert adverts advertisement adverts sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs footer sidebar"
    " widget notice alert cookie cookies consent gdpr popup modal overlay share sharing social related recommended newsletter subscribe subscription signup"
    " login form search pagination pager toolbar contentinfo complementary skip".split()
)
#: Words that mark what readers have written.
REPLIES = frozenset("comment comments disqus respond reply replies".split())
#: First and last words of names that tell a state, as has-sidebar or share-enabled do, and mark nothing.
STATE_FIRST = frozenset("has no not is with without".split())
STATE_LAST = frozenset("enabled disabled active inactive open closed on off ready loaded".split())
#: The same, but only outside an article: within one they hold its title.
HEADS = frozenset("header masthead hero topbar".split())
CENTRE = frozenset("article content main post entry story text body".split())
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def tokens(value: str | None) -> set[str]:
    """Words of the names in an attribute, but for names that tell a state."""
    found: set[str] = set()
    for name in (value or "").split():
        words = [t.lower() for t in TOKEN.findall(name)]
        if words and words[0] not in STATE_FIRST and (len(words) == 1 or words[-1] not in STATE_LAST):
            found.update(words)
    return found


class Lines(HTMLParser):
    """Lines of a page: text, characters in links, tags, number of the container, of the article around it, and of the marked element around it (0: none)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, bool, int, int, int]] = []  # element, left out, container, article, marked
        self.at: dict[str, list[int]] = {}  # places in the stack of each element, of containers and of blocks
        self.lines: list[tuple[str, int, int, int, int, int]] = []
        self.parts: list[str] = []
        self.linked = self.tags = self.links = 0
        #: The container around each; 0 is the page. A number is always greater than that of what is around it.
        self.parents = [0]
        #: The same for marked elements, of which a name says that they are no article.
        self.marked = [0]
        self.central: set[int] = set()
        self.regions: set[int] = set()
        #: Containers that are the page: none, and `body`.
        self.pages = {0}

    def cut(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            _, _, container, article, marked = self.stack[-1] if self.stack else ("", False, 0, 0, 0)
            self.lines.append((text, self.linked, self.tags, container, article, marked))
            self.tags = 0
        self.parts.clear()
        self.linked = 0

    def kinds(self, tag: str) -> Iterator[str]:
        yield tag
        if tag in CONTAINERS:
            yield " container"
        if tag in BLOCKS:
            yield " block"

    def last(self, *kinds: str) -> int:
        """Place of the innermost open element of a kind, or -1."""
        return max((self.at[k][-1] for k in kinds if self.at.get(k)), default=-1)

    def close_to(self, place: int) -> None:
        while len(self.stack) > place:
            tag = self.stack.pop()[0]
            self.links -= tag == "a"
            for kind in self.kinds(tag):
                self.at[kind].pop()

    def handle_starttag(self, tag: str, attrs) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.cut()
            if (place := self.last(" block")) >= 0 and self.stack[place][0] == "p":
                self.close_to(place)
        elif tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        if tag in CLOSED:
            same = ("td", "th") if tag in ("td", "th") else ("dt", "dd") if tag in ("dt", "dd") else (tag,)
            if (place := self.last(*same)) > self.last(*CLOSED[tag].split()):
                self.close_to(place)
        _, out, container, article, marked = self.stack[-1] if self.stack else ("", False, 0, 0, 0)
        given = dict(attrs)
        marks = tokens(given.get("class")) | tokens(given.get("id")) | tokens(given.get("role"))
        if not out and tag not in ("html", "body"):
            out = (
                tag in UNSEEN
                or tag in ASIDE
                or (bool(marks & REPLIES) and tag not in REGIONS)
                or (not article and tag == "header")
                or "hidden" in given
                or (given.get("aria-hidden") or "").lower() == "true"
                or "display:none" in (given.get("style") or "").replace(" ", "").lower()
            )
            if not out and tag not in REGIONS and (tag == "form" or marks & MARKS or (not article and marks & HEADS)):
                self.marked.append(marked)
                marked = len(self.marked) - 1
        if tag in CONTAINERS:
            self.parents.append(container)
            container = len(self.parents) - 1
            if tag == "body":
                self.pages.add(container)
            if marks & CENTRE:
                self.central.add(container)
            if tag in REGIONS and not out:
                article = container
                self.regions.add(container)
        if tag == "a":
            self.links += 1
        for kind in self.kinds(tag):
            self.at.setdefault(kind, []).append(len(self.stack))
        self.stack.append((tag, out, container, article, marked))

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.cut()
        place = self.last(tag)
        # an inline element does not close what holds it
        if place >= 0 and (tag in BLOCKS or place >= self.last(" container")):
            self.close_to(place)

    def handle_startendtag(self, tag: str, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data: str) -> None:
        if self.stack and self.stack[-1][1]:
            return
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())


def smoothed(ratios: np.ndarray) -> np.ndarray:
    places = np.arange(-REACH, REACH + 1)
    kernel = np.exp(-(places**2) / (2 * WIDTH**2))
    return np.convolve(np.pad(ratios, REACH), kernel / kernel.sum(), "valid")


def below(parents: list[int], tops: set[int]) -> np.ndarray:
    """Per container, whether it is one of `tops` or within one."""
    out = np.zeros(len(parents), bool)
    for c, parent in enumerate(parents):
        out[c] = c in tops or (c > 0 and out[parent])
    return out


def smallest(parents: list[int], among: set[int], lines: np.ndarray) -> set[int]:
    """The innermost of `among` that holds all lines (given by their containers), else the outermost ones that hold any."""
    held = [0] * len(parents)
    for c in lines:
        held[c] += 1
    for c in range(len(parents) - 1, 0, -1):
        held[parents[c]] += held[c]
    if whole := [c for c in among if held[c] == len(lines)]:
        return {max(whole)}
    return {c for c in among if held[c]}


def left_out(parser: Lines) -> np.ndarray:
    """Per line, whether it lies in a marked element. One that holds more than half of the page's text, without links, is no aside, whatever its name."""
    held = [0] * len(parser.marked)
    for text, linked, _, _, _, marked in parser.lines:
        held[marked] += max(0, len(text) - linked)
    for m in range(len(held) - 1, 0, -1):
        held[parser.marked[m]] += held[m]
    aside = below(parser.marked, {m for m in range(1, len(held)) if 2 * held[m] <= held[0]})
    return aside[[line[5] for line in parser.lines]]


def main_text(html: str) -> str:
    """The main text of a page."""
    parser = Lines()
    done, step = 0, FED
    while done < len(html):  # what is not closed is read again with each step: steps double
        parser.feed(html[done : done + step])
        done, step = done + step, 2 * step
    parser.close()
    parser.cut()
    if parser.lines:
        aside = left_out(parser)
        parser.lines = [line for line, out in zip(parser.lines, aside, strict=True) if not out]
    if not parser.lines:
        return ""
    texts, linked, tags, container, article, _ = zip(*parser.lines, strict=True)
    own = np.array([*map(len, texts)]) - np.minimum(linked, [*map(len, texts)])
    ratios = smoothed(own / np.maximum(1, tags))
    # clustered by the spread of the ratios; a page of even lines is all content
    dense = (ratios >= min(ratios.std(), ratios.max())) & (own > 0)
    container, article = np.array(container), np.array(article)
    if article.any():
        among, within = parser.regions, article > 0
    else:
        among, within = {*range(len(parser.parents))}, np.ones(len(texts), bool)
        central = below(parser.parents, parser.central)[container]
        if (central & dense).any():
            among, within = parser.central, central
    wanted = dense & within if (dense & within).any() else within
    chosen = smallest(parser.parents, among, container[wanted])
    kept = below(parser.parents, chosen)[container]
    if chosen <= parser.pages:  # the whole page: links around the text, in containers without any, are its menus
        near = np.flatnonzero(wanted)
        places = np.arange(len(texts))
        kept &= (own > 0) | ((places > near[0]) & (places < near[-1])) | np.isin(container, container[wanted])
    return "\n".join(texts[i] for i in np.flatnonzero(kept))


def extracted(html: Column) -> Column:
    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(p) for p in each_text(pages)], pa.string())
        give_back()

    return extract(html)


def with_main_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """`pages` with the main text of each."""
    ship_code(pages.sparkSession)
    return pages.withColumn(out, extracted(F.col(html)))
