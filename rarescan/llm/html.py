"""Main text of HTML pages by text-to-tag ratio.

The standard library's parser streams events; they become lines, one per block,
with their text, tags and whether they lie in a part that never is content
(menus, forms, adverts, comments, ...).  A class or id only raises a doubt: alone or
beside neutral words (``site-header``) it drops the element, in other compounds
(``share-price``) only if links are most of its text.  A doubt is cleared where the
element holds the page's ``main`` or its longest ``article``, or, on pages without
them, twice the text that is beyond doubt; adverts, comments and notices are never
cleared by their size.  A form counts if the page has no other text.

The ratio of text to tags per line is smoothed by a Gaussian; lines above a threshold
taken from the ratios' spread cluster into content regions.  Short lines between or,
inside an ``article`` or ``main``, beside the clusters are kept unless links are most
of them; elsewhere a heading just above a cluster counts too.  Further articles that
are teasers (a link for a title or an end, or a quarter of links) are left out.

Defined cases: a null, empty or markup-free page gives its plain text, empty if
there is none; elements may stay open, and close with what encloses them, in time
linear in the page; repeated rows are extracted alike; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded_batches, narrow

SIGMA = 1.0
RADIUS = 2
SPREAD = 0.5  # lines above mean - SPREAD * deviation of the smoothed ratios are content

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre "
    "section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "aside button canvas datalist dialog embed footer head iframe input label map menu "
    "nav noscript object script select style svg template textarea video audio".split()
)
HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
CONTAINERS = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Words of class, id and role values whose element holds no content ...
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|consent|cookies?|disqus|footer"
    r"|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|notifications?"
    r"|outbrain|paywall|popup|promo\w*|recommend\w*|related|reviews?|search|share|sharing|sidebar"
    r"|signup|social|sponsor\w*|subscribe|taboola|toolbar|widget)(?=$|[\s_-]|\d)",
    re.IGNORECASE,
)
# ... of these, the ones that no compound and no size makes content, ...
NEVER = re.compile(
    r"ads?|advert\w*|comments?|consent|cookies?|disqus|gdpr|newsletter|outbrain|promo\w*|sponsor\w*"
    r"|subscribe|taboola"
)
# ... words beside which the others stay sure, and first words that only tell what a page has.
NEUTRAL = frozenset(
    "area bar block body bottom box btn button buttons center col container content fixed group icons "
    "inner item items left link links list main mobile outer page panel primary right secondary section "
    "site slot sticky title top unit user wrap wrapper".split()
)
TELLING = frozenset("has have no show with without".split())


def doubt_of(value: str) -> str:
    """What a class or id says of its element: "never" content, "part", "word", or nothing."""
    found = ""
    for token in value.lower().split():
        words = [w for w in (x.strip("0123456789") for x in re.split("[-_]+", token)) if w]
        noisy = [w for w in words if NOISE.fullmatch(w)]
        if not noisy or words[0] in TELLING:
            continue
        if any(NEVER.fullmatch(w) for w in noisy):
            return "never"
        if all(w in noisy or w in NEUTRAL for w in words):
            found = "part"
        found = found or "word"
    return found


@dataclass
class Line:
    text: str
    tags: int
    links: int  # characters inside links
    container: int  # number of the outermost article or main, 0 if none
    heading: bool

    @property
    def linked(self) -> bool:
        return 2 * self.links > len(self.text)


@dataclass
class Open:
    tag: str
    dropped: bool
    container: int
    holder: int  # number of the innermost article or main, -1 if none
    doubt: int  # number of the innermost doubtful element, 0 if none
    block: int  # depth of the innermost block, itself included
    link: bool
    heading: bool


@dataclass
class Doubt:
    above: int  # the doubtful element around it
    sort: str
    chars: int = 0
    links: int = 0


@dataclass
class Part:
    text: str
    link: bool
    holder: int
    doubt: int


@dataclass
class Lines(HTMLParser):
    """Parser events to the lines of a page that are not dropped."""

    lines: list[tuple[list[Part], int, int, bool]] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[Open] = [Open("", False, 0, -1, 0, 0, False, False)]
        self.depths: dict[str, list[int]] = {}  # of the open elements, by tag
        self.containers = 0
        self.holders: list[tuple[str, int]] = []
        self.doubts: list[Doubt] = [Doubt(0, "")]
        self._begin()

    def _begin(self):
        self.parts: list[Part] = []
        self.tags = 0

    def _break(self):
        """End the current line; it belongs to what is open now."""
        if self.parts:
            at = self.open[-1]
            self.lines.append((self.parts, self.tags, at.container, at.heading))
        self._begin()

    def _cut(self, depth: int):
        for element in self.open[depth:]:
            self.depths[element.tag].pop()
        del self.open[depth:]

    def _close(self, depth: int):
        self._break()
        self._cut(depth)

    def _implied(self, tag: str):
        """A block ends an open paragraph; an item ends the item before it."""
        depth = self.open[-1].block
        inner = self.open[depth].tag
        if inner == "p" or (inner == tag and tag in ("li", "dd", "dt", "td", "tr")):
            self._close(depth)

    def _leave_head(self, tag: str):
        """What cannot stand in a head ends it; a body ends it at any depth."""
        if self.depths.get("head") and (tag == "body" or (self.open[-1].tag == "head" and tag not in HEAD)):
            self._close(self.depths["head"][-1])

    def _doubt(self, tag: str, attrs) -> tuple[bool, str]:
        """Whether the element is dropped, and the doubt that it raises."""
        sort = "form" if tag == "form" else ""
        if tag in ("html", "body"):
            return False, ""
        for name, value in attrs:
            if name in ("class", "id") and value:
                said = doubt_of(value)
                sort = said if said and sort != "never" else sort
            elif name == "role" and value and NOISE.search(value):
                return True, ""
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                return True, ""
        return False, sort

    def handle_starttag(self, tag, attrs):
        self._leave_head(tag)
        self.tags += 1
        if tag in BLOCKS:
            self._implied(tag)
            self._break()
            self.tags += 1
        elif tag == "br":
            self._space()
        if tag in VOID:
            return
        above = self.open[-1]
        dropped = above.dropped or tag in DROPPED or (tag == "header" and not above.container)
        doubt = above.doubt
        if not dropped:
            dropped, sort = self._doubt(tag, attrs)
            if sort:
                doubt = len(self.doubts)
                self.doubts.append(Doubt(above.doubt, sort))
        container, holder = above.container, above.holder
        if tag in CONTAINERS and not dropped:
            self.containers += 1
            container = container or self.containers
            holder = len(self.holders)
            self.holders.append((tag, doubt))
        depth = len(self.open)
        block = depth if tag in BLOCKS else above.block
        link, heading = above.link or tag == "a", above.heading or tag in HEADINGS
        if tag in BLOCKS:
            heading = tag in HEADINGS
        self.open.append(Open(tag, dropped, container, holder, doubt, block, link, heading))
        self.depths.setdefault(tag, []).append(depth)

    def _space(self):
        self.parts.append(Part(" ", False, -1, 0))

    def handle_startendtag(self, tag, attrs):
        self._leave_head(tag)
        self.tags += 1
        if tag in BLOCKS:
            self._break()
        elif tag == "br":
            self._space()
        elif tag not in VOID:  # HTML ignores the slash
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        self.tags += 1
        depths = self.depths.get(tag)
        if not depths:
            return
        depth, block = depths[-1], self.open[-1].block
        if block >= depth and tag in BLOCKS:
            self._close(depth)
        elif block < depth:
            self._cut(depth)
        # an inline end tag does not reach over a block

    def handle_data(self, data):
        if self.open[-1].tag == "head" and not data.isspace():
            self._close(len(self.open) - 1)
        at = self.open[-1]
        if not at.dropped:
            self.parts.append(Part(data, at.link, at.holder, at.doubt))

    def _around(self, doubt: int):
        while doubt:
            yield doubt
            doubt = self.doubts[doubt].above

    def _cleared(self) -> set[int]:
        """The doubtful elements that hold the page's content after all."""
        sizes = [0] * len(self.holders)
        for parts, *_ in self.lines:
            for part in parts:
                size = len(part.text.strip())
                self.doubts[part.doubt].chars += size
                self.doubts[part.doubt].links += size * part.link
                if part.holder >= 0:
                    sizes[part.holder] += size
        sure = self.doubts[0].chars - self.doubts[0].links
        for doubt in reversed(self.doubts[1:]):  # an element comes after what encloses it
            if doubt.above and doubt.sort != "never":
                self.doubts[doubt.above].chars += doubt.chars
                self.doubts[doubt.above].links += doubt.links
        articles = [n for n, (tag, _) in enumerate(self.holders) if tag == "article" and sizes[n]]
        held = [doubt for tag, doubt in self.holders if tag == "main"]
        if articles:
            held.append(self.holders[max(articles, key=lambda n: sizes[n])][1])
        cleared = {n for doubt in set(held) for n in self._around(doubt)}
        bare = not any(sizes)
        for n, doubt in enumerate(self.doubts[1:], 1):
            prose = doubt.chars - doubt.links
            if doubt.sort == "word" and prose >= doubt.links:
                cleared.add(n)
            elif doubt.sort == "part" and bare and prose > max(2 * sure, doubt.links):
                cleared.add(n)
        return cleared

    def _without(self, cleared: set[int]) -> list[Line]:
        """The lines, without the text inside doubtful elements that are not ``cleared``."""
        kept = [True] * len(self.doubts)
        for n, doubt in enumerate(self.doubts[1:], 1):
            kept[n] = n in cleared and kept[doubt.above]
        out = []
        for parts, tags, container, heading in self.lines:
            parts = [x for x in parts if kept[x.doubt]]
            text = " ".join("".join(x.text for x in parts).split())
            if text:
                links = sum(len(x.text) for x in parts if x.link)
                out.append(Line(text, tags, links, container, heading))
        return out

    def done(self) -> list[Line]:
        self.close()
        self._break()
        cleared = self._cleared()
        forms = {n for n, doubt in enumerate(self.doubts) if doubt.sort == "form"}
        return self._without(cleared) or self._without(cleared | forms)


def smoothed(values: list[float], sigma: float = SIGMA, radius: int = RADIUS) -> list[float]:
    """Gaussian smoothing; at the ends the weights inside are scaled to 1."""
    weights = [math.exp(-(k * k) / (2 * sigma * sigma)) for k in range(radius + 1)]
    out = []
    for i in range(len(values)):
        near = range(max(0, i - radius), min(len(values), i + radius + 1))
        total = sum(weights[abs(i - j)] for j in near)
        out.append(sum(values[j] * weights[abs(i - j)] for j in near) / total)
    return out


def regions(lines: list[Line]) -> list[bool]:
    """Which lines lie in a cluster of a high smoothed text-to-tag ratio.

    Links alone count between text, not at a cluster's end.
    """
    ratios = [max(0, len(x.text) - x.links) / max(1, x.tags) for x in lines]
    smooth = smoothed(ratios)
    mean = sum(smooth) / len(smooth)
    deviation = math.sqrt(sum((v - mean) ** 2 for v in smooth) / len(smooth))
    chosen = [v > 0 and v >= mean - SPREAD * deviation for v in smooth]
    for ends in (range(len(lines)), range(len(lines) - 1, -1, -1)):
        before = False  # whether the line before lies in a cluster
        for i in ends:
            before = chosen[i] = chosen[i] and (ratios[i] > 0 or before)
    return chosen


def stories(lines: list[Line], found: set[int]) -> dict[int, list[Line]]:
    """The lines of the outermost containers ``found``, without teasers beside the longest."""
    held: dict[int, list[Line]] = {n: [] for n in found}
    for line in lines:
        if line.container in held:
            held[line.container].append(line)
    longest = max(held, key=lambda n: sum(len(x.text) - x.links for x in held[n]))

    def teaser(mine: list[Line]) -> bool:
        links, chars = sum(x.links for x in mine), sum(len(x.text) for x in mine)
        titles = any(x.heading and x.linked for x in mine)
        return titles or mine[-1].linked or 4 * links >= chars

    return {n: mine for n, mine in held.items() if n == longest or not teaser(mine)}


def content(lines: list[Line]) -> list[str]:
    """The texts of the content regions, in page order."""
    if not lines:
        return []
    chosen = regions(lines)
    whole = {x.container for x, c in zip(lines, chosen, strict=True) if c and x.container}
    if whole:  # what lies outside is not the article
        out = []
        for _, mine in sorted(stories(lines, whole).items()):
            inside = regions(mine)
            kept = [x.text for x, c in zip(mine, inside, strict=True) if c or x.heading or not x.linked]
            out += kept or [x.text for x in mine]
        return out
    places = [i for i, c in enumerate(chosen) if c]
    if not places:
        return []
    for i in range(places[0], places[-1]):
        chosen[i] = chosen[i] or not lines[i].linked
    for i in range(len(lines) - 1, 0, -1):
        if chosen[i] and lines[i - 1].heading:
            chosen[i - 1] = True
    return [x.text for x, c in zip(lines, chosen, strict=True) if c]


def main_text(html: str | None) -> str:
    parser = Lines()
    parser.feed(html or "")
    return "\n\n".join(content(parser.done()))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page."""
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])

    def run(batches):
        for batch in batches:
            texts = pa.array([main_text(h) for h in batch.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], schema=kinds)

    source = bounded_batches(narrow(pages, page_id="bigint", url="string", html="string"))
    return source.mapInArrow(run, "page_id bigint, url string, text string")
