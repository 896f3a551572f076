"""Main text of web pages: parser events, text-to-tag ratios, Gaussian smoothing and threshold clusters.

The standard library's parser streams start tags, end tags and text. Text between block-level tags is a block (a line of
the method); tags seen while it was open count for its text-to-tag ratio. Parts that are never article text (menus,
scripts, forms, adverts and the like) are marked by tag, role, or a class or id that says nothing else. The ratios of the
remaining blocks are smoothed with a Gaussian kernel and cut at a threshold into content and other. Where the page has an
article element, those that hold content are the text; elsewhere the text runs from the first to the last cluster of
content, with the headings before it and what shares a container with it, and without the links and labels around it. A
mark on a container is not believed where all running text is inside.

Time is linear in the page: open elements are looked up by tag and depth, and containers are numbered in page order, so that
a subtree is a range of numbers.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from heapq import heapify, heappop, heappush
from html.parser import HTMLParser
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

#: HTML elements by role in the page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img ruby rt rp".split())
HARD = frozenset("head title script style noscript template nav footer aside form button select option textarea iframe svg canvas object dialog menu audio video map".split())
ROOTS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words of class and id that mark parts which are not article text, ...
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion cookie cookies consent gdpr notice notices alert popup modal overlay"
    " sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs header masthead topbar footer colophon copyright comment comments disqus reply replies respond response responses discussion"
    " share sharing social related recommended recommendations newsletter subscribe subscription signup login register search searchbox pagination pager widget widgets toolbar tags tagcloud skip".split()
)
#: ... marks that are also what an article may be about: inside one they don't hold for a part with RUNS blocks of running text, ...
TOPICS = frozenset("alert cookie cookies menu menus notice notices register search share sharing social tags".split())
RUNS = 2
#: ... words that go with them without saying anything else, ...
FILLERS = frozenset(
    "area bar block body box boxes bottom btn button buttons card col column container content desktop dialog first form global grid group holder icons inner item items label last left line link links list main mobile"
    " page panel popover primary right row secondary section site slot small sticky strip text thread title top unit user users view wrap wrapper author by count meta header post posts article articles stories reader readers to media the your".split()
)
#: ... and those that name an article's own head where they stand in an article or beside a word for one.
HEADS = frozenset("header masthead banner".split())
_PARTS = frozenset("article post entry story content page title section main".split())
_WORDS = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")
_P_ENDERS = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
_CLOSES = {"li": ("li", ("ul", "ol")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
KEEP, SOFT, HARDLY = 0, 1, 2
#: First words of class names that tell what a page has, not what the element is.
_STATES = frozenset("no not has with without".split())
#: Fixed value: words from which on a block that isn't mostly links is running text.
RUNNING = 10
#: Fixed value: what a sentence may end with.
_STOPS = ".!?…。\"”»"


def _hidden(attrs: dict[str, str | None]) -> bool:
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true" or (attrs.get("role") or "").lower() in ROLES:
        return True
    return bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or "", re.I))


def _named(attrs: dict[str, str | None], within: bool, words: frozenset[str] = MARKS) -> bool:
    """Whether a class or id is made of marking words, and fillers at most; within: inside an article or main element; words: one of these is needed."""
    for key in ("class", "id"):
        for x in (attrs.get(key) or "").split():
            name = [w.lower() for w in _WORDS.findall(x)]
            if not name or name[0] in _STATES:
                continue
            marks = [w for w in name if w in MARKS]
            if not words.isdisjoint(marks) and all(w in MARKS or w in FILLERS for w in name):
                if HEADS.issuperset(marks) and (within or not _PARTS.isdisjoint(set(name) - {"page", "main"})):
                    continue
                return True
    return False


def _running(text: str, links: int) -> bool:
    return 2 * links <= len(text) and len(text.split()) >= RUNNING


class _Block(NamedTuple):
    text: str
    tags: int
    box: int  # number of its container
    drop: int
    links: int  # characters of links
    heading: bool
    mark: int  # number of the mark it stands under, 0 if none
    within: bool  # inside an article or main element


class _Blocks(HTMLParser):
    """Collects blocks; containers (parent's number, tag) in page order; marks (the mark around each).

    A mark is an element that drops its blocks by its name or as a form. Blocks that are dropped for another reason, too,
    are HARDLY or have drop SOFT without a mark.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.links = 0
        self.stack: list[tuple[str, int, int, int]] = []  # tag, drop for reasons other than marks, container, mark
        self.depths: dict[str, list[int]] = defaultdict(list)  # places of each open tag in the stack
        self.containers: list[tuple[int, str]] = [(-1, "")]
        self.marks: list[int] = [-1]
        self.topical: set[int] = set()  # marks inside an article that may be its subject
        self.blocks: list[_Block] = []
        self.parts: list[str] = []
        self.tags = 0

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)

    def top(self) -> tuple[str, int, int, int]:
        return self.stack[-1] if self.stack else ("", KEEP, 0, 0)

    def depth_of(self, tags) -> int:
        """Place of the innermost open one of the tags, -1 if there is none."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=-1)

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                _, drop, box, mark = self.top()
                self.blocks.append(_Block(text, self.tags, box, drop, self.links, self.depth_of(HEADINGS) >= 0, mark, self.depth_of(ROOTS) >= 0))
                self.tags = 0
            self.parts = []
            self.links = 0

    def close_to(self, depth: int) -> None:
        if any(self.stack[k][0] not in INLINE for k in range(depth, len(self.stack))):
            self.flush()
        while len(self.stack) > depth:
            self.depths[self.stack.pop()[0]].pop()

    def close_open(self, tags, stops) -> None:
        depth = self.depth_of(tags)
        if depth > self.depth_of(stops):
            self.close_to(depth)

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
            return
        if tag not in INLINE:
            self.flush()
        if tag in VOID:
            return
        if tag in _P_ENDERS:
            self.close_open(("p",), ("table", "button", "object"))
        if tag in HEADINGS:
            self.close_open(HEADINGS, _P_ENDERS - HEADINGS)
        if tag in _CLOSES:
            closed, stops = _CLOSES[tag]
            self.close_open(closed.split(), stops)
        _, drop, box, mark = before = self.top()
        attrs = dict(attrs)
        within = self.depth_of(ROOTS) >= 0
        if tag in ROOTS:
            # An article in a part of another one, such as its comments, stays what that part is.
            drop, mark = (KEEP, 0) if not within and (drop == SOFT or (mark and drop == KEEP and not self.in_form())) else (drop, mark)
        if tag in HARD - {"form"} or (tag == "header" and not within):
            drop = HARDLY
        elif tag not in ("html", "body", "main") and drop != HARDLY:
            if tag != "form" and _hidden(attrs):
                drop = SOFT
            elif tag == "form" or _named(attrs, within):
                self.marks.append(mark)
                mark = len(self.marks) - 1
                if within and tag != "form" and not _named(attrs, within, MARKS - TOPICS):
                    self.topical.add(mark)
        if tag not in INLINE and tag not in ("p", "li", "html") and tag not in HEADINGS:
            self.containers.append((box, tag))
            box = len(self.containers) - 1
        if (drop, mark) != (before[1], before[3]):
            self.flush()
        self.depths[tag].append(len(self.stack))
        self.stack.append((tag, drop, box, mark))

    def in_form(self) -> bool:
        return self.depth_of(("form",)) >= 0

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        depth = self.depth_of((tag,))
        if depth < 0:
            if tag not in INLINE and tag not in VOID:
                self.flush()
            return
        around = self.stack[depth - 1] if depth else ("", KEEP, 0, 0)
        if (self.stack[depth][1], self.stack[depth][3]) != (around[1], around[3]):
            self.flush()
        self.close_to(depth)

    def handle_data(self, data):
        self.parts.append(data)
        if self.depths.get("a"):
            self.links += len("".join(data.split()))


def smooth(values: list[float], sigma: float = 1.0) -> list[float]:
    """Gaussian smoothing over neighbours within 3 sigma; the kernel is cut at the ends and scaled to what is left."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for j in range(max(0, i - reach), min(len(values), i + reach + 1)):
            w = kernel[abs(i - j)]
            total += w * values[j]
            weight += w
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """Cut between the two clusters of the values: the middle of their means, from repeated reassignment."""
    cut = sum(values) / len(values)
    for _ in range(20):
        low, high = [x for x in values if x < cut], [x for x in values if x >= cut]
        if not low or not high:
            return cut
        new = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(new - cut) < 1e-9:
            break
        cut = new
    return cut


def _believed(parser: _Blocks) -> set[int]:
    """The marks that aren't believed: from the outermost in, as long as no running text is left and one mark holds most of the page."""
    kept = [b for b in parser.blocks if b.drop == KEEP]
    inside: list[list[int]] = [[] for _ in parser.marks]
    size, direct, running, rooted = ([0] * len(parser.marks) for _ in range(4))
    for mark in range(1, len(parser.marks)):
        inside[parser.marks[mark]].append(mark)
    for b in kept:
        size[b.mark] += len(b.text)
        direct[b.mark] += _running(b.text, b.links)
        rooted[b.mark] += b.within
    total, running = sum(size), list(direct)
    for mark in range(len(parser.marks) - 1, 0, -1):
        size[parser.marks[mark]] += size[mark]
        running[parser.marks[mark]] += running[mark]
    # Running text in an article makes a part of it that a topic marks its text, if it is not in a part that isn't.
    ignored = {0}
    for mark in range(1, len(parser.marks)):
        if mark in parser.topical and parser.marks[mark] in ignored and direct[mark] >= RUNS:
            ignored.add(mark)
    if direct[0] or rooted[0]:
        return ignored
    heap = [(-size[m], m) for m in inside[0] if running[m]]
    heapify(heap)
    while heap:
        held, best = heappop(heap)
        if -2 * held <= total:
            break
        ignored.add(best)
        if direct[best] or rooted[best]:
            break
        for m in inside[best]:
            if running[m]:
                heappush(heap, (-size[m], m))
    return ignored


#: Pieces of markup without an end that are looked at, one after another, before what is left of a page is text.
UNFINISHED = 20


def _parsed(html: str) -> _Blocks:
    """The page's blocks. The parser stops at markup that doesn't end; its first sign is then a sign of text, and the rest is parsed again.

    A page can hold a great many of them, each of which the parser would follow to the end of the page: after UNFINISHED ones
    the rest is text.
    """
    parser = _Blocks()
    parser.feed(html)
    for k in range(UNFINISHED + 1):
        rest, at = parser.rawdata, parser.rawdata.find("<")
        if at < 0:
            break
        parser.rawdata = ""
        parser.feed(rest[:at] + "&lt;" + rest[at + 1 :] if k < UNFINISHED else rest.replace("<", "&lt;"))
    parser.close()
    parser.flush()
    return parser


def main_text(html: str, sigma: float = 1.0, share: float = 0.25) -> str:
    """The page's article text: blocks in page order, joined by two newlines; empty if there is none."""
    parser = _parsed(html)
    ignored = _believed(parser)
    blocks = [b for b in parser.blocks if b.drop == KEEP and b.mark in ignored]
    if not blocks:
        return ""
    ratios = smooth([len(b.text) / max(1, b.tags) for b in blocks], sigma)
    cut = threshold(ratios)
    mostly_links = [2 * b.links > len(b.text) for b in blocks]
    content = [_running(b.text, b.links) or (r >= cut and not x) for b, r, x in zip(blocks, ratios, mostly_links, strict=True)]
    containers = parser.containers
    held, full = [0] * len(containers), [False] * len(containers)
    for b, r, c in zip(blocks, ratios, content, strict=True):
        held[b.box] += len(b.text) if r >= cut else 0
        full[b.box] |= c
    own = list(held)
    for at in range(len(containers) - 1, 0, -1):
        held[containers[at][0]] += held[at]
        full[containers[at][0]] |= full[at]
    present = {b.box for b in blocks}
    roots = [at for at, (_, tag) in enumerate(containers) if tag in ROOTS]
    used = [False] * len(containers)  # holds blocks
    for at in range(len(containers) - 1, -1, -1):
        used[at] |= at in present
        if at:
            used[containers[at][0]] |= used[at]
    roots = [at for at in roots if used[at]]
    if roots:
        inner = [at for at in roots if containers[at][1] == "article"] or roots
        if max(held[at] for at in inner) < share * max(held[at] for at in roots):
            inner = [at for at in roots if containers[at][1] == "main"] or inner
        chosen = {at for at in inner if full[at]} or set(inner)
        under = [False] * len(containers)
        for at in range(len(containers)):
            under[at] = at in chosen or (at > 0 and under[containers[at][0]])
        return "\n\n".join(b.text for b in blocks if under[b.box])
    # No article element: the clusters of content and what is between the first and the last of them in the region that
    # holds most, from the container with the most content up, as long as the one around it holds clearly more.
    best = max(present, key=lambda at: (own[at], -at))
    while containers[best][0] >= 0 and held[containers[best][0]] >= (1 + share) * held[best]:
        best = containers[best][0]
    under = [False] * len(containers)
    for at in range(len(containers)):
        under[at] = at == best or (at > 0 and under[containers[at][0]])
    # Smoothing lifts a label next to a long block too: where there is running text, it marks the clusters' ends.
    strong = [_running(b.text, b.links) for b in blocks]
    content = strong if any(strong) else content
    spots = [i for i, (b, c) in enumerate(zip(blocks, content, strict=True)) if c and under[b.box]] or [i for i, c in enumerate(content) if c]
    if not spots:
        return "\n\n".join(b.text for b in blocks)
    boxes = {b.box for b, c in zip(blocks, content, strict=True) if c and containers[b.box][1] not in ("", "body")}
    inside = []
    for i, (b, c, x) in enumerate(zip(blocks, content, mostly_links, strict=True)):
        between = spots[0] <= i <= spots[-1] and under[b.box]
        # Beyond the clusters only what shares a container with content, or is a sentence of the region.
        ends = under[b.box] and b.text[-1] in _STOPS and i > spots[0]
        inside.append(c or (not x and (between or b.box in boxes or ends)))
    for i in range(len(blocks) - 2, -1, -1):
        inside[i] = inside[i] or (blocks[i].heading and inside[i + 1])
    return "\n\n".join(b.text for b, x in zip(blocks, inside, strict=True) if x)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points of text) for every page.

    One row per input row, with no shuffle. Null html counts as empty and gives an empty text; pages without article text
    too; repeated rows stay; an empty table gives an empty result; other columns are not read. Pages of any length and depth
    are read whole, in time in proportion to their length, markup without an end included.
    """

    def each(batches):
        for batch in batches:
            got = [main_text(html) for some in texts(batch.column(2)) for html in some]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, pa.string()), pa.array([len(x) for x in got], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")).mapInArrow(each, "page_id long, url string, text string, n_chars long")
