"""Main text of web pages by tag-path ratios.

A page is read as a sequence of blocks (runs of text between block-level tags), each with its tag path from the root.
Per path, text lengths and punctuation marks of its blocks are smoothed along the page (within the path only) and
averaged; their product, lessened by the share of link text, is the path's ratio (fused). The path with the most text,
weighted by ratio, is the page's main path.

What does not look like content weighs less: classes and ids with words of menus, adverts, comments and the like a tenth,
or a thousandth if they hold no other word; forms a hundredth. Such a mark never counts on an ancestor of the main path,
nor, unless it holds no other word, on an element around two thirds of the page's text. Menus, footers, asides, page
headers and dialogues by element or role weigh nothing; controls, scripts, styles and hidden elements are not read.

Prose elements (paragraphs, headings, lists, tables) stand and fall with the innermost other element around them, their
group. The unmarked prose of groups on the main path, up to the nearest ``article`` or ``main`` above it, is content,
however short, and so is loose text of that element. Any other path is content if its ratio (of prose, its group's: the
mean over the characters of its prose) times its weight reaches ``INSIDE`` of the main one below the outermost of these
groups, and ``OUTSIDE`` of it elsewhere. Paths that are mostly link text are none. White space inside a block becomes one
space (a line break counts as white space), blocks are trimmed and joined by one line feed.

Defined cases: null counts as empty; a page without text, or with nothing but menus, footers and the like by element or
role, gives the empty text; if every text stands under marked classes, the marks around the best of them do not count;
broken or cut mark-up is read like a browser does as far as blocks go (open elements end with the page, stray end tags
are skipped). Long and deep pages are read whole, in time and memory linear in their size. Repeated rows are read each.
An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from doclake.llm.common import map_arrow

#: Elements without an end tag.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements inside a line of text.
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rp rt s samp small span "
    "strike strong sub sup time tt u var".split()
)
#: Elements that are not read.
UNREAD = set(
    "audio button canvas datalist fieldset head iframe input label legend map meter noscript object optgroup option output "
    "progress script search select style svg template textarea title video".split()
)
#: Elements that are never content.
NOT_CONTENT = set("aside dialog footer menu nav".split())
#: Elements that text is laid out with.
PROSE = set(
    "address blockquote caption dd details dl dt figcaption figure h1 h2 h3 h4 h5 h6 hgroup li ol p pre summary table tbody "
    "td tfoot th thead tr ul".split()
)
#: Roles, and words of classes and ids, of what is not content.
ROLES = set("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
MARKS = set(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie "
    "cookies copyright disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices notification pager "
    "pagination popup promo promoted promotion recommended related replies reply respond share sharing sidebar signup skip "
    "social sponsor sponsored subscribe subscription toc toolbar topbar widget widgets".split()
)
#: What a start tag ends if it is open.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
#: Elements that an implied end does not reach out of.
SCOPES = set("article aside body div dl footer form header html main nav ol section table td th ul".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PUNCTUATION = re.compile(r"[.,;:!?…](?=[\s\"'»”’)\]]|$)|[。，、؛،]")  # of sentences: not inside of numbers and addresses
WORD_OF_CLASS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
INSIDE, OUTSIDE = 0.3, 1.0  # thresholds: a path apart from the main text must be as much like an article
SPREAD = 1.0  # blocks, of the Gaussian
WRAPPER = 2 / 3  # of the text: an element around more is no menu, whatever its class
PLAIN, NAMED, FORM, ONLY_NAMED, NEVER = range(5)  # what speaks against an element
WEIGHT = {PLAIN: 1.0, NAMED: 0.1, FORM: 0.01, ONLY_NAMED: 0.001, NEVER: 0.0}


class Block(NamedTuple):
    path: int
    text: str
    links: int  # characters of it inside links


class Paths:
    """Tag paths as numbers: a path is its parent and one more step, 0 is the root. Parents come before children."""

    def __init__(self):
        self.parent, self.tag, self.mark = [0], [""], [PLAIN]
        self.known: dict[tuple[int, str, int], int] = {}

    def below(self, parent: int, tag: str, step: str, mark: int) -> int:
        path = self.known.setdefault((parent, step, mark), len(self.parent))
        if path == len(self.parent):
            self.parent.append(parent)
            self.tag.append(tag)
            self.mark.append(mark)
        return path

    def above(self, path: int) -> list[int]:
        """The path and its ancestors, innermost first, without the root."""
        out = []
        while path:
            out.append(path)
            path = self.parent[path]
        return out


class BlockReader(HTMLParser):
    """Collects the blocks of a page with their paths."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.paths = Paths()
        self.open: list[tuple[str, int, bool]] = []  # tag, path, whether unread
        self.places: dict[str, list[int]] = defaultdict(list)  # of the open elements, by tag
        self.unread = 0  # open elements that are not read
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.links = 0

    def _end_block(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            self.blocks.append(Block(self.open[-1][1] if self.open else 0, text, min(self.links, len(text))))
        self.pieces, self.links = [], 0

    def _pop(self, at: int) -> None:
        if any(tag not in INLINE for tag, _, _ in self.open[at:]):
            self._end_block()
        for tag, _, unread in self.open[at:]:
            self.places[tag].pop()
            self.unread -= unread
        del self.open[at:]

    def _innermost(self, tags: set[str]) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=-1)

    def _nearest(self, tags: set[str], scopes: set[str]) -> int | None:
        at = self._innermost(tags)
        return at if at >= 0 and at >= self._innermost(scopes) else None

    def _is_unread(self, tag: str, given: dict[str, str | None]) -> bool:
        return tag in UNREAD or "hidden" in given or "display:none" in (given.get("style") or "").replace(" ", "").lower()

    def _mark(self, tag: str, given: dict[str, str | None]) -> int:
        if tag in ("html", "body", "main", "article"):
            return PLAIN
        if tag in NOT_CONTENT or (given.get("role") or "").lower() in ROLES:
            return NEVER
        if tag == "header" and not self.places.get("article") and not self.places.get("main"):
            return NEVER
        if tag == "form" or (given.get("role") or "").lower() == "form":
            return FORM
        mark = PLAIN
        for name in f"{given.get('class') or ''} {given.get('id') or ''}".split():
            marked = [w.lower() in MARKS for w in WORD_OF_CLASS.findall(name)]
            if any(marked):
                mark = max(mark, ONLY_NAMED if all(marked) else NAMED)
        return mark

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "hr":
                self._end_block()
            elif tag == "br":
                self.pieces.append(" ")
            return
        if tag not in INLINE:
            self._end_block()
            if (at := self._nearest({"p"}, SCOPES)) is not None:
                self._pop(at)
            ends = HEADINGS if tag in HEADINGS else ENDS.get(tag, set())
            if ends and (at := self._nearest(ends, SCOPES - ends)) is not None:
                self._pop(at)
        given = dict(attrs)
        path = self.open[-1][1] if self.open else 0
        if tag not in INLINE:
            step = ".".join([tag, *sorted((given.get("class") or "").split())])
            path = self.paths.below(path, tag, step, self._mark(tag, given))
        unread = self._is_unread(tag, given)
        self.places[tag].append(len(self.open))
        self.open.append((tag, path, unread))
        self.unread += unread

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open and self.open[-1][0] == tag:
            self._pop(len(self.open) - 1)

    def handle_endtag(self, tag):
        if tag == "br":
            self.pieces.append(" ")
        elif (at := self._nearest({tag}, set() if tag not in INLINE else SCOPES)) is not None:
            self._pop(at)

    def handle_data(self, data):
        if not self.unread:
            self.pieces.append(data)
            if self.places.get("a"):
                self.links += len(data.strip())

    def finish(self, html: str) -> list[Block]:
        self.feed(html)
        self.close()
        self._end_block()
        return self.blocks


def _smooth(values: np.ndarray) -> np.ndarray:
    reach = np.arange(-3, 4)
    kernel = np.exp(-(reach**2) / (2 * SPREAD**2))
    weight = np.convolve(np.ones(len(values)), kernel)[3:-3]
    return np.convolve(values, kernel)[3:-3] / weight


def _weights(paths: Paths, size: dict[int, float], ignored: set[int]) -> list[float]:
    """Product of the weights of the elements of every path. ``size`` has the text of each path without links."""
    held = [size.get(p, 0.0) for p in range(len(paths.parent))]
    for p in range(len(held) - 1, 0, -1):
        held[paths.parent[p]] += held[p]
    out = [1.0]
    for p in range(1, len(held)):
        mark = paths.mark[p]
        wrapper = mark in (NAMED, FORM) and held[p] > WRAPPER * held[0]
        out.append(out[paths.parent[p]] * (1.0 if wrapper or p in ignored and mark != NEVER else WEIGHT[mark]))
    return out


def main_text(html: str | None) -> str:
    """The content blocks of a page, one per line."""
    reader = BlockReader()
    blocks, paths = reader.finish(html or ""), reader.paths
    members: dict[int, list[int]] = defaultdict(list)
    for i, block in enumerate(blocks):
        members[block.path].append(i)
    lengths = np.array([len(b.text) for b in blocks], float)
    marks = np.array([len(PUNCTUATION.findall(b.text)) for b in blocks], float)
    links = np.array([b.links for b in blocks], float)
    size, linked, fused = {}, {}, {}
    for path, own in members.items():
        size[path] = lengths[own].sum()
        linked[path] = links[own].sum() / size[path]
        # A trace of a mark, so that length still counts; a trace of a link, so that pages of links have a main path
        fused[path] = _smooth(lengths[own]).mean() * (_smooth(marks[own]).mean() + 0.01) * (1.001 - linked[path])
    unlinked = {p: size[p] * (1 - linked[p]) for p in size}
    weight = _weights(paths, unlinked, set())
    top = max(size, key=lambda p: (fused[p] * size[p] * weight[p], -members[p][0]), default=None)
    if top is None or not weight[top]:
        return ""
    on_main = paths.above(top)
    weight = _weights(paths, unlinked, set(on_main))
    group = [0]
    for p in range(1, len(paths.parent)):
        group.append(group[paths.parent[p]] if paths.tag[p] in PROSE else p)
    depth = next((i for i, p in enumerate(on_main) if paths.tag[p] in ("article", "main")), None)
    region = group[top] if depth is None else on_main[depth]
    inside = {group[p] for p in (on_main[: depth + 1] if depth is not None else on_main[:1] or [0])}
    below = [False]
    for p in range(1, len(paths.parent)):
        below.append(paths.parent[p] == region or below[paths.parent[p]])
    ratio = dict(fused)
    of_group: dict[int, list[int]] = defaultdict(list)
    for p in size:
        if group[p] != p:
            of_group[group[p]].append(p)
    for own in of_group.values():
        mean = sum(fused[p] * size[p] for p in own) / sum(size[p] for p in own)
        ratio.update(dict.fromkeys(own, mean))

    def content(p: int) -> bool:
        if p == top:
            return True
        if linked[p] > 0.5:
            return False
        if weight[p] == 1.0 and group[p] in inside and (group[p] != p or paths.tag[p] in ("article", "main")):
            return True
        return weight[p] * ratio[p] >= (INSIDE if below[p] else OUTSIDE) * fused[top]

    kept = {p for p in size if content(p)}
    return "\n".join(b.text for b in blocks if b.path in kept)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(h) for h in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    narrow = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    return map_arrow(narrow, _extracted, "page_id long, url string, text string, n_chars long")
