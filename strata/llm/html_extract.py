"""Main text of web pages by consensus host paths.

Each page's containers are scored by how much of the page's running text they hold and how
little else. A container's path is generalised (tags and classes, digits replaced), and the
scores are votes: Spark sums them for each path of a host. Pages are then read again, each
with the paths that its host elected, so that a page whose own scores mislead (a short article
under long comments) still gives the part that its host's pages agree on.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ship_package
from strata.session import materialize

#: Paths that a host elects; a page that has none of them follows its own scores.
WINNERS = 64
#: Votes are whole numbers, so that their sums do not depend on the order of adding.
VOTE = 10_000
#: Labels of a path that are kept readable; a deeper path carries a hash of what is above.
READABLE = 12

# Groups of HTML elements.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp noembed noframes iframe noscript".split())
CONTAINERS = frozenset("body div section article main td center".split())
BLOCKS = CONTAINERS | frozenset(
    "address aside blockquote caption dd details dialog dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr li menu nav ol optgroup option p pre search "
    "select summary table tbody tfoot th thead tr ul".split()
)
NEVER_TEXT = frozenset(
    "nav footer aside form script style noscript template iframe object svg canvas audio "
    "video button select input textarea dialog menu search map datalist noembed noframes".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN = frozenset(("article", "main"))
#: An open element of the key's group ends where one of the values' group begins.
ENDED_BY = {
    "li": frozenset(("li",)),
    "dt": frozenset(("dt", "dd")),
    "dd": frozenset(("dt", "dd")),
    "tr": frozenset(("tr", "tbody", "thead", "tfoot")),
    "td": frozenset(("td", "th", "tr", "tbody", "thead", "tfoot")),
    "th": frozenset(("td", "th", "tr", "tbody", "thead", "tfoot")),
    "option": frozenset(("option", "optgroup")),
}
#: Tags that only frame the page: a missing end of theirs must not swallow what follows.
FRAME = frozenset("html head body".split())
#: Open elements; what is nested deeper lies beside the deepest, as in browsers.
DEEPEST = 512
#: What closes no further out than these.
SCOPES = frozenset("ul ol dl table select".split())

# Words of class names and ids that tell what a part of a page is for.
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored "
    "sponsors promo promoted promotion banner sidebar aside widget widgets rail menu navbar nav "
    "navigation breadcrumb breadcrumbs header masthead topbar footer cookie cookies consent gdpr "
    "notice notices alert alerts newsletter subscribe subscription signup login share sharing "
    "social related recommended recommendations comment comments commentlist respond disqus reply "
    "replies discussion popup modal overlay pagination pager toolbar search paywall skip tooltip "
    "copyright disclaimer".split()
)
MAIN_WORDS = frozenset("article post entry story content main body text".split())
SIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog menu menubar "
    "toolbar".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^<>\"']*+(?:(?:\"[^\"<]*+\"|'[^'<]*+')[^<>\"']*+)*+|[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_NUMBERED = re.compile(r"[a-z0-9]*\d[a-z0-9]*")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


#: How far an element is from the running text: none of it, all but headings, or within.
SIDE, HEADINGS_ONLY, RUNNING = 2, 1, 0


class _Element:
    __slots__ = (
        "tag", "parent", "path", "words", "role", "never", "link",
        "main", "titled", "headed", "side", "content", "junk",
    )

    def __init__(self, tag: str, parent: int, path: tuple[str, ...] | None):
        self.tag, self.parent, self.path = tag, parent, path
        #: Words of class names and id; whether the role names a side part.
        self.words: list[list[str]] = []
        self.role = self.never = self.link = False
        #: Whether an article, a first heading or any heading is it or lies in it.
        self.main = self.titled = self.headed = False
        self.side = RUNNING
        self.content = self.junk = 0

    def named_aside(self) -> bool:
        """Side by its names. Of an article only the first word of a name counts: further
        ones tell its subject."""
        if self.tag in MAIN:
            return any(words[0] in SIDE_WORDS for words in self.words)
        return any(_is_side(words) for words in self.words)


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    return found


def _words(name: str) -> list[str]:
    return [part.lower() for part in _NAME_PARTS.findall(name)]


def _label(tag: str, classes: str, own_id: str) -> str:
    """The tag with its classes, or its id where it has none; numbered parts as ``#``."""
    names = sorted({_NUMBERED.sub("#", name) for name in (classes or own_id).lower().split()})
    return ".".join([tag, *names])


def _longer(path: tuple[str, ...], label: str) -> tuple[str, ...]:
    if len(path) < READABLE:
        return (*path, label)
    return (f"{_hash(path[0], path[1]):x}", *path[2:], label)


def _hash(*parts: str) -> int:
    value = 0xCBF29CE484222325
    for byte in "\0".join(parts).encode():
        value = (value ^ byte) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return value


class Page:
    """A page's block elements in page order, and its pieces of text.

    A piece is (element, block number, text): pieces of one block number run on.
    """

    def __init__(self, html: str):
        self.elements = [_Element("html", -1, ("body",))]
        self.pieces: list[tuple[int, int, str]] = []
        self._open = [0]
        self._block = 0
        self._read(html)
        self._weigh()

    # --- reading

    def _read(self, html: str) -> None:
        at, length = 0, len(html)
        while at < length:
            token = _TOKEN.search(html, at)
            if not token:
                # A tag that the page's end cuts off is no text.
                cut = re.search(r"<[a-zA-Z/!?]", html[at:])
                self._text(html[at : at + cut.start()] if cut else html[at:])
                break
            if token.start() > at:
                self._text(html[at : token.start()])
            at = token.end()
            if not token[2]:
                continue
            tag = token[2].lower()
            if token[1]:
                self._end(tag)
                continue
            self._start(tag, token[3])
            if tag in RAW:
                closing = re.compile(f"</{re.escape(tag)}[^>]*>", re.IGNORECASE).search(html, at)
                at = closing.end() if closing else length
                self._end(tag)

    def _text(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        if text:
            self.pieces.append((self._open[-1], self._block, text))

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.pieces.append((self._open[-1], self._block, " "))
            return
        if tag in FRAME:
            self._block += 1
            return
        if tag in BLOCKS:
            self._close_implied(tag)
            self._block += 1
        elif tag == "a":
            self._end("a")
        if tag in VOID:
            return
        if len(self._open) > DEEPEST:
            self._open.pop()
        parent = self._open[-1]
        element = _Element(tag, parent, None)
        element.link = self.elements[parent].link or tag == "a"
        element.never = tag in NEVER_TEXT
        found: dict[str, str] = {}
        if attributes and attributes.strip(" /"):
            found = _attributes(attributes)
            names = [*found.get("class", "").split(), found.get("id", "")]
            element.words = [words for words in map(_words, names) if words]
            role = found.get("role", "").lower()
            element.role = role in SIDE_ROLES
            element.never |= "hidden" in found or bool(_HIDDEN.search(found.get("style", "")))
            element.main = role == "main"
        element.main |= tag in MAIN and not element.named_aside()
        element.titled, element.headed = tag == "h1", tag in HEADINGS
        if tag in CONTAINERS:
            label = _label(tag, found.get("class", ""), found.get("id", ""))
            element.path = _longer(self._path_above(parent), label)
        self._open.append(len(self.elements))
        self.elements.append(element)

    def _path_above(self, at: int) -> tuple[str, ...]:
        while self.elements[at].path is None:
            at = self.elements[at].parent
        return self.elements[at].path

    def _close_implied(self, tag: str) -> None:
        """What an opening block element ends: a paragraph, or an element of its own kind."""
        for depth in range(len(self._open) - 1, 0, -1):
            open_tag = self.elements[self._open[depth]].tag
            if open_tag == "p" or tag in ENDED_BY.get(open_tag, ()):
                del self._open[depth:]
                return
            if open_tag in SCOPES or open_tag in CONTAINERS:
                return

    def _end(self, tag: str) -> None:
        block = tag in BLOCKS
        if block:
            self._block += 1
        for depth in range(len(self._open) - 1, 0, -1):
            open_tag = self.elements[self._open[depth]].tag
            if open_tag == tag:
                del self._open[depth:]
                return
            if not block and open_tag in BLOCKS:
                return

    # --- weighing

    def _weigh(self) -> None:
        """What is beside the running text; running and other text under every element."""
        elements = self.elements
        for element in reversed(elements[1:]):
            above = elements[element.parent]
            above.main |= element.main
            above.titled |= element.titled
            above.headed |= element.headed
        for element in elements[1:]:
            element.side = self._side(element, elements[element.parent].side)
        for at, _, text in self.pieces:
            element = elements[at]
            if element.side or element.link:
                element.junk += len(text.strip())
            else:
                element.content += len(text.strip())
        for element in reversed(elements[1:]):
            above = elements[element.parent]
            above.content += element.content
            above.junk += element.junk

    def _side(self, element: _Element, above: int) -> int:
        if above == SIDE or element.never or (element.role and not element.main):
            return SIDE
        aside = element.named_aside() and not element.main
        if element.tag == "header" or (aside and any("header" in w for w in element.words)):
            return HEADINGS_ONLY if element.headed and self._in_main(element) else SIDE
        # Around the page's title names tell of a layout, such as one with a sidebar.
        if aside and not element.titled:
            return SIDE
        return RUNNING if element.tag in HEADINGS else above

    def _in_main(self, element: _Element) -> bool:
        """Whether the element lies in an article or names itself after one."""
        while element.parent >= 0:
            if element.tag in MAIN or any(MAIN_WORDS.intersection(w) for w in element.words):
                return True
            element = self.elements[element.parent]
        return False

    def scores(self) -> dict[str, int]:
        """The generalised paths of the page's containers, with their votes.

        The share of the page's running text that a path's elements hold, times the square of
        its share of all their text, by what tag and names promise.
        """
        sums: dict[tuple[str, ...], list[int]] = defaultdict(lambda: [0, 0])
        for element in self.elements:
            if element.path is not None and not element.side and element.content:
                own = sums[element.path]
                own[0] += element.content
                own[1] += element.junk
        total = self.elements[0].content
        found = {}
        for path, (content, junk) in sums.items():
            pure = content / (content + junk)
            score = content / total * pure * pure * _promise(path)
            found["/".join(path)] = round(VOTE * score)
        return found

    # --- extracting

    def text(self, path: str | None) -> str:
        """The running text of the elements of a path: blocks joined by one blank."""
        if path is None:
            return ""
        inside: list[bool] = []
        for element in self.elements:
            own = element.path is not None and "/".join(element.path) == path
            above = element.parent >= 0 and inside[element.parent]
            inside.append(own or above)
        blocks: list[str] = []
        last = None
        for at, block, text in self.pieces:
            if not inside[at] or self.elements[at].side:
                continue
            if block == last:
                blocks[-1] += text
            else:
                blocks.append(text)
                last = block
        return " ".join(" ".join(blocks).split())


def _is_side(words: list[str]) -> bool:
    return any(
        word in SIDE_WORDS and not (i and words[i - 1] in ("has", "with", "no", "without"))
        for i, word in enumerate(words)
    )


def _promise(path: tuple[str, ...]) -> float:
    tag, *names = path[-1].split(".")
    if tag == "article":
        return 1.5
    if tag == "main":
        return 1.3
    if path == ("body",):
        return 0.7
    return 1.2 if any(MAIN_WORDS.intersection(_words(name)) for name in names) else 1.0


def choose(scores: dict[str, int], winners: dict[str, int]) -> str | None:
    """The page's path that its host rates highest, or its own best where none was elected."""
    rated = {path: winners[path] for path in scores if path in winners} or scores
    # Equal ratings go to the longer path, the inner of two containers.
    return max(rated, key=lambda path: (rated[path], path.count("/"), path), default=None)


# --- over tables -----------------------------------------------------------------------


def host(url: str) -> Column:
    """The host of an address, lower-cased; null where there is none."""
    found = F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.lower(found), F.lit(""))


def container_votes(pages: DataFrame) -> DataFrame:
    """(host, path, votes, pages): the votes of each host's pages for each path.

    Summed within each batch first, and before the shuffle again, so a host that holds a
    third of all pages sends a few rows from each task.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
            hosts = batch.column(0).to_pylist()
            for name, html in zip(hosts, batch.column(1), strict=True):
                for path, score in Page(html.as_py() or "").scores().items():
                    own = sums[name, path]
                    own[0] += score
                    own[1] += 1
            rows = [(*key, *own) for key, own in sums.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["host", "path", "votes", "pages"],
            )

    ship_package(pages.sparkSession)
    hosted = pages.select(host("url").alias("host"), "html").where("host IS NOT NULL")
    votes = hosted.mapInArrow(vote, "host string, path string, votes long, pages long")
    return votes.groupBy("host", "path").agg(
        F.sum("votes").alias("votes"), F.sum("pages").alias("pages")
    )


def host_winners(votes: DataFrame, most: int = WINNERS) -> DataFrame:
    """(host, paths, ratings): each host's paths of the highest ratings.

    A rating is the sum of votes over the number of pages that have the path, plus one: a
    path of a single odd page does not beat what hundreds agree on. Ranking keeps the first
    rows of each task before its shuffle, so no task holds all paths of a host.
    """
    rating = F.floor(F.lit(1000) * F.col("votes") / (F.col("pages") + 1))
    rank = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("rating"), "path"))
    best = votes.withColumn("rating", rating).withColumn("rank", rank).where(F.col("rank") <= most)
    return best.groupBy("host").agg(
        F.map_from_entries(F.collect_list(F.struct("path", "rating"))).alias("winners")
    )


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): the main text of every page, empty where there is none.

    Blocks of the chosen container are joined by one blank, white space is one blank,
    character references are decoded; navigation, headers, footers, side parts, notices,
    adverts, forms, scripts, styles and comments are left out by tag, role and name. Null
    html is an empty page. A page whose url is null or has no host, or whose host elected no
    path that the page has, goes by its own scores. Every row gives one row, also where ids
    are null or repeated; other columns are not read; an empty table gives an empty table.

    The table of winners is written first: Spark knows its bytes and sends it to the pages
    where it is small; else both sides are shuffled, and a host of very many pages is split.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, winners in zip(batch.column(2), batch.column(3), strict=True):
                page = Page(html.as_py() or "")
                texts.append(page.text(choose(page.scores(), dict(winners.as_py() or ()))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    winners = materialize(host_winners(container_votes(pages)), "host-paths")
    joined = pages.select("page_id", "url", "html", host("url").alias("host")).join(
        winners, "host", "left"
    )
    kinds = dict(pages.dtypes)
    return joined.select("page_id", "url", "html", "winners").mapInArrow(
        extract, f"page_id {kinds['page_id']}, url string, text string"
    )
