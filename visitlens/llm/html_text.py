"""Main text of web pages by consensus paths of their hosts.

A page is read once into elements and blocks of text. Each element that holds text outside of
boilerplate is a container, scored by the text below it that is not in links, less the further
away it lies. In Spark, the containers' generalised paths (tags and classes without
digits) are voted on per host with the scores as shares of the page; each host's winning path
is joined back, and every page is extracted again: the blocks below the elements of
that path, or of the page's own best container where the path does not occur.

Boilerplate: elements whose tag or class says so (menus, page headers, footers, sidebars,
notices, adverts, forms, reader comments), scripts, styles, hidden elements, comments. A class or id
says so as a whole, by its first part ("sidebar-left") or by its last after a known place ("site-footer"),
not if it tells a state ("has-sidebar", "menu-open") or an article ("social-article"). article and main are only
dropped where hidden or by their role. Nothing is thrown away while reading: an element of a kind that may stand
around a whole page (a form or dialog around everything, a sidebar layout) is taken back where it holds
nearly all of the page's text.

Defined cases: a null or empty html gives an empty text; a null url belongs to the host ''; broken
markup is read as far as it goes (unclosed elements end with their parents, unclosed anchors with the block
they stand in, a drawing or object without an end is read as if it was not there, stray end tags are ignored);
equal rows are treated alike; of paths with equal votes the first in order wins; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import SMALL_ROWS, on_workers
from visitlens.operators.skew import find_heavy_keys, left_join
from visitlens.session import cut_lineage

#: Elements that break blocks, and words in tags, classes and ids that mark boilerplate.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED_TAGS = frozenset("aside button dialog footer form head menu nav search".split())
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer gdpr login menu modal nav navbar navigation newsletter notice notices notification pagination pager popup promo "
    "promotion related respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
PLACES = frozenset("article blog bottom entry global main mobile page post primary secondary site top user".split())
STATES = frozenset(
    "active closed collapsed disabled enabled expanded free had has hide hides inactive is layout no non none not off on only open opened "
    "required show shows visible with without".split()
)
DROPPED_ROLES = frozenset("alert banner complementary contentinfo dialog form menu navigation search".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
STOPS = frozenset("ul ol dl table menu".split())
HEADERS = frozenset(("header", "masthead"))
MAIN = frozenset(("article", "main"))
#: Elements whose inside is no text of the page; of these the first go on to the end of the page if unclosed.
RAW = frozenset("script style noscript template svg iframe textarea select object canvas math".split())
OPEN_ENDED = frozenset(("script", "style"))
#: Tags and words that may stand around a whole page, with the share of its text outside links from which an
#: element of that kind is taken back. All others stay boilerplate.
DOUBTFUL = {
    0.75: (frozenset("dialog form header".split()), frozenset("header login masthead signup toolbar".split())),
    0.95: (frozenset(["aside"]), frozenset("modal popup sidebar widget".split())),
}
NEVER = 2.0
ARTICLES = frozenset(("article", "story"))
NOT_THE_ARTICLE = frozenset("ad ads advert promo promotion related sponsor sponsored".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][\w:-]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-z][\w:-]*)(?P<attributes2>[^>]*+)>"
    r"|<[!?][^>]*+>",
    re.IGNORECASE | re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
WORD = re.compile(r"[a-z]+")


def says(tokens: list[str], words: frozenset[str]) -> bool:
    """Whether one of the classes or ids names one of the words."""
    for token in tokens:
        parts = WORD.findall(token)
        if not ARTICLES.isdisjoint(parts) and parts[-1] not in words and parts[0] not in NOT_THE_ARTICLE:
            continue
        if parts and (parts[0] in words or parts[-1] in words and parts[0] in PLACES) and STATES.isdisjoint(parts):
            return True
    return False


class Page:
    """Elements (name, parent) and blocks (element, text, characters in links) of a page."""

    def __init__(self, source: str):
        self.names: list[str] = []
        self.tags: list[str] = []
        self.parents: list[int] = []
        self.blocks: list[tuple[int, str, str, int]] = []
        self._marks: list[float] = []  # the share of the text from which a boilerplate element is taken back; 0: it is none
        self._stack: list[int] = []
        self._text: list[str] = []
        self._links = 0
        self._link_depth: int | None = None  # of the stack where an open anchor started
        self._read(source)
        self._settle()

    def _read(self, source: str) -> None:
        at, unclosed = 0, set()
        while (m := TOKEN.search(source, at)) is not None:
            if m.start() > at:
                self._add(source[at : m.start()])
            at = m.end()
            tag = m["tag"] or m["tag2"]
            if tag is None:
                continue
            tag, attributes = tag.lower(), m["attributes"] or m["attributes2"] or ""
            if m["end"] or m["end2"]:
                self._end(tag)
            elif tag in RAW:
                end = None if tag in unclosed else re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(source, at)
                if end is not None:
                    at = end.end()
                elif tag in OPEN_ENDED:
                    at = len(source)
                else:
                    unclosed.add(tag)
            else:
                self._start(tag, attributes)
        self._add(source[at:])
        self._flush()

    def _add(self, text: str) -> None:
        self._text.append(text)
        if self._link_depth is not None:
            self._links += len(text)

    def _flush(self) -> None:
        if not self._text:
            return
        text = " ".join(entities.unescape("".join(self._text)).split())
        if text:
            at = self._stack[-1] if self._stack else -1
            self.blocks.append((at, self.tags[at] if at >= 0 else "", text, min(self._links, len(text))))
        self._text, self._links = [], 0

    def _start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self._add(" ")
            return
        found = {}
        if attributes:
            for k, v in ATTRIBUTE.findall(attributes):
                found.setdefault(k.lower(), v.strip("\"'").lower())
        if tag == "a":  # a new anchor ends an open one; one without a target is a mark in the text
            self._link_depth = len(self._stack) if "href" in found else None
        mark = self._boilerplate(tag, found)
        if tag not in BLOCKS and not mark or tag in VOID:
            if tag == "hr":
                self._flush()
            return
        self._flush()
        self._close_implied(tag)
        words = " ".join(WORD.findall(found.get("class", "")))
        self.names.append(f"{tag}.{words.replace(' ', '.')}" if words else tag)
        self.tags.append(tag)
        self.parents.append(self._stack[-1] if self._stack else -1)
        self._marks.append(mark)
        self._stack.append(len(self.tags) - 1)

    def _boilerplate(self, tag: str, found: dict[str, str]) -> float:
        """0 if the element is none, else the share of the page's text from which it is taken back."""
        if tag in ("html", "body"):
            return 0.0
        if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", ""):
            return NEVER
        named = f"{found.get('class', '')} {found.get('id', '')}"
        tokens = [] if tag in MAIN else named.split()
        dropped = tag in DROPPED_TAGS or says(tokens, DROPPED_WORDS) or found.get("role") in DROPPED_ROLES
        if not dropped and (tag == "header" or says(tokens, HEADERS)):
            dropped = not any(self.tags[i] in MAIN for i in self._stack) and not {"article", "post", "entry", "story"} & set(WORD.findall(named))
        if not dropped:
            return 0.0
        for share, (tags, words) in DOUBTFUL.items():
            if not says(tokens, DROPPED_WORDS - words) and (tag in tags or tag not in DROPPED_TAGS and says(tokens, words)):
                return share
        return NEVER

    def _settle(self) -> None:
        """Decide what is boilerplate: marked elements and all below them, but for those taken back."""
        count = range(len(self.tags))
        firm = [False] * len(self.tags)
        for e in count:
            firm[e] = self._marks[e] == NEVER or (self.parents[e] >= 0 and firm[self.parents[e]])
        worth, total = [0] * len(self.tags), 0  # text outside links that may be the page's own
        for at, _, text, links in self.blocks:
            if at < 0 or not firm[at]:
                total += len(text) - links
                if at >= 0:
                    worth[at] += len(text) - links
        for e in reversed(count):
            if self.parents[e] >= 0:
                worth[self.parents[e]] += worth[e]
        self._dropped = firm
        for e in count:
            back = total > 0 and worth[e] >= self._marks[e] * total
            self._dropped[e] = firm[e] or (self._marks[e] > 0 and not back) or (self.parents[e] >= 0 and self._dropped[self.parents[e]])
        self.blocks = [b for b in self.blocks if b[0] < 0 or not self._dropped[b[0]]]

    def _close_implied(self, tag: str) -> None:
        """A block ends an open paragraph; items and cells end the one before them."""
        if self._stack and self.tags[self._stack[-1]] == "p":
            self._stack.pop()
        ends = CLOSED_BY.get(tag)
        if ends:
            for depth in range(len(self._stack) - 1, -1, -1):
                open_tag = self.tags[self._stack[depth]]
                if open_tag in ends:
                    del self._stack[depth:]
                elif open_tag in STOPS:
                    break

    def _end(self, tag: str) -> None:
        if tag == "a":
            self._link_depth = None
        for depth in range(len(self._stack) - 1, -1, -1):
            if self.tags[self._stack[depth]] == tag:
                self._flush()
                del self._stack[depth:]
                if self._link_depth is not None and depth < self._link_depth:
                    self._link_depth = None
                return

    def path(self, element: int) -> str:
        names = []
        while element >= 0:
            names.append(self.names[element])
            element = self.parents[element]
        return ">".join(reversed(names))

    def scores(self) -> dict[int, float]:
        """Per container: text below it outside links, three quarters of it for each level in between."""
        out: dict[int, float] = {}
        for element, tag, text, links in self.blocks:
            worth = float(len(text) - links)
            at = element
            if at >= 0 and tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "dd", "dt", "pre"):
                at = self.parents[at]
            while at >= 0:
                out[at] = out.get(at, 0.0) + worth
                worth *= 0.75
                at = self.parents[at]
        return {e: s * (1.5 if self.tags[e] in MAIN else 1.0) for e, s in out.items()}

    def votes(self) -> dict[str, float]:
        """The paths of all containers with text, with their shares of the best score; the best of equal paths counts."""
        scores = {e: s for e, s in self.scores().items() if s > 0}
        top = max(scores.values(), default=1.0)
        out: dict[str, float] = {}
        for e, score in scores.items():
            path = self.path(e)
            out[path] = max(out.get(path, 0.0), score / top)
        return out

    def text_below(self, path: str | None) -> str:
        """Blocks below the elements of the path, or of the best container if there is none."""
        wanted = {e for e in range(len(self.tags)) if not self._dropped[e] and path and path.endswith(self.names[e]) and self.path(e) == path}
        inside = self._inside(wanted)
        if not any(inside):
            scores = self.scores()
            if not scores:
                return "\n\n".join(b[2] for b in self.blocks)
            inside = self._inside({max(scores, key=lambda e: (scores[e], -e))})
        if not any(tag == "h1" for (_, tag, _, _), kept in zip(self.blocks, inside) if kept):
            before = [k for k, b in enumerate(self.blocks[: inside.index(True)]) if b[1] == "h1"]
            if len(before) == 1:  # a title that stands in front of the container
                inside[before[0]] = True
        return "\n\n".join(b[2] for b, kept in zip(self.blocks, inside) if kept)

    def _inside(self, wanted: set[int]) -> list[bool]:
        below = [False] * len(self.tags)
        for e, parent in enumerate(self.parents):
            below[e] = e in wanted or (parent >= 0 and below[parent])
        return [b[0] >= 0 and below[b[0]] for b in self.blocks]


def host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def winning_paths(pages: DataFrame) -> DataFrame:
    """``_host`` and the path with most votes; ties go to the path first in order."""

    def vote(batches):
        for batch in batches:
            votes: dict[tuple[str, str], int] = {}
            for at, source in zip(batch.column(0), batch.column(1)):
                name = at.as_py()
                for path, share in Page(source.as_py() or "").votes().items():
                    votes[name, path] = votes.get((name, path), 0) + round(share * 1_000)
            columns = [list(c) for c in zip(*((*key, n) for key, n in votes.items()))] or [[], [], []]
            types = (pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["host", "path", "votes"])

    cast = on_workers(pages).select(host().alias("host"), "html").mapInArrow(vote, "host string, path string, votes long")
    sums = cast.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    best = sums.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("n"), "path")).alias("best"))
    return best.select(F.col("host").alias("_host"), F.col("best.path").alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text."""
    paths = cut_lineage(winning_paths(pages))
    pages = pages.select("page_id", "url", "html", host().alias("_host"))
    if paths.count() <= SMALL_ROWS:
        met = pages.join(F.broadcast(paths), "_host", "left")
    else:  # the pages of a large host are spread over as many tasks as they fill
        (heavy,) = find_heavy_keys(pages.select("_host"), ["_host"])
        placed = pages.withColumn("_place", F.monotonically_increasing_id())
        met = left_join(placed, paths, ["_host"], heavy, "_place")

    def read(batches):
        for batch in batches:
            texts = [Page(source.as_py() or "").text_below(path.as_py()) for source, path in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return met.select("page_id", "url", "html", "path").mapInArrow(read, "page_id long, url string, text string")


def digest(pages: DataFrame) -> DataFrame:
    return extract(pages).withColumn("n_chars", F.char_length("text").cast("long"))
