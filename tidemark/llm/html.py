"""Main text of web pages: what a page says itself, without what its site repeats.

The pages of a host are merged into a site style tree. Its nodes are paths of
elements (tag with class and id, digits dropped), whatever they mean. Over the m
pages that have a node, two entropies to base m are taken: of the styles, the
runs of child elements met below it, and of each piece of text, over the pages
that show it. A node's importance weighs both,

    (1 - 0.9**l) * entropy of styles + 0.9**l * (1 - mean entropy of texts),

with l styles, and no less than the part of the texts: on a large site the
entropy of a few hundred styles is small beside log m, and text that each page
has for itself must not go for it. Text that all pages show alike has an
importance near 0. Branches below :data:`LEAST_IMPORTANCE`, met on
:data:`LEAST_PAGES` pages or more, are removed from each page, inside ``main`` and
``article`` elements too; where words of an element's class or id speak against
it, :data:`VOTED_IMPORTANCE` is asked for. Pages of a host with equal features,
its copies, count as one page, so copies alone do not take away a text.

Beside the tree, elements go that are not text of an article by the HTML standard
or ARIA (navigation, asides, footers, forms, scripts ...), and containers whose
whole class or id says so (adverts, reader comments ...). Words like "search" or
"related" in a name decide nothing inside an article. A page's main text then
lies in its ``main`` elements, in its ``article`` elements if they hold half of
what is left or more, or else in its body.

Cases: a null or empty html has an empty text; broken markup is read as far as
it can be; a null url is a host of its own; an empty table gives no row; a page
that shows nothing but what its site repeats has an empty text. Other columns are
not read. A line that the site repeats in the very kind of element that holds the
article's own lines is not told apart from them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from html.parser import HTMLParser
from types import MappingProxyType

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import own_columns, partitions, prepare, remote

LEAST_IMPORTANCE = 0.3
VOTED_IMPORTANCE = 0.6
LEAST_PAGES = 4
WEIGHT = 0.9

_WORDS = str.split

# Elements of the HTML standard, by what they mean for a text.
_VOID = frozenset(_WORDS("area base br col embed hr img input link meta param source track wbr"))
#: Blocks beside the article.
_BESIDE = frozenset(_WORDS("aside dialog footer form menu nav search"))
#: What is no text of a page, wherever it stands.
_NEVER = frozenset(
    _WORDS(
        "audio button canvas datalist head iframe input meter noscript progress script select style svg "
        "template textarea title video"
    )
)
_INLINE = frozenset(
    _WORDS(
        "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark math object q rp rt ruby "
        "s samp small span strike strong sub sup td th time tt u var wbr br img annotation mfrac mi mn mo mover "
        "mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics "
        "audio button canvas iframe input meter noscript progress script select style svg template textarea video"
    )
)
_HEADINGS = frozenset(_WORDS("h1 h2 h3 h4 h5 h6 hgroup caption figcaption summary dt li td th tr tbody"))
_ROLES = frozenset(
    _WORDS("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar")
)
#: Words that name no article wherever a whole name is made of them.
_STRONG = frozenset(
    _WORDS(
        "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted "
        "cookie cookies consent gdpr newsletter signup popup sidebar sidenav submenu navbar breadcrumb "
        "breadcrumbs pagination pager masthead comment comments commentlist disqus respond replies"
    )
)
#: Words that name no article where a whole name is made of them outside one, and vote inside.
_WEAK = frozenset(
    _WORDS(
        "banner notice notices notification subscribe subscription modal overlay menu nav navigation toolbar "
        "copyright reply share sharing social related recommended recommendations login search skip hidden "
        "header footer top bottom side aside"
    )
)
#: Words that say nothing in a name of the others.
_PLAIN = frozenset(
    _WORDS(
        "area bar block box btn button buttons col column container content div global inner item items left link "
        "links list main outer page panel right row section site slot unit widget widgets wrap wrapper"
    )
)

#: A start of the first kind ends an open element of the second, up to the third.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


#: Why an element is out: it is beside the article, or no text at all.
BESIDE, NEVER = 1, 2


class _Node:
    """An open or closed element.

    Its path, why it is out if it is, whether its names speak against it, and
    whether it is in an article (1) or the main element (2).
    """

    __slots__ = ("tag", "path", "parent", "out", "voted", "article", "styles")

    def __init__(self, tag: str, path: int, parent: _Node | None, out: int, voted: bool, article: int) -> None:
        self.tag, self.path, self.parent, self.out, self.voted, self.article = tag, path, parent, out, voted, article
        self.styles = 0  # a hash of the child elements so far


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) >> 1


def _names(tag: str, given: dict[str, str | None]) -> list[set[str]]:
    """The words of each name of an element that can speak against it."""
    if tag in _HEADINGS or tag in _INLINE or tag in ("html", "body", "main"):
        return []
    named = f"{given.get('class') or ''} {given.get('id') or ''}".split()
    return [words for words in ({part.lower() for part in _PART.findall(name)} - _PLAIN for name in named) if words]


def _left_out(tag: str, given: dict[str, str | None], inside: bool) -> tuple[int, bool]:
    """Why an element by itself is not text of the article (0: it is), and whether its names speak against it."""
    if tag in _NEVER:
        return NEVER, False
    hidden = "hidden" in given or (given.get("aria-hidden") or "").lower() == "true"
    if hidden or "display:none" in (given.get("style") or "").replace(" ", "").lower():
        return NEVER if tag in _INLINE else BESIDE, False
    if tag in _BESIDE or tag == "header" and not inside or (given.get("role") or "").lower() in _ROLES:
        return NEVER if tag in _INLINE else BESIDE, False
    names = _names(tag, given)
    if any(words <= _STRONG | _WEAK and (words & _STRONG or not inside) for words in names):
        return BESIDE, True
    return 0, any(words & (_STRONG | _WEAK) for words in names)


class _Reader(HTMLParser):
    """Blocks of text of a page, each with the element it stands in."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("", 0, None, 0, False, 0)
        self.now = self.root
        self.blocks: list[tuple[str, _Node]] = []
        self.text: list[str] = []
        self.nodes: list[_Node] = []
        self.open: dict[str, int] = {}

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        end = self.rawdata.find(">", i)  # as a comment
        return -1 if end < 0 else end + 1

    def _block(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                node = self.now
                while node.parent is not None and node.tag in _INLINE:
                    node = node.parent
                self.blocks.append((text, node))
            self.text = []

    def _pop(self) -> None:
        self.open[self.now.tag] -= 1
        self.now = self.now.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in _INLINE and self.now.out != NEVER:
            self._block()
            if self.open.get("p") and tag not in ("html", "body"):
                node = self.now
                while node.tag in _INLINE:
                    node = node.parent
                if node.tag == "p":
                    while self.now is not node:
                        self._pop()
                    self._pop()
        if tag in _CLOSES:
            ends, bounds = _CLOSES[tag]
            node = self.now
            while node.parent is not None and node.tag not in ends and node.tag not in bounds:
                node = node.parent
            if node.tag in ends:
                while self.now is not node:
                    self._pop()
                self._pop()
        if tag in ("br", "td", "th"):
            self.text.append(" ")
        if tag in _VOID:
            return
        given = dict(attrs)
        style = re.sub(r"\d+", "", f"{tag}.{given.get('class') or ''}#{given.get('id') or ''}")
        parent = self.now
        main = tag == "main" or given.get("role") == "main"
        article = max(parent.article, 2 if main else int(tag == "article"))
        out, voted = _left_out(tag, given, bool(parent.article))
        out = max(parent.out, out)
        node = _Node(tag, _hash(f"{parent.path}/{style}"), parent, out, voted, 0 if out else article)
        parent.styles = _hash(f"{parent.styles} {style}")
        self.open[tag] = self.open.get(tag, 0) + 1
        self.nodes.append(node)
        self.now = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag not in _INLINE and self.now.out != NEVER:
            self._block()
        if not self.open.get(tag):
            return
        while self.now.tag != tag:
            self._pop()
        self._pop()

    def handle_data(self, data: str) -> None:
        if self.now.out != NEVER:
            self.text.append(data)

    def read(self, html: str) -> _Reader:
        self.feed(html)
        self.close()
        self._block()
        return self


def _judged(node: _Node) -> bool:
    """Whether the site's tree has an element; it asks for all that show text."""
    return node.out != NEVER and node.tag not in ("", "html", "body")


def main_text(html: str, low: Mapping[int, float] = MappingProxyType({})) -> str:
    """The text of the article, one line a block; ``low``: importance of unimportant paths."""
    kept, seen = [], {}
    for text, node in _Reader().read(html).blocks:
        if node.out:
            continue
        line, at = [], node
        while at is not None and id(at) not in seen:
            line.append(at)
            at = at.parent
        gone = seen[id(at)] if at is not None else False
        for at in reversed(line):
            least = VOTED_IMPORTANCE if at.voted else LEAST_IMPORTANCE
            gone = gone or (_judged(at) and low.get(at.path, 1.0) < least)
            seen[id(at)] = gone
        if not gone:
            kept.append((text, node.article))
    marked = [text for text, article in kept if article == 2]
    if not marked:
        # Small articles beside a longer text are teasers.
        marked = [text for text, article in kept if article]
        if 2 * sum(map(len, marked)) < sum(len(text) for text, _ in kept):
            marked = [text for text, _ in kept]
    return "\n".join(marked)


#: Kinds of a counted feature, its last two bits: the node itself, a run of child elements, a text.
NODE, STYLE, TEXT = 0, 1, 2

#: Copies that a task leaves out already; it forgets them all and starts anew beyond that.
SEEN = 1 << 16


def _feature(kind: int, mark: int = 0) -> int:
    return (mark & 0x3FFFFFFF) << 2 | kind


def _pack(features: set[tuple[int, int]]) -> bytes:
    paths, marks = zip(*sorted(features), strict=True) if features else ((), ())
    return np.array(paths, "<i8").tobytes() + np.array(marks, "<u4").tobytes()


def _features(batches):
    """Of each page the features of its nodes, packed (all paths, then all features), and their digest."""
    seen: set[tuple[str, int]] = set()
    for batch in batches:
        rows = []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            page = _Reader().read(html or "")
            own, beside = set(), set()
            for node in page.nodes:
                if _judged(node):
                    found = beside if node.out else own
                    found.add((node.path, _feature(NODE)))
                    found.add((node.path, _feature(STYLE, node.styles)))
            for text, node in page.blocks:
                mark, out = _feature(TEXT, _hash(text)), node.out
                found = beside if out else own
                # What goes anyway says nothing about the elements around it.
                while node is not None and node.out == out:
                    if _judged(node):
                        if (node.path, mark) in found:
                            break
                        found.add((node.path, mark))
                    node = node.parent
            if not own and not beside:
                continue
            # Copies may differ in what is beside the article.
            digest = xxhash.xxh3_64_intdigest(_pack(own)) >> 1
            packed = _pack(own | beside)
            if (host, digest) not in seen:
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add((host, digest))
                rows.append((host, digest, packed))
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(("host", "digest", "features"), map(list, zip(*rows, strict=True)), strict=True)))


def _counted(batches):
    """How many pages of a batch show each feature of each node: host, path, feature, pages."""
    names = ("host", "path", "feature")
    for batch in batches:
        counts: dict[tuple, int] = {}
        for host, packed in zip(batch.column("host").to_pylist(), batch.column("features").to_pylist(), strict=True):
            number = len(packed) // 12
            paths, marks = np.frombuffer(packed, "<i8", number), np.frombuffer(packed, "<u4", number, 8 * number)
            for path, mark in zip(paths.tolist(), marks.tolist(), strict=True):
                key = (host, path, mark)
                counts[key] = counts.get(key, 0) + 1
        if counts:
            columns = dict(zip(names, map(list, zip(*counts, strict=True)), strict=True))
            yield pa.RecordBatch.from_pydict(columns | {"pages": list(counts.values())})


def host(url: str = "url"):
    """A URL's host in lower case; empty without one."""
    return F.lower(F.coalesce(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, pages (copies count once) and importance of every judged node of every host's tree."""
    prepare(pages.sparkSession)
    own = own_columns(pages, url="string", html="string")
    counted = (
        own.select(host().alias("host"), "html")
        .mapInArrow(remote(_features), "host string, digest long, features binary")
        .groupBy("host", "digest")
        .agg(F.min("features").alias("features"))
        .select("host", "features")
        .mapInArrow(remote(_counted), "host string, path long, feature long, pages long")
        .groupBy("host", "path", "feature")
        .agg(F.sum("pages").alias("pages"))
    )
    # By node the sums that both entropies need; m is known only at the end.
    log = F.log(F.col("pages").cast("double"))
    kind = F.col("feature").bitwiseAND(3)
    style, text = kind == STYLE, kind == TEXT
    sums = counted.groupBy("host", "path").agg(
        F.max(F.when(kind == NODE, F.col("pages"))).alias("m"),
        F.count(F.when(style, 1)).alias("styles"),
        F.sum(F.when(style, F.col("pages") * log)).alias("style_logs"),
        F.sum(F.when(style, F.col("pages"))).alias("style_pages"),
        F.avg(F.when(text, log)).alias("text_log"),
    )
    m = F.log(F.greatest(F.col("m"), F.lit(2)).cast("double"))
    weight = F.pow(F.lit(WEIGHT), F.col("styles"))
    # -sum(p log p) with p = pages / n is log n - sum(pages log pages) / n.
    styles = (F.log(F.col("style_pages").cast("double")) - F.col("style_logs") / F.col("style_pages")) / m
    texts = 1 - F.coalesce(F.col("text_log") / m, F.lit(0.0))
    importance = F.when(F.col("m") < 2, F.lit(1.0)).otherwise(
        F.greatest(texts, (1 - weight) * styles + weight * texts)
    )
    return sums.select("host", "path", F.col("m").alias("pages"), importance.alias("importance"))


def _extract(batches):
    """Texts of pages sorted by (host, part); a host's unimportant paths come before its pages."""
    key, low = None, {}
    for batch in batches:
        columns = {name: batch.column(name).to_pylist() for name in ("host", "part", "path", "importance", "html")}
        page = batch.column("page").to_pylist()
        places, texts, held = [], [], 0
        for i, own in enumerate(zip(columns["host"], columns["part"], strict=True)):
            if own != key:
                key, low = own, {}
            if not page[i]:
                low[columns["path"][i]] = columns["importance"][i]
                continue
            texts.append(main_text(columns["html"][i] or "", low))
            places.append(i)
            held += len(texts[-1])
            if held > 1 << 22:
                yield _texts(batch, places, texts)
                places, texts, held = [], [], 0
        yield _texts(batch, places, texts)


def _texts(batch: pa.RecordBatch, places: list[int], texts: list[str]) -> pa.RecordBatch:
    own = batch.select(["page_id", "url"]).take(pa.array(places, pa.int64()))
    chars = pa.array([len(text) for text in texts], pa.int64())
    return pa.RecordBatch.from_arrays([*own.columns, pa.array(texts, pa.string()), chars], ["page_id", "url", "text", "n_chars"])


#: Pages of a host that one task reads at most, about; hosts are counted in so many cells by a hash.
PAGES = 256
CELLS = 1 << 19


def _parts(own: DataFrame) -> DataFrame:
    """cell and parts: into how many parts the hosts of a cell are dealt, at most CELLS rows."""
    cells = own.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    return cells.select("cell", F.expr(f"cast((n - 1) div {PAGES} + 1 as int)").alias("parts")).where("parts > 1")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page.

    The pages of a host are dealt in parts by their number, and its unimportant
    paths go to each part once, ahead of the pages, in rows of their own. Numbers
    are taken by a hash of the host, so that the table of parts, which is
    broadcast, has at most CELLS rows whatever the number of hosts.
    """
    spark = pages.sparkSession
    low = style_tree(pages).where((F.col("importance") < VOTED_IMPORTANCE) & (F.col("pages") >= LEAST_PAGES))
    cell = F.pmod(F.xxhash64("host"), F.lit(CELLS)).alias("cell")
    own = own_columns(pages, page_id="long", url="string", html="string").withColumn("host", host())
    parts = F.broadcast(_parts(own.select(cell)))
    many = F.coalesce("parts", F.lit(1))
    lot = F.pmod(F.xxhash64("page_id", "html"), many).cast("int")
    read = own.select("*", cell).join(parts, "cell", "left").select(
        "host", lot.alias("part"), F.lit(1).alias("page"), F.lit(None).cast("long").alias("path"),
        F.lit(None).cast("double").alias("importance"), "page_id", "url", "html",
    )
    sent = low.select("host", "path", "importance", cell).join(parts, "cell", "left").select(
        "host", F.explode(F.sequence(F.lit(0), many - 1)).alias("part"), F.lit(0).alias("page"), "path", "importance",
        *(F.lit(None).cast(kind).alias(name) for name, kind in (("page_id", "long"), ("url", "string"), ("html", "string"))),
    )
    return (
        read.union(sent)
        .repartition(partitions(spark), "host", "part")
        .sortWithinPartitions("host", "part", "page")
        .mapInArrow(remote(_extract), "page_id long, url string, text string, n_chars long")
    )
