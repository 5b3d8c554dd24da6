"""Main text of web pages, with site templates removed.

The elements of every page are hashed from their subtrees (name, class, text, children), those of
navigation, headers and footers as well. Spark counts for each host on how many different pages a
subtree occurs; one that recurs on many of them is the site's template and is deleted before the
text is taken. In addition, what pages call navigation, header, footer, sidebar, notice, advert,
form or comments is left out by name and class, and where a page marks its article, only that is
text, of which headings, paragraphs and quotations are never deleted as template. Inside an
article a class or id drops nothing unless all its words speak of a purpose, and never prose; on
a page without a marked article classes and ids count only if they leave any text.

Defined results: a null html is empty and gives no text; without tags all is text. A null url
belongs to the host "". Pages with the same main text count once towards a template. Unclosed,
misnested and unknown elements are taken as they come. Repeated rows are extracted each.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .shared import hot_join, kept, once, unused

# A subtree on this share of a host's different pages, and on this many, is template. A host
# then has at most (subtrees of a page) / LEAST_SHARE templates on average.
LEAST_SHARE = 0.3
LEAST_PAGES = 5

# Hosts' templates that are sent to all tasks; with more of them pages are dealt by host instead.
MOST_SENT = 1_000_000
# Parts that a host's pages are dealt to in that case.
SPREAD = 64

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template textarea title iframe svg".split())
DROPPED = RAW | frozenset("head nav footer aside form button select menu dialog canvas video audio map".split())
OUTSIDE = frozenset(["noscript"])  # dropped but for what an article has of it
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption figure "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main ol p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
INLINE = frozenset("b i em strong a span br".split())
PROSE = INLINE | frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre".split())
CLOSES = {  # an opening tag ends open elements of these names, up to their container
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTAINERS = frozenset("ul ol dl table article section div main body aside nav blockquote td th".split())
ENDS_P = BLOCKS - {"html", "body"}

# Words of a class or id, or roles, that say what an element is for.
PURPOSE = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
    "cookie cookies consent disqus footer gdpr masthead menu modal nav navbar navigation newsletter "
    "notice notification pagination popup promo promoted promotion related replies reply share "
    "sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget "
    "complementary contentinfo search alert alertdialog dialog form".split()
)

# Words that say nothing more about it.
PARTS = frozenset(
    "area bar block bottom box button buttons container group icons inline inner item items left link "
    "links list outer page post posts right row section site slot top unit wrap wrapper".split()
)

# A quote opens a value only behind an equals sign; elsewhere it is a character like others.
# What was matched is never tried in another way, so that the time is in proportion.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+)>""",
    re.S,
)
_UNENDED = re.compile(r"<!--|<!\[CDATA\[")
# Attributes one after the other, values whole, so that nothing in a value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_WORD = re.compile(r"[a-z]+")


class Element:
    __slots__ = ("name", "label", "role", "children", "dropped", "by_label", "hash", "inside")

    def __init__(self, name: str, attributes: str, inside: bool = False):
        self.name = name
        self.children: list[Element | str] = []
        self.label = self.role = ""
        self.dropped = name in DROPPED or (name in OUTSIDE and not inside)
        self.by_label = False  # dropped, but only for a class, an id or a role
        self.hash = 0
        self.inside = inside  # an article
        if attributes and not attributes.isspace():
            for key, *values in _ATTRIBUTE.findall(attributes):
                key = key.lower()
                if key == "hidden":
                    self.dropped = True
                if key not in ("class", "id", "role"):
                    continue
                value = "".join(values).lower()
                self.label += f" {value}"
                if key == "role":
                    self.role = value
                if name not in ("html", "body", "article", "main") and self._says_purpose(key, value):
                    self.by_label = True
        if self.dropped:
            self.by_label = False
        self.dropped |= self.by_label

    def _says_purpose(self, key: str, value: str) -> bool:
        words = _WORD.findall(value)
        if PURPOSE.isdisjoint(words):
            return False
        if key == "role" or not self.inside:
            return True
        # Names inside an article are often made from headings and layouts: all words must agree.
        return self.name not in PROSE and PURPOSE.union(PARTS).issuperset(words)

    def is_article(self) -> bool:
        return self.name in ("article", "main") or self.role in ("article", "main")


class _Open:
    """The open elements; where the last one of a name is, is known without a search."""

    def __init__(self, root: Element):
        self.elements = [root]
        self.places: dict[str, list[int]] = {}
        self.containers = [0]

    def push(self, element: Element) -> None:
        at = len(self.elements)
        self.elements.append(element)
        self.places.setdefault(element.name, []).append(at)
        if element.name in CONTAINERS:
            self.containers.append(at)

    def last(self, name: str) -> int:
        """Where the innermost element of a name is; 0 if none is open."""
        places = self.places.get(name)
        return places[-1] if places else 0

    def close(self, at: int) -> None:
        """End the element at a place and all in it."""
        while len(self.elements) > at:
            self.places[self.elements.pop().name].pop()
        while self.containers[-1] >= at:
            self.containers.pop()


def parsed(html: str) -> Element:
    """The tree of a page; comments and declarations are left out."""
    root = Element("html", "")
    open_, at = _Open(root), 0
    last = html.rfind(">") + 1  # no tag ends behind it
    while found := _TAG.search(html, at, last):
        if found.start() > at:
            open_.elements[-1].children.append(html[at : found.start()])
        at = found.end()
        closing, name, attributes = found.groups()
        if not name:
            if found[0].startswith("<!--") and not found[0].endswith("-->"):
                at = len(html)
            elif found[0].startswith("<![CDATA[") and not found[0].endswith("]]>"):
                at = len(html)
            continue
        name = name.lower()
        if closing:
            if place := open_.last(name):
                open_.close(place)
            continue
        ends = CLOSES.get(name, frozenset()) | ({"p"} if name in ENDS_P else frozenset())
        place = max((open_.last(e) for e in ends), default=0)
        if place and place >= open_.containers[-1]:
            open_.close(place)
        above = open_.elements[-1]
        element = Element(name, attributes, above.inside or above.is_article())
        above.children.append(element)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif name not in VOID and not attributes.endswith("/"):
            open_.push(element)
    rest = html[at:]
    if unended := _UNENDED.search(rest):
        rest = rest[: unended.start()]
    if rest:
        open_.elements[-1].children.append(rest)
    return root


def hashed(element: Element, found: set[int]) -> bool:
    """Set the hashes of the subtrees that have text; add those that may be template to found.

    What names and classes drop is hashed too, but is no part of the hash of what is around it.
    """
    stack: list[tuple[Element, bool, bool]] = [(element, False, False)]
    while stack:
        own, below, ready = stack.pop()
        if not ready:
            stack.append((own, below, True))
            within = below or own.dropped
            stack.extend((c, within, False) for c in own.children if isinstance(c, Element))
            continue
        digest, some = xxhash.xxh64(f"{own.name}{own.label}"), False
        for c in own.children:
            if isinstance(c, str):
                if text := " ".join(c.split()):
                    some = True
                    digest.update(text.encode("utf-8", "surrogatepass"))
            elif c.hash and (below or own.dropped or not c.dropped):
                some = True
                digest.update(c.hash.to_bytes(8, "little", signed=True))
            elif c.dropped:
                continue
            digest.update(b"\0")
        if some:
            value = digest.intdigest()
            own.hash = (value - (1 << 64) if value >> 63 else value) or 1
            whole = own.name in ("html", "body") or own.is_article()
            # Links and the like in what is dropped may be words of a sentence elsewhere.
            if not whole and not (own.inside and own.name in PROSE) and not (below and own.name in INLINE):
                found.add(own.hash)
    return bool(element.hash)


def _articles(root: Element) -> list[Element]:
    """The outermost article elements, else main ones, else the root."""
    for is_one in (
        lambda e: e.name == "article" or e.role == "article",
        lambda e: e.name == "main" or e.role == "main",
    ):
        found, left = [], [root]
        while left:
            e = left.pop()
            if is_one(e):
                found.append(e)
            else:
                left.extend(c for c in reversed(e.children) if isinstance(c, Element) and not c.dropped)
        if found:
            return found
    return [root]


def text_of(root: Element, template: Callable[[int], bool]) -> str:
    """The blocks of the main text, white space folded, joined with an empty line."""
    articles = _articles(root)
    marked = articles[0] is not root
    blocks = _blocks(articles, template, marked, labels=True)
    if not blocks and not marked:
        blocks = _blocks(articles, template, marked, labels=False)
    return "\n\n".join(blocks)


def _blocks(articles: list[Element], template: Callable[[int], bool], marked: bool, labels: bool) -> list[str]:
    """The blocks' texts; without `labels`, classes and ids drop nothing."""
    blocks, line = [], []

    def end_block() -> None:
        if text := " ".join(unescape("".join(line)).split()):
            blocks.append(text)
        line.clear()

    left: list[Element | str | None] = [*reversed(articles)]
    while left:
        e = left.pop()
        if e is None:
            end_block()
        elif isinstance(e, str):
            line.append(e)
        elif template(e.hash) and not (e.inside and e.name in PROSE):
            continue
        elif (e.dropped and (labels or not e.by_label)) or (e.name == "header" and not marked):
            continue
        elif e.name == "br":
            line.append("\n")
        else:
            if e.name in BLOCKS:
                end_block()
                left.append(None)
            left.extend(reversed(e.children))
    end_block()
    return blocks


def subtrees(html: str) -> tuple[int, list[int]]:
    """A hash of the main text, templates included, and those of the subtrees that may be template."""
    found: set[int] = set()
    root = parsed(html)
    hashed(root, found)
    text = text_of(root, lambda h: False).encode("utf-8", "surrogatepass")
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value, sorted(found)


def extract(html: str, templates: frozenset[int] | set[int] = frozenset()) -> str:
    """The main text of a page, without the subtrees whose hashes are given."""
    root = parsed(html)
    if templates:
        hashed(root, set())
    return text_of(root, lambda h: h in templates)


def host(url: str) -> Column:
    """The host of a url column in lower case, without user and port; "" where there is none."""
    found = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(found)


def templates(
    pages: DataFrame, url: str = "url", html: str = "html", least_share: float = LEAST_SHARE, least_pages: int = LEAST_PAGES
) -> DataFrame:
    """(host, templates): hashes of the subtrees that recur on a host; hosts with none are left out."""

    def find(htmls: pa.Array) -> pa.Array:
        pages_, found = zip(*map(subtrees, htmls.to_pylist())) if len(htmls) else ((), ())
        columns = [pa.array(pages_, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(columns, ["page", "hashes"])

    rows = pages.select(host(url).alias("host"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    found = rows.select("host", once(find, "struct<page:bigint,hashes:array<bigint>>")("html").alias("found"))
    # Pages with the same main text are copies; each text counts once.
    different = found.groupBy("host", "found.page").agg(F.min("found.hashes").alias("hashes"))
    different = kept(different, "subtrees")
    sizes = different.groupBy("host").agg(F.count("*").alias("pages"))
    counts = different.select("host", F.explode("hashes").alias("hash")).groupBy("host", "hash").count()
    least = F.greatest(F.lit(least_pages), F.ceil(F.col("pages") * least_share))
    return (
        hot_join(counts.where(F.col("count") >= least_pages), sizes, ["host"])
        .where(F.col("count") >= least)
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("hash")).alias("templates"))
    )


def with_text(
    pages: DataFrame, url: str = "url", html: str = "html", to: str = "main_text", most_sent: int = MOST_SENT, **options
) -> DataFrame:
    """pages with one more column, the main text."""

    def find(htmls: pa.Array, known: pa.Array) -> pa.Array:
        memo: dict[tuple, frozenset] = {}
        out = []
        for h, t in zip(htmls.to_pylist(), known.to_pylist()):
            key = tuple(t or ())
            if key not in memo:
                memo[key] = frozenset(key)
            out.append(extract(h, memo[key]))
        return pa.array(out, pa.string())

    by_host = kept(templates(pages, url, html, **options), "templates")
    total = by_host.agg(F.sum(F.size("templates") + 1)).first()[0] or 0
    own, list_, part_of = (unused(pages, c) for c in ("host", "templates", "part"))
    rows = pages.withColumn(own, host(url))
    known = by_host.select(F.col("host").alias(own), F.col("templates").alias(list_))
    if total <= most_sent:
        joined = rows.join(F.broadcast(known), own, "left")
    else:
        part = F.pmod(F.xxhash64(F.col(html)), F.lit(SPREAD))
        spread = known.withColumn(part_of, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))))
        joined = rows.withColumn(part_of, F.coalesce(part, F.lit(0))).join(spread, [own, part_of], "left")
    text = once(find, "string")(F.coalesce(F.col(html), F.lit("")), list_)
    return joined.withColumn(to, text).select(*[c for c in pages.columns if c != to], to)
