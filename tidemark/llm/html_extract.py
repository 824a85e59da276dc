"""Main text of web pages by template deduction over the pages of a host.

A page is read as tokens: its elements, each named by its tag, first class and id
and the element around it (a hash of both, so the cost is linear in the nesting),
and its texts together with the element they stand in. Over the different pages
of a host each token has an occurrence vector, how often each page has it. Tokens
with the same vector that hang in the same class form an equivalence class. A class
is valid if at least ``SHARE`` of the host's pages have it and it has more than one
token; the valid classes, nested in this way, are the host's template. Its texts are fixed; what it leaves open are the slots, and
their content is the main text. A page that fills no slot has no content of
its own apart from the fixed texts, so these are its text.

Tags and roles say outright what is no main text: menus, headers, footers,
sidebars, forms, scripts. Names of classes and ids are hints. They only choose among
slots: a slot with such a name goes if others on the page hold text, and where a
page has an article, the slots inside it are taken. Of a compound name the last
word that tells a part counts (``site-footer``, ``ad-box``; not ``share-price``).

Vectors are only compared, so each is kept as a sum of hashes (bitwise) of
(page, count), built by aggregation: the pages of a host never meet in one
place. Pages whose texts outside of menus, adverts and the like are equal count as one page,
so copies with other adverts make no template. A host where near copies of one
article are nearly all pages looks like a template, and what they share goes.
A template has at most 1 / ``SHARE`` times as many tokens as its pages have on average.

Defined cases: null or empty html gives the empty text; a null or odd url is a
host of its own name; hosts of fewer than ``PAGES`` different pages have no template,
only tags and hints decide there; repeated pages count once for the template and each
get a row; a cut page is read up to where it ends, and a tag cut there is dropped.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import flat
from tidemark.llm.tables import written

#: Different pages that a host needs for a template, and the share of them that must have its tokens.
PAGES, SHARE = 4, 0.8
#: Pages of a host that meet one copy of its template; more where there would be over ``PARTS`` such hosts.
PART, PARTS = 20_000, 100_000

# Names that HTML and common page layouts give these parts.
DROPPED = set("head script style noscript template nav footer aside form button select option textarea input iframe object svg canvas dialog menu".split())
RAW = set("script style noscript template textarea title iframe xmp".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr html legend li main menu nav ol optgroup option p pre section summary table tbody tfoot thead tr ul".split()
)
SPACED = set("br td th img wbr button input select textarea".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
#: An element that opens closes an open one of these, if no stopper lies between.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPPERS = set("ul ol dl table article section div main body aside nav footer header form blockquote td th".split())
HINTS = set(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice popup modal overlay "
    "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer header masthead comment comments disqus reply replies respond share sharing social "
    "related recommended recommendations newsletter subscribe subscription signup login search widget pagination pager toolbar".split()
)
#: Words at the end of a name that tell no part of a page, so the word before them counts.
GENERIC = set("area bar block bottom box button buttons col column container form group inner item items left link links list outer panel posts right row section slot top unit wrap wrapper zone".split())
#: Whole names of the article's own element; on such an element other names are no hints.
ARTICLE = set("article content post entry story main article-body post-body post-content entry-content story-body main-content".split())
#: Classes that begin so tell how a page is laid out.
LAYOUT = set("has with without no is".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|</?[a-zA-Z][^>]*\Z""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|hidden|aria-hidden|style|itemprop)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE) for name in RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_PART = re.compile(r"[^a-z0-9]+")


class Piece(NamedTuple):
    """A text between tags: the element it stands in, its block, and what tags and names say of its place."""

    element: int
    text: str
    block: int
    dropped: bool
    hinted: bool
    main: bool


class _Open(NamedTuple):
    name: str
    token: int
    dropped: bool
    hinted: bool
    main: bool
    header: bool
    heading: bool


def _unwanted(name: str, attributes: dict[str, str]) -> bool:
    """Whether a tag, its role or its style says that this is no main text."""
    if name in DROPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(attributes.get("style", "")):
        return True
    return attributes.get("role", "") in ROLES


def _hinted(name: str, attributes: dict[str, str], inside_main: bool) -> bool:
    """Whether a class or an id names a part that is no main text."""
    if name in ("html", "body", "main"):
        return False
    names = [mark for key in ("class", "id") for mark in attributes.get(key, "").lower().split()]
    if any(mark in ARTICLE for mark in names):
        return False
    for mark in names:
        parts = [part for part in _PART.split(mark) if part]
        if not parts or parts[0] in LAYOUT:
            continue
        while len(parts) > 1 and (parts[-1] in GENERIC or parts[-1].isdigit()):
            parts.pop()
        if parts[-1] in HINTS and not (inside_main and parts[-1] == "header"):
            return True
    return False


def _hash(*parts: str) -> int:
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


ROOT = _hash("")


class _Stack:
    """The open elements; where the last of each name and the last stopper are is known without a search."""

    def __init__(self) -> None:
        self.elements = [_Open("", ROOT, False, False, False, False, False)]
        self._places: dict[str, list[int]] = {}
        self._stoppers = [0]

    def push(self, element: _Open) -> None:
        place = len(self.elements)
        self._places.setdefault(element.name, []).append(place)
        if element.name in STOPPERS:
            self._stoppers.append(place)
        self.elements.append(element)

    def _cut(self, place: int) -> None:
        while len(self.elements) > place:
            self._places[self.elements.pop().name].pop()
        while self._stoppers[-1] >= place:
            self._stoppers.pop()

    def close(self, name: str) -> None:
        if self._places.get(name):
            self._cut(self._places[name][-1])

    def close_before(self, names: set[str]) -> None:
        """Closes the last open element of these names, if no stopper lies between."""
        place = max((self._places[name][-1] for name in names if self._places.get(name)), default=0)
        if place and place >= self._stoppers[-1]:
            self._cut(place)


def pieces(html: str) -> tuple[list[Piece], list[tuple[int, int]]]:
    """The texts of a page in order, and its elements with the elements around them."""
    out, elements = [], []
    stack = _Stack()
    block, at = 0, 0

    def text(raw: str) -> None:
        if raw:
            top = stack.elements[-1]
            # In an article's header only the headings belong to it.
            out.append(Piece(top.token, entities.unescape(raw), block, top.dropped or top.header and not top.heading, top.hinted, top.main))

    for m in _MARKUP.finditer(html):
        if m.start() < at:
            continue
        text(html[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            block += 1
        elif name in SPACED:
            out.append(Piece(stack.elements[-1].token, " ", block, True, False, False))
        if m[1] or m[4]:
            stack.close(name)
            continue
        stack.close_before({"p"} if name in BLOCKS else CLOSES.get(name, set()))
        stack.close_before(CLOSES.get(name, set()))
        written_out = m[3] if m[2] else m[6]
        attributes = {a[1].lower(): (a[2] or "").strip("\"'") for a in _ATTRIBUTE.finditer(written_out)} if written_out.strip() else {}
        top = stack.elements[-1]
        first = attributes.get("class", "").split()
        token = _hash(str(top.token), name, first[0] if first else "", attributes.get("id", ""))
        elements.append((token, top.token))
        main = top.main or name in ("article", "main") or attributes.get("role") == "main" or attributes.get("itemprop") == "articleBody"
        header = name == "header" and top.main or top.header
        dropped = top.dropped or _unwanted(name, attributes) or name == "header" and not top.main
        hinted = top.hinted or _hinted(name, attributes, top.main)
        if name in RAW:
            end = _RAW_END[name].search(html, at)
            at = end.end() if end else len(html)
        elif name not in VOID and not written_out.endswith("/"):
            stack.push(_Open(name, token, dropped, hinted, main, header, top.heading or name in HEADINGS))
    text(html[at:])
    return out, elements


def _token(piece: Piece) -> int:
    return _hash(str(piece.element), " ".join(piece.text.split()))


def _filled(texts: list[Piece]) -> bool:
    return any(p.text.strip() for p in texts)


def _article(found: list[Piece]) -> list[Piece]:
    """The texts that tags leave: inside the article, where the page has one."""
    readable = [p for p in found if not p.dropped]
    inside = [p for p in readable if p.main and not p.hinted]
    return inside if _filled(inside) else readable


def _chosen(texts: list[Piece]) -> list[Piece]:
    """Those that no name tells from the main text; names that would take all tell nothing."""
    plain = [p for p in texts if not p.hinted]
    return plain if _filled(plain) else texts


def main_text(html: str | None, template: set[int]) -> str:
    """The main text of a page; ``template`` has the hashes of the host's fixed texts."""
    if not html:
        return ""
    found, _ = pieces(html)
    texts = _article(found)
    slots = [p for p in texts if not (template and p.text.strip() and _token(p) in template)]
    inside = {id(p) for p in _chosen(slots if _filled(slots) else texts)}
    blocks: dict[int, list[str]] = {}
    for p in found:
        if id(p) in inside or p.text == " ":
            blocks.setdefault(p.block, []).append(p.text)
    lines = (" ".join("".join(b).split()) for b in blocks.values())
    return "\n\n".join(line for line in lines if line)


def host_of(url: Column) -> Column:
    """The host of an address in lower case, without user and port."""
    place = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]*)", 1)
    return F.lower(place)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, token, parent, is_text, page, n) for all tokens of the pages; parent is the element around."""
    for run in flat.runs(batches, "html"):
        rows = []
        for place, html in zip(run.column("host").to_pylist(), run.column("html").to_pylist(), strict=True):
            if not html:
                continue
            texts, elements = pieces(html)
            page = _hash(*(" ".join(p.text.split()) for p in _chosen(_article(texts)) if p.text.strip()))
            counts = Counter((*element, False) for element in elements)
            counts.update((_token(p), p.element, True) for p in texts if p.text.strip())
            rows.append((place, ROOT, 0, False, page, 1))
            rows += [(place, *token, page, n) for token, n in counts.items()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["host", "token", "parent", "is_text", "page", "n"])


def classes(pages: DataFrame) -> DataFrame:
    """(host, token, parent, is_text, vector, around, valid) of the frequent tokens of each host's pages (host, html).

    Tokens that every page has once are in the root's class, and a token whose parent has the same vector is
    in its parent's; ``around`` is null for both. Other tokens form a class with those of their vector
    whose parents have one vector, ``around``.
    """
    found = pages.select("host", "html").mapInArrow(_tokens, "host long, token long, parent long, is_text boolean, page long, n long")
    once = found.groupBy("host", "token", "parent", "is_text", "page").agg(F.max("n").alias("n"))
    vectors = once.groupBy("host", "token", "parent", "is_text").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.count(F.lit(1)).alias("support")
    ).where(F.col("support") >= SHARE * PAGES)
    vectors = written(vectors)
    pages_of = vectors.where((F.col("parent") == 0) & ~F.col("is_text")).select("host", F.col("support").alias("pages"), F.col("vector").alias("root_vector"))
    frequent = vectors.join(pages_of, "host").where((F.col("pages") >= PAGES) & (F.col("support") >= SHARE * F.col("pages")))
    # A page that has a token has the elements around it, so the parent of a frequent token is frequent.
    parents = frequent.where(~F.col("is_text")).select("host", F.col("token").alias("parent"), F.col("vector").alias("parent_vector"))
    around = F.when(~F.col("vector").isin(F.col("root_vector"), F.col("parent_vector")), F.col("parent_vector"))
    hung = frequent.join(parents, ["host", "parent"], "left").select("host", "token", "parent", "is_text", "vector", around.alias("around"))
    alone = hung.where(F.col("around").isNotNull()).groupBy("host", "vector", "around").agg(F.count(F.lit(1)).alias("size")).where("size = 1").drop("size")
    valid = F.col("lone").isNull()
    return hung.join(alone.withColumn("lone", F.lit(True)), ["host", "vector", "around"], "left").select(*hung.columns, valid.alias("valid"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, tokens): the hashes of the fixed texts of each host's template, for pages (host, html); hosts are hashes."""
    return classes(pages).where("valid and is_text").groupBy("host").agg(F.collect_set("token").alias("tokens"))


def _dealt(pages: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages and templates with ``part``: a host of many pages meets several copies of its template."""
    sizes = written(pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") > PART))
    part = max(PART, (sizes.agg(F.sum("pages")).first()[0] or 0) // PARTS)
    # At most PARTS rows: that many hosts can have so many pages.
    hot = F.broadcast(sizes.where(F.col("pages") > part).select("host", F.ceil(F.col("pages") / part).alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    dealt = pages.join(hot, "host", "left").withColumn("part", F.pmod(F.xxhash64("id", "url", "html"), parts)).drop("parts")
    copies = known.join(hot, "host", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))).drop("parts")
    return dealt, copies


def extracted(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row for each row of ``pages``: id, url, text."""
    plain = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    plain = plain.withColumn("host", F.xxhash64(host_of(F.col("url"))))
    dealt, copies = _dealt(plain, written(templates(plain)))
    # Written first, so that Spark knows the templates' size and broadcasts them only if they are small.
    known = written(copies)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in flat.runs(batches, "html"):
            texts = [main_text(h, set(t or ())) for h, t in zip(run.column("html").to_pylist(), run.column("tokens").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([run.column("id"), run.column("url"), pa.array(texts, pa.string())], ["id", "url", "text"])

    schema = plain.select("id", "url").schema.add("text", "string")
    rows = dealt.join(known, ["host", "part"], "left").select("id", "url", "html", "tokens").mapInArrow(work, schema)
    return rows.toDF(id_column, url_column, "text")
