"""Main text of web pages by template deduction over equivalence classes of tokens.

Tokens are a page's elements, told apart by their path, and its text blocks.

1. Pages of a host with the same text but for what markup tells apart are copies
   and count as one page.  A token's occurrence vector (how often it stands on each
   page) is condensed to a set hash: an XOR over pages of hash(page, count).  Tokens
   of one vector form an equivalence class.  Its tokens are frequent on at least
   ``LEAST_PAGES`` pages and half of those of their layout, which are the pages with
   anything at the token's place: its path, or for text the article or main it is in.
   Classes of at least ``LEAST_TOKENS`` frequent tokens remain.
2. A class is valid if its tokens come in one order on every page and its spans
   nest with those of the other classes.  The valid classes are the template.
3. What is no template is in slots, also inside an ``article``; template text is
   left out everywhere.  A page's article is in its ``article`` element, else
   ``main``, if these hold enough text next to the fullest slot.  Else it is all
   slots of the least container of those with enough text outside links, and the
   slots beside it that are not mostly links.  Hosts without a template go by the
   elements alone, else by the least container and an ``h1`` beside it.
   Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts
   and styles go by what their markup says; inside an ``article``, where a part of
   a class or id says so, only if they are template text too or mostly links.

Vectors and classes are grouped aggregations; no host's pages are ever gathered.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import batches, frugal, materialise

LEAST_PAGES, LEAST_TOKENS, LEAST_SHARE = 5, 3, 0.5
ENOUGH = 0.2  # of the fullest slot's text outside links

# Elements of HTML by how they are treated.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title template iframe annotation annotation-xml desc metadata".split())
SPACED = frozenset("text object canvas noscript".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre "
                   "section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "p": {"p"}}
ENDED = frozenset().union(*CLOSES.values())
SCOPES = frozenset("ul ol dl table article section div main body td th li blockquote aside nav header footer form".split())
# Markup that is not the article, by element, role, and word of a class or id.
ASIDE_TAGS = frozenset("head nav footer aside form button select menu dialog".split()) | RAW
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar "
                        "toolbar".split())
ASIDE_WORDS = frozenset(
    "nav navbar navigation menu submenu breadcrumb breadcrumbs sidebar rail footer masthead ad ads advert adverts advertisement "
    "adsbygoogle adbox banner promo promotion sponsor sponsored cookie cookies consent gdpr notice notification alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social comment comments disqus respond "
    "reply replies related recommended recommendations widget widgets toolbar pagination pager paging searchbox".split())
HEAD_WORDS = frozenset({"header", "topbar"})
OWN_WORDS = frozenset("article post entry story".split())
LAYOUT_WORDS = frozenset("has with no without".split())
FILLERS = frozenset("list box section area container wrapper button buttons link links post posts block bar slot left right top "
                    "bottom media icon icons inner outer item items".split())

_tag = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][\w:-]*)((?:[^<>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][\w:-]*)([^>]*)>|<[!?][^>]*>""",
    re.DOTALL)
_attribute = re.compile(r"""([\w:-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_words = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Block:
    path: int  # hash of the elements that it is in, the same on every page
    text: str
    linked: int  # characters inside links
    aside: bool
    region: int  # 2 inside an article, 1 inside main, else 0
    doubt: int = 0  # number of the element, inside an article, whose label only partly tells that it is none
    node: int = 0  # the element that it is in, among the page's


@dataclass
class Page:
    """Elements with the same labels from the root down are one node; a node's number is above its parent's."""

    tokens: list[int] = field(default_factory=list)  # elements and blocks in page order
    places: list[int] = field(default_factory=list)  # where each token stands
    blocks: list[Block] = field(default_factory=list)
    parents: list[int] = field(default_factory=lambda: [0])
    paths: list[int | str] = field(default_factory=lambda: [""])  # hash of the labels from the root down
    titles: list[bool] = field(default_factory=lambda: [False])  # in an h1


def token(kind: str, path: int | str, text: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{kind}\0{path}\0{text}") - (1 << 63)


def _is_aside(name: str, attributes: dict[str, str], in_article: bool) -> bool | None:
    """Whether an element is told not to be the article; None if a part of its label says so inside an article."""
    if name in ASIDE_TAGS or (name == "header" and not in_article):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role") in ASIDE_ROLES:
        return True
    if name in ("html", "body", "main"):
        return False
    told: bool | None = False
    for value in (attributes.get("class", ""), attributes.get("id", "")):
        for label in value.split():
            words = {w.lower() for w in _words.findall(label)}
            if words & LAYOUT_WORDS:
                continue
            if words & ASIDE_WORDS:
                if not in_article or all(w in ASIDE_WORDS or w in FILLERS or w.isdigit() for w in words):
                    return True
                told = None
            elif words & HEAD_WORDS and not words & OWN_WORDS and not in_article:
                return True
    return told


def parse(html: str | None) -> Page:
    """Blocks and tokens of a page; missing end tags are made up for, stray ones ignored."""
    html, page = html or "", Page()
    stack: list[tuple] = [("", 0, False, 0, 0)]  # name, node, aside, region, doubt
    opened: Counter = Counter()  # names on the stack
    marks: list[int] = []  # where on it the elements are that a start tag can end or that keep it from doing so
    nodes: dict[tuple[int, str], int] = {}
    doubts = 0
    held: list[str] = []
    linked = links = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(held)).split())
        held.clear()
        if text:
            _, node, aside, region, doubt = stack[-1]
            path = page.paths[node]
            page.blocks.append(Block(path, text, linked, aside, region, doubt, node))
            page.tokens.append(token("text", path, text))
            page.places.append(token("place", path if aside or not region else "", f"text {region}"))
        linked = 0

    def close(depth: int) -> None:
        while len(stack) > depth:
            opened[stack.pop()[0]] -= 1
        while marks and marks[-1] >= depth:
            marks.pop()

    at, end = 0, len(html)
    while at < end:
        m = _tag.search(html, at)
        if m is None:
            held.append(html[at:])
            break
        if m.start() > at:
            held.append(html[at:m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        name = (m.group(2) or m.group(5) or "").lower()
        if not name:
            continue
        closing, raw = m.group(1) or m.group(4), m.group(3) or m.group(6) or ""
        if closing:
            if opened[name]:
                if name in BLOCKS:
                    flush()
                if name == "a":
                    links = 0
                depth = len(stack) - 1
                while stack[depth][0] != name:
                    depth -= 1
                close(depth)
            elif name == "p":
                flush()
            continue
        if name == "br" or name == "wbr":
            held.append(" " if name == "br" else "")
            continue
        if name in BLOCKS:
            flush()
            shut = CLOSES.get(name, {"p"}) | ({"p"} if name != "option" else set())
            for depth in reversed(marks):
                if stack[depth][0] in shut:
                    close(depth)
                    break
                if stack[depth][0] in SCOPES:
                    break
        attributes = {k.lower(): (a or b or c) for k, a, b, c in _attribute.findall(raw)} if raw.strip(" /") else {}
        _, parent, aside, region, doubt = stack[-1]
        first = (attributes.get("class") or attributes.get("id") or "").split()
        label = name + (f".{first[0]}" if first else "")
        node = nodes.get((parent, label))
        if node is None:
            node = nodes[parent, label] = len(page.parents)
            page.parents.append(parent)
            page.paths.append(xxhash.xxh64_intdigest(f"{page.paths[parent]}/{label}"))
            page.titles.append(name == "h1" or page.titles[parent])
        told = _is_aside(name, attributes, region == 2)
        if told is None and not doubt:
            doubts += 1
            doubt = doubts
        aside = aside or bool(told)
        if not aside:
            region = 2 if name == "article" else max(region, 1 if name == "main" or attributes.get("role") == "main" else 0)
        if name in BLOCKS:
            page.tokens.append(token("element", page.paths[node]))
            page.places.append(token("place", page.paths[parent], "element"))
        if name in SPACED:
            held.append(" ")
        if name in RAW or name == "noscript" and region != 2:
            if raw.endswith("/") and (opened["svg"] or opened["math"]):
                continue
            shut = re.compile(rf"</{name}\b[^>]*>", re.IGNORECASE).search(html, at)
            at = shut.end() if shut else end
            continue
        if name in VOID or raw.endswith("/") and name not in BLOCKS:
            continue
        if name == "a":
            links = 1
        if name in SCOPES or name in ENDED:
            marks.append(len(stack))
        opened[name] += 1
        stack.append((name, node, aside, region, doubt))
    flush()
    return page


def article_blocks(page: Page, template: set[int]) -> list[str]:
    """Text of the page's article, block by block; ``template`` are its host's template tokens."""
    size, linked = Counter(), Counter()
    for b in page.blocks:
        size[b.doubt] += len(b.text)
        linked[b.doubt] += min(b.linked, len(b.text))
    blocks = [b for b in page.blocks if not b.aside and not (b.doubt and linked[b.doubt] * 2 >= size[b.doubt])
              and token("text", b.path, b.text) not in template]
    if not blocks:
        return []
    own: Counter = Counter()
    slot = [page.parents[b.node] for b in blocks]
    for b, k in zip(blocks, slot, strict=True):
        own[k] += len(b.text) - min(b.linked, len(b.text))
    enough = max(own.values()) * ENOUGH
    for region in (2, 1):  # the markup bounds the article where it agrees with the slots, or there is no template
        marked = [(b, k) for b, k in zip(blocks, slot, strict=True) if b.region >= region]
        if marked and (not template or max(own[k] for _, k in marked) >= enough):
            return [b.text for b, _ in marked]
    linked.clear()
    for b, k in zip(blocks, slot, strict=True):
        linked[k] += min(b.linked, len(b.text))
    region = _least_container([k for k in own if own[k] >= enough and own[k]], page.parents)
    held = [region == 0]
    for node in range(1, len(page.parents)):
        held.append(node == region or held[page.parents[node]])
    inside = [held[b.node] for b in blocks]
    if template:  # what is left outside is no boilerplate; lists of links are menus
        return [b.text for b, near, k in zip(blocks, inside, slot, strict=True) if near or own[k] > linked[k]]
    titled = any(near and page.titles[b.node] for b, near in zip(blocks, inside, strict=True))
    return [b.text for b, near in zip(blocks, inside, strict=True) if near or not titled and page.titles[b.node]]


def _least_container(nodes: list[int], parents: list[int]) -> int:
    """The deepest node that all ``nodes`` are in; the root for none."""
    below = [0] * len(parents)
    for node in nodes:
        below[node] = 1
    for node in range(len(parents) - 1, 0, -1) if nodes else ():
        if below[node] == len(nodes):
            return node  # the first from behind that holds all is the deepest: its ancestors come before it
        below[parents[node]] += below[node]
    return 0


def host_of(url: Column) -> Column:
    """Lower-case host of a URL, empty if it has none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1), F.lit("")))


def _map_pages(pages: DataFrame, schema: str, out: pa.Schema, rows_of) -> DataFrame:
    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for part in parts:
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    yield from rows_of(*row)

        yield from batches(rows(), out)

    return pages.mapInArrow(frugal(run), schema)


def deduce_templates(pages: DataFrame, least_pages: int = LEAST_PAGES, least_tokens: int = LEAST_TOKENS,
                     least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, tokens array<long>): the tokens of each host's valid classes.

    ``pages`` has (host, html).  Pages of one host with the same unmarked text count
    once.  Hosts without a valid class do not appear; pages without host have no
    template.
    """
    hosted = pages.where("host <> ''").select("host", "html")

    def contents(host: str, html: str | None) -> Iterator[tuple]:
        page = parse(html)
        own = "\0".join(b.text for b in page.blocks if not b.aside)
        yield host, xxhash.xxh64_intdigest(own) - (1 << 63), page.tokens, page.places

    distinct = materialise(
        _map_pages(hosted, "host string, content long, tokens array<long>, places array<long>", pa.schema(
            [("host", pa.string()), ("content", pa.int64()), ("tokens", pa.list_(pa.int64())), ("places", pa.list_(pa.int64()))]), contents)
        .groupBy("host", "content").agg(F.min(F.struct("tokens", "places")).alias("p"))
        .select("host", "content", "p.tokens", "p.places"), "page-contents")
    seen = (distinct.select("host", "content", F.explode(F.arrays_zip("tokens", "places")).alias("t"))
            .groupBy("host", "content", F.col("t.tokens").alias("token"), F.col("t.places").alias("place")).agg(F.count("*").alias("n")))
    vectors = seen.groupBy("host", "token", "place").agg(
        F.count("*").alias("pages"), F.sum("n").alias("times"), F.expr("bit_xor(xxhash64(content, n))").alias("vector"))
    place_pages = (distinct.select("host", F.explode(F.array_distinct("places")).alias("place"))
                   .groupBy("host", "place").agg(F.count("*").alias("place_pages")))
    frequent = vectors.where(F.col("pages") >= least_pages).join(place_pages, ["host", "place"]).where(
        F.col("pages") >= F.col("place_pages") * least_share)
    group = Window.partitionBy("host", "vector", "pages", "times")
    frequent = materialise(
        frequent.withColumn("size", F.count("*").over(group)).where(F.col("size") >= least_tokens)
        .groupBy("host").agg(F.collect_list(F.struct("token", F.col("vector").alias("class"))).alias("classes")), "page-classes")

    def orders(host: str, tokens: list[int], classes: list[dict]) -> Iterator[tuple]:
        of = {c["token"]: c["class"] for c in classes}
        places: dict[int, list[tuple[int, int]]] = {}
        for i, t in enumerate(tokens):
            if t in of:
                places.setdefault(of[t], []).append((i, t))
        spans = sorted((p[0][0], -p[-1][0], c) for c, p in places.items())
        crossed, open_spans = set(), []
        for first, last, c in spans:  # spans that overlap without nesting: the later one is no part of a template
            while open_spans and open_spans[-1] < first:
                open_spans.pop()
            if open_spans and open_spans[-1] < -last:
                crossed.add(c)
            else:
                open_spans.append(-last)
        for c, p in places.items():
            unit = len({t for _, t in p})
            sequence = [t for _, t in p]
            once = sequence[:unit]
            regular = len(sequence) % unit == 0 and sequence == once * (len(sequence) // unit)
            yield host, c, xxhash.xxh64_intdigest(str(once)) - (1 << 63), regular and c not in crossed

    joined = distinct.join(frequent, "host").select("host", "tokens", "classes")
    checked = _map_pages(joined, "host string, class long, sequence long, fits boolean", pa.schema(
        [("host", pa.string()), ("class", pa.int64()), ("sequence", pa.int64()), ("fits", pa.bool_())]), orders)
    valid = checked.groupBy("host", "class").agg(
        F.min("sequence").alias("a"), F.max("sequence").alias("b"), F.min("fits").alias("fits")).where("fits and a = b")
    members = frequent.select("host", F.explode("classes").alias("c")).select("host", "c.class", "c.token")
    return materialise(members.join(valid, ["host", "class"], "left_semi").groupBy("host").agg(
        F.collect_list("token").alias("tokens")), "page-templates")


def extract_articles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text): the article's blocks, joined by a line feed; empty if there is none.

    One row per row of ``pages``.  A null html counts as empty, a null url as a
    page without host; repeated rows and copies count once for the template.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url")))
    templates = deduce_templates(rows)

    def texts(page: int, url: str | None, html: str | None, tokens: list[int] | None) -> Iterator[tuple]:
        yield page, url, "\n".join(article_blocks(parse(html), set(tokens or ())))

    return _map_pages(rows.join(templates, "host", "left").select("id", "url", "html", "tokens"),
                      "id long, url string, text string", pa.schema(
                          [("id", pa.int64()), ("url", pa.string()), ("text", pa.string())]), texts)
