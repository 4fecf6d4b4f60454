"""Main text of web pages by consensus paths of their host.

Every page is read into elements and blocks of text. Elements that are marked as something else by tag,
class, id or role (menus, headers, footers, sidebars, notices, adverts, forms, comments) are left out.
A class or id marks an element only if all its words say so (`cookie-notice`, not `share-prices`), and such
a mark, or that of a form or dialog, is lifted from an element that holds the page's text itself: its main
heading, article or main element with a good part of the text, or most of the text where nothing else has these.

Every container votes under its generalised path of tags and classes (numbers and serial parts removed)
whether it holds all of the page's remaining text, text in links aside. Spark sums the votes per host and
path; a path that holds all of it on nearly all pages that have the path, and that is not rare on its host,
is a consensus path. Each page is then read again, and the text of the elements on its deepest consensus
path that holds all of this page's remaining text is its main text, with the lists of links inside it; lists
of links outside it are menus. Text that is not marked and not in links is never cut, wherever it stands.

Defined cases: a null or empty page, or one of markup only, has an empty text; a null URL has an empty
host, which votes like any other; a page with none of its host's paths falls back on its own votes; a page
with all text in links counts that text; an unclosed comment, script or tag ends with the page; only void
elements close themselves; equal pages of a host get equal texts; an empty table
gives an empty result. Columns named like a result are replaced, all others pass through.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetday.llm import url_filter
from fleetday.sources.tables import stage

#: Share of the pages with a consensus path on which it has to hold all text, and of a host's pages that have it.
SHARE = 0.9
SUPPORT = 0.01
#: Shares of a page's text from which an element with the main heading, and any element, keeps its text despite a mark.
PART, MOST = 1 / 3, 1 / 2
DEEPEST = 40

BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead "
    "tr ul caption option".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("html body main article section div td center table tbody tr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noframes".split())
#: An element of the first closes an open one of the second when it begins.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
OTHER_TAGS = frozenset(
    "nav footer aside form button select dialog menu menuitem svg canvas object audio video label input datalist head".split()
)
NEVER_OTHER = frozenset(("html", "body", "main", "article"))
OTHER_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts adsense banner banners sponsor sponsored promo promos promotion nav "
    "navbar navigation menu menus menubar breadcrumb breadcrumbs footer foot sidebar sidebars aside widget widgets cookie "
    "cookies consent gdpr notice notices alert alerts popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended recommendations comment comments commentlist disqus respond replies "
    "pagination pager toolbar skip masthead topbar form search paywall".split()
)
#: Words that say nothing of what a class or id marks.
PLAIN_WORDS = frozenset(
    "site page main global top bottom left right inner outer upper lower primary secondary fixed sticky small large mobile desktop "
    "box wrap wrapper container area block section row col column panel group unit slot bar list lists item items link links "
    "title text content heading button btn icon icons image img body post posts article articles entry blog user reader js id".split()
)
#: Marks that stay although much of a page's text is in them.
READERS_WORDS = frozenset("comment comments commentlist disqus respond replies".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/]|\Z))""", re.I)
_TARGET = re.compile(r"(?:^|[\s\"'/])href\s*=", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SERIAL = re.compile(r"[^a-z]*\d[^\s]*")


NONE, SOFT, READERS, HARD = range(4)


@dataclass
class Page:
    """Elements as parallel lists (0 is the page itself) and blocks as (element, text, characters in links)."""

    tag: list[str] = field(default_factory=lambda: ["html"])
    path: list[str] = field(default_factory=lambda: ["html"])
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    mark: list[int] = field(default_factory=lambda: [NONE])
    link: list[bool] = field(default_factory=lambda: [False])
    other: list[bool] = field(default_factory=lambda: [False])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _says_other(token: str) -> set[str]:
    """The telling words of a class or id if all its words are telling or plain."""
    words = {w.lower() for w in _WORD.findall(token)}
    telling = words & OTHER_WORDS
    return telling if telling and words <= OTHER_WORDS | PLAIN_WORDS else set()


def _marks(tag: str, attributes: str, in_article: bool) -> tuple[int, str]:
    """Whether an element is marked as something other than main text, and its generalised name."""
    mark = SOFT if tag in ("form", "dialog") else HARD if tag in OTHER_TAGS or (tag == "header" and not in_article) else NONE
    name = tag
    if attributes and not attributes.isspace():
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id"):
                if tag not in NEVER_OTHER:
                    for token in value.split():
                        words = {w.lower() for w in _WORD.findall(token)}
                        if "header" in words and not in_article and words <= PLAIN_WORDS | {"header"} and not words & {"article", "entry", "post"}:
                            mark = max(mark, SOFT)
                        elif telling := _says_other(token):
                            mark = max(mark, READERS if telling & READERS_WORDS else SOFT)
                if key == "class":
                    classes = sorted({_SERIAL.sub("#", c.lower()) for c in value.split()})
                    name = ".".join([tag, *classes])
            elif key == "role":
                if value.lower() in OTHER_ROLES:
                    mark = max(mark, SOFT if value.lower() in ("form", "dialog", "search", "alert") else HARD)
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                mark = HARD
            elif key == "style" and re.search(r"display\s*:\s*none", value, re.I):
                mark = HARD
    return mark, name


def settle(page: Page) -> None:
    """Decide which elements are other than main text: those below a mark that is not lifted."""
    size = len(page.tag)
    hard = [False] * size
    for i, up in enumerate(page.parent):
        hard[i] = page.mark[i] == HARD or (up >= 0 and hard[up])
    held = [0] * size
    for at, text, linked in page.blocks:
        if not hard[at]:
            held[at] += max(0, len(text) - linked)
    heads = [not h and tag in ("h1", "main", "article") for h, tag in zip(hard, page.tag)]
    for i in range(size - 1, 0, -1):
        held[page.parent[i]] += held[i]
        heads[page.parent[i]] |= heads[i]
    soft = [False] * size
    for i, up in enumerate(page.parent):
        soft[i] = page.mark[i] in (SOFT, READERS) or (up >= 0 and soft[up])
    free_head = any(tag in ("h1", "main", "article") and not soft[i] and not hard[i] and held[i] for i, tag in enumerate(page.tag))
    for i, up in enumerate(page.parent):
        lifted = page.mark[i] == NONE
        if page.mark[i] in (SOFT, READERS):
            of_readers = page.mark[i] == READERS
            lifted = (heads[i] and held[i] >= PART * held[0] and not (of_readers and free_head)) or (
                held[i] >= MOST * held[0] > 0 and not free_head and not of_readers
            )
        page.other[i] = (up >= 0 and page.other[up]) or not lifted


def parse(source: str) -> Page:
    page = Page()
    stack = [0]
    text: list[str] = []
    linked, in_link, article = 0, 0, 0

    def flush() -> None:
        nonlocal text, linked
        if text:
            whole = " ".join(entities.unescape("".join(text)).split())
            if whole:
                page.blocks.append((stack[-1], whole, linked))
            text, linked = [], 0

    def pop(to: int) -> None:
        """Close all elements above the stack's place `to`, and that one."""
        nonlocal in_link, article
        for i in stack[to:]:
            in_link -= page.link[i]
            article -= page.tag[i] in ("article", "main")
        del stack[to:]

    def close(tags: set[str], until: frozenset[str] | set[str]) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if page.tag[stack[at]] in tags:
                pop(at)
                return
            if page.tag[stack[at]] in until:
                return

    at, end = 0, len(source)
    while at < end:
        found = _TOKEN.search(source, at)
        upto = found.start() if found else end
        if upto > at:
            part = source[at:upto]
            text.append(part)
            if in_link:
                linked += len(part)
        if not found:
            break
        at = found.end()
        closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if tag in BLOCKS:
                flush()
            if tag != "html":
                for i in range(len(stack) - 1, 0, -1):
                    open_tag = page.tag[stack[i]]
                    if open_tag == tag:
                        pop(i)
                        break
                    # an inline end tag doesn't close blocks; a cell's doesn't leave its table
                    if (tag not in BLOCKS and open_tag in BLOCKS) or (open_tag == "table" and tag in ("td", "th", "tr")):
                        break
            continue
        if tag in RAW:
            shut = re.compile(rf"</{tag}\b[^>]*>", re.I).search(source, at)
            at = shut.end() if shut else end
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCKS:
            flush()
            close({"p"}, CONTAINERS | {"li", "blockquote"})
            if tag in CLOSES:
                close(CLOSES[tag], {"ul", "ol", "dl", "table", "select"})
        if tag in VOID or tag == "html":
            continue
        if tag == "a":
            close({"a"}, BLOCKS)
        up = stack[-1]
        mark, name = _marks(tag, attributes, article > 0)
        deep = page.depth[up] + 1
        page.tag.append(tag)
        page.parent.append(up)
        page.depth.append(deep)
        page.path.append(f"{page.path[up]}>{name}" if deep <= DEEPEST and tag in BLOCKS else page.path[up])
        page.mark.append(mark)
        page.other.append(False)
        stack.append(len(page.tag) - 1)
        # an anchor without a target is no link
        page.link.append(tag == "a" and _TARGET.search(attributes) is not None)
        in_link += page.link[-1]
        article += tag in ("article", "main")
    flush()
    settle(page)
    return page


def weights(page: Page) -> list[int]:
    """Per block its characters outside links, first-level headings whole; 0 for what is not main text."""
    heading = [tag == "h1" for tag in page.tag]
    for i, up in enumerate(page.parent):
        heading[i] |= up >= 0 and heading[up]
    out = [0 if page.other[at] else len(text) if heading[at] else max(0, len(text) - linked) for at, text, linked in page.blocks]
    return out if any(out) else [0 if page.other[at] else len(text) for at, text, _ in page.blocks]


def votes_of(page: Page) -> dict[str, tuple[int, bool]]:
    """Per path of the page: its depth, and whether a container's elements on it hold all text."""
    weight = weights(page)
    own = [0] * len(page.tag)
    for (at, _, _), w in zip(page.blocks, weight):
        own[at] += w
    total = sum(weight)
    if not total:
        return {}
    for i in range(len(own) - 1, 0, -1):
        own[page.parent[i]] += own[i]
    held: dict[str, int] = {}
    for i, (path, up) in enumerate(zip(page.path, page.parent)):
        # an inline element, or one below DEEPEST, shares the path of one above it, whose text it is part of
        if not page.other[i] and (up < 0 or page.path[up] != path):
            held[path] = held.get(path, 0) + (own[i] if page.tag[i] in CONTAINERS else 0)
    return {p: (p.count(">"), w == total) for p, w in held.items()}


def main_text(page: Page, paths: list[str]) -> str:
    """Text of the elements on the first of `paths` (deepest first) that holds all text of the page, else on the page's own."""
    weight, have = weights(page), set(page.path)

    def under(path: str) -> list[bool]:
        inside = [False] * len(page.tag)
        for i, up in enumerate(page.parent):
            inside[i] = (page.path[i] == path and not page.other[i]) or (up >= 0 and inside[up])
        return inside

    def holds(inside: list[bool]) -> bool:
        return all(inside[at] for (at, _, _), w in zip(page.blocks, weight) if w)

    inside = next((x for x in (under(p) for p in paths if p in have) if holds(x)), None) if any(weight) else None
    if inside is None:
        full = [(d, p) for p, (d, whole) in votes_of(page).items() if whole]
        inside = under(max(full)[1] if full else "html")
    return "\n".join(text for at, text, _ in page.blocks if inside[at] and not page.other[at])


def _votes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, path, depth, whole) for every path of a page, and one row without a path per page."""
    for batch in batches:
        rows: list[tuple] = []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows.append((host, None, 0, 0))
            if source:
                rows += [(host, p, d, int(whole)) for p, (d, whole) in votes_of(parse(source)).items()]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "path", "depth", "whole"])


def consensus_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, paths): a host's consensus paths, the deepest first.

    They are on SUPPORT of the host's pages at least, and a page has few paths, so the lists are bounded
    however many pages a host has; votes are summed before they are shuffled.
    """
    votes = (
        pages.select(url_filter.host(F.col(url)).alias("host"), F.col(html).alias("html"))
        .mapInArrow(_votes, "host string, path string, depth int, whole int")
        .groupBy("host", "path", "depth").agg(F.count(F.lit(1)).alias("n"), F.sum("whole").alias("whole"))
    )
    votes = stage(votes, "votes")
    sizes = votes.where("path is null").select(F.col("host").alias("_host"), F.col("n").alias("pages"))
    judged = votes.where("path is not null").join(sizes, F.col("host") == F.col("_host")).where(
        (F.col("whole") >= SHARE * F.col("n")) & (F.col("n") >= SUPPORT * F.col("pages"))
    )
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("depth")).alias("d"), (-F.col("n")).alias("n"), "path")))
    return judged.groupBy("host").agg(F.transform(ranked, lambda x: x["path"]).alias("paths"))


def _texts(sources: pa.Array, paths: pa.Array) -> pa.Array:
    rows = zip(sources.to_pylist(), paths.to_pylist())
    return pa.array([main_text(parse(s), p or []) if s else "" for s, p in rows], pa.string())


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`pages` with `text`, the main text of every page."""
    paths = stage(consensus_paths(pages, url, html), "paths").withColumnsRenamed({c: f"_{c}" for c in ("host", "paths")})
    kept = pages.drop(*[c for c in ("text", *paths.columns) if c not in (url, html)])
    joined = kept.join(paths, url_filter.host(F.col(url)) == F.col("_host"), "left")
    found = F.arrow_udf(_texts, "string")(F.col(html), F.col("_paths"))
    return joined.withColumn("text", found).drop(*paths.columns)
