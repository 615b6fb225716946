"""Main text of web pages by host-wide consensus on where it stands.

Every page's containers are scored by the text they hold outside boilerplate and
links. Each page votes for the generalised paths (tags and classes, without numbers)
of its best containers, or of what encloses them if that holds more of the text; Spark
sums the votes of each host. The winning path of a host then says where to extract on
its pages, with what encloses it there below the body, and a page without such a
container, or without a host, uses its own best one.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import column, cut_lineage, load

# A container votes if it scores at least this share of its page's best one.
VOTE_SHARE = 0.5
# What a container's parent gets of the score of a text.
PARENT_SHARE = 0.5
# The body encloses an article if it holds at least this share of its text beside it.
BODY_SHARE = 0.2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|svg|title|select|object)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_WORD = re.compile(r"[a-z]+")
_NUMBER = re.compile(r"[-_]?\d+")

_CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "dd", "center", "details"}
# Whole elements that never belong to an article.
_DROPPED_TAGS = {"head", "nav", "header", "footer", "aside", "form", "button", "dialog", "menu"}
_DROPPED_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
    "comments", "consent", "cookie", "cookies", "disclaimer", "disqus", "footer", "gdpr", "header", "login", "masthead",
    "menu", "menus", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "notification",
    "pagination", "popup", "promo", "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup",
    "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}
# Words that stand beside those in a name without changing what it means.
_PLAIN_WORDS = {
    "area", "bar", "block", "bottom", "box", "buttons", "container", "content", "form", "group", "inner", "item", "items", "left", "link", "links",
    "list", "main", "outer", "page", "panel", "post", "posts", "primary", "right", "secondary", "section", "site", "slot", "text", "title", "top",
    "unit", "wrap", "wrapper",
}
_NEVER_DROPPED = {"html", "body", "main", "article", "h1", "h2", "h3", "h4", "h5", "h6"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr",
}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}


class Node(NamedTuple):
    tag: str
    # Place in the list of containers; of a dropped element, that of the container around it.
    container: int
    dropped: bool


class Page(NamedTuple):
    """Containers by number: generalised path and parent; and the texts kept: container, words, link share, new block."""

    paths: list[str]
    parents: list[int]
    texts: list[tuple[int, str, bool, bool]]


def _label(tag: str, attributes: str) -> tuple[str, bool]:
    """Generalised name of an element, and whether its names mark it as boilerplate."""
    if "=" not in attributes:
        return tag, False
    named = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    names = [set(_WORD.findall(name)) for value in named.values() for name in value.split()]
    classes = sorted({c for c in (_NUMBER.sub("", x) for x in named.get("class", "").split()) if c})
    return ".".join([tag, *classes]), tag not in _NEVER_DROPPED and any(words & _DROPPED_WORDS and words <= _DROPPED_WORDS | _PLAIN_WORDS for words in names)


def parse(html: str) -> Page:
    """Containers and kept texts in page order; forgiving about what isn't closed."""
    paths, parents, texts = [""], [-1], []
    stack = [Node("", 0, False)]
    linked, fresh, at = False, True, 0

    def text(start: int, stop: int) -> None:
        nonlocal fresh
        top = stack[-1]
        if stop > start and not top.dropped:
            piece = html[start:stop]
            if not piece.isspace() or not fresh:
                texts.append((top.container, unescape(piece) if "&" in piece else piece, linked, fresh))
                fresh = False

    for found in _TOKEN.finditer(html):
        text(at, found.start())
        at = found.end()
        tag = found[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "a":
            linked = not found[2]
            continue
        if tag in _INLINE:
            # Named boilerplate is dropped even where it is inline.
            if tag == "span" and not found[2] and "=" in found[4] and not found[4].endswith("/") and _label(tag, found[4])[1]:
                stack.append(Node(tag, stack[-1].container, True))
            elif tag == "span" and found[2] and stack[-1].tag == "span":
                stack.pop()
            elif tag == "span" and stack[-1].tag == "span":
                stack.append(stack[-1])
            continue
        fresh = True
        if found[2]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if stack[-1].tag == "p":  # a paragraph ends where the next block begins
            stack.pop()
        if tag in _VOID or found[4].endswith("/"):
            continue
        top = stack[-1]
        label, marked = _label(tag, found[4])
        dropped = top.dropped or marked or tag in _DROPPED_TAGS
        if tag in _CONTAINERS and not dropped:
            paths.append(f"{paths[top.container]}>{label}")
            parents.append(top.container)
            stack.append(Node(tag, len(paths) - 1, False))
        elif dropped and (tag in _CONTAINERS or tag in _DROPPED_TAGS or marked or any(n.tag == tag for n in stack)):
            stack.append(Node(tag, top.container, True))
    text(at, len(html))
    return Page(paths, parents, texts)


def scores(page: Page) -> list[float]:
    """Per container: letters of its own texts outside links, with a share of its children's."""
    own = [0.0] * len(page.paths)
    for container, piece, linked, _ in page.texts:
        worth = len(piece.strip()) * (-0.5 if linked else 1.0)
        own[container] += worth
        if page.parents[container] >= 0:
            own[page.parents[container]] += PARENT_SHARE * worth
    return own


def enclosing(page: Page, chosen: set[int], body: bool) -> set[int]:
    """The containers, each replaced by the one around it that holds more of its text.

    A parent counts if it has text of its own or other children with text, links taken
    off; an article or main element counts above parents that have none, too. The body
    counts only if `body` is set, and by its share; nothing above it does.
    """
    own = [0.0] * len(page.paths)
    for container, piece, linked, _ in page.texts:
        own[container] += len(piece.strip()) * (-0.5 if linked else 1.0)
    total = own.copy()
    for k in range(len(own) - 1, 0, -1):
        total[page.parents[k]] += total[k]
    # What each container holds in text of its own and in children, without losses by links.
    held = [max(value, 0.0) for value in own]
    for k in range(1, len(own)):
        held[page.parents[k]] += max(total[k], 0.0)
    tags = [path.rpartition(">")[2].partition(".")[0] for path in page.paths]
    inside: dict[int, float] = {}
    for k in chosen:
        inside[page.parents[k]] = inside.get(page.parents[k], 0.0) + max(total[k], 0.0)
    out = set()
    for first in chosen:
        top, below, near = first, first, True
        while (up := page.parents[below]) > 0 and tags[up] != "html":
            mine = inside.get(up, 0.0) if below == first else max(total[below], 0.0)
            more = held[up] - mine
            if tags[up] == "body":
                if body and near and more >= BODY_SHARE * max(mine, 1.0):
                    top = up
                break
            if more > 0 and (near or tags[up] in ("article", "main")):
                top, near = up, True
            else:
                near = False
            below = up
        out.add(top)
    return out


def votes(page: Page) -> dict[str, float]:
    """Paths of a page's good containers, or of what encloses them, with their share of its best score."""
    found: dict[str, float] = {}
    for path, value in zip(page.paths, scores(page), strict=True):
        if value > 0:
            found[path] = found.get(path, 0.0) + value
    best = max(found.values(), default=0.0)
    out: dict[str, float] = {}
    for path, value in found.items():
        if value >= VOTE_SHARE * best:
            for k in enclosing(page, {k for k, p in enumerate(page.paths) if p == path}, True):
                out[page.paths[k]] = max(out.get(page.paths[k], 0.0), value / best)
    return out


def extract(page: Page, path: str | None) -> str:
    """Text in all containers at the path and what encloses them, or else in the page's best ones."""
    chosen = {k for k, p in enumerate(page.paths) if p == path}
    if not chosen:
        best = votes(page)
        if not best:
            return ""
        top = max(best, key=lambda p: (best[p], p))
        chosen = {k for k, p in enumerate(page.paths) if p == top}
    chosen = enclosing(page, chosen, False)
    for k, parent in enumerate(page.parents):  # parents come before their children
        if parent in chosen:
            chosen.add(k)
    out = []
    for container, piece, _, fresh in page.texts:
        if container in chosen:
            out.append(f" {piece}" if fresh else piece)
    return " ".join("".join(out).split())


# ---------------------------------------------------------------------- Spark


def _voter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, shares = [], [], []
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for path, share in votes(parse(html)).items():
                hosts.append(host)
                paths.append(path)
                shares.append(round(share * 1000))
        columns = [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(shares, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["host", "path", "share"])


def _extractor(place: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, paths = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [extract(parse(html), path) if html else "" for html, path in zip(pages, paths, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[place:], pa.array(texts, pa.string())], [*batch.schema.names[place:], "__text"])

    return run


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`host` and its winning `path`: most votes, then the longer path, then the later in order."""
    heard = pages.select(host_of(url_col).alias("host"), F.col(html_col).alias("html")).filter("host <> '' AND html <> ''")
    tally = heard.mapInArrow(_voter, "host string, path string, share long").groupBy("host", "path").agg(F.sum("share").alias("share"))
    return tally.groupBy("host").agg(F.max_by("path", F.struct("share", F.length("path"), "path")).alias("path"))


def host_of(url_col: str):
    return F.lower(F.regexp_extract(F.col(url_col), r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))


def main_text(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """All rows and columns but the html, with `text` and `n_chars`, its code points.

    Null or empty html gives empty text. A null or unreadable url has no host to agree
    with, so such a page is judged alone. Input columns named `text` or `n_chars` are
    replaced. Repeated rows stay. An empty table stays empty.
    """
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    # A small table in most cases, so that pages needn't move; else a plain, splittable join.
    winners = cut_lineage(host_paths(pages, url_col, html_col))
    named = pages.select(column(html_col).alias("__html"), host_of(url_col).alias("__host"), *[column(c).alias(f"__{i}") for i, c in enumerate(kept)])
    placed = named.join(winners, F.col("__host") == F.col("host"), "left").select("__html", "path", *[f"__{i}" for i in range(len(kept))])
    schema = placed.select(*[f"__{i}" for i in range(len(kept))], F.lit("").alias("__text")).schema
    texts = placed.mapInArrow(_extractor(2), schema)
    back = [F.col(f"__{i}").alias(c) for i, c in enumerate(kept)]
    return texts.select(*back, F.col("__text").alias("text"), F.length("__text").cast("long").alias("n_chars"))


def op5_html_main_text(spark, sf_dir: str) -> DataFrame:
    return main_text(load(spark, sf_dir, "pages", "page_id", "url", "html"))


QUERIES = {"op5_html_main_text": op5_html_main_text}
ORACLES: dict[str, str] = {}
