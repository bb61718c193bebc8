"""Main text of web pages by paths that the pages of a host agree on (operator 9).

Each page is parsed into its blocks of text outside boilerplate and its containers, which are
scored by the text that stands in them outside links. Its best one votes, under a
generalised path of tags and classes, for its host; votes are counted in Spark. Then each
page is extracted again from that one of its containers whose path has the most votes on the
host, ties by the page's own score. A path with one vote says no more than the page's own
choice, so only repeated ones are looked up.

Votes are summed in each task first, and meet the containers of the pages by host and path: one
narrow row a container, of which a page's best is kept in each task before it moves. Neither
pages nor a host's paths are gathered anywhere, and adaptive execution can split a path that a third of all
pages share.

A page is parsed once for its containers and once for its text, so that of the texts nothing is stored.
What the host decides is a function of host and html and known by their digest. Only decisions against a page's
own choice are kept; where they are many, the blocks of the pages move once to meet them.

NULL and empty html give an empty text; a NULL or unreadable url is the host ''.
Repeated rows give repeated rows. Pages are read whole. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.llm.common import columns, stash

# Comments, declarations, and tags; only a quote after = hides a >.
_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?|[\"'])*+)(?:>|\Z)",
    re.S)
_ATTRIBUTE = re.compile(
    r"(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORDS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_DIGITS = re.compile(r"\d+")

RAW = frozenset("script style noscript template textarea title iframe svg math select "
                "object canvas audio video".split())
BLOCK = frozenset(
    "html head body main article section div nav header footer aside form dialog menu p h1 h2 h3 "
    "h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot caption tr td th blockquote pre figure "
    "figcaption address fieldset details summary hr center hgroup search button".split())
VOID = frozenset(["hr"])
CONTAINER = frozenset("body main article section div td center".split())
CLOSES_P = BLOCK - {"html", "head", "body", "button"}
# A start tag ends an open one of the same kind, unless one of these lies between.
SIBLING = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",),
           "td": ("table", "tr"), "th": ("table", "tr")}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}

BOILERPLATE_TAGS = frozenset("nav aside footer form dialog menu button head search".split())
BOILERPLATE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu "
    "menubar toolbar".split())
BOILERPLATE_WORDS = frozenset(
    "nav navbar navigation menu masthead header footer sidebar aside widget widgets ad ads advert "
    "adverts advertisement advertisements adsense advertising banner sponsor sponsored sponsors "
    "promo promos promotion cookie cookies consent gdpr notice notices notification alert popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social comment "
    "comments disqus reply replies respond related recommended recommendations breadcrumb "
    "breadcrumbs pagination pager toolbar search form hidden copyright outbrain taboola".split())
CONTENT_WORDS = frozenset("article entry post story content".split())
NEGATED = frozenset("with has no without".split())


@dataclass
class Node:
    tag: str
    key: str
    tail: tuple[str, ...]
    skip: bool
    inside: bool  # in an article or main
    container: int  # number of the nearest container, itself included; -1: none
    parent: int  # number of the container above that
    last: int = -1  # number of the last node below
    score: float = 0.0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)  # node, text


def _is_boilerplate(tag: str, inside: bool, attributes: str) -> bool:
    if tag in BOILERPLATE_TAGS or tag == "header" and not inside:
        return True
    if not attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name = m[1].lower()
        value = m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "style":
            if "display:none" in value.replace(" ", "").lower():
                return True
        elif name == "role":
            if value.lower() in BOILERPLATE_ROLES:
                return True
        elif tag not in ("html", "body", "main"):
            for one in value.split():
                words = [w.lower() for w in _WORDS.findall(one)]
                if not words or words[0] in NEGATED:
                    continue
                if words[-1] == "header" and CONTENT_WORDS.intersection(words):
                    continue
                if words[0] in BOILERPLATE_WORDS or words[-1] in BOILERPLATE_WORDS:
                    return True
    return False


def _step(tag: str, attributes: str) -> str:
    """Tag and classes, digits generalised."""
    for m in _ATTRIBUTE.finditer(attributes) if attributes else ():
        if m[1].lower() == "class":
            names = sorted(set(_DIGITS.sub("#", m[2] or m[3] or m[4] or "").lower().split()))
            return ".".join([tag, *names])
    return tag


def parse(source: str | None) -> Page:
    """Elements that matter, in order, and the blocks of text outside boilerplate."""
    page, text = Page(), source or ""
    nodes, stack, opened = page.nodes, [], Counter()
    parts: list[str] = []
    linked = 0
    in_link = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            block = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            if block:
                node = stack[-1] if stack else -1
                page.blocks.append((node, block))
                if node >= 0:
                    own = nodes[node].container
                    gain = max(0, len(block) - linked)
                    if own >= 0:
                        nodes[own].score += gain
                        if (above := nodes[own].parent) >= 0:
                            nodes[above].score += gain / 2
        linked = 0

    def close() -> None:
        node = nodes[stack.pop()]
        node.last = len(nodes) - 1
        opened[node.tag] -= 1

    at = 0
    while True:
        m = _TAG.search(text, at)
        upto = m.start() if m else len(text)
        if upto > at and not (stack and nodes[stack[-1]].skip):
            parts.append(text[at:upto])
            if in_link:
                linked += upto - at
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        ends, attributes = m[1], m[3].strip(" /\t\n\r\f")
        if tag in RAW:
            if not ends and not m[3].endswith("/"):
                end = re.compile(f"</{tag}[^>]*>", re.I).search(text, at)
                at = end.end() if end else len(text)
            continue
        if tag == "a":
            in_link = 0 if ends else 1
        elif tag == "br":
            parts.append(" ")
        if ends:
            if opened[tag] > 0:
                flush()
                while nodes[stack[-1]].tag != tag:
                    close()
                close()
            elif tag in BLOCK:
                flush()
            continue
        inside = bool(stack) and nodes[stack[-1]].inside
        block = tag in BLOCK
        if not block and not attributes:
            continue
        boilerplate = _is_boilerplate(tag, inside, attributes)
        if not block and (not boilerplate or tag in ("a", "br", "img", "input", "meta", "link")):
            continue
        flush()
        if block:
            if stack and nodes[stack[-1]].tag == "p" and tag in CLOSES_P:
                close()
            if tag in SIBLING:
                kinds = SAME.get(tag, (tag,))
                for depth in range(len(stack) - 1, -1, -1):
                    kind = nodes[stack[depth]].tag
                    if kind in kinds:
                        while len(stack) > depth:
                            close()
                        break
                    if kind in SIBLING[tag] or kind in CONTAINER:
                        break
        if tag in VOID:
            continue
        up = nodes[stack[-1]] if stack else None
        step = _step(tag, attributes)
        number = len(nodes)
        key, tail = up.key if up else "", up.tail if up else ()
        if tag in CONTAINER:
            key = hashlib.md5(f"{key}>{step}".encode()).hexdigest()[:16]
            tail = (*tail, step)[-3:]
        node = Node(tag, key, tail, boilerplate or bool(up and up.skip),
                    inside or tag in ("article", "main"), -1, -1)
        own = up.container if up else -1
        node.container, node.parent = (number, own) if tag in CONTAINER else (own, -1)
        nodes.append(node)
        stack.append(number)
        opened[tag] += 1
    flush()
    while stack:
        close()
    _whole_articles(page)
    return page


def _whole_articles(page: Page) -> None:
    """An article or main element counts all that stands in it, and so beats its parts."""
    sums = [0]
    at = [n for n, _ in page.blocks]
    for _, block in page.blocks:
        sums.append(sums[-1] + len(block))
    lo = 0
    for number, node in enumerate(page.nodes):
        if node.tag in ("article", "main") and not node.skip:
            while lo < len(at) and at[lo] < number:
                lo += 1
            hi = _after(at, lo, node.last)
            node.score = max(node.score, 1.0 * (sums[hi] - sums[lo]))


def _after(at: list[int], lo: int, last: int) -> int:
    """Blocks stand in page order, so those of one element are neighbours."""
    while lo < len(at) and at[lo] <= last:
        lo += 1
    return lo


def candidates(page: Page) -> list[tuple[str, float, int]]:
    """Path, score and number of each container with text; the first of a path stands for it."""
    found: dict[str, tuple[str, float, int]] = {}
    for number, node in enumerate(page.nodes):
        if node.container == number and not node.skip and node.score > 0:
            path = f"{' > '.join(node.tail)} #{node.key}"
            if path not in found or found[path][1] < node.score:
                found[path] = (path, node.score, number)
    return list(found.values())


def best(page: Page, votes: dict[str, int]) -> tuple[str, int] | None:
    """Path and number of the container with the most votes, then score, then the outer one."""
    found = candidates(page)
    if not found:
        return None
    path, _, number = max(found, key=lambda c: (votes.get(c[0], 1), c[1], -c[2]))
    return path, number


def main_text(source: str | None, votes: dict[str, int]) -> str:
    page = parse(source)
    chosen = best(page, votes)
    if chosen is None:
        return "\n".join(b for n, b in page.blocks)
    number = chosen[1]
    last = page.nodes[number].last
    return "\n".join(b for n, b in page.blocks if number <= n <= last)


def _host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)),
                      F.lit(""))


CONTAINERS = "array<struct<path:string,score:double,number:int,last:int>>"
BLOCKS = "array<struct<node:int,block:string>>"


def _digest(url: str, source: str):
    """Of host and html. No host has a slash."""
    return F.unhex(F.sha2(F.concat(_host(url), F.lit("/"), F.coalesce(F.col(source), F.lit(""))), 256))


def _ranked(page: Page) -> list[tuple[str, float, int]]:
    """Candidates in the order of the page's own choice."""
    return sorted(candidates(page), key=lambda c: (-c[1], c[2]))


def read(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """Host, digest and containers of each page, stored.

    A container has its path, score, and first and last node. Containers stand in the order of
    the page's own choice.
    """
    container = pa.struct([("path", pa.string()), ("score", pa.float64()), ("number", pa.int32()), ("last", pa.int32())])

    def run(batches):
        for batch in batches:
            found = []
            for (texts,) in columns(batch, "body"):
                for page in map(parse, texts):
                    found.append([{"path": path, "score": score, "number": n, "last": page.nodes[n].last}
                                  for path, score, n in _ranked(page)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(found, pa.list_(container))], names=["host", "digest", "containers"])

    rows = pages.select(_host(url).alias("host"), _digest(url, source).alias("digest"), F.col(source).alias("body"))
    return stash(rows.mapInArrow(run, f"host string, digest binary, containers {CONTAINERS}"), "containers")


def blocks(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """Of each page key, url, digest, blocks, and the nodes from low to high that it would choose itself.

    A block has its node and its text.
    """
    schema = T.StructType([
        T.StructField("page", pages.schema[key].dataType), T.StructField("url", pages.schema[url].dataType),
        T.StructField("digest", T.BinaryType()), T.StructField("low", T.IntegerType()),
        T.StructField("high", T.IntegerType()), T.StructField("blocks", T._parse_datatype_string(BLOCKS))])
    block = pa.struct([("node", pa.int32()), ("block", pa.string())])

    def run(batches):
        for batch in batches:
            low, high, found = [], [], []
            for (texts,) in columns(batch, "body"):
                for page in map(parse, texts):
                    chosen = best(page, {})
                    low.append(chosen[1] if chosen else -1)
                    high.append(page.nodes[chosen[1]].last if chosen else (1 << 31) - 1)
                    found.append([{"node": n, "block": b} for n, b in page.blocks])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(low, pa.int32()), pa.array(high, pa.int32()),
                 pa.array(found, pa.list_(block))], names=schema.names)

    rows = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), _digest(url, source).alias("digest"),
                        F.col(source).alias("body"))
    return rows.mapInArrow(run, schema)


def tally(known: DataFrame) -> DataFrame:
    """Host, path and votes, for paths that at least two pages of the host chose."""
    chosen = known.filter(F.size("containers") > 0).select("host", F.col("containers")[0]["path"].alias("path"))
    return chosen.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes")).filter("votes > 1")


def vote(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """Host, path and votes of a table of pages."""
    return tally(read(pages, url, source))


def winners(votes: DataFrame) -> DataFrame:
    """The winning path of each host."""
    return votes.groupBy("host").agg(F.max_by("path", F.struct("votes", "path")).alias("path"),
                                     F.max("votes").alias("votes"))


def overruled(known: DataFrame) -> DataFrame:
    """Digest, and first and last node, of pages for which the votes of their host choose another container."""
    votes = stash(tally(known), "votes")
    single = known.select("host", "digest", F.col("containers")[0]["number"].alias("own"),
                          F.explode("containers").alias("c")).select("host", "digest", "own", "c.*")
    agreed = single.join(votes, ["host", "path"]).groupBy("digest").agg(
        F.first("own").alias("own"),
        F.max(F.struct("votes", "score", (-F.col("number")).alias("first"), "last")).alias("agreed"))
    return agreed.select("digest", "own", (-F.col("agreed.first")).alias("first"), F.col("agreed.last").alias("last")) \
        .filter("first <> own").drop("own")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url",
            source: str = "html") -> DataFrame:
    """Key, url, main text and its length in code points, for every page."""
    # Stored, so that Spark knows the size and broadcasts it where it is small.
    other = stash(overruled(read(pages, url, source)), "overruled")
    rows = blocks(pages, key, url, source).join(other, "digest", "left")
    rows = rows.select("page", "url", "blocks", F.coalesce("first", "low").alias("first"),
                       F.coalesce("last", "high").alias("last"))
    inside = F.filter("blocks", lambda b: (b["node"] >= F.col("first")) & (b["node"] <= F.col("last")))
    text = F.concat_ws("\n", F.transform(inside, lambda b: b["block"]))
    rows = rows.select("page", "url", text.alias("text"))
    return rows.select(F.col("page").alias(key), F.col("url").alias(url), "text",
                       F.length("text").cast("long").alias("n_chars"))
