"""Near-duplicates by SimHash, linked through vantage-point trees (operator 11).

A fingerprint has 64 bits; a bit is set if it is set in over half of the hashes of a
text's shingles, repeats included. Texts link if their fingerprints differ in at most
NEAR bits, and links lead on: a component is all that can be reached.

Only distinct fingerprints are compared. A vantage-point tree over a bounded sample
deals them to shards: a node parts what lies within a radius of its point from what lies
beyond. By the triangle bound a fingerprint has links beyond its own side only if its
distance is within NEAR of the radius; then it is dealt to the other side as well, as a
visitor. So every pair meets in the shard that one of the two calls home, whatever the sample
was. A shard is searched by trees of the same kind, grown from its own fingerprints down to
LEAF of them, which are compared one by one. A shard hands on no more links than it has
fingerprints, enough to keep together what is linked.

Fingerprints that no point tells apart, being all within a few bits of one another, are
looked up by their neighbours, all numbers that differ in at most NEAR bits, where that is
less work than to compare them.

Texts without a word (NULL, empty, blank) have fingerprint zero and link like any other. Texts
with fewer words than a shingle have one shingle of them all. Equal rows are one fingerprint.
Of NULL keys none is the smallest; a component without any key has NULL. An empty table has
no rows. Other columns are ignored. Texts are read whole, in pieces of bounded memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.llm.common import columns, stash
from paywarden.llm.graph import components

SHINGLE = 3
SEED = 42
NEAR = 2
# Fingerprints that shards are laid out by, on average half of them, and how many a shard should
# have. There are at most SAMPLE / SAMPLE_LEAF shards; with more fingerprints the shards are larger.
SAMPLE = 65_536
SAMPLE_LEAF = 16
SHARD = 10_000
LEAF = 64
CANDIDATES = 6
# Shingles hashed at once.
PIECE = 65_536
# Comparisons beyond which neighbours are looked up.
COMPARED = 400_000_000

_LOWER = bytes(range(256)).lower()


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    width = min(SHINGLE, len(words))
    total = len(words) - width + 1
    ones = np.zeros(64, np.int64)
    for start in range(0, total, PIECE):
        part = words[start:min(start + PIECE, total) + width - 1]
        shingles = map(b" ".join, zip(*(part[k:] for k in range(width))))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns key and print, the fingerprint as a signed number."""
    schema = T.StructType([docs.schema[key], T.StructField("print", T.LongType())])

    def run(batches):
        for batch in batches:
            found = [fingerprint(body) for (texts,) in columns(batch, text) for body in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


def distance(prints: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(prints ^ point)


@dataclass(frozen=True)
class Vantage:
    """A node: what is within ``radius`` of ``point`` is inside. Children are nodes or shard numbers."""

    point: np.uint64
    radius: int
    inside: Vantage | int
    outside: Vantage | int


def chosen(homes: np.ndarray) -> tuple[np.uint64, int]:
    """The point and radius that part the fingerprints well with few at the border."""
    best = (np.inf, homes[0], 0)
    for point in homes[np.linspace(0, len(homes) - 1, CANDIDATES).astype(int)]:
        within = np.cumsum(np.bincount(distance(homes, point), minlength=65 + NEAR)) / len(homes)
        below = np.concatenate([np.zeros(NEAR), within])
        for radius in range(64):
            inside, outside = within[min(radius + NEAR, 64)], 1 - below[radius]
            # Work on two parts of these shares, were it to grow with the square of their sizes.
            work = inside ** 2 + outside ** 2
            if within[radius] > 0 and work < best[0]:
                best = (work, point, radius)
    return best[1], best[2]


def planted(sample: np.ndarray, shards: int) -> tuple[Vantage | int, int]:
    """A tree with about that many shards, and how many it has."""
    def grow(part: np.ndarray, wanted: float, number: int) -> tuple[Vantage | int, int]:
        if wanted < 2 or len(part) < 2 * SAMPLE_LEAF:
            return number, number + 1
        point, radius = chosen(part)
        near = distance(part, point) <= radius
        if near.all():
            return number, number + 1
        share = near.mean()
        inside, number = grow(part[near], wanted * share, number)
        outside, number = grow(part[~near], wanted * (1 - share), number)
        return Vantage(point, radius, inside, outside), number

    return grow(sample, shards, 0) if len(sample) else (0, 1)


def dealt(tree: Vantage | int, prints: np.ndarray, home: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, fingerprints, which of them are at home there)."""
    todo = [(tree, prints, home)]
    while todo:
        node, prints, home = todo.pop()
        if not len(prints):
            continue
        if not isinstance(node, Vantage):
            yield node, prints, home
            continue
        far = distance(prints, node.point).astype(int)
        inside, outside = far <= node.radius + NEAR, far > node.radius - NEAR
        mine = far <= node.radius
        todo.append((node.inside, prints[inside], (home & mine)[inside]))
        todo.append((node.outside, prints[outside], (home & ~mine)[outside]))


def pairs(prints: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between fingerprints at home and all others, as arrays of both ends."""
    todo = [(prints, home)]
    while todo:
        prints, home = todo.pop()
        homes = prints[home]
        if not len(homes) or len(prints) < 2:
            continue
        if len(homes) > LEAF:
            point, radius = chosen(homes)
            tree = Vantage(point, radius, 0, 1)
            parts = [(p, h) for _, p, h in dealt(tree, prints, home) if h.any()]
            if max(len(p) for p, _ in parts) <= 0.95 * len(prints):
                todo += parts
                continue
        yield from _compared(prints, homes) if len(homes) * len(prints) <= COMPARED else _looked_up(prints, homes)


def _compared(prints: np.ndarray, homes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = max(1, 2_000_000 // len(homes))
    for start in range(0, len(prints), step):
        part = prints[start:start + step]
        row, col = np.nonzero(np.bitwise_count(part[:, None] ^ homes[None, :]) <= NEAR)
        other = part[row] != homes[col]
        yield part[row[other]], homes[col[other]]


def _looked_up(prints: np.ndarray, homes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    homes = np.sort(homes)
    bits = [np.uint64(1 << b) for b in range(64)]
    for size in range(1, NEAR + 1):
        for some in combinations(bits, size):
            other = prints ^ np.bitwise_or.reduce(some)
            at = np.minimum(np.searchsorted(homes, other), len(homes) - 1)
            met = homes[at] == other
            yield prints[met], other[met]


def spanning(prints: np.ndarray, found: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Links that keep together what ``found`` links: each fingerprint with the first of its group."""
    prints = np.unique(prints)
    label = np.arange(len(prints))
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def settle() -> None:
        a = np.concatenate([x for x, _ in held])
        b = np.concatenate([x for _, x in held])
        held.clear()
        while True:
            low = np.minimum(label[a], label[b])
            if (label[a] == label[b]).all():
                return
            for end in (a, b):
                np.minimum.at(label, label[end], low)
            while not (label[label] == label).all():
                label[:] = label[label]

    for a, b in found:
        if len(a):
            held.append((np.searchsorted(prints, a), np.searchsorted(prints, b)))
            size += len(a)
            if size >= 4_000_000:
                settle()
                size = 0
    if held:
        settle()
    moved = np.flatnonzero(label != np.arange(len(prints)))
    return prints[moved], prints[label[moved]]


def links(distinct: DataFrame) -> DataFrame:
    """Columns a and b: links that keep together all fingerprints (column print) that link."""
    rows = distinct.count()
    # About SAMPLE / 2 fingerprints, chosen by a hash of their own.
    one_in = F.lit(max(1, 2 * rows // SAMPLE))
    sample = distinct.filter(F.pmod(F.xxhash64("print"), one_in) == 0).select("print").toPandas()["print"]
    tree, _ = planted(np.sort(sample.to_numpy(np.int64)).view(np.uint64), -(-rows // SHARD))

    def deal(batches):
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for shard, part, home in dealt(tree, prints, np.ones(len(prints), bool)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), shard, np.int32)), pa.array(part.view(np.int64)),
                     pa.array(home)], names=["shard", "print", "home"])

    def search(table: pa.Table) -> pa.Table:
        prints = table["print"].to_numpy().view(np.uint64)
        home = table["home"].to_numpy(zero_copy_only=False).astype(bool)
        a, b = spanning(prints, pairs(prints, home))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    placed = distinct.select("print").mapInArrow(deal, "shard int, print long, home boolean")
    return placed.groupBy("shard").applyInArrow(search, "a long, b long")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each document its fingerprint and the smallest key of its component."""
    rows = stash(fingerprints(docs, key, text), "fingerprints")
    distinct = stash(rows.groupBy("print").agg(F.min(key).alias("least")), "distinct")
    comps = components(stash(links(distinct), "near"))
    placed = distinct.join(comps.withColumnRenamed("id", "print"), "print", "left")
    placed = stash(placed.select("print", "least", F.coalesce("comp", "print").alias("comp")), "placed")
    least = placed.groupBy("comp").agg(F.min("least").alias("component_id"))
    of = placed.join(least, "comp").select("print", "component_id")
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0")
    return rows.join(of, "print").select(key, hexed.alias("fingerprint"), "component_id")
