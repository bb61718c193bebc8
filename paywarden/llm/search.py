"""Ranked lexical search by presence masks (operator 12).

Every item's best documents, by a sum over the item's terms. A term's weight falls with the
number of documents that hold it; its share in a document grows with its occurrences, against
the document's length. All is whole numbers but the logarithm in the weight.

One pass reads the texts and stores for each document its length and how often it holds each
term of the items. A second takes the stored rows in blocks of BLOCK documents. In a block
each term has a bitmap of the documents that hold it. An item parts the block by its terms,
heaviest first: the documents that hold the term, and those that do not. A group is known by
the mask of terms it holds, and no document of it can score more than the largest shares in
the block of the terms it holds or may yet hold. Groups are taken up by descending maximum; a
group that is parted by all terms, or has few documents, is scored exactly. When no group's maximum
reaches the item's worst of the best so far, which is carried from block to block, the item is done.

What a task hands on is the best of each item. Items go to the tasks in blocks of ITEM_BYTES
of text, each with a pass of its own, so what is broadcast does not grow with the items.
Counts and scores cover all documents; no postings list is gathered anywhere.

NULL texts have no terms; such documents are never found, such items find nothing. Of equal
scores the smaller key goes first, then rows as they come; NULL keys go last. Repeated documents are found
each, repeated items are answered each. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.llm.common import columns, fresh, resident, stash

TOP = 10
# Scale of a share, weight of a term's first occurrence, and of the length.
SCALE, ONCE, PLAIN, LENGTH = 1_000_000_000, 1000, 25, 75
BLOCK = 8192
# Documents that are scored without being parted further.
FEW = 8
ITEM_BYTES = 4_000_000
# Bitmaps that a task keeps; of a block of BLOCK documents at most 1 kB each.
BITMAPS = 20_000

_LOWER = bytes(range(256)).lower()
_SPLIT = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in _LOWER)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_SPLIT).split()


@dataclass(frozen=True)
class Items:
    """Some items, and the numbers of their terms; of each item its row, terms and repeats."""

    numbers: dict[bytes, int]
    rows: list[int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]


def read_items(rows: list) -> Items:
    numbers: dict[bytes, int] = {}
    terms, repeats = [], []
    for row in rows:
        found = Counter(terms_of(row["text"]))
        terms.append(np.array([numbers.setdefault(t, len(numbers)) for t in found], np.int64))
        repeats.append(np.array(list(found.values()), np.int64))
    return Items(numbers, [row["row"] for row in rows], terms, repeats)


INDEX = [("n", T.LongType()), ("terms", T.ArrayType(T.IntegerType())), ("counts", T.ArrayType(T.IntegerType()))]


def indexed(docs: DataFrame, sent, name: str, key: str, text: str) -> DataFrame:
    """For each document its key, n, and the items' terms that it holds, with their counts."""
    schema = T.StructType([docs.schema[key], *(T.StructField(c, t) for c, t in INDEX)])

    def run(batches):
        numbers = resident(f"items {name}", lambda: sent.value).numbers
        for batch in batches:
            n, terms, counts = [], [], []
            for (texts,) in columns(batch, text):
                for body in texts:
                    words = terms_of(body)
                    n.append(len(words))
                    found = [(numbers[w], c) for w, c in Counter(words).items() if w in numbers]
                    terms.append([t for t, _ in found])
                    counts.append([c for _, c in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int32()))], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


class Best:
    """The best documents of one item so far, as a heap with the worst on top."""

    def __init__(self):
        self.heap: list[tuple] = []

    def floor(self) -> int:
        """What a document must reach; a score of 0 is no match."""
        return self.heap[0][0] if len(self.heap) == TOP else 1

    def offer(self, score: int, key, number: int) -> None:
        # Of equal scores the larger key is the worse, NULL the worst.
        entry = (score, key is not None, _Last(key), -number, key)
        if len(self.heap) < TOP:
            heapq.heappush(self.heap, entry)
        else:
            heapq.heappushpop(self.heap, entry)


@dataclass(frozen=True, eq=True)
class _Last:
    """Keys in reverse order; NULLs are told apart before."""

    key: object

    def __lt__(self, other: _Last) -> bool:
        return self.key is not None and other.key is not None and other.key < self.key


class Block:
    """Some documents by term: bitmaps, and each term's share in the score of each."""

    def __init__(self, keys: list, n: np.ndarray, starts: np.ndarray, terms: np.ndarray, counts: np.ndarray,
                 documents: int, length: int, first: int):
        self.keys, self.starts, self.terms, self.first = keys, starts, terms, first
        size = np.diff(starts)
        self.owner = np.repeat(np.arange(len(n)), size)
        short = PLAIN + LENGTH * n * documents // length
        self.share = SCALE * counts // (ONCE * counts + 8 * np.repeat(short, size))
        order = np.argsort(terms, kind="stable")
        self.held, at = np.unique(terms[order], return_index=True)
        self.at = np.append(at, len(order))
        self.by_term = self.owner[order]
        self.most = np.maximum.reduceat(self.share[order], at) if len(at) else np.empty(0, np.int64)
        self.bitmaps: dict[int, int] = {}

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Place of each term among those the block holds, or -1."""
        if not len(self.held):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.held, terms), len(self.held) - 1)
        return np.where(self.held[at] == terms, at, -1)

    def bitmap(self, place: int) -> int:
        found = self.bitmaps.get(place)
        if found is None:
            if len(self.bitmaps) >= BITMAPS:
                self.bitmaps.clear()
            bits = np.zeros(len(self.keys), bool)
            bits[self.by_term[self.at[place]:self.at[place + 1]]] = True
            found = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            self.bitmaps[place] = found
        return found

    def documents(self, group: int) -> np.ndarray:
        raw = np.frombuffer(group.to_bytes(-(-len(self.keys) // 8), "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(raw, bitorder="little"))

    def scores(self, some: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of documents; ``weights`` has a number for each term of all items."""
        begin, stop = self.starts[some], self.starts[some + 1]
        size = stop - begin
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)
        total = np.append(0, np.cumsum(weights[self.terms[at]] * self.share[at]))
        return total[ends] - total[ends - size]


def search(block: Block, terms: np.ndarray, values: np.ndarray, weights: np.ndarray, best: Best) -> int:
    """Add to ``best`` what the block has for an item; returns how many groups were taken up.

    ``values`` are the item's weights with repeats, in the order of ``terms``.
    """
    place = block.places(terms)
    there = (place >= 0) & (values > 0)
    place, value = place[there], values[there]
    if not len(place):
        return 0
    value = value * block.most[place]
    order = np.argsort(-value, kind="stable")
    bitmaps = [block.bitmap(p) for p in place[order].tolist()]
    value = value[order].tolist()
    # Groups by descending maximum: how many terms they are parted by, and their documents.
    todo = [(-sum(value), 0, (1 << len(block.keys)) - 1)]
    taken = 0
    while todo and -todo[0][0] >= best.floor():
        bound, depth, group = heapq.heappop(todo)
        bound, taken = -bound, taken + 1
        few = group.bit_count() <= FEW
        while not few and depth < len(bitmaps):
            with_term = group & bitmaps[depth]
            without = group ^ with_term
            less = bound - value[depth]
            depth += 1
            if without and with_term:
                if less >= best.floor():
                    heapq.heappush(todo, (-less, depth, without))
                group = with_term
                few = group.bit_count() <= FEW
            elif without:
                bound = less
                if bound < best.floor():
                    break
                if todo and bound < -todo[0][0]:
                    heapq.heappush(todo, (-bound, depth, group))
                    break
        else:
            some = block.documents(group)
            for i, score in zip(some.tolist(), block.scores(some, weights).tolist()):
                if score >= best.floor():
                    best.offer(score, block.keys[i], block.first + i)
    return taken


def weight(documents: int, holding: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2 * documents + 2) / (2 * holding + 1))).astype(np.int64)


def _found(index: DataFrame, sent, name: str, weights: np.ndarray, documents: int, length: int,
           key: str) -> DataFrame:
    """Row of the item, key, number of the document and score: the best of each task."""
    schema = T.StructType([T.StructField("row", T.LongType()), index.schema[key],
                           T.StructField("number", T.LongType()), T.StructField("score", T.LongType())])

    def run(batches):
        items = resident(f"items {name}", lambda: sent.value)
        best = [Best() for _ in items.rows]
        kind, held, first = pa.null(), [], 0
        mine = np.zeros(len(weights), np.int64)

        def settle() -> None:
            nonlocal first
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            lists, counts = (table[c].combine_chunks() for c in ("terms", "counts"))
            block = Block(table[key].to_pylist(), table["n"].to_numpy(),
                          np.append(0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))),
                          lists.flatten().to_numpy().astype(np.int64),
                          counts.flatten().to_numpy().astype(np.int64), documents, length, first)
            first += len(block.keys)
            for terms, repeats, found in zip(items.terms, items.repeats, best):
                values = weights[terms] * repeats
                mine[terms] = values
                search(block, terms, values, mine, found)
                mine[terms] = 0

        for batch in batches:
            kind = batch.schema.field(key).type
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                if held and sum(b.num_rows for b in held) + part.num_rows > BLOCK:
                    settle()
                held.append(part)
        if held:
            settle()
        rows = [(row, e[4], -e[3], e[0]) for row, found in zip(items.rows, best) for e in found.heap]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), kind, pa.int64(), pa.int64()))],
                names=schema.names)

    return index.mapInArrow(run, schema)


def _blocks(rows: DataFrame, text: str) -> Iterator[DataFrame]:
    """The items in parts of about ITEM_BYTES."""
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = -(-size // ITEM_BYTES) or 1
    for part in range(parts):
        yield rows.filter(F.pmod(F.xxhash64("row"), F.lit(parts)) == part)


def ranked(docs: DataFrame, items: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text",
           top: int = TOP) -> DataFrame:
    """Each item's ``top`` (at most TOP) documents with a score above 0: item, rank, key, score."""
    spark = docs.sparkSession
    rows = stash(items.select(F.col(item).alias("item"), F.col(text).alias("text"),
                              F.monotonically_increasing_id().alias("row")), "items")
    found = None
    for part in _blocks(rows, "text"):
        read = read_items(part.select("row", "text").collect())
        sent, name = spark.sparkContext.broadcast(read), uuid.uuid4().hex
        index = stash(indexed(docs, sent, name, key, text), "index")
        total = index.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("length")).first()
        holding = index.select(F.explode("terms").alias("term")).groupBy("term").agg(
            F.count(F.lit(1)).alias("n")).toPandas()
        weights = np.zeros(len(read.numbers), np.int64)
        weights[holding["term"].to_numpy(np.int64)] = weight(
            total["documents"], holding["n"].to_numpy(np.float64))
        some = stash(_found(index, sent, name, weights, total["documents"], total["length"] or 1, key)
                     .withColumn("task", F.spark_partition_id()), "found")
        found = some if found is None else found.unionByName(some)
    order = [F.desc("score"), F.asc_nulls_last(key), "task", "number"]
    # In groups of tasks first, so that no item's rows of all tasks meet at once.
    near = Window.partitionBy("row", F.pmod("task", F.lit(64))).orderBy(*order)
    found = found.withColumn("place", F.row_number().over(near)).filter(F.col("place") <= top)
    whole = Window.partitionBy("row").orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= top)
    name = fresh(found, "item")
    return found.join(rows.select("row", F.col("item").alias(name)), "row").select(
        F.col(name).alias(item), "rank", F.col(key), "score")
