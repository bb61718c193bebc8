"""Near-duplicate classes by BagMinHash signatures (operator 2).

Words are normalised as runs of letters and digits with A-Z in lower case; a text is the
multiset of its runs of five words (all its words, if fewer). Two texts are linked if
the weighted Jaccard similarity of these multisets, sum of minima over sum of maxima, is
0.8 or more; classes are what links connect.

Signatures. The weights, which are counts, are cut at powers of two into levels
[0,1), [1,2), [2,4) and so on. Each shingle has a Poisson process on each level, with a
rate as wide as the level; a point has a time, a place on the level, found by halving it
once for each random bit, and one of the signature's positions. A text takes the points
below its weight, and a position keeps the earliest. Points are drawn in order of time up
to a limit at which all positions are likely to be filled, and further where they are not,
so the cost hardly depends on the text's length. Equal positions have the probability of
the similarity.

Links. Texts with the same words are one text. Bands of six positions make buckets. Each
text of a bucket is compared with the bucket's smallest id by its true multiset; so a
bucket costs one comparison a text. What is in one class by then needs no more. In buckets
that still hold several classes, texts of different classes are compared in blocks of
bounded size: whole signatures first, then, from the most alike on, the true multisets, as
long as the two classes have not met. Only links that join classes leave the task; pairs
are never written out. Nothing is capped: of pairs at 0.8 the bands miss 3 in a million,
and the signatures, which may fall short of it by 0.12, fewer.

NULL and empty texts, and texts without letters or digits, have no words; they are copies
of each other. Repeated rows are copies. Keys may repeat or be NULL: rows are numbered.
An empty table has no rows. Columns of any name pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.llm.common import columns, fresh, resident, stash
from paywarden.llm.decontam import normalised
from paywarden.llm.graph import components

WIDTH = 5
THRESHOLD = 0.8
BANDS = 42
BAND_ROWS = 6
POSITIONS = BANDS * BAND_ROWS
ROWS = 512
# Word hashes, and multisets of shingles, that a Python worker remembers.
MEMO = 200_000
BAGS = 1_500
# Texts of a bucket, and their bytes, that are held against as many others at once.
BLOCK = 1_000
BLOCK_BYTES = 16 << 20
# How far the share of equal positions may lie below the threshold: five deviations.
SLACK = 0.12

_U = np.uint64
_ONE = 1 << 64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        got = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[word] = got
        return got


def shingles(words: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, ascending, and how often each occurs."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = resident("word hashes", _Hashes)
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    size = min(width, n)
    joined = np.full(n - size + 1, size, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            joined = _mix(joined * _U(0x9E3779B97F4A7C15) + one[k:n - size + 1 + k])
    return np.unique(joined, return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets; of two empty ones 1."""
    total = int(a[1].sum() + b[1].sum())
    if not total:
        return 1.0
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = int(np.minimum(a[1][i], b[1][j]).sum())
    return least / (total - least)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = POSITIONS) -> np.ndarray:
    """A row of ``m`` numbers for each bag; rows of empty bags are zero."""
    n = len(bags)
    best = np.full(n * m, np.inf)
    out = np.zeros(n * m, np.uint64)
    sizes = np.array([len(b[0]) for b in bags], np.int64)
    if not sizes.sum():
        return out.reshape(n, m)
    of = np.repeat(np.arange(n), sizes)
    keys = np.concatenate([b[0] for b in bags])
    weights = np.concatenate([b[1] for b in bags]).astype(np.int64)
    total = np.bincount(of, weights=weights, minlength=n)
    limit = m * (np.log(m) + 3) / np.maximum(total, 1)
    # One process for each level that begins below the weight.
    parts = []
    low, width, level = 0, 1, 0
    some = np.arange(len(keys))
    while len(some):
        parts.append((some, np.full(len(some), low), np.full(len(some), width),
                      np.full(len(some), level)))
        low, width, level = (1, 1, 1) if level == 0 else (low * 2, width * 2, level + 1)
        some = some[weights[some] > low]
    at, low, width, level = (np.concatenate(c) for c in zip(*parts))
    doc, weight = of[at], weights[at]
    with np.errstate(over="ignore"):
        seed = _mix(keys[at] + level.astype(np.uint64) * _U(0xD1342543DE82EF95))
    rate = width.astype(float)
    time = np.zeros(len(at))
    drawn = np.zeros(len(at), np.int64)
    todo = np.arange(len(at))
    while len(todo):
        live = todo
        while len(live):
            block = int(np.clip(65536 // len(live), 1, 512))
            number = drawn[live][:, None] + np.arange(1, block + 1)
            with np.errstate(over="ignore"):
                first = _mix(seed[live][:, None] + number.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
                second = _mix(first + _U(0x632BE59BD9B4E019))
            gap = -np.log((first >> _U(11)).astype(float) * 2.0 ** -53 + 2.0 ** -54)
            gap /= rate[live][:, None]
            gap[:, 0] += time[live]
            when = np.cumsum(gap, axis=1)
            inside = when <= limit[doc[live]][:, None]
            # A point's place: the bits choose halves of the level.
            place = low[live][:, None] + (
                ((second >> _U(40)).astype(np.int64) * width[live][:, None]) >> 24)
            row, col = np.nonzero(inside & (place < weight[live][:, None]))
            if len(row):
                where = doc[live][row] * m + ((second[row, col] & _U(0xFFFFFFFF)).astype(np.int64) * m >> 32)
                t, tag = when[row, col], first[row, col]
                np.minimum.at(best, where, t)
                won = best[where] == t
                out[where[won]] = tag[won]
            # Where the block ended inside the limit, draw on; else stop before the first point beyond.
            whole = inside[:, -1]
            count = inside.sum(axis=1)
            last = np.where(count > 0, when[np.arange(len(live)), np.maximum(count - 1, 0)], time[live])
            time[live] = last
            drawn[live] += count
            live = live[whole]
        short = np.isinf(best).reshape(n, m).any(axis=1) & (sizes > 0)
        limit[short] *= 1.5
        todo = np.flatnonzero(short[doc])
    return out.reshape(n, m)


def bands(signature: np.ndarray) -> np.ndarray:
    """Bucket numbers of each signature row."""
    cut = signature.reshape(len(signature), BANDS, BAND_ROWS)
    with np.errstate(over="ignore"):
        joined = np.broadcast_to(_mix(np.arange(1, BANDS + 1, dtype=np.uint64)), cut.shape[:2])
        for k in range(BAND_ROWS):
            joined = _mix(joined * _U(0x9E3779B97F4A7C15) + cut[:, :, k])
    return joined.view(np.int64)


def sketched(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct of row number, digest of the words, buckets and tags; its name."""
    sketch = fresh(docs, "_sketch")
    row = fresh(docs, "_row")
    fields = T.StructType([T.StructField("row", T.LongType()), T.StructField("digest", T.BinaryType()),
                           T.StructField("buckets", T.ArrayType(T.LongType())),
                           T.StructField("tags", T.BinaryType())])
    arrow = pa.struct([("row", pa.int64()), ("digest", pa.binary()),
                       ("buckets", pa.list_(pa.int64())), ("tags", pa.binary())])
    names = [*docs.columns, sketch]

    def run(batches):
        for batch in batches:
            digests, buckets, tags = [], [], []
            for (texts,) in columns(batch, text, rows=ROWS):
                bags = []
                for body in texts:
                    words = normalised(body)
                    digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
                    bags.append(shingles(words))
                signed = signatures(bags)
                found = bands(signed)
                buckets += [f if len(b[0]) else [] for f, b in zip(found, bags)]
                # The last eight bits of each position are enough to estimate with.
                tags += [t.tobytes() for t in signed.astype(np.uint8)]
            made = pa.StructArray.from_arrays(
                [batch.column(batch.num_columns - 1), pa.array(digests, pa.binary()),
                 pa.array(buckets, pa.list_(pa.int64())), pa.array(tags, pa.binary())],
                fields=list(arrow))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=names)

    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    made = numbered.mapInArrow(run, T.StructType([*docs.schema, T.StructField(sketch, fields)]))
    return stash(made, "sketched"), sketch


class _Bags(dict):
    """Multisets of the texts a Python worker met last, by id."""

    def of(self, key: int, body: str) -> tuple[np.ndarray, np.ndarray]:
        found = self.get(key)
        if found is None:
            if len(self) >= BAGS:
                self.clear()
            found = self[key] = shingles(normalised(body))
        return found


def compared(pairs: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) of ids that are links; ``bodies`` has id and body."""
    one = bodies.withColumnsRenamed({"id": "a", "body": "body_a"})
    two = bodies.withColumnsRenamed({"id": "b", "body": "body_b"})
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "body_a", "body_b")

    def run(batches):
        bags = _Bags()
        for batch in batches:
            left, right = [], []
            for rows in columns(batch, "a", "b", "body_a", "body_b"):
                for a, b, x, y in zip(*rows):
                    if similarity(bags.of(a, x), bags.of(b, y)) >= threshold:
                        left.append(a)
                        right.append(b)
            yield _links(left, right)

    return joined.mapInArrow(run, "a long, b long")


def _links(left: list[int], right: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def linked(rows: DataFrame, sketch: str, text: str = "text",
           threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Ids of the texts (digest, id: the smallest row number) and components of their links."""
    texts = stash(rows.groupBy(F.col(f"{sketch}.digest").alias("digest")).agg(
        F.min(f"{sketch}.row").alias("id"), F.first(f"{sketch}.buckets").alias("buckets"),
        F.first(f"{sketch}.tags").alias("tags"),
        F.max(F.octet_length(text)).alias("size")), "texts")
    postings = texts.select("id", "size", F.explode("buckets").alias("bucket"))
    shared = postings.groupBy("bucket").agg(
        F.min("id").alias("pivot"), F.count("id").alias("n"), F.sum("size").alias("bytes"))
    members = stash(postings.join(shared.filter("n > 1"), "bucket"), "members")
    firsts = members.filter("id <> pivot").select(
        F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    # The words of every text that shares a bucket, once.
    ids = members.select("id").distinct()
    bodies = rows.select(F.col(f"{sketch}.row").alias("id"), F.col(text).alias("body"))
    bodies = stash(bodies.join(ids, "id", "left_semi"), "bodies")
    links = stash(compared(firsts, bodies, threshold), "compared")
    comps = components(links)
    more = stash(_across(members, texts, bodies, comps, threshold), "more")
    if more.limit(1).count():
        comps = components(links.union(more))
    return texts.select("digest", "id"), comps


def _blocks(n, size):
    """In how many blocks texts are dealt, by their number and bytes."""
    return F.ceil(F.greatest(n / BLOCK, size / BLOCK_BYTES)).cast("int")


def _dealt(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Members (bucket, id, size) of buckets with several components, a row for each pair of blocks to meet in."""
    placed = members.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    sized = placed.groupBy("bucket", "comp").agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    # Texts of a bucket's largest class need not meet each other, only the texts of other classes.
    mixed = sized.groupBy("bucket").agg(
        F.max(F.struct("n", "bytes", "comp")).alias("main"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
    mixed = stash(mixed.filter("n > main.n").select(
        "bucket", F.col("main.comp").alias("main"), _blocks(F.col("main.n"), F.col("main.bytes")).alias("mains"),
        _blocks(F.col("n") - F.col("main.n"), F.col("bytes") - F.col("main.bytes")).alias("others")), "mixed")
    placed = placed.select("bucket", "id", "comp").join(mixed, "bucket")
    # A class or the rest of a bucket that a block does not hold is dealt to several; all pairs of blocks
    # meet but those of the largest class.
    usual = F.col("comp") == F.col("main")
    number = F.xxhash64("id")
    own = F.when(usual, F.pmod(number, "mains")).otherwise(F.col("mains") + F.pmod(number, "others")).cast("int")
    first = F.when(usual, F.col("mains")).otherwise(F.lit(0))
    placed = placed.select("bucket", "id", "comp", own.alias("own"),
                           F.explode(F.sequence(first, F.col("mains") + F.col("others") - 1)).alias("other"))
    return placed.select("bucket", "id", "comp", "own", F.least("own", "other").alias("i"),
                         F.greatest("own", "other").alias("j"))


def _across(members: DataFrame, texts: DataFrame, bodies: DataFrame, comps: DataFrame,
            threshold: float) -> DataFrame:
    """Links between components that share a bucket: enough of them to join what is linked."""
    placed = _dealt(members, comps)
    full = placed.join(texts.select("id", "buckets", "tags"), "id").join(bodies, "id")
    keys = ["bucket", "i", "j"]
    together = full.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        bags, held, key = _Bags(), [], None
        for batch in batches:
            left, right = [], []
            for rows in columns(batch, "bucket", "i", "j", "own", "id", "comp", "buckets", "tags", "body"):
                for bucket, i, j, *member in zip(*rows):
                    if (bucket, i, j) != key:
                        _join(held, key, bags, threshold, left, right)
                        held, key = [], (bucket, i, j)
                    held.append(member)
            yield _links(left, right)
        left, right = [], []
        _join(held, key, bags, threshold, left, right)
        yield _links(left, right)

    return together.mapInArrow(run, "a long, b long").distinct()


def _join(held: list, key: tuple | None, bags: _Bags, threshold: float, left: list[int],
          right: list[int]) -> None:
    """Compare the texts of a block, or of two, of a bucket, and note links that join components."""
    if len(held) < 2:
        return
    bucket, i, j = key
    own = np.array([h[0] for h in held])
    ids = [h[1] for h in held]
    numbers: dict[int, int] = {}
    comp = np.array([numbers.setdefault(h[2], len(numbers)) for h in held])
    buckets = np.array([h[3] for h in held])
    tags = np.frombuffer(b"".join(h[4] for h in held), np.uint8).reshape(len(held), POSITIONS)
    band = int(np.flatnonzero(buckets[0] == bucket)[0])
    least = (threshold - SLACK) * POSITIONS
    for x in range(len(held)):
        # Each pair once: in one order within a block, from the first block to the second else.
        later = np.arange(len(held)) > x if i == j else (own == j) & (own[x] == i)
        some = np.flatnonzero(later & (comp != comp[x]))
        if not len(some):
            continue
        alike = (tags[some] == tags[x]).sum(axis=1)
        near = alike >= least
        some, alike = some[near], alike[near]
        # And in the first of the buckets that the two share.
        first = (buckets[some] == buckets[x])[:, :band].any(axis=1)
        for y in some[~first][np.argsort(-alike[~first], kind="stable")]:
            if comp[x] != comp[y] and similarity(
                    bags.of(ids[x], held[x][5]), bags.of(ids[y], held[y][5])) >= threshold:
                left.append(ids[x])
                right.append(ids[y])
                comp[comp == comp[y]] = comp[x]


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """For each document the smallest key of its class and the class's number of documents."""
    rows, sketch = sketched(docs.select(key, text), text)
    placed = _placed(rows, sketch, text, threshold, [key])
    sizes = placed.groupBy("class").agg(F.min(key).alias("class_id"),
                                        F.count(F.lit(1)).alias("class_size"))
    return placed.join(sizes, "class").select(key, "class_id", "class_size")


def _placed(rows: DataFrame, sketch: str, text: str, threshold: float, keep: list[str]) -> DataFrame:
    """Columns ``keep``, digest, row number and class (the smallest row of the class) of each row."""
    texts, comps = linked(rows, sketch, text, threshold)
    of = texts.join(comps, "id", "left").select("digest", F.coalesce("comp", "id").alias("class"))
    of = stash(of, "classes")
    return rows.select(*keep, F.col(f"{sketch}.row").alias("row"),
                       F.col(f"{sketch}.digest").alias("digest")).join(of, "digest")


def unique(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with all its columns: the first row."""
    rows, sketch = sketched(docs, text)
    placed = _placed(rows, sketch, text, threshold, [])
    # A class is called after its first row's text's first row.
    kept = placed.filter("row = class").select("row")
    row = fresh(rows, "_row")
    return rows.withColumn(row, F.col(f"{sketch}.row")).join(
        kept.withColumnRenamed("row", row), row, "left_semi").select(*docs.columns)
