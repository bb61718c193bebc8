"""Removal of repeated byte strings by a Burrows-Wheeler transform (operator 7).

A byte goes if a string of WIDTH bytes that covers it also starts anywhere else, in the
same text or another. Two things bring equal strings of different texts together:

Anchors. The anchor of a window of WIDTH bytes is its gram of GRAM bytes with the smallest
hash, the leftmost of equals. It depends on the window alone, so equal windows have equal
anchors at equal places. Neighbouring windows with the same anchor make a segment, about
70 windows long. Spark counts anchors, then segments. An anchor that occurs once repeats
nothing. A segment that occurs twice is repeated as a whole.

Transform. An anchor with several different segments may have windows in common where
copies begin, end or differ. Their bytes are fetched and brought together by anchor. Each
task sorts the suffixes of such bytes, a bounded number at a time, by their first WIDTH
symbols and forms the Burrows-Wheeler transform. Starting from the empty string, intervals
of suffixes with a common beginning are extended backwards by one symbol, breadth first;
an interval found at length n sets the common prefix at its end to n, if nothing shorter
has, and only then goes on. The values appear in increasing order, and the search ends at
WIDTH: places still unset join suffixes with WIDTH bytes in common.

An anchor with more than GROUP different segments is split: windows by their distance to
the anchor, in halves, each with the bytes that all its windows share as a further part of
the key. After at most eight halvings a part holds one distance, and equal keys mean equal
windows. So no group is gathered beyond that bound, and none is cut.

NULL and empty texts have no bytes and nothing to remove. Copies are counted as such, so
all copies of a text of WIDTH bytes or more vanish. Repeated rows are copies. An empty
table has no rows. Keys may repeat or be NULL. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.llm.common import columns, stash

WIDTH = 200
GRAM = 64
GROUP = 3_000
SMALL = 1 << 16
# Bytes that are transformed at once, beyond which no further group is added.
CHUNK = 1 << 20
# Longer texts are read in parts that overlap by a window.
PART = 1 << 21

_U = np.uint64
_PLACE_BITS = 24


def anchors(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window of a text its anchor's place, and for each place its gram's hash."""
    n = len(raw) - GRAM + 1
    with np.errstate(over="ignore"):
        value = raw.astype(np.uint64) + _U(1)
        factor, size = 0x9E3779B97F4A7C15, 1
        while size < GRAM:
            value = value[:-size] * _U(factor) + value[size:]
            factor = factor * factor % (1 << 64)
            size *= 2
        value ^= value >> _U(31)
        value *= _U(0xBF58476D1CE4E5B9)
        value ^= value >> _U(29)
    span = WIDTH - GRAM + 1
    ranked = (value & ~_U((1 << _PLACE_BITS) - 1)) | np.arange(n, dtype=np.uint64)
    least, reach = ranked, 1
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < span:
        least = np.minimum(least[:n - span + 1], least[span - reach:])
    return (least & _U((1 << _PLACE_BITS) - 1)).astype(np.int64), value


def segments(raw: bytes) -> list[tuple[int, int, int, int]]:
    """Anchor hash, anchor place, first and last window of each segment of a text."""
    out = []
    for start in range(0, max(len(raw) - WIDTH + 1, 0), PART):
        part = np.frombuffer(raw, np.uint8)[start:start + PART + WIDTH - 1]
        place, value = anchors(part)
        ends = np.flatnonzero(np.diff(place))
        first = np.concatenate([[0], ends + 1])
        last = np.concatenate([ends, [len(place) - 1]])
        at = place[first]
        out += zip(value[at].view(np.int64).tolist(), (at + start).tolist(),
                   (first + start).tolist(), (last + start).tolist())
    return out


def _digest(data: bytes) -> int:
    """A segment is known by its anchor's hash and this one: 128 bits together."""
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _texts(docs: DataFrame, text: str, *keep: str) -> DataFrame:
    """Columns ``keep``, the text as body, and its hash t.

    The hash only brings rows together: what texts of the same hash share beyond their own
    segments does not touch them.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(*keep, body.alias("body"), F.xxhash64(body).alias("t"))


def occurrences(texts: DataFrame) -> DataFrame:
    """Text, anchor and segment with how often: a row for each text of a batch and segment."""
    names = ["t", "a", "s", "n"]

    def run(batches):
        for batch in batches:
            for hashes, bodies in columns(batch, "t", "body"):
                out: list[list[int]] = [[], [], [], []]
                copies = Counter(zip(hashes, bodies))
                for (key, body), times in copies.items():
                    raw = body.encode()
                    found = Counter((anchor, _digest(raw[first:last + WIDTH]))
                                    for anchor, _, first, last in segments(raw))
                    for (anchor, digest), k in found.items():
                        out[1].append(anchor)
                        out[2].append(digest)
                        out[3].append(k * times)
                    out[0] += [key] * len(found)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=names)

    long = texts.filter(F.octet_length("body") >= WIDTH).select("t", "body")
    return long.mapInArrow(run, "t long, a long, s long, n long")


PIECE = "a long, lo int, hi int, core long, s long, skip int, place int, body binary"
_PIECE = pa.schema([("a", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("core", pa.int64()),
                    ("s", pa.int64()), ("skip", pa.int32()), ("place", pa.int32()),
                    ("body", pa.binary())])


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_PIECE)], schema=_PIECE)


def fetched(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of wanted segments (t, a, s), once each, with the anchor's place in them."""
    lists = wanted.groupBy("t").agg(F.collect_list(F.struct("a", "s")).alias("want"))
    joined = texts.filter(F.octet_length("body") >= WIDTH).select("t", "body").join(lists, "t")

    def run(batches):
        for batch in batches:
            rows = []
            for bodies, wants in columns(batch, "body", "want"):
                for body, want in zip(bodies, wants):
                    raw, left = body.encode(), {(w["a"], w["s"]) for w in want}
                    for anchor, place, first, last in segments(raw):
                        data = raw[first:last + WIDTH]
                        known = (anchor, _digest(data))
                        if known in left:
                            left.remove(known)
                            rows.append((anchor, 0, WIDTH - GRAM, 0, known[1], 0, place - first, data))
            yield _pieces(rows)

    return joined.mapInArrow(run, PIECE).dropDuplicates(["a", "s"])


def halved(pieces: DataFrame) -> DataFrame:
    """Each piece as two: the windows that lie further from, and those nearer to, the anchor."""
    def run(batches):
        for batch in batches:
            out = []
            for rows in columns(batch, *_PIECE.names):
                for a, lo, hi, _, s, skip, place, data in zip(*rows):
                    middle = (lo + hi) // 2
                    cut = place - middle  # first window of the nearer half
                    last = len(data) - WIDTH
                    for low, high, begin, end in ((middle + 1, hi, 0, min(cut - 1, last)),
                                                  (lo, middle, max(cut, 0), last)):
                        if begin <= end:
                            part = data[begin:end + WIDTH]
                            at = place - begin
                            core = _digest(part[at - low:at - high + WIDTH])
                            out.append((a, low, high, core, s, skip + begin, at, part))
            yield _pieces(out)

    return pieces.mapInArrow(run, PIECE)


KEY = ["a", "lo", "hi", "core"]
RANGES = "a long, s long, begin int, end int"


def common_windows(pieces: DataFrame, group: int = GROUP) -> DataFrame:
    """Windows of segments, as ranges from the segment's first, that occur in several pieces."""
    found = None
    while True:
        sizes = pieces.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
        large = stash(sizes.filter(F.col("n") > group).select(*KEY), "large")
        split = large.limit(1).count() > 0
        small = pieces.join(large, KEY, "left_anti") if split else pieces
        ranges = stash(_transformed(small), "ranges")
        found = ranges if found is None else found.unionByName(ranges)
        if not split:
            return found
        hot = pieces.join(large, KEY, "left_semi")
        # At one distance the key holds the whole window: the pieces are equal.
        one = hot.filter("lo = hi").select("a", "s", F.col("skip").alias("begin"), F.col("skip").alias("end"))
        found = found.unionByName(stash(one, "ranges"))
        pieces = stash(halved(hot.filter("lo < hi")), "pieces")


def _transformed(pieces: DataFrame) -> DataFrame:
    def run(batches):
        held: list[tuple] = []  # of whole groups
        own: list[tuple] = []  # of the group that is being read
        size, key = 0, None
        for batch in batches:
            for rows in columns(batch, *KEY, "s", "skip", "body"):
                for *new, s, skip, data in zip(*rows):
                    if new != key:
                        if len(own) > 1:  # one alone repeats nothing
                            held += own
                            size += sum(len(o[3]) for o in own)
                        own, key = [], new
                        if size >= CHUNK:
                            yield _ranges(held)
                            held, size = [], 0
                    own.append((new[0], s, skip, data))
        yield _ranges(held + own)

    together = pieces.repartition(*KEY).sortWithinPartitions(*KEY)
    return together.mapInArrow(run, RANGES)


def _ranges(held: list[tuple]) -> pa.RecordBatch:
    out = []
    marks = repeated_starts([h[3] for h in held]) if held else []
    for (a, s, skip, _), mark in zip(held, marks):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], mark.astype(np.int8), [0]])))
        out += [(a, s, skip + int(b), skip + int(e) - 1) for b, e in zip(edges[::2], edges[1::2])]
    return pa.RecordBatch.from_arrays(
        [pa.array([o[k] for o in out], pa.int64() if k < 2 else pa.int32()) for k in range(4)],
        names=["a", "s", "begin", "end"])


def repeated_starts(strings: list[bytes], width: int = WIDTH) -> list[np.ndarray]:
    """For each string, at which places a window starts that also starts elsewhere among them."""
    sizes = np.array([len(s) for s in strings], np.int64)
    line = np.empty(int(sizes.sum()) + len(strings), np.int64)
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(line), bool)
    inside[ends] = False
    line[inside] = np.frombuffer(b"".join(strings), np.uint8)
    line[ends] = 256 + np.arange(len(strings))  # each end differs, so no match crosses it
    shared = shared_suffixes(line, width)
    return [shared[e - n:e - n + max(n - width + 1, 0)] for e, n in zip(ends, sizes)]


def suffix_order(line: np.ndarray, width: int) -> np.ndarray:
    """Places of ``line`` ordered by the ``width`` or more symbols from there on.

    Ranks by the first symbols are doubled in length until they reach ``width``. Keys
    carry their place in the low bits where all fits into 64, as plain numbers sort faster.
    """
    n = len(line)
    place = int(n + 1).bit_length()
    bits = int(line.max() + 1).bit_length()
    length = max(1, min(4, (64 - place) // bits))
    padded = np.concatenate([line + 1, np.zeros(length - 1, np.int64)]).astype(np.uint64)
    key = padded[:n].copy()
    for k in range(1, length):
        key = key << _U(bits) | padded[k:n + k]
    size = bits * length
    while True:
        if size + place <= 64:
            packed = np.sort(key << _U(place) | np.arange(n, dtype=np.uint64))
            order = (packed & _U((1 << place) - 1)).astype(np.int64)
            ordered = packed >> _U(place)
        else:
            order = np.argsort(key)
            ordered = key[order]
        if length >= width:
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[1], ordered[1:] != ordered[:-1]])).astype(np.uint64)
        key = rank << _U(place)
        key[:n - length] |= rank[length:]
        size = 2 * place
        length *= 2


def shared_suffixes(line: np.ndarray, width: int) -> np.ndarray:
    """Whether the ``width`` symbols from each place on also start elsewhere.

    Common prefixes come from the Burrows-Wheeler transform in order of length.
    """
    n = len(line)
    order = suffix_order(line, width)
    transform = line[order - 1]  # the symbol before each suffix; the first has the last, a lone end
    if transform.max() < SMALL:
        transform = transform.astype(np.uint16)  # sorted by counting
    back = np.argsort(transform, kind="stable")  # rows by the symbol before, then in order
    forward = np.empty(n, np.int64)
    forward[back] = np.arange(n)
    unset = np.ones(n + 1, bool)
    unset[0] = unset[n] = False
    begin, end = np.array([0]), np.array([n])
    owner = np.zeros(n, np.int64)
    hit = np.zeros(n, bool)
    for _ in range(width):
        if not len(begin):
            break
        sizes = end - begin
        rows = np.repeat(begin - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
        owner[rows] = np.repeat(np.arange(len(begin)), sizes)
        # Rows that the extended strings' intervals hold, in order.
        if len(rows) * 16 > n:
            hit[forward[rows]] = True
            reached = np.flatnonzero(hit)
            hit[reached] = False
        else:
            reached = np.sort(forward[rows])
        source = back[reached]
        new = np.concatenate([[True], (np.diff(owner[source]) != 0) | (transform[source][1:] != transform[source][:-1])])
        starts = np.flatnonzero(new)
        stops = np.concatenate([starts[1:], [len(reached)]])
        first, last = reached[starts], reached[stops - 1] + 1
        # Only an interval whose end had no value yet gives one, and goes on.
        goes = unset[last]
        unset[last[goes]] = False
        begin, end = first[goes], last[goes]
    same = unset[:n]  # with the row before
    shared = np.zeros(n, bool)
    shared[order] = same | np.concatenate([same[1:], [False]])
    return shared


def marked(docs: DataFrame, text: str = "text", group: int = GROUP) -> DataFrame:
    """For each text hash t with repeats: its repeated windows, as ranges by segment."""
    texts = _texts(docs, text)
    seen = stash(occurrences(texts), "occurrences")
    often = seen.groupBy("a").agg(F.sum("n").alias("m")).filter("m > 1").select("a")
    shared = stash(seen.join(often, "a", "left_semi"), "shared")
    kinds = stash(shared.groupBy("a", "s").agg(
        F.sum("n").alias("n"), F.min("t").alias("t")), "kinds")
    mixed = kinds.groupBy("a").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("a")
    wanted = kinds.join(mixed, "a", "left_semi").select("t", "a", "s")
    pieces = stash(fetched(texts, wanted), "pieces")
    whole = kinds.filter("n > 1").select("a", "s", F.lit(0).alias("begin"), F.lit(PART).alias("end"))
    alone = kinds.filter("n = 1").select("a", "s")
    ranges = common_windows(pieces, group).join(alone, ["a", "s"], "left_semi").unionByName(whole)
    return shared.select("t", "a", "s").distinct().join(ranges, ["a", "s"]).groupBy("t").agg(
        F.collect_list(F.struct("a", "s", "begin", "end")).alias("ranges"))


def spans(raw: bytes, ranges: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that repeated windows cover."""
    by: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r in ranges:
        by.setdefault((r["a"], r["s"]), []).append((r["begin"], r["end"]))
    out: list[tuple[int, int]] = []
    for anchor, _, first, last in segments(raw):
        for begin, end in sorted(by.get((anchor, _digest(raw[first:last + WIDTH])), ())):
            start, stop = first + begin, min(first + end, last) + WIDTH
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], max(stop, out[-1][1]))
            else:
                out.append((start, stop))
    return out


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", group: int = GROUP,
           keep_bytes: bool = False) -> DataFrame:
    """Key, n_bytes, n_removed, n_spans, kept_sha256; with ``keep_bytes`` the rest as kept, too."""
    marks = stash(marked(docs, text, group), "marks")
    joined = _texts(docs, text, key).join(marks, "t", "left").select(key, "body", "ranges")
    fields = [docs.schema[key], *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")),
              T.StructField("kept_sha256", T.StringType())]
    if keep_bytes:
        fields.append(T.StructField("kept", T.BinaryType()))
    schema = T.StructType(fields)

    def run(batches):
        for batch in batches:
            made = []
            for bodies, lists in columns(batch, "body", "ranges"):
                for body, ranges in zip(bodies, lists):
                    raw = body.encode()
                    gone = spans(raw, ranges) if ranges else []
                    rest, at = [], 0
                    for start, stop in gone:
                        rest.append(raw[at:start])
                        at = stop
                    rest = b"".join([*rest, raw[at:]])
                    made.append((len(raw), len(raw) - len(rest), len(gone),
                                 hashlib.sha256(rest).hexdigest(), rest))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[:4 + keep_bytes]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([m[k] for m in made], t) for k, t in enumerate(kinds))],
                names=schema.names)

    return joined.mapInArrow(run, schema)
