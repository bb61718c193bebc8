"""States over whole words for the suffix tree of operator 8, held as Spark tables.

A context is a run of up to DEPTH words before a token, the beginning of the text among
them. Every run of words seen LEAST times in the training texts is counted; there is no
share of the corpus below which one is dropped, so the tables grow with the input. A
context is a state if its distribution diverges from that of the context without its
oldest word by more than its entries cost to describe. The share that a state's entries
leave goes to the next shorter state, and from the shortest to the tree of symbols.

Words and runs of words are known by 64-bit hashes. Nothing here is collected or broadcast by hand.
Texts are split into words once, into folds: rows of some million tokens. A fold names each of its runs
once, in one packed array for each bucket of hashes. When pairs are counted, every fold is told which of its pairs were
seen LEAST times; a longer run is named only if all its pairs were, for it is not seen more often than they are. The
buckets are summed; what was seen LEAST times goes
to the bucket of its suffix, which knows its probability one level below, and on to that of its prefix,
which decides. Answers to a fold stand in the order of its questions.
Runs are counted in up to SLICES, and folds scored in up to PARTS, one after the other, so that the
disk holds a share of them at a time. Each run is in one slice and each fold in one part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.llm.common import ROWS, drop, owned, stash

DEPTH = 3
LEAST = 2
# Tokens of a fold, which ends with the texts that reach them.
FOLDED = 800_000
SLICES = 2
PARTS = 5
# Tokens that are worth a slice or part of their own.
SHARE = 2_000_000
# Tokens for each bucket, about.
BUCKET = 1_000_000

END = xxhash.xxh3_64_intdigest(b"")  # no word is empty or has a space
_END, _BEGIN = np.uint64(END), np.uint64(xxhash.xxh3_64_intdigest(b" "))


def _mixed(code: np.ndarray) -> np.ndarray:
    # In place: fresh memory costs more than the arithmetic.
    out = code >> np.uint64(31)
    out ^= code
    out *= np.uint64(0x9E3779B97F4A7C15)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out


def joined(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The run that starts with one run and ends with another, each but a word of it."""
    out = _mixed(prefix)
    out += suffix
    return out


def _shares(tokens: int, most: int) -> int:
    return min(most, 1 + tokens // SHARE)


def buckets_for(tokens: int) -> int:
    slices = _shares(tokens, SLICES)
    # A fold has a row for each bucket: of many tokens a bucket holds twice as many.
    size = BUCKET if tokens < 64 * BUCKET else 2 * BUCKET
    return slices * (1 + tokens // (slices * size))


def distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different hashes, ascending; for each hash its place among these; and where each is first."""
    # Sorted by leading bits, with places in the others, which is much faster than argsort.
    n, bits = len(grams), np.uint64(len(grams).bit_length())
    keys = grams >> bits
    keys <<= bits
    keys |= np.arange(n, dtype=np.uint64)
    keys.sort()
    keys &= (np.uint64(1) << bits) - np.uint64(1)
    order = keys.view(np.int64)
    found = grams[order]
    mixed = np.flatnonzero(found[1:] < found[:-1])
    if len(mixed):  # hashes that differ in their last bits alone
        lead = found >> bits
        at = np.flatnonzero(np.isin(lead, lead[mixed]))
        order[at] = order[at][np.argsort(found[at], kind="stable")]
        found = grams[order]
    new = np.ones(n, bool)
    new[1:] = found[1:] != found[:-1]
    rank = np.cumsum(new)
    rank -= 1
    places = np.empty(n, np.int64)
    places[order] = rank
    return found[new], places, order[new]


def ascending(grams: np.ndarray) -> np.ndarray:
    """The different hashes, ascending."""
    out = np.sort(grams)
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    return out[new]


def bucket_of(grams: np.ndarray, buckets: int) -> np.ndarray:
    """Ascending hashes have ascending buckets."""
    return (grams >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def grouped(grams: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket, the buckets that occur, and where their parts start and end."""
    bucket = bucket_of(grams, buckets).astype(np.uint16 if buckets < 1 << 16 else np.int64)
    return np.argsort(bucket, kind="stable"), *_parts(bucket, buckets)


def _parts(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    number = np.bincount(bucket.astype(np.int64), minlength=buckets)
    present = np.flatnonzero(number)
    return present, np.append(0, np.cumsum(number[present]))


def packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Parts of an array, as bytes."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [
        None, pa.py_buffer((ends * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def flat(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """The array whose parts the column has as bytes."""
    parts = [np.zeros(0, np.uint8)]
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(chunk):
            _, offsets, data = chunk.buffers()
            ends = np.frombuffer(offsets, np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
            if ends[-1] > ends[0]:
                parts.append(np.frombuffer(data, np.uint8)[ends[0]:ends[-1]])
    return np.concatenate(parts).view(kind)


def _bit_places(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the values of parts have their bits, when each part starts a byte; and where the parts' bytes end."""
    width = (sizes + 7) // 8
    ends = np.append(0, np.cumsum(width))
    return np.arange(sizes.sum()) + np.repeat(8 * ends[:-1] - (np.cumsum(sizes) - sizes), sizes), ends


def bits(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Parts of an array of truth values, as bits."""
    at, ends = _bit_places(sizes)
    out = np.zeros(8 * int(ends[-1]), bool)
    out[at] = values
    return packed(np.packbits(out), ends)


def unbits(column: pa.ChunkedArray | pa.Array, sizes: np.ndarray) -> np.ndarray:
    """The truth values whose parts, of these sizes, the column has as bits."""
    return np.unpackbits(flat(column, np.uint8))[_bit_places(sizes)[0]].astype(bool)


def rows_of(bucket: np.ndarray, ends: np.ndarray, **values: np.ndarray) -> pa.Table:
    """A row for each bucket with its parts of the arrays."""
    return pa.table({"bucket": pa.array(bucket, pa.int64()), **{k: packed(v, ends) for k, v in values.items()}})


def packed_rows(rows: DataFrame, buckets: int, **kinds: type) -> DataFrame:
    """Rows with a column gram, as arrays for each bucket; their columns are of the given kinds."""
    def handed(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(held)
        values = {k: found[k].to_numpy().astype(kind, copy=False) for k, kind in kinds.items()}
        order, present, ends = grouped(found["gram"].to_numpy().view(np.uint64), buckets)
        return rows_of(present, ends, **{k: v[order] for k, v in values.items()}).to_batches()

    def run(batches):
        held, length = [], 0
        for batch in batches:
            held.append(batch)
            length += batch.num_rows
            if length >= FOLDED:
                yield from handed(held)
                held, length = [], 0
        if length:
            yield from handed(held)

    return rows.select(*kinds).mapInArrow(run, "bucket long, " + ", ".join(f"{k} binary" for k in kinds))


@dataclass
class Fold:
    """Texts as places among their different words' hashes."""

    fold: int
    key: pa.Array
    size: np.ndarray  # words of each text
    code: np.ndarray
    word: np.ndarray
    bytes: np.ndarray  # of each word, 255 at most
    taught: bool = True
    pairs: np.ndarray | None = None  # whether the pair that ends at each place is known, if that is told

    @cached_property
    def starts(self) -> np.ndarray:
        """Where a text's line is: its beginning, its words and its end."""
        return np.cumsum(self.size + 2) - (self.size + 2)

    def ends_of(self, longest: int) -> np.ndarray:
        """Whether a run of so many words ends at a place of the lines."""
        out = np.ones(len(self.code) + 2 * len(self.size), bool)
        for k in range(longest - 1):
            at = self.starts + k  # where a text is shorter, the next one has no such run either
            out[at[at < len(out)]] = False
        return out

    def places_of(self, longest: int) -> np.ndarray:
        """Whether a run of so many words ends at a place of the lines that may be known: one is
        not seen more often than its pairs."""
        out = self.ends_of(longest)
        if self.pairs is not None:
            for k in range(longest - 1):
                out[k:] &= self.pairs[:len(out) - k]
        return out

    def line(self, of_words: np.ndarray, begin, end) -> np.ndarray:
        """What each place has, by the word there."""
        out = np.empty(len(self.code) + 2 * len(self.size), of_words.dtype)
        inside = np.ones(len(out), bool)
        last = self.starts + self.size + 1
        inside[self.starts] = inside[last] = False
        out[self.starts], out[last], out[inside] = begin, end, of_words[self.code]
        return out

    def runs(self, longest: int) -> list[np.ndarray]:
        """By length the hashes of the runs that end at each place; some have no meaning (``ends_of``)."""
        made = [self.line(self.word, _BEGIN, _END)]
        for _ in range(longest - 1):
            code = _mixed(made[-1])
            code[1:] = code[:-1] + made[-1][1:]
            made.append(code)
        return made

    def asks(self, depth: int) -> Iterator[np.ndarray]:
        """The different words and runs of ``asked``, without their places."""
        yield ascending(np.append(self.word, _BEGIN))
        for k, made in enumerate(self.runs(depth + 1)[1:], 2):
            yield ascending(made[self.places_of(k)])

    def asked(self, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """By length, of words and runs of up to depth + 1 words: the different ones that may be known, ascending, and for
        each place which of them ends there, their number where none does."""
        gram, places, _ = distinct(np.append(self.word, _BEGIN))
        out = [(gram, self.line(places[:-1], places[-1], len(gram)))]
        for k, made in enumerate(self.runs(depth + 1)[1:], 2):
            there = self.places_of(k)
            gram, places, _ = distinct(made[there])
            at = np.full(len(there), len(gram), np.int32)
            at[there] = places
            out.append((gram, at))
        return out


def _schema(key: T.DataType) -> T.StructType:
    packs = [T.StructField(n, T.BinaryType()) for n in ("size", "code", "word", "bytes")]
    return T.StructType([T.StructField("fold", T.LongType()), T.StructField("taught", T.BooleanType()),
                         T.StructField("tokens", T.LongType()), T.StructField("key", T.ArrayType(key)), *packs])


def unfolded(batch: pa.RecordBatch | pa.Table) -> Iterator[Fold]:
    for i in range(batch.num_rows):
        def values(name, kind):
            return flat(batch[name].slice(i, 1), kind)

        fold = Fold(batch["fold"][i].as_py(), batch["key"][i].values, values("size", np.int32).astype(np.int64),
                    values("code", np.int32), values("word", np.uint64), values("bytes", np.uint8),
                    batch["taught"][i].as_py())
        if "pairs" in batch.schema.names:
            fold.pairs = np.unpackbits(values("pairs", np.uint8), count=len(fold.code) + 2 * len(fold.size)).astype(bool)
        yield fold


class _Gathered:
    """Texts on their way to a fold."""

    def __init__(self, taught: bool):
        self.taught = taught
        self._clear()

    def _clear(self):
        self.held: list[tuple] = []
        self.length = 0

    def added(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column(1), "")))
        words = lists.flatten()
        # White space at either end leaves an empty piece there.
        there = pc.greater(pc.binary_length(words), 0)
        owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        size = np.bincount(owner[there.to_numpy(zero_copy_only=False)], minlength=len(lists))
        words = words.filter(there)
        self.held.append((batch.column(0), batch.column(2)[0], size.astype(np.int32), words))
        self.length += len(words) + len(size)
        if self.length >= FOLDED:
            yield self.handed()

    def handed(self) -> pa.RecordBatch:
        key, row, size, words = zip(*self.held)
        key, size = pa.concat_arrays(key), np.concatenate(size)
        coded = pa.concat_arrays(words).dictionary_encode()
        word = np.fromiter(map(xxhash.xxh3_64_intdigest, coded.dictionary.to_numpy(zero_copy_only=False).tolist()),
                           np.uint64, len(coded.dictionary))
        length = np.minimum(pc.binary_length(coded.dictionary).to_numpy(zero_copy_only=False), 255).astype(np.uint8)
        packs = (packed(x, np.array([0, len(x)])) for x in (size, coded.indices.to_numpy(), word, length))
        out = pa.RecordBatch.from_arrays(
            [pa.array([row[0].as_py()], pa.int64()), pa.array([self.taught]), pa.array([self.length]),
             pa.ListArray.from_arrays(pa.array([0, len(key)], pa.int32()), key), *packs],
            names=["fold", "taught", "tokens", "key", "size", "code", "word", "bytes"])
        self._clear()
        return out


def folded(docs: DataFrame, text: str = "text", key: str | None = None, learnt: Column | None = None) -> DataFrame:
    """The texts in folds; those learnt from are in folds of their own."""
    named = F.lit(None).cast("long") if key is None else F.col(key)
    flag = F.lit(True) if learnt is None else F.coalesce(learnt, F.lit(False))
    rows = docs.select(named.alias("key"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"),
                       flag.alias("taught"))

    def run(batches):
        kinds = [_Gathered(True), _Gathered(False)]
        for batch in batches:
            for kind in kinds:
                mine = batch.filter(batch.column(3) if kind.taught else pc.invert(batch.column(3)))
                for start in range(0, mine.num_rows, ROWS):
                    yield from kind.added(mine.slice(start, ROWS))
        for kind in kinds:
            if kind.held:
                yield kind.handed()

    return rows.mapInArrow(run, _schema(rows.schema["key"].dataType))


def tokens_of(folds: DataFrame) -> int:
    return folds.agg(F.sum("tokens")).first()[0] or 0


def run_counts(folds: DataFrame, size: int, part: int, tokens: int) -> DataFrame:
    """Runs of so many words seen LEAST times in texts learnt from, those of one slice, as arrays for the buckets of
    their suffixes: prefix, suffix, n.

    Of pairs all folds are told, in further rows, which of theirs are known: fold, bucket, hit.
    """
    buckets, slices, told = buckets_for(tokens), _shares(tokens, SLICES), size == 2

    def run(batches):
        for batch in batches:
            for fold in unfolded(batch):
                made = fold.runs(size)
                mine = fold.places_of(size)
                if slices > 1:
                    mine &= bucket_of(made[-1], slices) == part
                at = np.flatnonzero(mine)
                gram, places, first = distinct(made[-1][at])
                n = np.bincount(places, minlength=len(gram)).astype(np.int32) * np.int32(fold.taught)
                at = at[first]
                present, ends = _parts(bucket_of(gram, buckets), buckets)
                found = rows_of(present, ends, prefix=made[-2][at - 1], suffix=made[-2][at], n=n)
                yield from found.append_column("fold", pa.array(np.full(len(present), fold.fold))).to_batches()

    def total(rows: pa.Table) -> pa.Table:
        prefix, suffix = flat(rows["prefix"], np.uint64), flat(rows["suffix"], np.uint64)
        gram, places, first = distinct(joined(prefix, suffix))
        n = np.bincount(places, weights=flat(rows["n"], np.int32), minlength=len(gram)).astype(np.int64)
        known = n >= LEAST
        often = np.flatnonzero(known)
        at, n = first[often], n[often]
        order, present, ends = grouped(suffix[at], buckets)
        out = rows_of(present, ends, prefix=prefix[at[order]], suffix=suffix[at[order]], n=n[order])
        out = out.append_column("fold", pa.nulls(len(present), pa.int64())).append_column(
            "hit", pa.nulls(len(present), pa.binary()))
        if not told:
            return out
        hit = bits(known[places], pc.binary_length(rows["n"]).to_numpy() // 4)
        none = pa.nulls(rows.num_rows, pa.binary())
        return pa.concat_tables([out, pa.table({
            "bucket": rows["bucket"], "prefix": none, "suffix": none, "n": none, "fold": rows["fold"], "hit": hit})])

    schema = "bucket long, prefix binary, suffix binary, n binary, fold long"
    return folds.mapInArrow(run, schema).groupBy("bucket").applyInArrow(total, schema + ", hit binary")


def counted(folds: DataFrame, size: int, tokens: int) -> DataFrame:
    """What ``run_counts`` gives, of all slices, stored."""
    out = None
    for part in range(_shares(tokens, SLICES)):
        found = stash(run_counts(folds, size, part, tokens), "runs")
        out = found if out is None else out.unionByName(found)
    return out


def paired(folds: DataFrame, pairs: DataFrame, tokens: int) -> DataFrame:
    """The folds, and for each place as a bit whether the pair that ends there is among the counted ``pairs``."""
    buckets = buckets_for(tokens)

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        told = told.sort_by("bucket")
        out = []
        for fold in unfolded(texts):
            made, there = fold.runs(2)[-1], fold.ends_of(2)
            gram, places, _ = distinct(made[there])
            _, ends = _parts(bucket_of(gram, buckets), buckets)
            there[there] = unbits(told["hit"], np.diff(ends))[places]
            out.append(np.packbits(there).tobytes())
        return texts.append_column("pairs", pa.array(out, pa.binary()))

    told = pairs.filter(F.col("fold").isNotNull()).select("fold", "bucket", "hit")
    return folds.groupBy("fold").cogroup(told.groupBy("fold")).applyInArrow(
        run, T.StructType([*folds.schema, T.StructField("pairs", T.BinaryType())]))


def _found(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether ascending hashes have those asked for, and where."""
    if not len(known):
        return np.zeros(len(asked), bool), np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return known[at] == asked, at


_LEVEL = "bucket long, gram binary, n binary, p binary, share binary, state binary, rest binary"


def _level(rows: DataFrame, shorter: DataFrame, buckets: int, prior: float) -> DataFrame:
    """The runs of a level with their probabilities, and the states that these follow.

    ``rows`` are the runs that ``run_counts`` gives, ``shorter`` the level below. ``share`` is NaN for
    the runs of a context that is no state.
    """
    def likened(runs: pa.Table, below: pa.Table) -> pa.Table:
        gram, p = flat(below["gram"], np.uint64), flat(below["p"], float)
        by = np.argsort(gram)
        prefix, suffix, n = (flat(runs[c], k) for c, k in (
            ("prefix", np.uint64), ("suffix", np.uint64), ("n", np.int64)))
        hit, at = _found(gram[by], suffix)
        prefix, suffix, n, q = prefix[hit], suffix[hit], n[hit], p[by][at[hit]]
        order, present, ends = grouped(prefix, buckets)
        return rows_of(present, ends, prefix=prefix[order], suffix=suffix[order], n=n[order], q=q[order])

    def decided(runs: pa.Table, below: pa.Table) -> pa.Table:
        context, seen = flat(below["gram"], np.uint64), flat(below["n"], np.int64)
        by = np.argsort(context)
        prefix, suffix, n, q = (flat(runs[c], k) for c, k in (
            ("prefix", np.uint64), ("suffix", np.uint64), ("n", np.int64), ("q", float)))
        hit, _ = _found(context[by], prefix)
        prefix, suffix, n, q = prefix[hit], suffix[hit], n[hit], q[hit]
        states, owner, _ = distinct(prefix)
        total = seen[by][_found(context[by], states)[1]].astype(float) if len(states) else np.zeros(0)
        given = np.bincount(owner, weights=n, minlength=len(states))
        entries = np.bincount(owner, minlength=len(states))
        weight = total + prior
        rest = (weight - given) / weight
        share = n / weight[owner]
        p = share + rest[owner] * q
        # Kullback-Leibler divergence from the shorter state; what is no entry differs by the rest.
        gain = np.bincount(owner, weights=p * np.log(p / q), minlength=len(states))
        named = np.bincount(owner, weights=p, minlength=len(states))
        divergence = gain + np.maximum(1 - named, 0) * np.log(rest)
        kept = total * divergence > 0.5 * np.log(np.maximum(total, 2)) * entries
        stays = kept[owner]
        gram = joined(prefix, suffix)
        p, share = np.where(stays, p, q), np.where(stays, share, np.nan)
        order, present, ends = grouped(gram, buckets)
        none, states, rest = np.zeros(len(present) + 1, np.int64), states[kept], rest[kept]
        out = rows_of(present, ends, gram=gram[order], n=n[order], p=p[order], share=share[order])
        out = out.append_column("state", packed(states[:0], none)).append_column("rest", packed(rest[:0], none))
        home, mine, until = grouped(states, buckets)
        none = np.zeros(len(mine) + 1, np.int64)
        empty = {c: packed(out_kind, none) for c, out_kind in (
            ("gram", gram[:0]), ("n", n[:0]), ("p", p[:0]), ("share", share[:0]))}
        own = pa.table({"bucket": pa.array(mine, pa.int64()), **empty, "state": packed(states[home], until),
                        "rest": packed(rest[home], until)})
        return pa.concat_tables([out, own])

    below = shorter.select("bucket", "gram", "n", "p").groupBy("bucket")
    told = rows.groupBy("bucket").cogroup(below).applyInArrow(
        likened, "bucket long, prefix binary, suffix binary, n binary, q binary")
    return told.groupBy("bucket").cogroup(below).applyInArrow(decided, _LEVEL)


def _unpacked(level: DataFrame, depth: int) -> DataFrame:
    """A level's states and their entries, one in a row."""
    def run(batches):
        for batch in batches:
            gram, share, state, rest = (flat(batch[c], k) for c, k in (
                ("gram", np.int64), ("share", float), ("state", np.int64), ("rest", float)))
            entry = ~np.isnan(share)
            gram, share = gram[entry], share[entry]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(gram, state)), pa.array(np.full(len(gram) + len(state), depth, np.int32)),
                 pa.array(np.append(share, np.full(len(state), np.nan)), from_pandas=True),
                 pa.array(np.append(np.full(len(gram), np.nan), rest), from_pandas=True)],
                names=["gram", "depth", "share", "rest"])

    return level.select("gram", "share", "state", "rest").mapInArrow(
        run, "gram long, depth int, share double, rest double")


def learn(docs: DataFrame, vocabulary: DataFrame, lex, frequent, prior: float, text: str = "text",
          depth: int = DEPTH, folds: DataFrame | None = None) -> DataFrame:
    """States and their entries: gram, depth, share, rest.

    A state's row has the share it leaves to the next shorter one as rest. An entry, known by
    the run of the state's words and the next, has its own share, beside what the shorter
    state adds. ``folds`` are those of the texts, if there are any. ``frequent`` is not used: folds get
    the counts of words that tasks do not know when they are scored.
    """
    spark = docs.sparkSession
    out = None
    with owned([]) as texts:
        folds = stash(folded(docs, text), "folds", "zstd") if folds is None else folds
    with owned([]) as counts:
        pairs = counted(folds, 2, lex.tokens)
    with owned(texts):
        folds = stash(paired(folds, pairs, lex.tokens), "folds", "zstd")
    for k, level in enumerate(levels(folds, pairs, counts, vocabulary, lex, prior, depth), 1):
        found = _unpacked(level, k)
        out = found if out is None else out.unionByName(found)
    drop(spark, texts)
    return out


def levels(folds: DataFrame, pairs: DataFrame, folders: list[str], vocabulary: DataFrame, lex, prior: float,
           depth: int = DEPTH) -> list[DataFrame]:
    """What ``learn`` gives, by level and packed: in the row of a bucket gram and share of the runs, NaN
    where one is no entry, and state and rest of the states.

    ``folds`` are what ``paired`` gives, ``pairs`` those counted, whose ``folders`` are dropped when they are read.
    """
    spark = folds.sparkSession
    folds = folds.filter("taught")
    buckets = buckets_for(lex.tokens)
    start = vocabulary.filter(F.col("word") == _signed(_END)).select(
        F.lit(_signed(_BEGIN)).alias("gram"), F.col("c").alias("n"))
    words = vocabulary.select(F.col("word").alias("gram"), F.col("c").alias("n")).unionByName(start).withColumn(
        "p", F.pow(F.lit(10.0), F.log10(F.col("n") + F.lit(0.1)) - F.lit(lex.norm)))
    shorter = packed_rows(words, buckets, gram=np.int64, n=np.int64, p=float)
    out = []
    for level in range(1, depth + 1):
        if level > 1:
            with owned([]) as folders:
                pairs = counted(folds, level + 1, lex.tokens)
        rows = pairs.filter(F.col("fold").isNull()).select("bucket", "prefix", "suffix", "n")
        shorter = stash(_level(rows, shorter, buckets, prior), "level", "zstd")
        drop(spark, folders)
        out.append(shorter)
    return out


def _signed(gram: np.uint64) -> int:
    return int(gram.view(np.int64))


def _entries(level: DataFrame) -> DataFrame:
    """A level without the runs that are no entries."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                gram, share = (flat(batch[c].slice(i, 1), k) for c, k in (("gram", np.uint64), ("share", float)))
                entry = ~np.isnan(share)
                yield pa.RecordBatch.from_arrays(
                    [batch["bucket"].slice(i, 1), pa.array([gram[entry].tobytes()]), pa.array([share[entry].tobytes()]),
                     batch["state"].slice(i, 1), batch["rest"].slice(i, 1)],
                    names=["bucket", "gram", "share", "state", "rest"])

    return level.select("bucket", "gram", "share", "state", "rest").mapInArrow(
        run, "bucket long, gram binary, share binary, state binary, rest binary")


def model(states: DataFrame | None, rare: DataFrame, buckets: int, known: list[DataFrame] | None = None) -> DataFrame:
    """The states and entries of each bucket in one row: bucket, and gram, share, rest, packed.

    ``known`` are the levels, in as many buckets, or ``states`` what ``learn`` makes of them. A word that tasks do
    not know has how often it was seen as its share.
    """
    none = F.lit(b"")
    rows = packed_rows(rare.select(F.col("word").alias("gram"), F.col("c").cast("double").alias("share")), buckets,
                       gram=np.int64, share=float).select("bucket", "gram", "share", none.alias("state"), none.alias("rest"))
    for level in known or []:
        rows = rows.unionByName(_entries(level))
    if states is not None:
        for value, columns in (("share", ("gram", "share", none.alias("state"), none.alias("rest"))),
                               ("rest", (none.alias("gram"), none.alias("share"), F.col("gram").alias("state"), "rest"))):
            some = packed_rows(states.filter(F.col(value).isNotNull()), buckets, gram=np.int64, **{value: float})
            rows = rows.unionByName(some.select("bucket", *columns))

    def merge(found: pa.Table) -> pa.Table:
        entry, state = flat(found["gram"], np.uint64), flat(found["state"], np.uint64)
        grams, at, _ = distinct(np.append(entry, state))
        share, rest = np.full(len(grams), np.nan), np.full(len(grams), np.nan)
        share[at[:len(entry)]] = flat(found["share"], float)
        rest[at[len(entry):]] = flat(found["rest"], float)
        return rows_of(found["bucket"].slice(0, 1).to_numpy(), np.array([0, len(grams)]), gram=grams, share=share, rest=rest)

    return rows.groupBy("bucket").applyInArrow(merge, "bucket long, gram binary, share binary, rest binary")


def questions(folds: DataFrame, depth: int, buckets: int) -> DataFrame:
    """The words and runs that folds ask the states for, each once a fold: bucket, fold, length, gram."""
    def run(batches):
        for batch in batches:
            for fold in unfolded(batch):
                for length, gram in enumerate(fold.asks(depth)):
                    present, ends = _parts(bucket_of(gram, buckets), buckets)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(present, pa.int64()), pa.array(np.full(len(present), fold.fold)),
                         pa.array(np.full(len(present), length)), packed(gram, ends)],
                        names=["bucket", "fold", "length", "gram"])

    return folds.mapInArrow(run, "bucket long, fold long, length long, gram binary")


_TOLD = "fold long, bucket long, length long, hit binary, share binary, rest binary"


def _replies(asks: pa.Table, known: pa.Table) -> pa.Table:
    """For each fold which of its questions the states of a bucket know, as bits, and their values."""
    gram, share, rest = (flat(known[c], k) for c, k in (("gram", np.uint64), ("share", float), ("rest", float)))
    hit, at = _found(gram, flat(asks["gram"], np.uint64))
    at = at[hit]
    sizes = pc.binary_length(asks["gram"]).to_numpy() // 8
    ends = np.append(0, np.cumsum(hit))[np.append(0, np.cumsum(sizes))]
    return pa.table({**{c: asks[c] for c in ("fold", "bucket", "length")}, "hit": bits(hit, sizes),
                     "share": packed(share[at], ends), "rest": packed(rest[at], ends)})


def _answers(asked: list[tuple], buckets: int, replies: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """By length, share and rest of each question, and of none at the end: what is no entry has no share,
    what is no state leaves all."""
    out = [(np.zeros(len(gram) + 1), np.ones(len(gram) + 1)) for gram, _ in asked]
    for length, (gram, _) in enumerate(asked):
        mine = replies.filter(pc.equal(replies["length"], length)).sort_by("bucket")
        _, ends = _parts(bucket_of(gram, buckets), buckets)
        hit = np.flatnonzero(unbits(mine["hit"], np.diff(ends)))
        for values, name in zip(out[length], ("share", "rest")):
            value = flat(mine[name], float)
            there = ~np.isnan(value)
            values[hit[there]] = value[there]
    return out


def scores(folds: DataFrame, known: DataFrame, depth: int, tokens: int, told: Callable) -> DataFrame:
    """key, n_tokens, n_known, base_score and score of each text.

    ``known`` is what ``model`` gives. ``told`` gives, for a fold and how often its words were seen as
    far as tasks do not know, whether each word is known, the log10 of its base probability, both of
    the end, and the tree's probability of each token.
    """
    buckets, parts = buckets_for(tokens), _shares(tokens, PARTS)
    schema = T.StructType([
        T.StructField("key", folds.schema["key"].dataType.elementType), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()),
        T.StructField("score", T.DoubleType())])

    def scored(texts: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        for fold in unfolded(texts):
            asked = fold.asked(depth)
            answers = _answers(asked, buckets, replies)
            rare = answers[0][0][np.searchsorted(asked[0][0], fold.word)]
            seen, base, end_seen, end_base, p = told(fold, rare)
            after = np.flatnonzero(fold.ends_of(2))  # every token
            for d in range(1, depth + 1):  # from the shortest state up
                share, rest = answers[d][0][asked[d][1][after]], answers[d - 1][1][asked[d - 1][1][after - 1]]
                p = share + rest * p
            n = len(fold.size)
            owner = np.repeat(np.arange(n), fold.size)
            step = fold.size + 1
            out.append(pa.table({
                "key": fold.key, "n_tokens": step,
                "n_known": np.bincount(owner, weights=seen[fold.code], minlength=n).astype(np.int64) + end_seen,
                "base_score": np.bincount(owner, weights=base[fold.code], minlength=n) + end_base,
                "score": np.add.reduceat(np.log10(p), np.cumsum(step) - step)}))
        return pa.concat_tables(out)

    out = None
    for part in range(parts):
        mine = folds.filter(F.pmod(F.xxhash64("fold"), F.lit(parts)) == part)
        replies = questions(mine, depth, buckets).groupBy("bucket").cogroup(
            known.groupBy("bucket")).applyInArrow(_replies, _TOLD)
        found = stash(mine.groupBy("fold").cogroup(replies.groupBy("fold")).applyInArrow(scored, schema), "gains")
        out = found if out is None else out.unionByName(found)
    return out
