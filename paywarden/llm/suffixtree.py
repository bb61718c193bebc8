"""Scoring texts by a probabilistic suffix tree over words (operator 8).

Tokens are the words of a text, A-Z in lower case, and one end. Spark counts the words of
all training texts. Words that make up at least a share SYMBOL of the tokens are symbols;
all others share one symbol, within which a word keeps its share of the base model. A
context is one of the latest symbols or a run of them, up to DEPTH; Spark counts what
follows each context that makes up at least a share CONTEXT. A context stays in the tree
if its distribution diverges from that of the context without its oldest symbol by more
than its entries cost to describe. Each state's distribution is smoothed towards that of
the next shorter state, down to the base model, so all sum to one.

This tree of symbols is the hot part, which is sent to the tasks. Above it stand the states
over whole words (``wordstates``): runs of any words seen twice or more, held in Spark
tables. A token is scored by the longest state over words that fits the words before it;
what that leaves goes to the shorter ones and last to the longest state of symbols.

Shares bound the tree of symbols, whatever the corpus: at most 1/SYMBOL symbols, 1/CONTEXT
contexts and 1/ENTRY entries a depth. Words with at least a share LOOKUP, at most 1/LOOKUP, are sent
to the tasks as sorted hashes; of the rest each fold of texts asks for its own, once, beside the runs it
asks the states for. So the vocabulary may grow without bound, and no word, text or source is gathered
in one task. Words are told apart by 64-bit hashes.

NULL and empty texts have the end alone. Without training texts every token has the same
probability. An empty table has no rows. Repeated rows are counted and scored each. Rows
are numbered, so keys may repeat or be NULL. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paywarden.llm import wordstates
from paywarden.llm.common import drop, owned, resident, stash

DEPTH = 2
SYMBOL = 5e-4
CONTEXT = 1e-4
ENTRY = 1e-6
LOOKUP = 2.5e-7
# The hashes of longer words are never sent to the tasks.
LOOKUP_BYTES = 64
PRIOR = 5.0  # weight of the shorter state in a distribution
# Coded counts that a task holds before it hands them on.
HELD = 1_000_000
# Contexts that a task has a flag each for, rather than look them up.
TABLE = 1 << 24

END = int(np.uint64(wordstates.END).view(np.int64))  # the end's place among the words' hashes
_OTHER, _BEGIN, _END = 0, 1, 2


def training(key: str = "doc_id"):
    """Documents that are learnt from."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 10 != 0


def word_counts(docs: DataFrame, text: str = "text", folds: DataFrame | None = None) -> DataFrame:
    """Columns word, its hash, bytes, its length, and c; the end as the hash of an empty word."""
    folds = wordstates.folded(docs, text) if folds is None else folds
    buckets = wordstates.buckets_for(wordstates.tokens_of(folds))

    def run(batches):
        for batch in batches:
            for fold in wordstates.unfolded(batch):
                word, length = np.append(fold.word, np.uint64(wordstates.END)), np.append(fold.bytes, np.uint8(0))
                n = np.append(np.bincount(fold.code, minlength=len(fold.word)), len(fold.size))
                order, present, ends = wordstates.grouped(word, buckets)
                yield from wordstates.rows_of(
                    present, ends, word=word[order], bytes=length[order], n=n[order]).to_batches()

    def total(rows: pa.Table) -> pa.Table:
        word, length, n = (wordstates.flat(rows[c], k) for c, k in (
            ("word", np.uint64), ("bytes", np.uint8), ("n", np.int64)))
        different, places, _ = wordstates.distinct(word)
        size = np.zeros(len(different), np.int32)
        size[places] = length
        c = np.bincount(places, weights=n, minlength=len(different)).astype(np.int64)
        return pa.table({"word": different.view(np.int64), "bytes": size, "c": c})

    return folds.mapInArrow(run, "bucket long, word binary, bytes binary, n binary").groupBy("bucket").applyInArrow(
        total, "word long, bytes int, c long")


@dataclass(frozen=True)
class Lexicon:
    """Frequent words as ascending hashes, with counts and symbols; sizes of the training texts."""

    hashes: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    tokens: int
    distinct: int
    ends: int
    size: int  # number of symbols

    def base(self, counts) -> np.ndarray:
        """log10 of the base probability of tokens seen so often."""
        return np.log10(np.asarray(counts) + 0.1) - self.norm

    @property
    def norm(self) -> float:
        return float(np.log10(self.tokens + 0.1 * (self.distinct + 1)))

    def root(self) -> np.ndarray:
        """Base probability of each symbol; none for the beginning, which is never predicted."""
        out = np.zeros(self.size)
        named = self.symbols > _END
        out[self.symbols[named]] = 10 ** self.base(self.counts[named])
        out[_END] = 10 ** float(self.base(self.ends))
        out[_OTHER] = max(1 - out.sum(), 10 ** float(self.base(0)))
        return out


def lexicon(vocabulary: DataFrame) -> Lexicon:
    """The part of the vocabulary that goes to the tasks: at most 1/LOOKUP short words."""
    total = vocabulary.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"),
                           F.max(F.when(F.col("word") == END, F.col("c"))).alias("e")).first()
    n = total["n"] or 0
    frequent = vocabulary.filter(_frequent(n)).toPandas()
    hashes = frequent["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    counts = frequent["c"].to_numpy(np.int64)[order]
    named = counts >= max(2, n * SYMBOL)
    symbols = np.where(named, np.cumsum(named) + _END, _OTHER).astype(np.int64)
    return Lexicon(hashes[order], counts, symbols, n, total["v"], total["e"] or 0,
                   int(named.sum()) + _END + 1)


def _frequent(n: int):
    return ((F.col("c") >= max(2.0, n * LOOKUP)) & (F.col("word") != END)
            & (F.col("bytes") <= LOOKUP_BYTES))


class Reader:
    """Places of words in a lexicon."""

    def __init__(self, lex: Lexicon):
        self.lex = lex

    def places(self, words: np.ndarray) -> np.ndarray:
        """For the hash of each word its place in the lexicon, or -1."""
        lex = self.lex
        if not len(lex.hashes):
            return np.full(len(words), -1)
        # Ascending words are found much faster.
        order = np.argsort(words)
        known = words[order]
        at = np.minimum(np.searchsorted(lex.hashes, known), len(lex.hashes) - 1)
        out = np.empty(len(words), np.int64)
        out[order] = np.where(lex.hashes[at] == known, at, -1)
        return out

    def symbols(self, places: np.ndarray) -> np.ndarray:
        if not len(self.lex.symbols):
            return np.zeros(len(places), np.int64)
        return np.where(places >= 0, self.lex.symbols[places], _OTHER)


def _reader(name: str, sent) -> Reader:
    """One reader a Python worker and lexicon."""
    return resident(f"reader {name}", lambda: Reader(sent.value))


def _lines(symbols: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """Next symbols, ends included, and the ``depth`` symbols before each, latest first.

    Before a text stand beginnings, so no context reaches into another text.
    """
    step = sizes + 1 + depth
    line = np.full(int(step.sum()), _BEGIN, np.int64)
    starts = np.cumsum(step) - step + depth
    inside = np.arange(len(symbols)) + np.repeat(
        starts - (np.cumsum(sizes) - sizes), sizes)
    line[inside] = symbols
    line[starts + sizes] = _END
    there = np.ones(len(line), bool)
    for k in range(1, depth + 1):
        there[starts - k] = False
    at = np.flatnonzero(there)
    return line[at], *(line[at - k] for k in range(1, depth + 1))


def _codes(before: tuple[np.ndarray, ...], size: int) -> np.ndarray:
    """Contexts as numbers: the latest symbol last."""
    code = np.zeros(len(before[0]), np.int64)
    for k, symbol in enumerate(before):
        code += symbol * size ** k
    return code


def follower_counts(folds: DataFrame, sent, name: str, contexts: np.ndarray | None, depth: int) -> DataFrame:
    """How often each symbol follows each context of length ``depth``: context, symbol, n.

    ``contexts`` are ascending codes, at most 1/CONTEXT; at depth 1 all symbols count.
    """
    def run(batches):
        reader = _reader(name, sent)
        size = reader.lex.size
        if contexts is not None:
            wanted = np.zeros(size ** depth if size ** depth < TABLE else 0, bool)
            if len(wanted):
                wanted[contexts] = True
        held: list[tuple[np.ndarray, np.ndarray]] = []
        length = 0
        for batch in batches:
            for fold in wordstates.unfolded(batch):
                symbols = reader.symbols(reader.places(fold.word))[fold.code]
                following, *before = _lines(symbols, fold.size, depth)
                code = _codes(tuple(before), size)
                if contexts is not None:
                    if len(wanted):
                        good = wanted[code]
                    else:
                        at = np.minimum(np.searchsorted(contexts, code), len(contexts) - 1)
                        good = contexts[at] == code
                    code, following = code[good], following[good]
                code = code * size + following
                if contexts is None:  # few of them
                    n = np.bincount(code, minlength=1)
                    held.append((np.flatnonzero(n), n[n > 0]))
                else:
                    held.append(np.unique(code, return_counts=True))
                length += len(held[-1][0])
                if length >= HELD:
                    held = [_summed(held)]
                    length = len(held[0][0])
                    if length >= HELD // 2:
                        yield from _coded(*held[0], size)
                        held, length = [], 0
        if held:
            yield from _coded(*_summed(held), size)

    counted = folds.mapInArrow(run, "context long, symbol long, n long")
    return counted.groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def _summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
    return codes, np.bincount(at, weights=np.concatenate([h[1] for h in held])).astype(np.int64)


def _coded(codes: np.ndarray, n: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(codes), 100_000):
        part = codes[start:start + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part // size), pa.array(part % size), pa.array(n[start:start + 100_000])],
            names=["context", "symbol", "n"])


@dataclass(frozen=True)
class Depth:
    """States of one depth, ascending by context code; entries ascending by state and symbol."""

    contexts: np.ndarray
    rest: np.ndarray  # natural log of the share left to the shorter state
    entries: np.ndarray  # state * size + symbol
    logs: np.ndarray  # natural log of the probability


@dataclass(frozen=True)
class Tree:
    size: int
    root: np.ndarray  # natural log of the probability of each symbol
    depths: tuple[Depth, ...]

    def logs(self, following: np.ndarray, before: list[np.ndarray]) -> np.ndarray:
        """Natural log probability of symbols, each by the longest state for what is before it.

        Equal symbols after equal ones are looked up once.
        """
        code = _codes((following, *before[:len(self.depths)]), self.size)
        span = self.size ** (1 + len(self.depths))
        free = 64 - span.bit_length()
        if len(code) < 2 or span.bit_length() + len(code).bit_length() > 64:
            return self._logs(following, before)
        _, places, first = wordstates.distinct(code.astype(np.uint64) << np.uint64(free))
        return self._logs(following[first], [b[first] for b in before])[places]

    def _logs(self, following: np.ndarray, before: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(len(following))
        todo = np.arange(len(following))
        for k in range(len(self.depths), 0, -1):
            level = self.depths[k - 1]
            if not len(level.contexts) or not len(todo):
                continue
            code = _codes(tuple(b[todo] for b in before[:k]), self.size)
            state = np.minimum(np.searchsorted(level.contexts, code), len(level.contexts) - 1)
            fits = level.contexts[state] == code
            entry = state * self.size + following[todo]
            at = np.minimum(np.searchsorted(level.entries, entry), max(len(level.entries) - 1, 0))
            found = fits & (level.entries[at] == entry) if len(level.entries) else fits & False
            out[todo[found]] += level.logs[at[found]]
            left = fits & ~found
            out[todo[left]] += level.rest[state[left]]
            todo = todo[~found]
        out[todo] += self.root[following[todo]]
        return out


def grow(tree: Tree, counts: DataFrame, tokens: int) -> tuple[Tree, np.ndarray]:
    """The tree with one more depth, and the contexts worth counting at the next.

    Of the counts only contexts with a share CONTEXT and entries with a share ENTRY reach
    the driver, so their number is bounded.
    """
    size, depth = tree.size, len(tree.depths) + 1
    totals = counts.groupBy("context").agg(F.sum("n").alias("total"))
    totals = totals.filter(F.col("total") >= max(2.0, tokens * CONTEXT))
    states = totals.toPandas().sort_values("context")
    rows = counts.join(totals, "context").filter(F.col("n") >= max(2.0, tokens * ENTRY))
    rows = rows.select("context", "symbol", "n").toPandas().sort_values(["context", "symbol"])
    contexts, total = states["context"].to_numpy(np.int64), states["total"].to_numpy(float)
    context, symbol = rows["context"].to_numpy(np.int64), rows["symbol"].to_numpy(np.int64)
    n = rows["n"].to_numpy(float)
    state = np.searchsorted(contexts, context)
    # What the shorter state says of the same symbols.
    before = [context // size ** k % size for k in range(depth - 1)]
    shorter = tree.logs(symbol, before)
    given = np.bincount(state, weights=n, minlength=len(contexts))
    rest = (total - given + PRIOR) / (total + PRIOR)
    logs = np.log((n + (total - given + PRIOR)[state] * np.exp(shorter)) / (total + PRIOR)[state])
    told = np.bincount(state, weights=np.exp(logs), minlength=len(contexts))
    divergence = (np.bincount(state, weights=np.exp(logs) * (logs - shorter), minlength=len(contexts))
                  + np.maximum(1 - told, 0) * np.log(rest))
    entries = np.bincount(state, minlength=len(contexts))
    stays = total * divergence > 0.5 * np.log(np.maximum(total, 2)) * entries
    kept = np.flatnonzero(stays & (entries > 0))
    number = np.full(len(contexts), -1)
    number[kept] = np.arange(len(kept))
    mine = number[state] >= 0 if len(state) else np.zeros(0, bool)
    level = Depth(contexts[kept], np.log(rest[kept]),
                  number[state[mine]] * size + symbol[mine], logs[mine])
    # A longer context is as frequent as its last symbol is after the rest of it.
    often = (n >= max(2.0, tokens * CONTEXT)) & (symbol != _END)
    return Tree(size, tree.root, (*tree.depths, level)), np.unique(context[often] * size + symbol[often])


def learn(docs: DataFrame, vocabulary: DataFrame, text: str = "text", depth: int = DEPTH,
          folds: DataFrame | None = None) -> tuple[Lexicon, Tree]:
    """Lexicon and tree of the training texts ``docs``, or their ``folds``."""
    lex = lexicon(vocabulary)
    folds = wordstates.folded(docs, text) if folds is None else folds
    sent, name = docs.sparkSession.sparkContext.broadcast(lex), uuid.uuid4().hex
    with np.errstate(divide="ignore"):
        tree = Tree(lex.size, np.log(lex.root()), ())
    contexts = None
    for level in range(1, depth + 1):
        counts = stash(follower_counts(folds, sent, name, contexts, level), "followers")
        tree, contexts = grow(tree, counts, lex.tokens)
        if not len(contexts):
            break
    return lex, tree


def scored(docs: DataFrame, vocabulary: DataFrame, lex: Lexicon, tree: Tree, key: str = "doc_id",
           text: str = "text", states: DataFrame | None = None, folders: list[str] | None = None,
           folds: DataFrame | None = None, levels: list[DataFrame] | None = None) -> DataFrame:
    """Key, n_tokens, n_known, base_score and score of each document.

    ``states`` are those over whole words, which go before the tree's, or ``levels`` the same packed; ``folders`` hold
    nothing else and are dropped when the states are read. ``folds`` are those of the documents, if there are any.
    """
    spark = docs.sparkSession
    sent, name = spark.sparkContext.broadcast(lex), uuid.uuid4().hex
    grown = spark.sparkContext.broadcast(tree)
    folds = stash(wordstates.folded(docs, text, key), "numbered", "zstd") if folds is None else folds
    rare = vocabulary.filter(~_frequent(lex.tokens) & (F.col("word") != END))
    known = stash(wordstates.model(states, rare, wordstates.buckets_for(lex.tokens), levels), "packed", "zstd")
    drop(spark, folders or [])

    def told(fold: wordstates.Fold, counts: np.ndarray) -> tuple:
        reader, tree = _reader(name, sent), grown.value
        lex = reader.lex
        places = reader.places(fold.word)
        if len(lex.counts):
            counts = np.where(places >= 0, lex.counts[places], counts)
        base = lex.base(counts)
        symbols = reader.symbols(places)
        # Within the shared symbol a word has its share of the base model.
        own = np.where(symbols == _OTHER, base * np.log(10) - tree.root[_OTHER], 0.0)
        following, *before = _lines(symbols[fold.code], fold.size, max(1, len(tree.depths)))
        path = tree.logs(following, before)
        inside = np.ones(len(path), bool)
        inside[np.cumsum(fold.size + 1) - 1] = False
        path[inside] += own[fold.code]
        return counts > 0, base, int(lex.ends > 0), float(lex.base(lex.ends)), np.exp(path)

    depth = 0 if states is None and levels is None else wordstates.DEPTH
    found = stash(wordstates.scores(folds, known, depth, lex.tokens, told), "scored")
    return found.withColumnRenamed("key", key)


def language_model_scores(docs: DataFrame, key: str = "doc_id", text: str = "text",
                          learnt: Callable = training) -> DataFrame:
    """Scores of all documents by what the training documents among them teach."""
    rows = docs.select(key, text)
    spark = docs.sparkSession
    with owned([]) as plain:
        folds = stash(wordstates.folded(rows, text, key, learnt(key)), "numbered", "zstd")
    train = folds.filter("taught")
    vocabulary = stash(word_counts(rows, text, train), "vocabulary")
    lex, tree = learn(rows, vocabulary, text, folds=train)
    with owned([]) as counts:
        pairs = wordstates.counted(folds, 2, lex.tokens)
    folds = stash(wordstates.paired(folds, pairs, lex.tokens), "numbered", "zstd")
    drop(spark, plain)
    with owned([]) as folders:
        levels = wordstates.levels(folds, pairs, counts, vocabulary, lex, PRIOR)
    found = scored(rows, vocabulary, lex, tree, key, text, None, folders, folds, levels)
    return found.select(key, (~learnt(key)).alias("held_out"), "n_tokens", "n_known",
                        F.lit(lex.tokens).cast("long").alias("train_tokens"), "base_score", "score")
