"""Byte-pair encoding and decoding with a public vocabulary file (operator 1).

A text is cut at the added tokens of the file, then into pieces by the usual pattern
of byte-level vocabularies. In a piece the symbols form a doubly linked list; a heap
holds the merge rank of each adjacent pair. The lowest rank, leftmost first, is
merged; an entry whose pair has changed meanwhile is stale and skipped. Decoding
concatenates the vocabulary's byte strings.

NULL and empty texts have no tokens. Every row gives one row, repeated rows too.
Texts are encoded whole; a piece of n bytes takes O(n log n). Columns besides the
named ones are ignored, so clashing names do no harm.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from paywarden.llm.common import columns, resident

# The vocabulary is sent to every task; a file above this size is refused.
MAX_FILE_BYTES = 64 << 20
# Words, and pieces, whose ids a Python worker remembers in each of two generations.
CACHE_ENTRIES = 200_000
# Longer words are encoded each time, so that the memory of a cache is bounded too.
CACHE_LENGTH = 64

# Fixed value: the pattern of the vocabulary.
PIECE = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
         r"| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


PLACE = (1 << 40) - 1


class LooseText(Exception):
    """White space that is more than one space between two words."""


class Memo(dict):
    """Ids by text, made when first met. Of two generations the older is dropped when the younger is full."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        got = self.older.get(text)
        if got is None:
            got = self.make(text)
        if len(text) <= CACHE_LENGTH:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[text] = got
        return got


class Codec:
    """Encoder and decoder built from the bytes of a vocabulary file."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.strings = [b""] * (1 + max([*vocab.values(), *added.values()]))
        for token, i in vocab.items():
            self.strings[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            self.strings[i] = token.encode()
        self.numbers = [str(i) for i in range(len(self.strings))]
        self.first = [0] * 256
        for token, i in vocab.items():
            if len(token) == 1:
                self.first[letters[token]] = i
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[left] << 20 | vocab[right]] = rank
            self.made.append(vocab[left + right])
        self.piece = regex.compile(PIECE)
        self.gap = re.compile(r"(?<=\S) (?=\S)")
        self.added = added
        ordered = sorted(added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if added else None
        self.words = Memo(self.follower)
        self.pieces = Memo(lambda piece: self.merge(piece.encode()))

    def merge(self, data: bytes) -> tuple[int, ...]:
        """Token ids of one piece."""
        first, ranks, made = self.first, self.ranks, self.made
        ids = [first[b] for b in data]
        n = len(ids)
        if n == 1:
            return (ids[0],)
        get = ranks.get
        # An entry is rank and place in one number: the lowest rank, leftmost, comes first.
        heap = [r << 40 | i for i, r in enumerate(
            [get(a << 20 | b) for a, b in zip(ids, ids[1:])]) if r is not None]
        if not heap:
            return tuple(ids)
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            entry = heappop(heap)
            rank = entry >> 40
            i = entry & PLACE
            left = ids[i]
            j = after[i]
            if left < 0 or j >= n or get(left << 20 | ids[j]) != rank:
                continue  # stale
            new = ids[i] = made[rank]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = get(new << 20 | ids[k])
                if rank is not None:
                    heappush(heap, rank << 40 | i)
            h = before[i]
            if h >= 0:
                rank = get(ids[h] << 20 | new)
                if rank is not None:
                    heappush(heap, rank << 40 | h)
        return tuple([i for i in ids if i >= 0])

    def _cut(self, text: str) -> tuple[int, ...]:
        return tuple(chain.from_iterable(map(self.pieces.__getitem__, self.piece.findall(text))))

    def follower(self, word: str) -> tuple[int, ...]:
        """Ids of a space and a word that neither starts nor ends with white space."""
        if not word or word[0].isspace() or word[-1].isspace():
            raise LooseText
        if word.isalpha():
            return self.pieces[" " + word]
        if word[-1] in ".,:;!?" and word[:-1].isalpha():
            return self.pieces[" " + word[:-1]] + self.pieces[word[-1]]
        return self._cut(" " + word)

    def _plain(self, text: str) -> list[int]:
        # A space between two characters that are no white space always starts a piece.
        first, *rest = text.split(" ")
        try:
            if rest and (not first or first[-1].isspace()):
                raise LooseText
            return [*self._cut(first), *chain.from_iterable(map(self.words.__getitem__, rest))]
        except LooseText:
            first, *rest = self.gap.split(text)
        return [*self._cut(first), *chain.from_iterable(self._cut(" " + x) for x in rest)]

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        if self.special is None or not self.special.search(text):
            return self._plain(text)
        out: list[int] = []
        for part in self.special.split(text):
            if part in self.added:
                out.append(self.added[part])
            elif part:
                out.extend(self._plain(part))
        return out

    def decode(self, ids: list[int] | None) -> str:
        if not ids:
            return ""
        return b"".join(map(self.strings.__getitem__, ids)).decode("utf-8", "replace")


def codec(raw: bytes) -> Codec:
    """One codec a worker and file; its caches outlive a task."""
    return resident(f"codec {hashlib.sha256(raw).hexdigest()}", lambda: Codec(raw))


def _sent(frame: DataFrame, path: str):
    if os.path.getsize(path) > MAX_FILE_BYTES:
        raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
    with open(path, "rb") as file:
        return frame.sparkSession.sparkContext.broadcast(file.read())


def _hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _mapped(frame: DataFrame, field: T.StructField, path: str, source: str, work) -> DataFrame:
    """``frame`` with one more column, or that column replaced, made from ``source``."""
    sent = _sent(frame, path)
    kept = [c for c in frame.columns if c != field.name]
    schema = T.StructType([*(frame.schema[c] for c in kept), field])
    arrow = {T.ArrayType: pa.list_(pa.int32()), T.StringType: pa.string()}[type(field.dataType)]

    def run(batches):
        own = codec(sent.value)
        for batch in batches:
            made = [work(own, x) for (xs,) in columns(batch, source) for x in xs]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept),
                 pa.array(made, arrow)], names=[*kept, field.name])

    return frame.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns of ``docs`` and the token ids of ``text``; an older column ``ids`` is replaced."""
    field = T.StructField(ids, T.ArrayType(T.IntegerType()))
    return _mapped(docs, field, path, text, Codec.encode)


def decode(rows: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns of ``rows`` and the text of the token ids in ``ids``."""
    return _mapped(rows, T.StructField(text, T.StringType()), path, ids, Codec.decode)


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token count and digests of the ids and of the text decoded from them, a row each document.

    Ids stay in the task: only counts and digests go back to the JVM.
    """
    rows = docs.select(key, text)
    sent = _sent(docs, path)
    schema = T.StructType([docs.schema[key], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()),
                           T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        own = codec(sent.value)
        for batch in batches:
            counts, first, second = [], [], []
            for (texts,) in columns(batch, text):
                for value in texts:
                    found = own.encode(value)
                    counts.append(len(found))
                    first.append(_hex(",".join(map(own.numbers.__getitem__, found)).encode()))
                    second.append(_hex(own.decode(found).encode()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()),
                 pa.array(second, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
