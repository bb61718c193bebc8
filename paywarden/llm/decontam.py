"""Benchmark decontamination with one Aho-Corasick automaton (operator 6).

Normalising lower-cases A-Z and takes as words the runs of characters other than
ASCII non-alphanumerics. The windows of an item are its runs of ``width`` words; an
item of fewer, but not none, is one window. All windows go into one automaton; each
text is scanned once, and hits are mapped back to words and to the code points of the
original. A word inside any occurrence of a window is hit.

The windows are sent to every task, in blocks of at most ``block_bytes``: a benchmark
beyond it is scanned block after block, with the same result. Texts are scanned whole.

NULL and empty texts or items have no words; an empty table of items contaminates
nothing. A NULL item id counts as the empty string. Repeated rows give repeated rows,
items with the same id count once. Columns besides the named ones are ignored.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.llm.common import columns, fresh, resident, stash

WIDTH = 10
BLOCK_BYTES = 64 << 20

# UTF-8 bytes: A-Z become a-z, other ASCII outside 0-9 and a-z becomes a space.
_FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()
_WORD = re.compile(rb"[^ ]+")

_PAIRS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                   T.StructField("end", T.LongType())]))
HITS = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("words", _PAIRS),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("chars", _PAIRS)])
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_HITS = pa.struct([("n_words", pa.int64()), ("words", _SPAN), ("items", pa.list_(pa.string())),
                   ("chars", _SPAN)])


def normalised(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes."""
    return (text or "").encode().translate(_FOLD).split()


def windows(items: DataFrame, width: int = WIDTH, key: str = "item_id",
            text: str = "text") -> DataFrame:
    """Distinct pairs of a window's text and the id, as text, of an item that has it."""
    rows = items.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("item"),
                        F.col(text).alias("body"))

    def run(batches):
        for batch in batches:
            for ids, texts in columns(batch, "item", "body"):
                made = []
                for item, body in zip(ids, texts):
                    words = normalised(body)
                    if words:
                        spans = max(1, len(words) - width + 1)
                        made += {(b" ".join(words[i:i + width]).decode(), item)
                                 for i in range(spans)}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m[0] for m in made], pa.string()),
                     pa.array([m[1] for m in made], pa.string())], names=["window", "item"])

    return rows.mapInArrow(run, "window string, item string").distinct()


def _automaton(packed: bytes):
    """The automaton of a block of windows, or None of no window.

    Each byte of UTF-8 is one character of it, so the classes of bytes stay exact.
    """
    found: dict[bytes, list[str]] = {}
    for window, item in pickle.loads(packed):
        found.setdefault(window.encode(), []).append(item)
    automaton = ahocorasick.Automaton()
    for window, items in found.items():
        automaton.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, items))
    if not found:
        return None
    automaton.make_automaton()
    return automaton


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Spans of word numbers inside occurrences, and the items found."""
    if automaton is None or not words:
        return [], set()
    line = b" " + b" ".join(words) + b" "
    spans, items = [], set()
    at = done = 0  # words begun before the place `done`
    for end, (n, of) in automaton.iter(line.decode("latin-1")):
        at += line.count(b" ", done, end)
        done = end
        spans.append((at - n, at))
        items.update(of)
    return _merge(spans), items


def scan(docs: DataFrame, items: DataFrame, width: int = WIDTH, text: str = "text",
         hits: str = "_hits", keep: list[str] | None = None,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns ``keep`` of ``docs``, or all, and a struct of what was found.

    Its fields: n_words, words (hit words, as spans of word numbers, end exclusive), items
    (texts of ids, sorted) and chars (the same spans in code points of the original).
    """
    context = docs.sparkSession.sparkContext
    found = stash(windows(items, width), "windows")
    total = found.agg(F.sum(F.octet_length("window") + F.octet_length("item"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    part = F.pmod(F.xxhash64("window"), F.lit(blocks))
    rows = docs
    for block in range(blocks):
        # At most about block_bytes, as counted above.
        pairs = [tuple(r) for r in found.filter(part == block).collect()]
        sent = context.broadcast(pickle.dumps(pairs))
        last = block == blocks - 1
        kept = [c for c in (keep or docs.columns) if c != hits] if last else docs.columns
        schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(hits, HITS)])
        rows = rows.mapInArrow(_scanner(sent, block > 0, text, hits, kept), schema)
        if not last:
            rows = stash(rows, "scanned")
    return rows


def _scanner(sent, again: bool, text: str, hits: str, kept: list[str]):
    name = hashlib.sha256(sent.value).hexdigest()

    def run(batches):
        automaton = resident(f"automaton {name}", lambda: _automaton(sent.value))
        for batch in batches:
            made = []
            for texts, before in columns(batch, text, hits if again else text):
                for body, old in zip(texts, before):
                    words = normalised(body)
                    hit, of = _scan(automaton, words)
                    if again:
                        hit = _merge(hit + [(s["start"], s["end"]) for s in old["words"]])
                        of |= set(old["items"])
                    made.append({"n_words": len(words), "words": _spans(hit), "items": sorted(of),
                                 "chars": _spans(_in_text(body, hit))})
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept),
                 pa.array(made, _HITS)], names=[*kept, hits])

    return run


def _spans(pairs: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": a, "end": b} for a, b in pairs]


def _in_text(text: str | None, hit: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of code points of the original."""
    if not hit:
        return []
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    out, done, at = [], 0, 0
    for a, b in hit:
        start, end = places[a][0], places[b - 1][1]
        at += len(raw[done:start].decode())
        size = len(raw[start:end].decode())
        out.append((at, at + size))
        at, done = at + size, end
    return out


def contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """For each document counts and a digest of what was found."""
    rows = scan(docs.select(key, text), items, width, text, keep=[key])
    n_hit = F.aggregate("_hits.words", F.lit(0).cast("long"),
                        lambda n, s: n + s["end"] - s["start"])
    return rows.select(
        key, F.col("_hits.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("_hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_hits.items").cast("binary"), 256).alias("items_sha256"),
        (F.size("_hits.words") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame, width: int = WIDTH, text: str = "text") -> DataFrame:
    """Documents, all their columns, in which no window occurs."""
    hits = fresh(docs, "_hits")
    rows = scan(docs, items, width, text, hits)
    return rows.filter(F.size(f"{hits}.words") == 0).select(*docs.columns)
