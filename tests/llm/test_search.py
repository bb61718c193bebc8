import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from corpus_rows import ODD
from pyspark.sql import types as T

from paywarden.llm import search

ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()),
                      T.StructField("rank", T.StringType()), T.StructField("score", T.StringType()),
                      T.StructField("doc_id", T.StringType())])


def terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def plain(docs, items):
    """Every document scored for every item; rows of (key, text)."""
    bags = [Counter(terms(t)) for _, t in docs]
    lengths = [sum(b.values()) for b in bags]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (key, _), bag, length in zip(docs, bags, lengths):
            score = 0
            for t, k in Counter(terms(text)).items():
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    m = 100 - 75 + (75 * length * n) // total
                    score += k * w * ((1000000000 * bag[t]) // (1000 * bag[t] + 8 * m))
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:10], 1)]
    return sorted(map(repr, out))


def found(spark, docs, items, **options):
    frame = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in items], ITEMS)
    return sorted(repr(tuple(r)) for r in search.ranked(docs, frame, **options).collect())


def corpus(seed, size=400):
    rng = random.Random(seed)
    words = [f"W{i}" if i % 3 else f"é{i}" for i in range(60)]
    common = [1 / (i + 1) for i in range(60)]
    docs = [(rng.randint(0, 10 ** 6), ", ".join(rng.choices(words, common, k=rng.randint(0, 50))))
            for _ in range(size)]
    docs += [(n, docs[0][1]) for n in range(50)] + docs[:5]
    items = [(n, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for n in range(25)]
    return docs, items


@pytest.mark.parametrize("block", [16, 8192])
def test_ranks_as_scoring_everything_does(spark, documents, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK", block)
    docs, items = corpus(block)
    assert found(spark, documents(docs), items) == plain(docs, items)


def test_items_in_many_blocks(spark, documents, monkeypatch):
    monkeypatch.setattr(search, "ITEM_BYTES", 100)
    docs, items = corpus(5, 60)
    assert found(spark, documents(docs), items) == plain(docs, items)


def test_odd_rows(spark, documents):
    docs = [(r[0], r[1]) for r in ODD]
    items = [(1, "two words one"), (1, "two words one"), (None, "HUNTER2hunter2 x"), (3, None), (4, ""),
             (5, "nowhere"), (6, "long long 日本語"), (7, "x" * 50_000)]
    assert found(spark, documents(ODD), items) == plain(docs, items)


def test_empty_tables(spark, documents):
    assert found(spark, documents([]).filter("false"), [(1, "one")]) == []
    assert found(spark, documents([(1, "one")]), []) == []
    assert found(spark, documents([(1, None), (2, "!")]), [(1, "one")]) == []


def test_few_groups_are_taken_up():
    """Most documents hold but common terms; their groups are never parted to the end."""
    rng = np.random.default_rng(1)
    n = 4000
    lists = [np.unique(np.concatenate([rng.integers(0, 5, 4), rng.integers(5, 400, 3)])) for _ in range(n)]
    for i in range(20):
        lists[i * 100] = np.array([0, 1, 50, 51, 52, 300])
    starts = np.append(0, np.cumsum([len(x) for x in lists]))
    flat = np.concatenate(lists)
    block = search.Block(list(range(n)), np.diff(starts), starts, flat, np.ones(len(flat), np.int64), n,
                         int(starts[-1]), 0)
    weights = np.zeros(400, np.int64)
    terms = np.array([0, 1, 2, 3, 4, 50, 51, 52])
    weights[terms] = search.weight(n, np.bincount(flat, minlength=400).astype(float))[terms]
    best = search.Best()
    taken = search.search(block, terms, weights[terms], weights, best)
    scores = block.scores(np.arange(n), weights)
    order = sorted(range(n), key=lambda i: (-scores[i], i))[:10]
    assert sorted(e[4] for e in best.heap) == sorted(order)
    assert taken < 50
