import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from corpus_rows import ODD

from paywarden.llm import suffixtree
from paywarden.llm.common import stash

_LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_LOWER)) + [None]


def held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 10 == 0


def corpus(seed=1, n=150):
    """Words that depend on the word before, so that contexts tell something; some are rare."""
    pick = random.Random(seed)
    after = {w: [f"w{pick.randrange(40)}" for _ in range(3)] for w in (f"w{i}" for i in range(40))}
    rows = []
    for key in range(n):
        word, text = "w0", []
        for _ in range(pick.randrange(0, 120)):
            word = pick.choice(after[word]) if pick.random() < 0.95 else f"w{pick.randrange(40)}"
            text.append(word.upper() if pick.random() < 0.2 else word)
            if pick.random() < 0.1:
                text.append(f"rare{pick.randrange(300)}")
        rows.append((key, " ".join(text)))
    return rows


@pytest.fixture(params=["usual", "coarse"])
def shares(request, monkeypatch):
    if request.param == "coarse":  # most words are rare or share the common symbol
        monkeypatch.setattr(suffixtree, "SYMBOL", 0.02)
        monkeypatch.setattr(suffixtree, "LOOKUP", 0.01)
        monkeypatch.setattr(suffixtree, "LOOKUP_BYTES", 3)


def test_base_scores_and_counts(documents, shares):
    rows = corpus() + [r for r in ODD if r[0] != 6]
    found = suffixtree.language_model_scores(documents(rows)).collect()
    seen = Counter(t for r in rows if not held(r[0]) for t in tokens(r[1]))
    n, v = sum(seen.values()), len(seen)
    expected = sorted(
        (repr(r[0]), held(r[0]), len(tokens(r[1])), sum(seen[t] > 0 for t in tokens(r[1])), n,
         round(sum(math.log10((seen[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(r[1])), 6))
        for r in rows)
    got = sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                  round(r["base_score"], 6)) for r in found)
    assert got == expected
    out = [r for r in found if r["held_out"] and r["n_tokens"] > 30]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_distributions_sum_to_one(documents, shares):
    docs = documents(corpus())
    vocabulary = stash(suffixtree.word_counts(docs), "vocabulary")
    lex, tree = suffixtree.learn(docs, vocabulary)
    assert len(tree.depths[0].contexts)
    every = np.array([s for s in range(lex.size) if s != suffixtree._BEGIN])
    pick = random.Random(3)
    for _ in range(60):
        before = [np.full(len(every), pick.randrange(lex.size)) for _ in tree.depths]
        assert abs(np.exp(tree.logs(every, before)).sum() - 1) < 1e-9


def test_longest_state_scores(documents, monkeypatch):
    """A tree grown by hand: pairs that always follow each other score as counted and smoothed."""
    rows = [(i, "a b " * 30) for i in range(1, 30)]
    docs = documents(rows)
    vocabulary = stash(suffixtree.word_counts(docs), "vocabulary")
    lex, tree = suffixtree.learn(docs, vocabulary, depth=1)
    count = {"a": 29 * 30, "b": 29 * 30, "": 29}
    n = sum(count.values())
    base = {w: (c + 0.1) / (n + 0.1 * 4) for w, c in count.items()}
    after = {"a": ({"b": 870}, 870), "b": ({"a": 841, "": 29}, 870), "^": ({"a": 29}, 29)}
    prior = suffixtree.PRIOR

    def p(word, before):
        entries, total = after[before]
        rest = total - sum(entries.values()) + prior
        return (entries.get(word, 0) + rest * base[word]) / (total + prior)

    words = ("a b " * 30).split() + [""]
    expected = sum(math.log10(p(w, b)) for w, b in zip(words, ["^", *words]))
    found = suffixtree.scored(docs, vocabulary, lex, tree).first()["score"]
    assert abs(found - expected) < 1e-6


def test_odd_tables(documents):
    docs = documents(ODD)
    assert suffixtree.language_model_scores(docs).count() == len(ODD)
    assert suffixtree.language_model_scores(docs.filter("false")).count() == 0
    untaught = suffixtree.language_model_scores(docs, learnt=lambda key: suffixtree.F.lit(False)).collect()
    assert all(r["score"] == r["base_score"] == 0 and r["n_known"] == 0 for r in untaught)
