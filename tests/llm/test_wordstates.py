import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from paywarden.llm import suffixtree, wordstates
from paywarden.llm.common import owned, stash


def passage(n=400):
    """Texts of words that are each too rare for a symbol, and one passage copied in some."""
    pick = random.Random(5)
    copied = [f"p{i}" for i in range(30)]
    rows = []
    for key in range(n):
        words = [f"w{pick.randrange(4000)}" for _ in range(60)]
        if key % 20 == 0:
            words[20:20] = copied
        rows.append((key, " ".join(words)))
    return rows, " ".join(copied)


def plain_states(lists, prior, depth):
    """Kept contexts with their followers' shares and the rest, by recursion over word tuples."""
    lines = [("^", *x, "") for x in lists]
    count = Counter(x[i:i + k] for x in lines for k in range(1, depth + 2) for i in range(len(x) - k + 1))
    base = Counter(w for x in lines for w in x[1:])
    n, v = sum(base.values()), len(base)
    after = defaultdict(dict)
    for g, c in count.items():
        if len(g) > 1 and c >= wordstates.LEAST:
            after[g[:-1]][g[-1]] = c
    kept = {}

    def p(context, word):
        if not context:
            return (base[word] + 0.1) / (n + 0.1 * (v + 1))
        share, rest = kept.get(context, ({}, 1.0))
        return share.get(word, 0.0) + rest * p(context[1:], word)

    for context in sorted(after, key=len):
        total, of = count[context], after[context]
        rest = (total - sum(of.values()) + prior) / (total + prior)
        q = {w: p(context[1:], w) for w in of}
        at = {w: c / (total + prior) + rest * q[w] for w, c in of.items()}
        gain = sum(at[w] * math.log(at[w] / q[w]) for w in of) + max(1 - sum(at.values()), 0) * math.log(rest)
        if total * gain > 0.5 * math.log(max(total, 2)) * len(of):
            kept[context] = ({w: c / (total + prior) for w, c in of.items()}, rest)
    return kept


def test_scores_by_states_over_words(documents, monkeypatch):
    """With a tree that knows no context, scores are those of the plain states over the base model."""
    pick = random.Random(2)
    rows = []
    for k in range(60):
        at = [0, 1]
        for _ in range(pick.randrange(40)):
            at.append(pick.choice([at[-1] * 5 + at[-2], at[-1] * 7, pick.randrange(12)]) % 12)
        rows.append((k, " ".join(f"w{i}" for i in at[2:])))
    rows += [(900, None), (901, "")]
    docs = documents(rows)
    for lookup in (suffixtree.LOOKUP, 0.05):  # the second leaves most words to the join
        monkeypatch.setattr(suffixtree, "LOOKUP", lookup)
        monkeypatch.setattr(suffixtree, "SYMBOL", 2.0)
        vocabulary = stash(suffixtree.word_counts(docs), "vocabulary")
        lex, tree = suffixtree.learn(docs, vocabulary, depth=0)
        states = wordstates.learn(docs, vocabulary, lex, suffixtree._frequent(lex.tokens), suffixtree.PRIOR)
        lists = [(t or "").split() for _, t in rows]
        kept = plain_states(lists, suffixtree.PRIOR, wordstates.DEPTH)
        assert {len(c) for c in kept} == set(range(1, wordstates.DEPTH + 1))
        assert states.filter("rest IS NOT NULL").count() == len(kept)
        other = {w: c for w, c in Counter(w for x in lists for w in [*x, ""]).items()}
        n, v = sum(other.values()), len(other)

        def p(context, word):
            if not context:
                return (other[word] + 0.1) / (n + 0.1 * (v + 1))
            share, rest = kept.get(context, ({}, 1.0))
            return share.get(word, 0.0) + rest * p(context[1:], word)

        found = {r["doc_id"]: r["score"] for r in suffixtree.scored(
            docs, vocabulary, lex, tree, states=states).collect()}
        for (key, _), words in zip(rows, lists):
            line = ("^", *words, "")
            expected = sum(math.log10(p(line[max(0, i - wordstates.DEPTH):i], line[i])) for i in range(1, len(line)))
            assert abs(found[key] - expected) < 1e-6


def test_copied_passage_of_rare_words_is_learnt(documents):
    rows, copied = passage()
    held = next(k for k in range(10_000, 20_000) if zlib.crc32(str(k).encode()) % 10 == 0)
    shuffled = copied.split()
    random.Random(1).shuffle(shuffled)
    other = next(k for k in range(held + 1, 20_000) if zlib.crc32(str(k).encode()) % 10 == 0)
    found = {r["doc_id"]: r for r in suffixtree.language_model_scores(
        documents([*rows, (held, copied), (other, " ".join(shuffled))])).collect()}
    assert found[held]["held_out"] and found[other]["held_out"]
    assert abs(found[held]["base_score"] - found[other]["base_score"]) < 1e-6
    # 30 words, each of which follows from those before in most of the texts that have them.
    assert found[held]["score"] > found[other]["score"] + 30


def test_tables_grow_with_the_corpus(documents):
    """Twice as many passages, twice as many states: no share of the corpus drops a context."""
    def states(n):
        rows = [(k * 10 + c, " ".join(f"t{k}x{i}" for i in range(15))) for k in range(n) for c in range(4)]
        docs = documents(rows)
        vocabulary = stash(suffixtree.word_counts(docs), "vocabulary")
        lex = suffixtree.lexicon(vocabulary)
        return wordstates.learn(docs, vocabulary, lex, suffixtree._frequent(lex.tokens), suffixtree.PRIOR).filter(
            "rest IS NOT NULL").count()

    small, large = states(100), states(200)
    assert small > 1000 and large > 1.9 * small


def test_slices_and_parts_leave_nothing_out_and_nothing_behind(documents, monkeypatch):
    """Runs counted in slices and texts scored in parts give the scores of one pass; only what the result reads stays."""
    rows, copied = passage(300)
    rows += [(k, copied) for k in range(20_000, 20_010)] + [(None, None), (1, "")]
    docs = documents(rows)

    def scores():
        with owned([]) as folders:
            found = suffixtree.language_model_scores(docs).collect()
        labels = {f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in folders}
        return sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 6)) for r in found), labels

    whole, labels = scores()
    # Counted runs, entries, states and lookups go as soon as they are used.
    assert labels == {"vocabulary", "followers", "numbered", "scored", "packed", "gains"}
    monkeypatch.setattr(wordstates, "SHARE", 4_000)
    monkeypatch.setattr(wordstates, "BUCKET", 1_000)
    monkeypatch.setattr(wordstates, "FOLDED", 2_000)
    assert wordstates._shares(18_000, wordstates.PARTS) == 5
    assert scores()[0] == whole


def test_texts_are_read_once(documents):
    """Words are counted, followers and runs learnt and all texts scored from one pass over the texts."""
    rows, _ = passage(60)
    docs = documents([*rows, (None, None), (1, "")])
    read = docs.sparkSession.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    marked = docs.withColumn("text", F.udf(seen, "string")("text"))
    assert suffixtree.language_model_scores(marked).count() == len(rows) + 2
    assert read.value == len(rows) + 2


def test_a_fold_names_each_run_once(documents):
    """However often a run is copied in a fold, it is asked for once, and its answer reaches all its places."""
    docs = documents([(k, "a b c d " * 50) for k in range(20)] + [(99, "")])
    folds = wordstates.folded(docs)
    for batch in folds.toArrow().to_batches():
        for fold in wordstates.unfolded(batch):
            asked = fold.asked(wordstates.DEPTH)
            assert sum(len(gram) for gram, _ in asked) <= 5 + 3 * 10
            for k, (runs, (gram, at)) in enumerate(zip(fold.runs(wordstates.DEPTH + 1), asked), 1):
                assert len(set(gram.tolist())) == len(gram)
                there = at < len(gram)
                # No answer is asked for an end: nothing follows it.
                assert (there == fold.ends_of(k)).all() or k == 1
                assert (gram[at[there]] == runs[there]).all()


def test_hashes_alike_in_their_leading_bits():
    pick = random.Random(4)
    grams = np.array([pick.choice([7 << 40, 7 << 40 | 1, 9 << 50]) + pick.randrange(3) for _ in range(5000)], np.uint64)
    for part in (grams, grams[:1], grams[:0]):
        found, places, first = wordstates.distinct(part)
        assert found.tolist() == sorted(set(part.tolist()))
        assert (found[places] == part).all() and (part[first] == found).all()


def test_packed_levels_are_the_states_as_rows(documents):
    """Levels go packed into the model that tasks look things up in, the same as their rows do."""
    rows, _ = passage(200)
    docs = documents([*rows, (None, None), (1, "")])
    vocabulary = stash(suffixtree.word_counts(docs), "vocabulary")
    lex = suffixtree.lexicon(vocabulary)
    rare = vocabulary.filter("c < 5")
    states = wordstates.learn(docs, vocabulary, lex, None, suffixtree.PRIOR)
    folds = stash(wordstates.folded(docs), "folds")
    pairs = wordstates.counted(folds, 2, lex.tokens)
    levels = wordstates.levels(wordstates.paired(folds, pairs, lex.tokens), pairs, [], vocabulary, lex, suffixtree.PRIOR)
    buckets = wordstates.buckets_for(lex.tokens)
    a, b = (sorted((r["bucket"], bytes(r["gram"]), bytes(r["share"]), bytes(r["rest"])) for r in m.collect())
            for m in (wordstates.model(states, rare, buckets), wordstates.model(None, rare, buckets, levels)))
    assert a == b and len(a[0][1]) > 0


def test_equal_symbols_are_looked_up_once(monkeypatch):
    pick = np.random.default_rng(3)
    size = 40
    contexts = np.unique(pick.integers(0, size * size, 300))
    entries = np.unique(pick.integers(0, len(contexts) * size, 4000))
    level = [suffixtree.Depth(np.arange(10, 30), pick.random(20), np.arange(0, 20 * size, 3), pick.random(len(range(0, 20 * size, 3)))),
             suffixtree.Depth(contexts, pick.random(len(contexts)), entries, pick.random(len(entries)))]
    tree = suffixtree.Tree(size, pick.random(size), tuple(level))
    following, *before = (pick.integers(0, size, 100_000) for _ in range(3))
    seen, plain = [], suffixtree.Tree._logs
    monkeypatch.setattr(suffixtree.Tree, "_logs", lambda self, f, b: seen.append(len(f)) or plain(self, f, b))
    assert (tree.logs(following, before) == plain(tree, following, before)).all()
    assert seen == [len(np.unique(following + size * before[0] + size * size * before[1]))]


def test_asks_are_what_is_asked(documents):
    for batch in wordstates.folded(documents(passage(30)[0])).toArrow().to_batches():
        for fold in wordstates.unfolded(batch):
            for gram, (same, _) in zip(fold.asks(wordstates.DEPTH), fold.asked(wordstates.DEPTH), strict=True):
                assert gram.tolist() == same.tolist()


def test_runs_whose_pairs_are_not_known_are_not_sent(documents):
    """A fold learns which of its pairs are known and names only runs of such; these are all that are known."""
    rows, copied = passage(120)
    rows += [(50_000, copied + " once only"), (None, None), (1_000, "")]
    lines = {key: ["^", *(text or "").split(), ""] for key, text in rows}
    taught = Counter(x for key, line in lines.items() if key != 50_000 for x in zip(line, line[1:]))
    docs = documents(rows)
    folds = stash(wordstates.folded(docs, key="doc_id", learnt=~F.col("doc_id").eqNullSafe(50_000)), "folds")
    tokens = wordstates.tokens_of(folds)
    found = wordstates.paired(folds, wordstates.counted(folds, 2, tokens), tokens).toArrow()
    places, runs = 0, 0
    for fold in wordstates.unfolded(found):
        at = [(line, i) for line in map(lines.get, fold.key.to_pylist()) for i in range(len(line))]
        assert fold.pairs.tolist() == [i > 0 and taught[line[i - 1], line[i]] >= wordstates.LEAST for line, i in at]
        for k in (2, 3, 4):
            assert fold.places_of(k).tolist() == [
                i >= k - 1 and all(taught[line[j - 1], line[j]] >= wordstates.LEAST for j in range(i - k + 2, i + 1))
                for line, i in at]
        places += int(fold.places_of(3).sum())
        runs += int(fold.ends_of(3).sum())
    assert 0 < places < runs / 2


def test_bits_of_parts():
    pick = np.random.default_rng(2)
    for sizes in ([], [0], [1], [8, 0, 3, 17], [5, 5, 5]):
        sizes = np.array(sizes, np.int64)
        values = pick.random(int(sizes.sum())) < 0.4
        assert (wordstates.unbits(wordstates.bits(values, sizes), sizes) == values).all()
