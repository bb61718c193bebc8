import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from corpus_rows import ODD

from paywarden.llm import neardup
from paywarden.llm.decontam import normalised
from paywarden.llm.graph import components


def bag(text):
    words = normalised(text)
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def plain_classes(rows):
    """All pairs compared: smallest key and size of the class of each row."""
    bags = [bag(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(bags):
        for j in range(i):
            b = bags[j]
            least = sum((a & b).values())
            most = sum((a | b).values())
            if not most or least / most >= 0.8:
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = []
    for members in groups.values():
        keys = [rows[m][0] for m in members if rows[m][0] is not None]
        out += [(rows[m][0], min(keys, default=None), len(members)) for m in members]
    return sorted(map(repr, out))


def varied(seed=3, groups=6, size=14, words=60):
    """Texts that drift apart step by step, so that classes hang together by chains, and a shared passage."""
    pick = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(40))
    rows, key = [], 100
    for g in range(groups):
        text = [f"g{g}w{pick.randrange(500)}" for _ in range(words)]
        for _ in range(size):
            rows.append((key, " ".join(text) + (" " + passage if g % 2 else "")))
            key += 1
            for _ in range(pick.choice([0, 1, 2])):
                text[pick.randrange(words)] = f"n{pick.randrange(10**6)}"
    pick.shuffle(rows)
    return rows


def test_signature_agreement_is_the_similarity():
    pick = random.Random(5)
    for _ in range(12):
        one = {pick.getrandbits(63): pick.choice([1, 1, 2, 7, 900]) for _ in range(pick.choice([2, 40]))}
        two = {k: max(1, v // pick.choice([1, 1, 2])) for k, v in one.items()}
        two[pick.getrandbits(63)] = 3
        bags = []
        for d in (one, two):
            keys = np.array(sorted(d), np.uint64)
            bags.append((keys, np.array([d[int(k)] for k in keys])))
        true = neardup.similarity(*bags)
        got = neardup.signatures(bags, m=4096)
        assert abs((got[0] == got[1]).mean() - true) < 5 * (0.25 / 4096) ** 0.5


def test_signature_does_not_depend_on_the_batch():
    bags = [neardup.shingles(normalised(r[1])) for r in varied()]
    assert (neardup.signatures(bags)[5:9] == neardup.signatures(bags[5:9])).all()
    assert not neardup.signatures([neardup.shingles([])]).any()


@pytest.mark.parametrize("block", [neardup.BLOCK, 3])
def test_classes_are_those_of_all_pairs(documents, block, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = varied() + [(r[0], r[1]) for r in ODD]
    found = neardup.classes(documents(rows)).collect()
    assert sorted(repr(tuple(r)) for r in found) == plain_classes(rows)


def test_classes_that_meet_away_from_the_smallest_id(documents):
    """Texts that all differ from the first by much, and from each other step by step."""
    pick = random.Random(11)
    base = [f"w{i}" for i in range(80)]
    rows = [(1, " ".join(base))]
    for key in range(2, 40):
        text = list(base)
        for i in range(pick.choice([1, 2, 3])):
            text[(key * 2 + 7 * i) % 80] = f"n{key // 3}x{i}"
        rows.append((key, " ".join(text)))
    found = neardup.classes(documents(rows)).collect()
    assert sorted(repr(tuple(r)) for r in found) == plain_classes(rows)


def test_one_document_of_each_class_stays(documents):
    rows = varied(seed=9)
    docs = documents(rows)
    kept = neardup.unique(docs)
    assert kept.columns == docs.columns
    left = [r["doc_id"] for r in kept.collect()]
    of = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    assert sorted(of[k] for k in left) == sorted(set(of.values()))


def test_empty_table(documents):
    none = documents(ODD).filter("false")
    assert neardup.classes(none).count() == 0
    assert neardup.unique(none).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["id"]: r["comp"] for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_a_large_class_is_sent_once_to_the_few_others_of_its_bucket(spark, monkeypatch):
    """Bodies are sent about as often as there are texts, not as there are pairs of blocks."""
    members = spark.range(5010).selectExpr("7L AS bucket", "id", "100 AS size", "0L AS pivot", "5010L AS n", "1L AS bytes")
    comps = spark.range(5000).selectExpr("id", "0L AS comp")
    rows = neardup._dealt(members, comps)
    assert rows.count() == 5000 + 10 * 6
    # Every two texts of different classes meet in a pair of blocks, once.
    monkeypatch.setattr(neardup, "BLOCK", 3)
    few = members.filter("id >= 4980")
    met = {}
    for r in neardup._dealt(few, comps).collect():
        met.setdefault((r.i, r.j), []).append(r)
    pairs = [tuple(sorted((x.id, y.id))) for rows in met.values() for n, x in enumerate(rows) for y in rows[:n]
             if x.comp != y.comp and (x.i == x.j or x.own != y.own)]
    assert len(pairs) == len(set(pairs)) == 20 * 10 + 45
