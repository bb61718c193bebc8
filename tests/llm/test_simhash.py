import random

import numpy as np
import pytest
import xxhash
from corpus_rows import ODD

from paywarden.llm import simhash


def plain_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace(
        "\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows):
    """Every pair compared; rows of (key, text)."""
    prints = [plain_print(t) for _, t in rows]
    comp = list(range(len(rows)))

    def top(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                comp[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(top(i), []).append(key)
    first = {c: min((k for k in keys if k is not None), default=None) for c, keys in least.items()}
    return sorted(repr((key, f"{p:016x}", first[top(i)])) for i, ((key, _), p) in enumerate(zip(rows, prints)))


def found(docs):
    return sorted(repr(tuple(r)) for r in simhash.classes(docs).collect())


def test_every_link_between_texts_with_few_changes(spark, documents):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 60))] for _ in range(25)]
    rows = []
    for n in range(300):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((rng.randint(0, 10 ** 6), " ".join(text)))
    rows += [(r[0], r[1]) for r in ODD if len(r[1] or "") < 1000]
    assert found(documents(rows)) == plain(rows)


def test_odd_rows_and_an_empty_table(spark, documents):
    assert found(documents(ODD)) == plain([(r[0], r[1]) for r in ODD])
    assert found(documents([]).filter("false")) == []
    assert found(documents([(None, ""), (None, None)])) == ["(None, '0000000000000000', None)"] * 2


def test_a_long_text_is_read_in_pieces(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    monkeypatch.setattr(simhash, "PIECE", 64)
    assert simhash.fingerprint(text) == plain_print(text)


def near(prints):
    return {(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 2}


def clouds(rng, size):
    """Numbers at random, and some with many others a few bits away."""
    out = {rng.getrandbits(64) for _ in range(size)}
    for _ in range(3):
        middle = rng.getrandbits(64)
        for _ in range(size // 3):
            out.add(middle ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(0, 4))}))
    return sorted(out)


@pytest.mark.parametrize("compared", [simhash.COMPARED, 0])
@pytest.mark.parametrize("leaf", [2, 64])
def test_trees_lose_no_pair(monkeypatch, leaf, compared):
    """Also where no point parts the numbers and their neighbours are looked up."""
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "COMPARED", compared)
    prints = clouds(random.Random(leaf), 240)
    array = np.array(prints, np.uint64)
    got = {(int(x), int(y)) for a, b in simhash.pairs(array, np.ones(len(array), bool)) for x, y in zip(a, b)}
    assert {(max(p), min(p)) for p in got} == near(prints)


@pytest.mark.parametrize("shards", [1, 7, 30])
def test_shards_lose_no_pair(shards):
    prints = clouds(random.Random(shards), 400)
    array = np.array(prints, np.uint64)
    tree, number = simhash.planted(array[::2], shards)
    assert number == 1 or shards > 1
    met, homes = set(), []
    for shard, part, home in simhash.dealt(tree, array, np.ones(len(array), bool)):
        assert 0 <= shard < number
        homes += part[home].tolist()
        for a, b in simhash.pairs(part, home):
            met |= {(max(x, y), min(x, y)) for x, y in zip(a.tolist(), b.tolist())}
    assert sorted(homes) == prints
    assert met == near(prints)


def test_links_handed_on_are_few_and_keep_groups_together():
    prints = np.array(clouds(random.Random(9), 300), np.uint64)
    a, b = simhash.spanning(prints, simhash.pairs(prints, np.ones(len(prints), bool)))
    assert len(a) < len(prints)

    def groups(links):
        comp = {int(p): int(p) for p in prints}
        for x, y in links:
            old, new = comp[int(x)], comp[int(y)]
            comp = {k: new if v == old else v for k, v in comp.items()}
        return sorted(sorted(k for k in comp if comp[k] == c) for c in set(comp.values()))

    assert groups(zip(a, b)) == groups(near(prints.tolist()))
