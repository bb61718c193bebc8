import hashlib
import random

import numpy as np
import pytest
from corpus_rows import ODD

from paywarden.llm import repeats


def plain_starts(strings, width):
    seen = {}
    for s in strings:
        for i in range(len(s) - width + 1):
            seen[s[i:i + width]] = seen.get(s[i:i + width], 0) + 1
    return [np.array([seen[s[i:i + width]] > 1 for i in range(len(s) - width + 1)], bool) for s in strings]


def test_transform_finds_all_repeats():
    for seed in range(150):
        pick = random.Random(seed)
        width = pick.choice([1, 2, 3, 5, 8, 13])
        signs = pick.choice([b"a", b"ab", b"abc", bytes(range(256))])
        strings = [bytes(pick.choice(signs) for _ in range(pick.randrange(60)))
                   for _ in range(pick.randrange(1, 8))]
        strings += [strings[0][3:] + strings[-1]] * pick.randrange(2)
        for a, b in zip(repeats.repeated_starts(strings, width), plain_starts(strings, width)):
            assert (a == b).all()


def test_segments_cover_each_window_once(monkeypatch):
    pick = random.Random(1)
    for size in (0, 199, 200, 201, 1000, 5000):
        raw = bytes(pick.choice(b"abcd") for _ in range(size))
        whole = repeats.segments(raw)
        assert [w for _, _, f, l in whole for w in range(f, l + 1)] == list(range(max(0, size - 199)))
        monkeypatch.setattr(repeats, "PART", 700)
        parts = repeats.segments(raw)
        assert [w for _, _, f, l in parts for w in range(f, l + 1)] == list(range(max(0, size - 199)))
        place = {w: (a, p) for a, p, f, l in whole for w in range(f, l + 1)}
        assert place == {w: (a, p) for a, p, f, l in parts for w in range(f, l + 1)}
        monkeypatch.undo()


def plain(rows, width=repeats.WIDTH):
    raws = [(r[1] or "").encode() for r in rows]
    out = []
    for row, raw, starts in zip(rows, raws, plain_starts(raws, width)):
        covered = np.zeros(len(raw) + 1, bool)
        for i in np.flatnonzero(starts):
            covered[i:i + width] = True
        rest = bytes(np.frombuffer(raw, np.uint8)[~covered[:-1]])
        runs = int((np.diff(covered.astype(int)) == -1).sum())
        out.append((row[0], len(raw), len(raw) - len(rest), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(map(repr, out))


def texts(seed=2):
    pick = random.Random(seed)

    def fill(n):
        return "".join(pick.choice("abcdefghijé \n") for _ in range(n))

    passage, other = fill(450), fill(230)
    rows = [(i, fill(pick.randrange(300)) + passage + fill(pick.randrange(300))) for i in range(100, 125)]
    rows += [(200, passage[100:299]), (201, passage[100:300]), (202, passage + other), (203, other + passage)]
    rows += [(204, passage[:220] + "#" + passage[221:]), (205, fill(700)), (206, "ab" * 300), (207, "xab" * 90)]
    rows += [(208, other), (209, other), (210, passage * 3), (211, "é" * 150), (212, "é" * 150 + "x")]
    return rows


@pytest.mark.parametrize("group", [repeats.GROUP, 3])
def test_removal_equals_brute_force(documents, group):
    rows = texts() + [r for r in ODD if not r[1] or len(r[1]) < 1000]
    found = repeats.remove(documents(rows), group=group).collect()
    assert sorted(repr(tuple(r)) for r in found) == plain(rows)


def test_very_long_texts(documents):
    found = {r["doc_id"]: r for r in repeats.remove(documents(ODD)).collect()}
    assert found[6]["n_removed"] == found[6]["n_bytes"] == 150_000
    assert found[7]["n_removed"] == 50_000 and found[7]["n_spans"] == 1


def test_kept_bytes_and_empty_table(documents):
    docs = documents(texts())
    rows = repeats.remove(docs, keep_bytes=True).collect()
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in rows)
    assert repeats.remove(docs.filter("false")).count() == 0
