import random
import zlib

import numpy as np
from corpus_rows import ODD

from paywarden.llm import quality


def texts(seed=1, n=400):
    pick = random.Random(seed)
    rows, labels = [], []
    for key in range(n):
        good = pick.random() < 0.7
        words = [pick.choice("abcdefgh") * pick.randrange(1, 9) + str(pick.randrange(50)) * (not good)
                 for _ in range(pick.randrange(30, 90))]
        text = " ".join(words).capitalize() + "." if good else " | ".join([words[0]] * 20 + words)
        rows.append((key, text))
        labels.append((key, int(good)))
    return rows, labels


def test_scores_equal_a_plain_discriminant(documents, spark):
    rows, known = texts()
    labels = spark.createDataFrame(known, "doc_id long, quality int")
    found = {r["doc_id"]: r for r in quality.classify(documents(rows), labels).collect()}
    held = {k for k, _ in rows if zlib.crc32(str(k).encode()) % 4 == 2}
    x = np.array([quality.statistics(t) for _, t in rows])
    y = np.array([v for _, v in known])
    learn = np.array([k not in held for k, _ in rows])
    logs = []
    parts = [x[(y == k) & learn] for k in (0, 1)]
    common = sum(len(p) * p.var(axis=0) for p in parts) / learn.sum()
    for p in parts:
        cov = (1 - quality.SHRINKAGE) * np.cov(p.T, bias=True)
        cov += quality.SHRINKAGE * np.diag(common + quality.RIDGE) + quality.RIDGE * np.eye(x.shape[1])
        away = x - p.mean(axis=0)
        logs.append(np.log(len(p) / learn.sum()) - 0.5 * np.linalg.slogdet(cov)[1]
                    - 0.5 * (away @ np.linalg.inv(cov) * away).sum(axis=1))
    expected = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
    for (key, _), score in zip(rows, expected):
        assert abs(found[key]["score"] - score) < 1e-6
        assert found[key]["held_out"] == (key in held)
        assert found[key]["predicted"] == (found[key]["score"] >= 0.7)
    right = [found[k]["predicted"] == v for k, v in known if k in held]
    assert np.mean(right) > 0.95


def test_held_out_labels_are_not_learnt(documents, spark):
    rows, known = texts(n=120)
    flipped = [(k, 1 - v if zlib.crc32(str(k).encode()) % 4 == 2 else v) for k, v in known]
    scores = [sorted((r["doc_id"], r["score"]) for r in quality.classify(
        documents(rows), spark.createDataFrame(of, "doc_id long, quality int")).collect())
        for of in (known, flipped)]
    assert np.allclose([s for _, s in scores[0]], [s for _, s in scores[1]])


def test_odd_rows_and_few_labels(documents, spark):
    for known in ([], [(1, 1)], [(1, 0), (4, 1), (4, 0), (5, None), (99, 1)]):
        labels = spark.createDataFrame(known, "doc_id long, quality int")
        found = quality.classify(documents(ODD), labels).collect()
        assert len(found) == len(ODD)
        assert all(0 <= r["score"] <= 1 for r in found)
    assert quality.classify(documents(ODD).filter("false"), labels).count() == 0


def test_documents_without_label_are_scored(documents, spark):
    rows, known = texts(n=100)
    labels = spark.createDataFrame(known[:60], "doc_id long, quality int")
    assert quality.classify(documents(rows), labels).count() == 100
