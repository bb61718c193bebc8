"""Quality classifier: regularised quadratic discriminant (operator 4).

Each text becomes a vector of transformed statistics, computed over the whole text in
one pass. Spark sums vectors and their products by class over all training labels; the
class means and covariances follow from the sums, so nothing but sums reaches the
driver. Covariances are shrunk towards their common diagonal. A score is the logistic
function of the difference of two Mahalanobis log densities, each from a Cholesky factor
computed once, plus the log prior odds.

NULL and empty texts have the vector of no words and a score like any other. Documents
without a label are scored but not learnt from; several labels of a document count as
their largest, a NULL label as none. With fewer than two classes the score is the share
of label 1, smoothed; an empty table has no rows. Repeated rows give repeated rows.
Only the texts enter a score.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paywarden.llm.common import columns, stash

FEATURES = ("length", "word_length", "distinct", "adjacent", "top_word", "upper", "digits",
            "marks", "symbols", "stops", "lines", "same_lines")
SHRINKAGE = 0.2
RIDGE = 1e-3
THRESHOLD = 0.7

_SPACE = b" \t\n\r\x0b\x0c"
_KINDS = np.zeros((256, 5))
_KINDS[65:91, 0] = 1
_KINDS[48:58, 1] = 1
for _b in range(33, 127):
    if not chr(_b).isalnum():
        _KINDS[_b, 2] = 1
for _b in b"#*$%&|<>{}[]\\^~_=+@":
    _KINDS[_b, 3] = 1
for _b in b".,;:!?":
    _KINDS[_b, 4] = 1


def _share(part: float, whole: float) -> float:
    """Log odds of a share, pulled towards even odds as if two cases more were seen."""
    return float(np.log((part + 0.5) / (whole - part + 1.5)))


def statistics(text: str | None) -> list[float]:
    """The vector of a text, in the order of FEATURES."""
    raw = (text or "").encode()
    words = raw.split()
    n = len(words)
    size = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _KINDS
    distinct = len(set(words))
    adjacent = sum(map(operator.eq, words, words[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    longest = max(map(len, lines), default=0)
    letters = size - raw.count(b" ")
    return [
        float(np.log1p(n)),
        float(np.log1p(letters / n if n else 0)),
        _share(n - distinct, n) - 0.5 * float(np.log1p(n)),
        _share(adjacent, n),
        float(np.log1p(longest)),
        _share(counts[0], size),
        _share(counts[1], size),
        _share(counts[2], size),
        _share(counts[3], size),
        _share(counts[4], size),
        float(np.log1p(len(lines))),
        _share(len(lines) - len(set(lines)), len(lines)),
    ]


def featurised(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and vector of each document."""
    schema = T.StructType([docs.schema[key], T.StructField("vector", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for batch in batches:
            made = [statistics(x) for (xs,) in columns(batch, text) for x in xs]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made, pa.list_(pa.float64()))], names=schema.names)

    return docs.select(key, text).mapInArrow(run, schema)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and offsets of the two classes, or a constant score."""

    means: np.ndarray | None
    factors: np.ndarray | None
    offsets: np.ndarray | None
    constant: float

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(vectors), self.constant)
        logs = [self.offsets[k] - 0.5 * np.square(
            (vectors - self.means[k]) @ self.factors[k].T).sum(axis=1) for k in (0, 1)]
        odds = np.clip(logs[1] - logs[0], -700, 700)
        return 1 / (1 + np.exp(-odds))


def fit(vectors: DataFrame, shrinkage: float = SHRINKAGE, label: str = "label") -> Discriminant:
    """A discriminant from rows of ``vector`` and a 0/1 label."""
    d = len(FEATURES)
    x = [F.col("vector")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    rows = vectors.filter(F.col(label).isin(0, 1)).groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.array(*(F.sum(v) for v in x)).alias("sums"),
        F.array(*(F.sum(x[i] * x[j]) for i, j in pairs)).alias("products")).collect()
    by = {r[label]: r for r in rows}
    n = [by[k]["n"] if k in by else 0 for k in (0, 1)]
    constant = (n[1] + 1) / (sum(n) + 2)
    if min(n) < 2:
        return Discriminant(None, None, None, constant)
    means, covariances = [], []
    for k in (0, 1):
        mean = np.array(by[k]["sums"]) / n[k]
        second = np.zeros((d, d))
        for (i, j), value in zip(pairs, by[k]["products"]):
            second[i, j] = second[j, i] = value / n[k]
        means.append(mean)
        covariances.append(second - np.outer(mean, mean))
    common = (n[0] * np.diag(covariances[0]) + n[1] * np.diag(covariances[1])) / sum(n)
    target = np.diag(np.maximum(common, 0) + RIDGE)
    factors, offsets = [], []
    for k in (0, 1):
        lower = np.linalg.cholesky((1 - shrinkage) * covariances[k] + shrinkage * target
                                   + RIDGE * np.eye(d))
        factors.append(np.linalg.inv(lower))
        offsets.append(np.log(n[k] / sum(n)) - np.log(np.diag(lower)).sum())
    return Discriminant(np.array(means), np.array(factors), np.array(offsets), constant)


def score(vectors: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """All columns but the vector, with score and predicted."""
    kept = [c for c in vectors.columns if c != "vector"]
    schema = T.StructType([*(vectors.schema[c] for c in kept),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    d = len(FEATURES)

    def run(batches):
        for batch in batches:
            flat = batch.column(batch.schema.get_field_index("vector")).flatten()
            scores = model.scores(flat.to_numpy(zero_copy_only=False).reshape(-1, d))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept),
                 pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=schema.names)

    return vectors.mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    """Documents whose labels are never learnt."""
    text = F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % 4 == 2


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
             label: str = "quality", shrinkage: float = SHRINKAGE) -> DataFrame:
    """Key, held_out, score and predicted of every document."""
    vectors = stash(featurised(docs, key, text), "vectors")
    known = labels.filter(~held_out(key)).groupBy(key).agg(F.max(label).alias("label"))
    model = fit(vectors.join(known, key), shrinkage)
    return score(vectors.withColumn("held_out", held_out(key)), model).select(
        key, "held_out", "score", "predicted")
