"""Quality classifier: naive-Bayes support vectors.

A text's features are indicators of hashed n-grams: its words and word pairs, the shapes of words (runs of capitals,
letters and digits as one sign, other signs as they are) singly, in pairs and threes, and how often a word equals the
one before it. Each is scaled by the class log-count ratio of naive Bayes; a linear hinge-loss model is fitted on that
by dual coordinate descent, pulled towards the mean weight as naive Bayes is, and its margins are made probabilities by
a logistic curve fitted on a fifth of the sample that neither the ratios nor the weights have seen.

It is fitted on at most SAMPLE labelled texts (the least by a hash of the id) outside the held-out fold
(crc32(doc_id) mod 5 = 0), and on at most SAMPLE_FEATURES features: texts that would pass that, in the same order, are
left out of the fit. Nothing else reaches the driver, and only the weights, 2^BITS numbers, are broadcast. All texts are
scored whole.

Defined results: null and empty texts have no features and the score of the intercept. Null labels are ignored; of
several labels of an id the lowest counts, of several texts of an id the one of the least hash. Without labels of both
classes all scores are the share of label 1, or 0.5. A null doc_id is not held out. Repeated rows are scored each. Texts
and words of any length are taken whole, in time linear in them. Equal texts have equal scores. Other columns are
ignored, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomlink.llm.common import U64, WordHashes, documents, mix, stored

BITS = 18
#: The bounds of the training sample: texts, and features of all of them (four bytes each).
SAMPLE, SAMPLE_FEATURES = 8192, 1 << 25
THRESHOLD = 0.3
ALPHA, BETA, COST, EPOCHS = 1.0, 0.25, 1.0, 12
_SHAPE = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256)
)


class ShapeHashes(dict):
    """Hash of each word's shape."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        shape, last = bytearray(), 0
        for c in word.translate(_SHAPE):
            if c != last or c not in b"aA0":
                shape.append(c)
            last = c
        self[word] = h = xxhash.xxh3_64_intdigest(bytes(shape), 1)
        return h


def features(text: str | None, hashes: WordHashes, shapes: ShapeHashes) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.int32)
    h = hashes.of(words)
    s = np.fromiter(map(shapes.__getitem__, words), U64, len(words))
    parts = [h, s]
    for x, salt in ((h, 3), (s, 5)):
        if len(x) > 1:
            parts.append(mix(x[:-1] * U64(0x9E3779B97F4A7C15) + x[1:] + U64(salt)))
    if len(s) > 2:
        parts.append(mix(mix(s[:-2] + U64(7)) * U64(3) + mix(s[1:-1]) * U64(5) + s[2:]))
    same = int((h[1:] == h[:-1]).sum())
    parts.append(mix(np.arange(same.bit_length() + 1, dtype=U64) + U64(1 << 40)))
    return np.unique(np.concatenate(parts) >> U64(64 - BITS)).astype(np.int32)


@dataclass
class Model:
    weights: np.ndarray
    intercept: float
    slope: float
    offset: float

    def score(self, ids: np.ndarray) -> float:
        margin = self.intercept + (float(self.weights[ids].sum()) / np.sqrt(len(ids)) if len(ids) else 0.0)
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def hinge_dual(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, n_features: int, cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise |w|^2 / 2 + cost * hinge losses, by dual coordinate descent in seeded order."""
    w, b, a = np.zeros(n_features), 0.0, np.zeros(len(rows))
    norms = np.array([float((v * v).sum()) + 1 for v in values])
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            g = y[i] * (float(values[i] @ w[rows[i]]) + b) - 1
            new = min(max(a[i] - g / norms[i], 0.0), cost)
            step = new - a[i]
            if step:
                a[i] = new
                w[rows[i]] += step * y[i] * values[i]
                b += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-4 * cost:
            break
    return w, b


def platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve for label 1, by Newton's method on smoothed targets."""
    n1, n0 = float((y > 0).sum()), float((y <= 0).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (target - p))
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """The model of these feature lists with labels 0 and 1; rows in a fixed order."""
    n = 1 << BITS
    y = np.where(np.asarray(labels) > 0, 1.0, -1.0)
    if len(set(y.tolist())) < 2:
        share = float(np.clip((y > 0).mean(), 0.01, 0.99)) if len(y) else 0.5
        return Model(np.zeros(n), 0.0, 0.0, float(np.log(share / (1 - share))))
    held = np.arange(len(rows)) % 5 == 0
    if len(set(y[held].tolist())) < 2 or len(set(y[~held].tolist())) < 2:
        held = np.zeros(len(rows), bool)
    train = np.flatnonzero(~held)
    counts = np.full((2, n), ALPHA)
    for i in train:
        counts[int(y[i] > 0), rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    values = [ratio[rows[i]] / np.sqrt(max(len(rows[i]), 1)) for i in train]
    w, b = hinge_dual([rows[i] for i in train], values, y[train], n)
    mean = np.abs(w).sum() / n
    w = (1 - BETA) * w + BETA * mean
    model = Model(ratio * w, b, 1.0, 0.0)
    check = np.flatnonzero(held) if held.any() else train
    margins = np.array([b + (float(model.weights[rows[i]].sum()) / np.sqrt(len(rows[i])) if len(rows[i]) else 0.0) for i in check])
    model.slope, model.offset = platt(margins, y[check])
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labels (doc_id, quality) outside the held-out fold."""
    known = labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    told = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most `sample` rows are broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, shapes = WordHashes(), ShapeHashes()
        for batch in batches:
            made = [features(t, hashes, shapes) for t in batch.column(1).to_pylist()]
            keys = [xxhash.xxh3_64_intdigest(x) >> 1 for x in made]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2).cast(pa.int32()), pa.array(keys, pa.int64()), pa.array([x.tobytes() for x in made], pa.binary())], ["doc_id", "quality", "key", "ids"])

    made = stored(told.mapInArrow(run, "doc_id long, quality int, key long, ids binary"), "features")
    one = made.groupBy("doc_id", "quality").agg(F.min(F.struct("key", F.octet_length("ids").alias("n"))).alias("x")).select("doc_id", "quality", "x.key", F.col("x.n").alias("n"))
    place = F.sum("n").over(W.orderBy(F.xxhash64("doc_id"), "doc_id"))  # of at most `sample` rows
    one = stored(one.withColumn("used", place).where(F.col("used") <= 4 * SAMPLE_FEATURES).select("doc_id", "key"), "sample")
    rows = made.join(F.broadcast(one), ["doc_id", "key"]).dropDuplicates(["doc_id", "key"]).select("doc_id", "quality", "ids").collect()
    rows.sort(key=lambda r: (xxhash.xxh3_64_intdigest(str(r["doc_id"]).encode()), r["doc_id"]))
    return fit([np.frombuffer(r["ids"], np.int32) for r in rows], np.array([r["quality"] for r in rows]))


def held_out(c):
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, shapes = WordHashes(), ShapeHashes()
        for batch in batches:
            own = [shared.value.score(features(t, hashes, shapes)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())]))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = classify(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op7_quality_classifier": op7_quality_classifier}
SQL: dict[str, str] = {}
