"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and the L1 term keeps all weights at zero that the
labels do not insist on, so the model that goes to the scoring tasks is a short list.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cauce.llm.ngrams import SAMPLE, features, held_out, learning_rows, per_document
from cauce.llm.registry import query, table
from cauce.llm.words import distinct, slices

BITS = 20
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 8.0, 0.1
#: Score where there was nothing to learn from.
NO_MODEL = 0.0


class Ftrl:
    """State per coordinate: ``z``, the shifted gradient sum, and ``n``, the sum of squared gradients."""

    def __init__(self, size: int, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)  # the last is the intercept

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        penalty = np.where(at == len(self.z) - 1, 0.0, self.l1)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - penalty, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: float) -> None:
        at = np.append(at, len(self.z) - 1)
        w = self.weights(at)
        gradient = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + gradient * gradient


def _learn(bits: int, epochs: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for part in slices(batches, "text"):
            rows += per_document(*features(part.column("text"), bits), part.num_rows, bits)
            labels += part.column("label").to_pylist()
        if not rows:
            return
        model = Ftrl(1 << bits)
        for _ in range(epochs):
            for (at, _), label in zip(rows, labels):
                model.learn(at, label)
        w = model.weights(np.arange(len(model.z)))
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["feature", "weight"])

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", bits: int = BITS,
                 epochs: int = EPOCHS, sample: int = SAMPLE) -> dict[int, float]:
    """Weights by feature number, ``2 ** bits`` being the intercept; empty without labelled rows.

    Learns from at most ``sample`` documents that are not held out. At most ``2 ** bits + 1``
    weights come to the driver, and the L1 term leaves few of them.
    """
    rows = learning_rows(docs, labels, F.col(label).cast("double"), sample).filter("label IN (0, 1)")
    return {r["feature"]: r["weight"] for r in rows.mapInArrow(_learn(bits, epochs), "feature long, weight double").collect()}


def score_toxicity(docs: DataFrame, weights: dict[int, float], text: str = "text", out: str = "score",
                   bits: int = BITS) -> DataFrame:
    """Add ``out``: the probability of the label, from the whole text.

    NULL and empty texts have no features and get the intercept's probability; without a model every
    score is ``NO_MODEL``. Other columns stay, one named ``out`` is replaced; repeated rows score alike.
    """
    kept = [c for c in docs.columns if c != out]
    schema = docs.select(*kept, F.lit(0.0).alias(out)).schema
    bias = weights.get(1 << bits, 0.0)
    at = np.array(sorted(k for k in weights if k < 1 << bits), dtype=np.int64)
    value = np.array([weights[int(k)] for k in at])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << bits, -1, np.int32)  # dense only inside a task
        place[at] = np.arange(len(at))
        for part in slices(batches, text):
            n = part.num_rows
            total = np.full(n, bias)
            number, owner = features(part.column(text), bits)
            held = place[number]
            hit = held >= 0
            if hit.any():
                key = distinct(owner[hit] * len(at) + held[hit])  # a feature counts once a document
                doc, k = np.divmod(key, len(at))
                total += np.bincount(doc, value[k], n)
            score = 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))) if weights else np.full(n, NO_MODEL)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(score)], [*kept, out])

    return docs.select(*kept).mapInArrow(run, schema)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    weights = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, weights).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
