"""Quality: ordinal cumulative-link regression on graded ratings over hashed text.

``P(grade <= k) = sigmoid(threshold_k - w . x)``: the weights of the hashed text are shared by all
grades, the thresholds are ordered by construction. From them follow an expected grade and the
probability of reaching a grade, by which documents are selected.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cauce.llm.ngrams import SAMPLE, features, held_out, learning_rows, per_document
from cauce.llm.registry import query, table
from cauce.llm.words import slices

BITS = 18
EPOCHS = 3
RATE, L2 = 0.5, 1e-5
#: Grades of the given labels: 0 poor, 1 sound but toxic, 2 sound and clean.
GRADES = 3
#: A document is selected if it reaches this grade with this probability.
KEEP_GRADE, KEEP_PROBABILITY = 1, 0.4


class Ordinal(NamedTuple):
    """Shared weights by feature number and the ordered thresholds between the grades."""

    weights: dict[int, float]
    thresholds: list[float]


def rating(quality: Column, toxic: Column) -> Column:
    """The grade of a labelled document; NULL where a label is NULL or neither 0 nor 1."""
    known = quality.isin(0, 1) & toxic.isin(0, 1)
    return F.when(known, F.when(quality == 0, 0).when(toxic == 1, 1).otherwise(2))


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def _inputs(column: pa.Array, n: int, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of each text, in their own case and with runs of symbols, as damped counts of unit length."""
    sets = per_document(*features(column, bits, symbols=True, lower=False), n, bits)
    damped = ((at, np.log1p(times)) for at, times in sets)
    return [(at, x / max(1e-9, np.sqrt((x * x).sum()))) for at, x in damped]


def _learn(bits: int, epochs: int, grades: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for part in slices(batches, "text"):
            rows += _inputs(part.column("text"), part.num_rows, bits)
            labels += part.column("label").to_pylist()
        if not rows:
            return
        w, seen = np.zeros(1 << bits), np.full(1 << bits, 1e-8)
        share = np.cumsum(np.bincount(np.array(labels, int), minlength=grades) + 1.0)[:-1] / (len(labels) + grades)
        first = np.log(share / (1 - share))
        # thresholds are the first one and positive steps, so no update can disorder them
        free = np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-3))])
        free_seen = np.full(len(free), 1e-8)
        for _ in range(epochs):
            for (at, x), label in zip(rows, labels):
                y = int(label)
                cuts = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
                score = (x * w[at]).sum()
                upper = _sigmoid(cuts[y] - score) if y < grades - 1 else 1.0
                lower = _sigmoid(cuts[y - 1] - score) if y else 0.0
                p = max(upper - lower, 1e-9)
                up, low = upper * (1 - upper) / p, lower * (1 - lower) / p
                slope = x * (up - low) + L2 * w[at]  # of the loss by each shared weight
                seen[at] += slope * slope
                w[at] -= RATE * slope / np.sqrt(seen[at])
                by_cut = np.zeros(grades - 1)
                if y < grades - 1:
                    by_cut[y] -= up
                if y:
                    by_cut[y - 1] += low
                step = np.concatenate([[by_cut.sum()], np.cumsum(by_cut[::-1])[::-1][1:] * np.exp(free[1:])])
                free_seen += step * step
                free -= 0.1 * step / np.sqrt(free_seen)
        cuts = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([at, -1 - np.arange(len(cuts))])), pa.array(np.concatenate([w[at], cuts]))], ["feature", "weight"])

    return run


def fit_quality(docs: DataFrame, labels: DataFrame, grade: Column, grades: int = GRADES, bits: int = BITS,
                epochs: int = EPOCHS, sample: int = SAMPLE) -> Ordinal:
    """Fit on at most ``sample`` rated documents that are not held out; no such rows give an empty model.

    At most ``2 ** bits`` weights come to the driver.
    """
    rows = learning_rows(docs, labels, grade, sample)
    found = {r["feature"]: r["weight"] for r in rows.mapInArrow(_learn(bits, epochs, grades), "feature long, weight double").collect()}
    return Ordinal({k: v for k, v in found.items() if k >= 0}, [found[k] for k in sorted((k for k in found if k < 0), reverse=True)])


def score_quality(docs: DataFrame, model: Ordinal, text: str = "text", out: str = "quality", bits: int = BITS) -> DataFrame:
    """Add the struct ``out``: ``expected_grade`` and ``reaches``, for each grade from 1 on the
    probability of that grade or a higher one.

    Whole texts are scored. NULL and empty texts have no features; the thresholds alone decide.
    Without a model ``expected_grade`` is NULL and ``reaches`` empty. Other columns stay, one named
    ``out`` is replaced; repeated rows score alike.
    """
    kept = [c for c in docs.columns if c != out]
    kind = pa.struct([("expected_grade", pa.float64()), ("reaches", pa.list_(pa.float64()))])
    schema = docs.select(*kept).withColumn(
        out, F.lit(None).cast("struct<expected_grade: double, reaches: array<double>>")).schema
    at = np.array(sorted(model.weights), dtype=np.int64)
    value = np.array([model.weights[int(k)] for k in at], dtype=np.float32)
    cuts = np.array(model.thresholds)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.zeros(1 << bits)
        w[at] = value
        for part in slices(batches, text):
            score = np.array([(x * w[s]).sum() for s, x in _inputs(part.column(text), part.num_rows, bits)])
            reach = 1 - _sigmoid(cuts[None, :] - score[:, None])
            result = [{"expected_grade": float(r.sum()) if len(cuts) else None, "reaches": r.tolist()} for r in reach]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], pa.array(result, kind)], [*kept, out])

    return docs.select(*kept).mapInArrow(run, schema)


@query("op2_quality_model")
def op2_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), rating(F.col("quality"), F.col("toxic")))
    reach = F.get("quality.reaches", F.lit(KEEP_GRADE - 1))
    return score_quality(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality.expected_grade").alias("expected_grade"),
        F.coalesce(reach, F.lit(1.0)).alias("score"), (F.coalesce(reach, F.lit(1.0)) >= KEEP_PROBABILITY).cast("int").alias("predicted"),
        (F.coalesce(reach, F.lit(1.0)) >= KEEP_PROBABILITY).alias("kept"))
