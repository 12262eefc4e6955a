"""Document quality by Bradley-Terry ranking of preference pairs.

A pair says that one document is better than another; the logistic loss on the
difference of their features gives weights, and a document's score is the
weighted sum of its own features.  The cut is the quantile of the training
scores at the share of worse documents; scores are moved and scaled so that the
cut lies at the threshold and the slope follows the pairs' odds.

Defined results: NULL and empty texts are scored from their zero features;
rows keep their number; without labels of both kinds every score is 1.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.llm.common import bounded_batches, held_out, labelled_sample, with_text_column

#: At most this many labelled documents are learned from, each worse one in this many pairs.
SAMPLE_DOCUMENTS = 20_000
PAIRS_EACH = 10
THRESHOLD = 0.3
RIDGE = 1.0
CLIP = 6.0

LETTERS = re.compile(r"[^\W\d_]+")
SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()\-]")
DIGITS = re.compile(r"\d")
ADDRESS = re.compile(r"https?:|www\.|@\w")
ENDINGS = re.compile(r"[.!?](?:\s|$)")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def features(text: str) -> list[float]:
    """Shape of the text: lengths, classes of characters, repetition of words and lines."""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * 24
    lines = [x for x in text.split("\n") if x.strip()]
    counts, line_counts = Counter(words), Counter(lines)
    pairs = len(set(zip(words, words[1:], strict=False)))
    letters = LETTERS.findall(text)
    symbols = SYMBOLS.findall(text)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=n)
    repeated = sum(c - 1 for c in line_counts.values())
    repeated_chars = sum((c - 1) * len(x) for x, c in line_counts.items())
    ends = len(ENDINGS.findall(text))
    return [
        float(np.log1p(n)),
        float(np.log1p(len(lines))),
        float(sizes.mean()),
        float(sizes.std()),
        float(np.log1p(sizes.max())),
        len(symbols) / chars,
        float(np.log1p(100 * len(symbols) / n)),
        len(set(symbols)) / 10,
        len(DIGITS.findall(text)) / chars,
        sum(map(len, letters)) / chars,
        len(letters) / n,
        len(CAPITALS.findall(text)) / chars,
        len(counts) / n,
        float(np.log(len(counts)) / np.log(n + 1)),
        max(counts.values()) / n,
        (n - 1 - pairs) / n,
        repeated / len(lines),
        repeated_chars / chars,
        float(np.log1p(ends)) - float(np.log1p(n)),
        ends / n,
        float(np.log1p(len(ADDRESS.findall(text)))),
        (chars - int(sizes.sum())) / chars,
        text.count(",") / n,
        sum(1 for x in lines if not x.rstrip().endswith((".", "!", "?", ":", '"', "。"))) / len(lines),
    ]


@dataclass
class Model:
    """Scaling of the features, their weights, and the map from raw to final scores."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float
    slope: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        raw = self._wide(rows) @ self.weight
        offset = np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(offset + self.slope * (raw - self.cut), -500, 500)))

    def _wide(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -CLIP, CLIP)
        return np.hstack([z, z * z])


def train(rows: np.ndarray, label: np.ndarray, seed: int = 0) -> Model:
    """Bradley-Terry weights by Newton steps on pairs of a better and a worse document."""
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    model = Model(mean, scale, np.zeros(2 * rows.shape[1]), -1.0, 100.0)
    better, worse = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(better) or not len(worse):
        return model
    wide = model._wide(rows)
    rng = np.random.default_rng(seed)
    few, many = sorted((better, worse), key=len)
    few = np.concatenate([np.repeat(few, PAIRS_EACH), rng.choice(few, len(many))])
    many = np.concatenate([rng.choice(many, len(few) - len(many)), many])
    first, second = (few, many) if label[few[0]] == 1 else (many, few)
    difference = wide[first] - wide[second]
    weight = np.zeros(wide.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(difference @ weight))
        slope = difference.T @ p - RIDGE * weight
        bend = (difference * (p * (1 - p))[:, None]).T @ difference + RIDGE * np.eye(len(weight))
        step = np.linalg.solve(bend, slope)
        weight += step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    raw = np.sort(wide @ weight)
    place = len(worse)
    model.weight, model.cut, model.slope = weight, float(raw[place - 1 : place + 1].mean()), 1.0
    return model


def _feature_batches(batches):
    for batch in batches:
        if batch.num_rows:
            rows = [features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(rows, pa.list_(pa.float64()))],
                names=["doc_id", "label", "features"],
            )


def fit(
    documents: DataFrame, labels: DataFrame, label: str = "quality", sample_documents: int = SAMPLE_DOCUMENTS
) -> Model:
    """A ranking learned from at most ``sample_documents`` labelled texts outside the held-out fold.

    The driver receives the few dozen features of each, not the texts.
    """
    bounded_batches(documents.sparkSession)
    sample = labelled_sample(documents, labels, label, sample_documents)
    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = (
        sample.select("text", "doc_id", "label")
        .mapInArrow(_feature_batches, f"doc_id {kind}, label int, features array<double>")
        .toPandas()
        .sort_values(["doc_id", "label"], kind="stable")
    )
    wide = np.array(rows["features"].tolist()) if len(rows) else np.zeros((1, len(features(""))))
    return train(wide, rows["label"].to_numpy())


def with_score(df: DataFrame, model: Model, out: str, text: str = "text") -> DataFrame:
    """All columns plus the score."""

    def make():
        return lambda texts: pa.array(model.score(np.array([features(t) for t in texts])), pa.float64())

    return with_text_column(df, out, DoubleType(), make, text)


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted): predicted is 1 from the threshold on."""
    slim = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    return with_score(slim, model, "score").select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
