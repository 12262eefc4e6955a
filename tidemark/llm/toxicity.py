"""Toxicity by multiple-instance learning: sentence scores combined by noisy-or.

A document is toxic if any of its sentences is, so its score is one minus the
product of the sentences' chances of being clean.  Only document labels are
given; the logistic sentence model is trained through that product, and then
tells which sentences offend.  The bias counts once for each document, and a
sentence adds what its features give beyond it; a scored sentence less than
``LEAST_CHANCE`` likely to be toxic is no evidence and adds nothing, so that no
length of clean text adds up to a toxic one.  Features are words and beginnings of words,
chosen by how much more often documents of one label have them, counted over the
whole training sample.  Training ends with the same floor that scoring has.

Defined results: NULL and empty texts have no sentence and score 0; rows keep
their number; without labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from tidemark.llm.common import bounded_batches, held_out, labelled_sample, with_text_column
from tidemark.session import cut_lineage

#: At most this many labelled documents are learned from, and this many words.
SAMPLE_DOCUMENTS = 20_000
VOCABULARY = 1_000
#: A feature needs so many documents, and so many standard errors between the labels' shares.
LEAST_DOCUMENTS, LEAST_ERRORS = 8, 6.0
BEGINNINGS = range(3, 9)
CACHED_WORDS = 300_000
THRESHOLD = 0.5
#: A sentence less likely toxic than this is no evidence; noisy-or would add up any number of them.  Of 0, 1, 2, 5,
#: 10 and 20 % the one with the least log loss in four-fold cross-validation within the training folds of sf0.1.
LEAST_CHANCE = 0.1
STEPS, RATE, SHRINK = 400, 0.1, 3e-5

SENTENCE = re.compile(r"[^.!?。！？\n]+")
WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """The word, and its proper beginnings marked by a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if n < len(word))]


class KnownFeatures(dict):
    """word -> numbers of its chosen features; emptied when it has grown to its bound."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = tuple(self.numbers[f] for f in features(word) if f in self.numbers)
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found
        return found

    def sentences(self, text: str) -> tuple[int, list[tuple[int, int, list[int]]]]:
        """Sentences without a chosen feature, and (start, end, features) of each other one."""
        lower = text.lower()
        if len(lower) != len(text):  # a letter whose lower case is longer would shift the spans
            lower = "".join(x if len(x := c.lower()) == 1 else c for c in text)
        plain, found = 0, []
        for match in SENTENCE.finditer(lower):
            own = {f for w in WORD.findall(match[0]) for f in self[w]}
            if own:
                found.append((match.start(), match.end(), sorted(own)))
            else:
                plain += 1
        return plain, found


def gate(bias: float, closed: float = 1.0) -> float:
    """The log odds from which on a sentence counts: the bias if not ``closed``, then up to those of the floor."""
    floor = float(np.log(LEAST_CHANCE / (1 - LEAST_CHANCE))) if LEAST_CHANCE else bias
    return bias + closed * max(0.0, floor - bias)


@dataclass
class Model:
    """Features, their weights and the bias, the log odds of a document or sentence without evidence."""

    words: list[str]
    weights: np.ndarray
    bias: float

    def known(self) -> KnownFeatures:
        return KnownFeatures({w: i for i, w in enumerate(self.words)})

    def score(self, text: str, known: KnownFeatures) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or score of the text, and its offending sentences with their own scores."""
        plain, found = known.sentences(text)
        odds = [(a, b, self.bias + float(self.weights[own].sum())) for a, b, own in found]
        base = float(np.logaddexp(0, self.bias))
        least = gate(self.bias)
        clean = base if plain or found else 0.0
        clean += sum(float(np.logaddexp(0, z)) - base for _, _, z in odds if z >= least)
        offending = [(a, b, 1 / (1 + float(np.exp(-z)))) for a, b, z in odds if z >= 0]
        return float(-np.expm1(-clean)), offending


def _word_counts(batches):
    """Documents of each label that hold a word, counted within the task."""
    counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def flush():
        words = sorted(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *(pa.array([counts[k][w] for w in words], pa.int64()) for k in (0, 1))],
            names=["word", "clean", "toxic"],
        )
        counts[0].clear()
        counts[1].clear()

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts[label].update({f for w in set(WORD.findall(text.lower())) for f in features(w)})
        if len(counts[0]) + len(counts[1]) > 500_000:
            yield from flush()
    yield from flush()


def choose_words(sample: DataFrame, size: int) -> tuple[list[str], int, int]:
    """The words whose share of documents differs most between the labels, and both labels' totals."""
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return [], clean, toxic
    counted = (
        sample.select("text", "label")
        .mapInArrow(_word_counts, "word string, clean long, toxic long")
        .groupBy("word")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("clean") + F.col("toxic") >= LEAST_DOCUMENTS)
    )
    share = (F.col("clean") + F.col("toxic")) / (clean + toxic)
    gap = F.col("toxic") / toxic - F.col("clean") / clean
    errors = gap / F.sqrt(share * (1 - share) * (1 / clean + 1 / toxic) + F.lit(1e-18))
    kept = counted.where(F.abs(errors) >= LEAST_ERRORS).orderBy(F.abs(errors).desc(), "word").limit(size)
    return [r["word"] for r in kept.select("word").collect()], clean, toxic


def sentence_rows(sample: DataFrame, words: list[str]) -> list[tuple[int, int, list[list[int]]]]:
    """(label, sentences without a chosen word, chosen words of each other sentence) per document."""
    numbers = {w: i for i, w in enumerate(words)}

    def run(batches):
        known = KnownFeatures(numbers)
        for batch in batches:
            own = [known.sentences(text) for text in batch.column(0).to_pylist()]
            columns = [
                batch.column(1),
                pa.array([plain for plain, _ in own], pa.int32()),
                pa.array([[x for _, _, x in found] for _, found in own], pa.list_(pa.list_(pa.int32()))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "plain", "bags"])

    rows = sample.select("text", "label").mapInArrow(run, "label int, plain int, bags array<array<int>>")
    return [(r["label"], r["plain"], r["bags"]) for r in rows.collect()]


def train(rows: list[tuple[int, int, list[list[int]]]], size: int) -> tuple[np.ndarray, float]:
    """Weights and bias that minimize the noisy-or log loss, by Adam over all rows at once.

    The gate closes over the middle half of the steps, so weights first grow in
    every sentence and the last quarter fits the very function that scores.
    """
    rows = sorted(rows, key=repr)
    label = np.array([r[0] for r in rows])
    filled = np.array([bool(r[1] or r[2]) for r in rows], dtype=float)
    owner = np.array([i for i, r in enumerate(rows) for _ in r[2]], dtype=np.int64)
    bags = [b for r in rows for b in r[2]]
    of = np.repeat(np.arange(len(bags)), [len(b) for b in bags])
    word = np.array([w for b in bags for w in b], dtype=np.int64)
    weight, bias = np.zeros(size), -5.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(of, weight[word], len(bags))
        p, base = 1 / (1 + np.exp(-z)), 1 / (1 + np.exp(-bias))
        level, above = np.logaddexp(0, bias), z >= gate(bias, min(1.0, max(0.0, 2 * step / STEPS - 0.5)))
        total = filled * level + np.bincount(owner, np.where(above, np.logaddexp(0, z) - level, 0), len(rows))
        by_total = np.where(label == 1, -1 / np.expm1(np.maximum(total, 1e-9)), 1.0)
        by_each = by_total[owner] * above
        by_z = by_each * p
        grad = np.append(
            np.bincount(word, by_z[of], size) / len(rows) + SHRINK * weight,
            (by_z.sum() + (float(by_total @ filled) - by_each.sum()) * base) / len(rows),
        )
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        weight, bias = weight - move[:-1], float(bias - move[-1])
    return weight, bias


def fit(
    documents: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    sample_documents: int = SAMPLE_DOCUMENTS,
    vocabulary: int = VOCABULARY,
) -> Model:
    """A sentence model learned from at most ``sample_documents`` labelled texts outside the held-out fold."""
    bounded_batches(documents.sparkSession)
    sample = cut_lineage(labelled_sample(documents, labels, label, sample_documents).select("text", "label"))
    words, clean, toxic = choose_words(sample, vocabulary)
    if not words:
        return Model([], np.zeros(0), -50.0)
    return Model(words, *train(sentence_rows(sample, words), len(words)))


def with_score(df: DataFrame, model: Model, out: str, text: str = "text") -> DataFrame:
    """All columns plus the noisy-or score."""

    def make():
        known = model.known()
        return lambda texts: pa.array([model.score(t, known)[0] for t in texts], pa.float64())

    return with_text_column(df, out, DoubleType(), make, text)


def score(df: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, offending): offending sentences as code-point spans with scores."""
    span = StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("score", DoubleType())])
    kind = StructType([StructField("score", DoubleType()), StructField("offending", ArrayType(span))])
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def make():
        known = model.known()

        def scores(texts: list[str]) -> pa.Array:
            scored = [model.score(t, known) for t in texts]
            offending = [[{"start": a, "end": b, "score": p} for a, b, p in o] for _, o in scored]
            return pa.StructArray.from_arrays(
                [pa.array([x for x, _ in scored], pa.float64()), pa.array(offending, spans)], ["score", "offending"]
            )

        return scores

    slim = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    found = with_text_column(slim, "found", kind, make)
    return found.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("found.offending").alias("offending"),
    )
