"""Document chunking and embedding."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.search import tokens
from tidemark.operators.splits import ordered_total
from tidemark.session import cut_lineage

# Where a chunk may end, best first.
BREAKS = (". ", "\n\n", "\n", " ")
#: So many documents are counted at once.
SLICE_ROWS = 256
CHUNK = "array<struct<text:string,start_char:int,end_char:int>>"


def break_ends(text: str) -> list[np.ndarray]:
    """Where the text may be cut, per kind of break: the offsets just after each, ascending."""
    return [
        np.array([found.start() + len(mark) for found in re.finditer(f"(?={re.escape(mark)})", text)], dtype=np.int64)
        for mark in BREAKS
    ]


def cut_after(ends: Sequence[np.ndarray], begin: int, size: int) -> int:
    """End of the chunk at ``begin``: the last break that fits, of the best kind that has one in the second half."""
    full = begin + size
    for mark, places in zip(BREAKS, ends):
        fitting = int(np.searchsorted(places, full, side="right"))
        if fitting and places[fitting - 1] - len(mark) > begin + size // 2:
            return int(places[fitting - 1])
    return full


def chunk_spans(text: str, size: int, overlap: int, tail: str = "stop") -> list[tuple[str, int, int]]:
    """Overlapping chunks of one text as (stripped text, start, end).

    The breaks of the text are listed once and every end is looked up among them.
    ``tail="reference"`` goes on past the end of the text with ever shorter
    chunks, one character apart, until the start reaches the end.
    """
    whole, ends = len(text), break_ends(text)

    def bounds() -> Iterator[tuple[int, int]]:
        begin, end = 0, 0
        while begin < whole and (end < whole or tail == "reference"):
            end = cut_after(ends, begin, size) if begin + size < whole else whole
            yield begin, end
            begin = max(begin + 1, end - overlap)

    return [(text[begin:end].strip(), begin, end) for begin, end in bounds()]


def chunk_documents(
    df: DataFrame, text: str, size: int, overlap: int, tail: str = "stop"
) -> DataFrame:
    """Each document with its list of chunks under ``chunks``."""
    if size <= 0:
        raise ValueError("the chunk size must be positive")

    @F.pandas_udf(CHUNK)
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(
                lambda t: []
                if t is None
                else [
                    {"text": c, "start_char": a, "end_char": b}
                    for c, a, b in chunk_spans(t, size, overlap, tail)
                ]
            )

    return df.withColumn("chunks", cut(F.col(text)))


def chunk_text(
    df: DataFrame,
    doc_order: str,
    text: str,
    size: int,
    overlap: int,
    *,
    keep: Sequence[str] = (),
    tail: str = "stop",
    rows_per_split: int | None = None,
) -> DataFrame:
    """One row per chunk, numbered over all documents in ``doc_order``.

    The chunks are cut once and written.  A document's first number is the count
    of chunks before it, from a running total over splits of the document order
    that reads only ids and counts of the written table.
    ``doc_order`` must name a document uniquely.
    """
    cut = chunk_documents(df, text, size, overlap, tail).select(doc_order, *keep, "chunks")
    chunked = cut_lineage(cut.withColumn("__n", F.size("chunks")))
    counts = chunked.select(F.col(doc_order).alias("__doc"), "__n")
    upto = ordered_total(counts, [], ["__doc"], F.col("__n"), "__upto", rows_per_split)
    firsts = upto.select("__doc", (F.col("__upto") - F.col("__n")).alias("__first"))
    opened = chunked.join(firsts, F.col(doc_order) == F.col("__doc")).select(
        doc_order, *keep, "__first", F.posexplode("chunks").alias("__at", "c")
    )
    return opened.select(
        (F.col("__first") + F.col("__at")).cast("long").alias("chunk_id"), doc_order, *keep, "c.*"
    )


def hashed_words(df: DataFrame, text: str, out: str, width: int) -> DataFrame:
    """Default embedding: word counts hashed into ``width`` places, scaled to length one.

    A word's place is the first eight digits of its SHA-256, modulo ``width``.
    Words are cut in the JVM; a slice of a batch hashes each distinct word once and
    counts all its documents' places together, so that beside the batch only a
    slice's words are held more than once.
    """

    def unit_counts(words: pa.Array) -> np.ndarray:
        coded = words.flatten().dictionary_encode()
        digests = (hashlib.sha256(w.encode()).hexdigest()[:8] for w in coded.dictionary.to_pylist())
        places = np.array([int(d, 16) % width for d in digests], dtype=np.int64)
        row = np.repeat(np.arange(len(words)), words.value_lengths().to_numpy())
        counts = np.bincount(row * width + places[coded.indices.to_numpy()], minlength=len(words) * width)
        counts = counts.astype(np.float64).reshape(len(words), width)
        norms = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        return (counts / np.where(norms > 0, norms, 1.0)).astype(np.float32).ravel()

    @F.arrow_udf("array<float>")
    def counted(words: pa.Array) -> pa.Array:
        unit = np.zeros(len(words) * width, dtype=np.float32)
        for at in range(0, len(words), SLICE_ROWS):
            own = unit_counts(words.slice(at, SLICE_ROWS))
            unit[at * width : at * width + len(own)] = own
        offsets = np.arange(0, (len(words) + 1) * width, width, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(unit))

    return df.withColumn(out, counted(tokens(F.coalesce(F.col(text), F.lit("")))))


def embed_text(
    df: DataFrame,
    text: str,
    out: str = "embedding",
    *,
    width: int = 384,
    model: Callable[[list[str]], np.ndarray] | None = None,
) -> DataFrame:
    """Text to vectors, by a model given as a function over a batch of texts.

    Without a model the hashed word counts are used.
    """
    if model is None:
        return hashed_words(df, text, out, width)

    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            vectors = np.asarray(model(texts.fillna("").tolist()), dtype=np.float32)
            yield pd.Series(list(vectors))

    return df.withColumn(out, embed(F.col(text)))
