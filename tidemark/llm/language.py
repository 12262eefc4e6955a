"""Language of pages by Bayesian fusion of text, declared language, address suffix and host.

The text gives a likelihood from letter trigrams.  How far a declared markup
language or an address suffix can be trusted is learned from the pages: grouped
sums of the text's own posteriors say how often each language goes with each
declared value and suffix.  A host's prior is its grouped sum without the page
itself, smoothed towards its domain's, which is smoothed towards that of all
pages.  The fused posterior is the normalized product.

Defined results: a page without text, declaration, suffix or host has the prior
of all pages; ties go to the first language in alphabetical order; every row comes
back, repeated rows as often as given; without labelled texts the language is NULL.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, host_of, text_or_empty
from tidemark.session import cut_lineage

#: At most this many labelled texts are learned from, and this many trigrams for each language.
SAMPLE_DOCUMENTS = 10_000
TRIGRAMS = 5_000
#: Trigrams of a text depend on each other; their evidence counts as that of at most so many.
EVIDENCE = 40.0
#: Weight, in pages, of the domain's prior in a host's, and of all pages' in a domain's.
HOST_WEIGHT = DOMAIN_WEIGHT = 5.0
MARK_WEIGHT = 1.0
#: Parts of one that chances are counted in.
UNITS = 1 << 32

RAW = re.compile(r"<(script|style)\b", re.I)
RAW_ENDS = {tag: re.compile(rf"</{tag}\s*+>", re.I) for tag in ("script", "style")}
DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})(?![a-z])"
WORDS = re.compile(r"[^\W\d_]+")


def trigrams(text: str) -> Counter:
    found: Counter = Counter()
    for word, times in Counter(WORDS.findall(text.lower())).items():
        padded = f" {word} "
        for i in range(len(padded) - 2):
            found[padded[i : i + 3]] += times
    return found


def page_text(markup: str) -> str:
    """The page without comments, scripts, styles and tags, in time in proportion to its length.

    What never ends is no comment or script: its first sign opens a tag, or is text if no tag ends either.
    """
    out, at, ends = [], 0, {"-->": True, ">": True, "script": True, "style": True}
    while (sign := markup.find("<", at)) >= 0:
        out.append(markup[at:sign])
        end = -1
        if ends["-->"] and markup.startswith("<!--", sign):
            end = markup.find("-->", sign + 4)
            ends["-->"] = end >= 0
            end += 3 if end >= 0 else 0
        elif (raw := RAW.match(markup, sign)) and ends[raw[1].lower()]:
            shut = RAW_ENDS[raw[1].lower()].search(markup, raw.end())
            ends[raw[1].lower()] = shut is not None
            end = shut.end() if shut else -1
        if end < 0 and ends[">"]:
            end = markup.find(">", sign) + 1
            ends[">"] = end > 0
            end = end or -1
        out.append(" " if end >= 0 else "<")
        at = end if end >= 0 else sign + 1
    return html.unescape("".join([*out, markup[at:]]))


class Model:
    """Log likelihoods of trigrams by language."""

    def __init__(self, languages: list[str], table: dict[str, np.ndarray], unseen: np.ndarray):
        self.languages, self.table, self.unseen = languages, table, unseen

    def log_likelihood(self, text: str) -> np.ndarray:
        """Evidence of the text, shrunk to that of at most EVIDENCE trigrams."""
        total, weight = np.zeros(len(self.languages)), 0
        for gram, times in trigrams(text).items():
            total += times * self.table.get(gram, self.unseen)
            weight += times
        return total * min(1.0, EVIDENCE / weight) if weight else total


def fit(documents: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS, features: int = TRIGRAMS) -> Model:
    """Trigram likelihoods from at most ``sample_documents`` texts with a language.

    Counts are summed by (trigram, language) in Spark; ``features`` trigrams of each language reach the driver.
    """
    bounded_batches(documents.sparkSession)
    sample = (
        documents.select("doc_id", text_or_empty("text").alias("text"), F.lower("lang").alias("lang"))
        .where(F.col("lang").rlike("^[a-z]{2,3}$"))
    )
    chosen = (
        sample.select("doc_id").where(F.col("doc_id").isNotNull()).distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_documents)
    )
    counted = (
        sample.join(F.broadcast(chosen), "doc_id").select("text", "lang")
        .mapInArrow(_count_batches, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    counted = cut_lineage(counted)
    totals = {r["lang"]: (r["n"], r["kinds"]) for r in counted.groupBy("lang").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()}
    languages = sorted(totals)
    table: dict[str, np.ndarray] = {}
    smooth = [np.log(totals[x][0] + totals[x][1] + 1.0) for x in languages]
    unseen = -np.array(smooth)
    for i, language in enumerate(languages):
        top = counted.where(F.col("lang") == language).orderBy(F.col("n").desc(), "gram").limit(features)
        for row in top.select("gram", "n").collect():
            table.setdefault(row["gram"], unseen.copy())[i] = np.log(row["n"] + 1.0) - smooth[i]
    return Model(languages, table, unseen)


def _count_batches(batches):
    counts: dict[str, Counter] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts.setdefault(lang, Counter()).update(trigrams(text))
    rows = [(lang, gram, n) for lang, own in counts.items() for gram, n in own.items()]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.string()),
            pa.array([r[1] for r in rows], pa.string()),
            pa.array([r[2] for r in rows], pa.int64()),
        ],
        names=["lang", "gram", "n"],
    )


def _softmax(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    raised = [F.exp(x - top) for x in logs]
    total = sum(raised[1:], raised[0])
    return [x / total for x in raised]


def identify(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """(page_id, url, host, lang, score, text_lang, declared): the most probable language and its probability."""
    size = len(model.languages)
    if not size:
        return pages.select(
            F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"),
            F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("score"),
            F.lit(None).cast("string").alias("text_lang"), F.lit(None).cast("string").alias("declared"),
        )
    bounded_batches(pages.sparkSession)
    read = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.nullif(host_of(F.col(url)), F.lit("")).alias("host"),
        F.nullif(F.lower(F.regexp_extract(F.coalesce(F.col(markup), F.lit("")), DECLARED, 1)), F.lit("")).alias("declared"),
        text_or_empty(markup).alias("markup"),
    )
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema[:4]]

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = [model.log_likelihood(page_text(m)).tolist() for m in batch.column(4).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:4], pa.array(found, pa.list_(pa.float64()))],
                    names=["page_id", "url", "host", "declared", "evidence"],
                )

    seen = read.mapInArrow(run, ", ".join([*kept, "evidence array<double>"]))
    logs = [F.col("evidence")[i] for i in range(size)]
    seen = seen.select(
        "page_id", "url", "host", "declared",
        F.regexp_extract("host", r"\.([a-z]+)$", 1).alias("suffix"),
        F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("domain"),
        *(x.alias(f"l{i}") for i, x in enumerate(logs)),
        *(x.alias(f"p{i}") for i, x in enumerate(_softmax(logs))),
    )
    seen = cut_lineage(seen)

    # chances are added as whole numbers, so that no order of rows changes a sum
    summed = [F.sum(F.round(F.col(f"p{i}") * UNITS).cast("long")) for i in range(size)]
    every = seen.agg(*summed).first()
    sums = [float(every[i] or 0) / UNITS for i in range(size)]
    base = [(x + 1.0) / (sum(sums) + size) for x in sums]

    def grouped(key: str, letter: str) -> DataFrame:
        """Sums by ``key``, written: the join sends them to the pages where they are small, and else splits hot keys."""
        sums = seen.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(key).agg(
            *((x / UNITS).alias(f"{letter}{i}") for i, x in enumerate(summed))
        )
        return cut_lineage(sums)

    joined = seen
    for key, letter in (("host", "h"), ("domain", "d"), ("declared", "m"), ("suffix", "s")):
        joined = joined.join(grouped(key, letter), key, "left")

    def others(letter: str, i: int) -> Column:
        """The group's sum without the page itself."""
        return F.greatest(F.coalesce(F.col(f"{letter}{i}") - F.col(f"p{i}"), F.lit(0.0)), F.lit(0.0))

    def total(letter: str) -> Column:
        parts = [others(letter, i) for i in range(size)]
        return sum(parts[1:], parts[0])

    fused = []
    for i in range(size):
        domain = (others("d", i) + DOMAIN_WEIGHT * base[i]) / (total("d") + DOMAIN_WEIGHT)
        host = (others("h", i) + HOST_WEIGHT * domain) / (total("h") + HOST_WEIGHT)
        marks = [(others(x, i) + MARK_WEIGHT * base[i]) / (total(x) + MARK_WEIGHT) / base[i] for x in ("m", "s")]
        fused.append(F.col(f"l{i}") + F.log(host) + F.log(marks[0]) + F.log(marks[1]))
    chances = joined.select(
        "page_id", "url", "host", "declared",
        F.array(*_softmax(fused)).alias("chances"),
        F.array(*(F.col(f"p{i}") for i in range(size))).alias("own"),
    )
    names = F.array(*map(F.lit, model.languages))

    def best(array: str) -> Column:
        return F.element_at(names, F.array_position(array, F.array_max(array)).cast("int"))

    return chances.select(
        "page_id", "url", "host", best("chances").alias("lang"), F.array_max("chances").alias("score"),
        best("own").alias("text_lang"), "declared",
    )
