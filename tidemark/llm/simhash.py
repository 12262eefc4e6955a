"""SimHash fingerprints, and near-duplicates by pigeonhole blocks.

A fingerprint's 64 bits are cut into ``blocks`` blocks.  Two fingerprints that
differ in at most ``distance`` bits agree on at least ``blocks - distance``
blocks, so they share one of the keys made from every choice of that many
blocks; rows that share a key are compared by their Hamming distance.  Equal
fingerprints are one row in all of this.

Defined results: NULL and empty texts have fingerprint zero and link like any
other; texts with fewer words than a shingle are one shingle; repeated rows come
back as often as given; NULL ids keep their row and never name a component.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tidemark.llm.blocks import dealt_tasks, unit_pairs
from tidemark.llm.common import merge_labels, with_text_column
from tidemark.llm.components import components
from tidemark.session import cut_lineage

SHINGLE_WORDS = 3
DISTANCE = 3
BLOCKS = 5
SEED = 42
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit fingerprint: a bit is set if more than half of the shingle hashes have it."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist()
    width = min(shingle_words, len(words))
    ends = ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for i in range(0, len(ends), HASHES_AT_ONCE):
        spans = zip(starts[i : i + HASHES_AT_ONCE], ends[i : i + HASHES_AT_ONCE], strict=False)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    set_bits = (2 * ones > len(ends)).astype(np.uint8)
    return int.from_bytes(np.packbits(set_bits).tobytes(), "big")


def with_fingerprint(df: DataFrame, out: str, text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """All columns plus the fingerprint as a signed number."""

    def make():
        def prints(texts: list[str]) -> pa.Array:
            found = np.array([fingerprint(t, shingle_words) for t in texts], dtype=np.uint64)
            return pa.array(found.view(np.int64))

        return prints

    return with_text_column(df, out, LongType(), make, text)


def pigeonhole_keys(column: str, distance: int, blocks: int) -> Column:
    """Array of (choice, kept bits) hashes, one for each choice of ``blocks - distance`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - distance)):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(F.xxhash64(F.lit(number), F.col(column).bitwiseAND(F.lit(signed))))
    return F.array(*keys)


def near_links(prints: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints within ``distance`` bits, as stars of each unit of work.

    Keys are hashes of (choice, kept bits); a collision only adds a comparison.
    """
    keyed = prints.select("fp", F.explode(pigeonhole_keys("fp", distance, blocks)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("bucket_rows")).where("bucket_rows > 1")
    met = cut_lineage(keyed.join(shared, "key"))

    def compare(table: pa.Table) -> pa.Table:
        table = table.sort_by([("unit", "ascending"), ("fp", "ascending")])
        get = {c: table[c].to_numpy() for c in ("unit", "fp", "block", "low", "high")}
        fp = get["fp"].view(np.uint64)
        parent = np.arange(len(fp))
        for a, b in unit_pairs(get["unit"], get["block"], get["low"] != get["high"]):
            near = np.bitwise_count(fp[a] ^ fp[b]) <= distance
            parent = merge_labels(parent, a[near], b[near])
        member = np.flatnonzero(parent != np.arange(len(fp)))
        return pa.table({"a": get["fp"][member], "b": get["fp"][parent[member]]})

    return dealt_tasks(met, "key", "fp").groupBy("task").applyInArrow(compare, "a long, b long")


def near_duplicates(
    df: DataFrame,
    shingle_words: int = SHINGLE_WORDS,
    distance: int = DISTANCE,
    blocks: int = BLOCKS,
    doc_id: str = "doc_id",
    text: str = "text",
    groups: bool = False,
) -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest id reachable by links of at most ``distance`` bits.

    With ``groups`` a column ``root`` names the group itself, also where one id stands on texts of several.
    """
    slim = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    prints = cut_lineage(with_fingerprint(slim, "fp", "text", shingle_words).drop("text"))
    distinct = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = components(near_links(distinct.select("fp"), distance, blocks))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = placed.join(named, "root").select("fp", "component_id", "root")
    found = prints.join(by_print, "fp").withColumn("fingerprint", printed("fp"))
    return found.select("doc_id", "fingerprint", "component_id", *(["root"] if groups else []))


def printed(fp: str) -> Column:
    """A fingerprint as 16 hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
