"""A stored inverted index: BM25 and phrases for many queries at once, from the asked terms' folders only.

A term's postings stand in blocks of 128, those with the greatest impact first,
and every block names its greatest impact.  Blocks lie in folders by hash of the
term.  A search opens the folders of its terms, scores the rarest term's first
block in full to learn what a hit must reach at least, and leaves out every block
that can't reach it: the result is that of a scan over all rows.  Positions are a
column of their own, which only phrases read.

Postings are made where a row's words are and moved once, into the order in which
they are stored; blocks are cut from the sorted stream.  Block numbers of a term
ascend with falling impact but leave gaps where a term goes on in another task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.search import BM25_B, BM25_IDF_FLOOR, BM25_K1, MERGE_BUCKETS, tokens
from tidemark.operators.splits import split_count
from tidemark.session import cut_lineage

BLOCK = 128
BUCKETS = 64
#: Places of one field are this far from those of the next, so no phrase goes over both.
FIELD = 1 << 32
#: So many words' postings are sorted by one task.
WORDS_PER_TASK = 4_000_000
#: So many rows' words are grouped at once.
SLICE_ROWS = 256


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _grouped(words: pa.Array) -> pa.Array:
    """Each row's words, of all its fields, with their places in ascending order.

    Rows are taken a slice at a time, so that beside the batch only a slice's
    places are held more than once.
    """

    def grouped(rows: pa.Array) -> pa.Array:
        fields = rows.flatten()
        size = fields.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        per_row = rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        row_of_field = np.repeat(np.arange(len(rows)), per_row)
        field = np.arange(len(fields)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
        row = np.repeat(row_of_field, size)
        at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        place = np.repeat(field, size) * FIELD + at
        coded = fields.flatten().dictionary_encode()
        key = row * max(1, len(coded.dictionary)) + coded.indices.to_numpy()
        order = np.argsort(key, kind="stable")  # a row's places come in ascending order
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, dtype=np.int64)
        ends = pa.array(np.r_[first, len(key)].astype(np.int32))
        terms = coded.dictionary.take(coded.indices.take(pa.array(order[first])))
        places = pa.ListArray.from_arrays(ends, pa.array(place[order]))
        pairs = pa.StructArray.from_arrays([terms, places], names=["term", "places"])
        bounds = np.searchsorted(row[order][first], np.arange(len(rows) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(bounds), pairs)

    slices = [grouped(words.slice(at, SLICE_ROWS)) for at in range(0, max(1, len(words)), SLICE_ROWS)]
    return pa.concat_arrays(slices)


def _postings_of(sized: DataFrame) -> DataFrame:
    """(id, length, term, places) of (id, words, length), made where a row is; only rows that share an id are moved."""

    grouped = F.arrow_udf(_grouped, "array<struct<term:string,places:array<bigint>>>")

    def opened(rows: DataFrame) -> DataFrame:
        return rows.select("id", "length", F.inline(grouped("words")))

    shared = cut_lineage(sized.groupBy("id", "length").agg(F.count(F.lit(1)).alias("times")).where("times > 1").drop("times"))
    if shared.isEmpty():
        return opened(sized)
    again = shared.select(F.col("id").alias("other"), F.col("length").alias("long"))
    same = F.col("id").eqNullSafe(F.col("other")) & (F.col("length") == F.col("long"))
    several = opened(sized.join(again, same, "left_semi")).groupBy("id", "length", "term")
    several = several.agg(F.sort_array(F.flatten(F.collect_list("places"))).alias("places"))
    return opened(sized.join(again, same, "left_anti")).unionAll(several)


def _packed(block: int):
    """Cuts a task's postings, sorted by term and falling impact, into blocks of one term each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, term, number = None, None, 0  # postings of the last block, which may go on in the next batch
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows]).combine_chunks()
            if not rows.num_rows:
                continue
            rows = rows.to_batches()[0]
            names = rows.column("term")
            changed = pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)
            begins = np.r_[0, np.flatnonzero(changed) + 1]
            size = np.diff(np.r_[begins, len(names)])
            blocks = -(-size // block)
            nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            starts = np.repeat(begins, blocks) + nth * block
            goes_on = names[0].as_py() == term
            nth[: blocks[0]] += number if goes_on else 0
            last = int(starts[-1])
            yield from made(rows, starts[:-1], nth[:-1], last)
            held, term, number = pa.Table.from_batches([rows.slice(last)]), names[-1].as_py(), int(nth[-1])
        if held is not None:
            rows = held.combine_chunks().to_batches()[0]
            yield from made(rows, np.zeros(1, dtype=np.int64), np.array([number]), rows.num_rows)

    def made(rows: pa.RecordBatch, starts: np.ndarray, nth: np.ndarray, end: int) -> Iterator[pa.RecordBatch]:
        if not len(starts):
            return
        bounds = pa.array(np.r_[starts, end].astype(np.int32))
        lists = {c: pa.ListArray.from_arrays(bounds, rows.column(c).slice(0, end)) for c in ("id", "impact", "places")}
        at = pa.array(starts)
        part = rows.column("part").take(at).to_numpy().astype(np.int64)
        columns = {
            "bucket": rows.column("bucket").take(at),
            "term": rows.column("term").take(at),
            "block": pa.array((part << 32) + nth),
            "n": pa.array(np.diff(np.r_[starts, end]).astype(np.int32)),
            "top": rows.column("impact").take(at),
            "ids": lists["id"], "impacts": lists["impact"], "places": lists["places"],
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def write_index(
    df: DataFrame, id_col: str, fields: Sequence[str], path: str, buckets: int = BUCKETS, block: int = BLOCK
) -> TextIndex:
    """Index the words of ``fields`` by ``id_col``, which must not repeat, under ``path``.

    The number of tasks follows from the number of words, so none sorts more as the table grows.
    """
    words = F.array(*(F.coalesce(tokens(F.col(f).cast("string")), F.array().cast("array<string>")) for f in fields))
    split = cut_lineage(df.select(F.col(id_col).alias("id"), words.alias("words")))
    length = F.aggregate("words", F.lit(0), lambda n, w: n + F.size(w))
    sized = split.withColumn("length", length)
    stats = sized.agg(F.count(F.lit(1)).alias("documents"), F.avg("length").alias("mean"))
    kind = df.schema[id_col].dataType.simpleString()
    stats.withColumns({"buckets": F.lit(buckets), "kind": F.lit(kind)}).write.parquet(f"{path}/stats")
    written = df.sparkSession.read.parquet(f"{path}/stats").first()
    mean, total = written["mean"] or 1.0, written["documents"] * (written["mean"] or 0.0)

    count = split_count(int(total), WORDS_PER_TASK, df.sparkSession.sparkContext.defaultParallelism)
    damping = BM25_K1 * (1 - BM25_B + BM25_B * F.col("length") / F.lit(mean))
    postings = _postings_of(sized).withColumn("tf", F.size("places"))
    postings = postings.select(
        _bucket(F.col("term"), buckets).alias("bucket"), "term", "id", (F.col("tf") / (F.col("tf") + damping)).alias("impact"), "places"
    )
    order = ["bucket", "term", F.col("impact").desc(), "id"]
    dealt = postings.repartitionByRange(count, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    kept = f"bucket int, term string, block bigint, n int, top double, ids array<{kind}>, impacts array<double>, places array<array<bigint>>"
    dealt.mapInArrow(_packed(block), kept).write.partitionBy("bucket").parquet(f"{path}/blocks")
    return TextIndex(df.sparkSession, path)


class TextIndex:
    """The index at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.documents, self.mean, self.buckets, kind = spark.read.parquet(f"{path}/stats").first()
        self.schema = (
            f"term string, block bigint, n int, top double, ids array<{kind}>, impacts array<double>, "
            "places array<array<bigint>>, bucket int"
        )

    def _lists(self, asked: DataFrame) -> DataFrame:
        """Blocks of the asked terms; the folders to open are at most as many as the index has buckets."""
        buckets = [r[0] for r in asked.select(_bucket(F.col("term"), self.buckets)).distinct().collect()]
        blocks = self.spark.read.schema(self.schema).parquet(f"{self.path}/blocks").filter(F.col("bucket").isin(buckets))
        return blocks.drop("bucket").join(asked.select("term").distinct(), "term", "left_semi")

    def _rarest(self, asked: DataFrame, lists: DataFrame) -> DataFrame:
        """The asked words with their documents and, per query, whether a word is its rarest."""
        counted = lists.groupBy("term").agg(F.sum("n").alias("held"), F.max("top").alias("most"), F.min("block").alias("foremost"))
        order = Window.partitionBy("query_id").orderBy("held", "term", "at")
        joined = asked.join(counted, "term")
        return cut_lineage(joined.withColumn("rarest", F.row_number().over(order) == 1))

    def bm25(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, id, score, rank): the k best rows that hold all words of (query_id, text)."""
        words = F.array_distinct(tokens(F.col("text")))
        asked = queries.select("query_id", F.size(words).alias("words"), F.posexplode(words).alias("at", "term"))
        asked = cut_lineage(asked)
        lists = self._lists(asked).select("term", "block", "n", "top", "ids", "impacts")
        idf = F.log((F.lit(self.documents) - F.col("held") + 0.5) / (F.col("held") + 0.5))
        weight = F.when(idf > 0, idf).otherwise(F.lit(BM25_IDF_FLOOR)) * (BM25_K1 + 1)
        weighed = self._rarest(asked, lists).withColumn("weight", weight)
        every = Window.partitionBy("query_id")
        best = F.col("weight") * F.col("most")
        weighed = weighed.withColumn("others", F.sum(best).over(every) - best)
        weighed = cut_lineage(weighed.withColumn("known", F.count(F.lit(1)).over(every)).where("known = words").drop("known"))
        wanted = lists.join(weighed.drop("held", "most", "at"), "term")

        # what a hit must reach: the k-th best of the rows in the first block of each query's rarest word
        first = wanted.where("rarest and block = foremost").select("query_id", F.explode("ids").alias("id"))
        tried = self._scored(self._postings(wanted).join(first, ["query_id", "id"], "left_semi"))
        least = top_scores(tried, k).groupBy("query_id").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("found"))
        least = cut_lineage(least.where(F.col("found") == k).select("query_id", (F.col("least") * (1 - 1e-9)).alias("least")))
        reach = F.col("weight") * F.col("top") + F.col("others")
        kept = wanted.join(least, "query_id", "left").where(F.col("least").isNull() | (reach >= F.col("least")))
        return top_scores(self._scored(self._postings(kept)), k)

    @staticmethod
    def _postings(lists: DataFrame) -> DataFrame:
        pairs = F.explode(F.arrays_zip("ids", "impacts")).alias("p")
        opened = lists.select("query_id", "words", "weight", pairs)
        return opened.select("query_id", "words", F.col("p.ids").alias("id"), (F.col("weight") * F.col("p.impacts")).alias("part"))

    @staticmethod
    def _scored(postings: DataFrame) -> DataFrame:
        summed = postings.groupBy("query_id", "id").agg(
            F.sum("part").alias("score"), F.count(F.lit(1)).alias("held"), F.max("words").alias("words")
        )
        return summed.where("held = words").select("query_id", "id", "score")

    def phrases(self, queries: DataFrame) -> DataFrame:
        """(query_id, id, times): rows that hold the words of (query_id, text) side by side, and how often.

        Every word of a phrase is looked for at its own distance from the first,
        so words may repeat.  Rows without the phrase's rarest word aren't opened.
        """
        words = tokens(F.col("text"))
        asked = queries.select("query_id", F.size(words).alias("words"), F.posexplode(words).alias("at", "term"))
        asked = cut_lineage(asked)
        lists = self._lists(asked).select("term", "block", "n", "top", "ids", "places")
        ordered = self._rarest(asked, lists).select("query_id", "words", "at", "term", "rarest")
        opened = lists.join(ordered, "term").select(
            "query_id", "words", "at", "rarest", F.explode(F.arrays_zip("ids", "places")).alias("p")
        )
        begins = F.transform("p.places", lambda x: x - F.col("at"))
        opened = opened.select("query_id", "words", "rarest", F.col("p.ids").alias("id"), begins.alias("begins"))
        rare = opened.where("rarest").select("query_id", "id")
        met = opened.join(rare, ["query_id", "id"], "left_semi").groupBy("query_id", "id").agg(
            F.collect_list("begins").alias("all"), F.max("words").alias("words")
        )
        common = F.aggregate(F.slice("all", 2, F.size("all")), F.element_at("all", 1), lambda a, b: F.array_intersect(a, b))
        found = met.where(F.size("all") == F.col("words")).select("query_id", "id", F.size(common).alias("times"))
        return found.where("times > 0")


def top_scores(scored: DataFrame, k: int) -> DataFrame:
    """k best per query with their rank, in two steps, so no task reads all rows of a query."""
    order = [F.desc("score"), F.col("id")]
    bucket = F.pmod(F.xxhash64("id"), F.lit(MERGE_BUCKETS))
    for group in (["query_id", bucket], ["query_id"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        scored = scored.withColumn("rank", rank).filter(F.col("rank") <= k)
    return scored
