"""Vector, text and hybrid retrieval.

Vector search scans Arrow batches with the query vectors at hand and keeps a
running top k per partition, so k rows per query and partition leave the scan
and no query-by-vector pairs are ever stored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage, fresh_path

# Distances by name.
METRICS = ("cosine", "L1", "L2", "inner_product")
QUERY_BYTES = 64 * 1024 * 1024
MERGE_BUCKETS = 64
DISTANCE_CELLS = 4_000_000


def _distances(queries: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    """Distances by query and vector; smaller is nearer for every metric."""
    if metric == "inner_product":
        return -(queries @ vectors.T)
    if metric == "cosine":
        norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            return 1.0 - (queries @ vectors.T) / norms
    if metric == "L2":
        return np.stack([np.sqrt(((vectors - q) ** 2).sum(axis=1)) for q in queries])
    if metric == "L1":
        return np.stack([np.abs(vectors - q).sum(axis=1) for q in queries])
    raise ValueError(f"metric {metric!r} is not one of {METRICS}")


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and vectors of the rows that hold a vector of the right width."""
    lengths = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float))
    rows = np.flatnonzero(lengths == width)
    kept = column.take(pa.array(rows)) if len(rows) < len(column) else column
    flat = kept.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return rows, flat.reshape(len(rows), width)


def _nearest(distances: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k nearest by (distance, id); undefined distances never match."""
    usable = np.flatnonzero(~np.isnan(distances))
    if len(usable) > k:
        bound = np.partition(distances[usable], k - 1)[k - 1]
        usable = usable[distances[usable] <= bound]
    order = np.lexsort((ids[usable], distances[usable]))
    return usable[order[:k]]


def _scan(df: DataFrame, id_col: str, vector: str, shared: Broadcast, k: int, metric: str) -> DataFrame:
    """k nearest rows per query and partition."""
    kinds = {f.name: f.dataType for f in df.schema}
    id_type = kinds[id_col]
    schema = T.StructType(
        [
            T.StructField("query_id", T.LongType()),
            T.StructField("id", id_type),
            T.StructField("distance", T.DoubleType()),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_names, queries = shared.value[:2]
        if not query_names:
            return
        best = [(np.empty(0), np.empty(0, dtype=object)) for _ in query_names]
        arrow_id = None
        for batch in batches:
            arrow_id = batch.column(0).type
            rows, vectors = _matrix(batch.column(1), queries.shape[1])
            if not len(rows):
                continue
            all_ids = batch.column(0).take(pa.array(rows)).to_numpy(zero_copy_only=False)
            step = max(1, DISTANCE_CELLS // len(queries))
            for at in range(0, len(vectors), step):
                ids = all_ids[at : at + step]
                scored = _distances(queries, vectors[at : at + step], metric)
                for number, row in enumerate(scored):
                    near = _nearest(row, ids, k)
                    held, held_ids = best[number]
                    both = np.concatenate([held, row[near]])
                    both_ids = np.concatenate([held_ids, ids[near].astype(object)])
                    keep = _nearest(both, both_ids, k)
                    best[number] = both[keep], both_ids[keep]
        for name, (held, held_ids) in zip(query_names, best):
            if len(held):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(held), pa.int64()),
                        pa.array(list(held_ids), arrow_id),
                        pa.array(held, pa.float64()),
                    ],
                    names=["query_id", "id", "distance"],
                )

    return df.select(id_col, vector).mapInArrow(run, schema)


def top_per_query(scored: DataFrame, k: int) -> DataFrame:
    """k nearest per query, merged in two steps so no task reads every partition's rows."""
    order = [F.col("distance"), F.col("id")]
    bucket = F.pmod(F.xxhash64("id"), F.lit(MERGE_BUCKETS))
    for group in (["query_id", bucket], ["query_id"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        scored = scored.withColumn("rank", rank).filter(F.col("rank") <= k)
    return scored


def vector_topk(
    df: DataFrame,
    id_col: str,
    vector: str,
    queries: DataFrame,
    k: int,
    metric: str = "L2",
    max_queries: int | None = None,
) -> DataFrame:
    """Exact k nearest rows for each (query_id, vector) of ``queries``.

    Returns query_id, id, distance and rank.  The queries of one scan must fit
    ``max_queries`` (by default 64 MB of vectors); a larger set is cut into
    blocks by hash.  One block at a time is sent out, scans the table, and is let
    go once its k rows per query and partition are written; only the last is held.
    """
    if metric not in METRICS:
        raise ValueError(f"metric {metric!r} is not one of {METRICS}")
    asked = queries.select(
        F.col("query_id").cast("long"), F.col("vector").cast("array<double>").alias("vector")
    ).filter(F.col("vector").isNotNull())
    sizes = asked.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not sizes["n"]:
        raise ValueError("no query vectors")
    limit = max_queries or max(1, QUERY_BYTES // (8 * sizes["width"]))
    blocks = math.ceil(sizes["n"] / limit)
    path, parts = fresh_path(df.sparkSession, "nearest"), []
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        if block == blocks - 1:  # the last one's scan stays part of the plan
            parts.append(_scan(df, id_col, vector, _broadcast(own), k, metric))
            continue
        with _sent(own) as shared:
            _scan(df, id_col, vector, shared, k, metric).write.mode("append").parquet(path)
    if blocks > 1:
        parts.append(df.sparkSession.read.parquet(path))
    return top_per_query(reduce(DataFrame.unionAll, parts), k)


def _broadcast(queries: DataFrame, more: Sequence[str] = ()) -> Broadcast:
    """One bounded block of queries for all executors: numbers, a matrix and ``more`` columns."""
    table = queries.select("query_id", "vector", *more).toArrow()
    matrix = np.array(table["vector"].to_pylist(), dtype=np.float64)
    names = table["query_id"].to_pylist()
    return queries.sparkSession.sparkContext.broadcast((names, matrix, *(table[c].to_pylist() for c in more)))


@contextmanager
def _sent(queries: DataFrame, more: Sequence[str] = ()) -> Iterator[Broadcast]:
    """A block on all executors, gone afterwards."""
    shared = _broadcast(queries, more)
    try:
        yield shared
    finally:
        shared.destroy()


def cosine_search(
    df: DataFrame, id_col: str, vector: str, queries: DataFrame, k: int
) -> DataFrame:
    """k most similar rows; similarity is one minus the cosine distance."""
    found = vector_topk(df, id_col, vector, queries, k, "cosine")
    return found.withColumn("similarity", 1 - F.col("distance"))


def hit_features(found: DataFrame, df: DataFrame, id_col: str, features: Sequence[str]) -> DataFrame:
    """Hits with the requested columns of their rows.

    The hits are written first, so that the join knows their size; only the
    requested columns of the table are read.
    """
    hits = cut_lineage(found)
    taken = [c for c in features if c in hits.columns]
    if taken:
        raise ValueError(f"the hits have columns {taken} already")
    stored = df.select(F.col(id_col).alias("id"), *features)
    return hits.join(stored, "id").select(*hits.columns, *features)


def unit(vector: Column) -> Column:
    """Vector of length one; a zero vector stays as it is."""
    wide = vector.cast("array<double>")
    norm = F.sqrt(F.aggregate(wide, F.lit(0.0), lambda a, x: a + x * x))
    return F.when(norm > 0, F.transform(wide, lambda x: x / norm)).otherwise(wide)


def vector_topk_batch(
    df: DataFrame,
    id_col: str,
    vector: str,
    text: str,
    queries: DataFrame,
    k: int,
    metric: str = "cosine",
) -> DataFrame:
    """k rows for every query, padded with id -1, empty text and a zero vector.

    The hits are written first, so the join to their rows knows their size: within
    the session's broadcast limit the stored vectors aren't shuffled for it.
    """
    scaled = queries.select("query_id", unit(F.col("vector")).alias("vector"))
    found = cut_lineage(vector_topk(df, id_col, vector, scaled, k, metric))
    stored = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"), vector)
    rows = found.join(stored, "id")
    width = F.size("wanted")
    slots = scaled.select(
        F.col("query_id").cast("long"),
        F.col("vector").alias("wanted"),
        F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"),
    )
    zero = F.array_repeat(F.lit(0.0).cast("float"), width)
    return slots.join(rows, ["query_id", "rank"], "left").select(
        "query_id",
        "rank",
        F.coalesce("id", F.lit(-1)).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col(vector).cast("array<float>"), zero).alias(vector),
        "distance",
    )


#: Scores by metric, from distances.
SCORES: dict[str, Callable[[Column], Column]] = {
    "cosine": lambda d: 2 - d,
    "inner_product": lambda d: -d,
    "L2": lambda d: 1 / (1 + d),
}


def vector_score(
    df: DataFrame, id_col: str, vector: str, queries: DataFrame, k: int, metric: str
) -> DataFrame:
    """Similarity scores, highest first: cosine + 1, dot product, or 1 / (1 + L2)."""
    if metric not in SCORES:
        raise ValueError(f"no score is defined for {metric!r}")
    found = vector_topk(df, id_col, vector, queries, k, metric)
    return found.withColumn("score", SCORES[metric](F.col("distance")))


def phrase_vector_score(
    df: DataFrame, id_col: str, vector: str, hits: DataFrame, queries: DataFrame, k: int, metric: str
) -> DataFrame:
    """Similarity scores of the rows that hold a phrase, highest first.

    ``hits`` are the (query_id, id) of :meth:`TextIndex.phrases`; a query's vector
    is compared with its own phrase's rows only.
    """
    found = cut_lineage(hits.select("query_id", "id"))
    asked = queries.select("query_id", F.col("vector").cast("array<double>").alias("wanted"))
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).alias("held")).join(found, "id").join(asked, "query_id")

    @F.arrow_udf("double")
    def distance(vectors: pa.Array, wanted: pa.Array) -> pa.Array:
        out: list = []
        for own, query in zip(vectors.to_pylist(), wanted.to_pylist(), strict=True):
            fits = own is not None and query is not None and len(own) == len(query) and None not in own
            out.append(float(_distances(np.array([query]), np.array([own], dtype=np.float64), metric)[0, 0]) if fits else None)
        return pa.array(out, pa.float64())

    if metric not in SCORES:
        raise ValueError(f"no score is defined for {metric!r}")
    scored = rows.select("query_id", "id", distance("held", "wanted").alias("distance")).where("distance is not null")
    return top_per_query(scored.where(~F.isnan("distance")), k).withColumn("score", SCORES[metric](F.col("distance")))


def validate_vector_len(df: DataFrame, id_col: str, vector: str, width: int) -> DataFrame:
    """Rows whose vector is not of the declared length."""
    found = F.size(vector)
    return df.filter(F.col(vector).isNotNull() & (found != width)).select(
        id_col, found.alias("found"), F.lit(width).alias("declared")
    )


def combine_embeddings(
    first: Column, second: Column, strategy: str, first_weight=0.5, second_weight=0.5
) -> Column:
    """Two vectors as one: weighted_sum, concatenate or average; the shorter is zero-padded."""
    if strategy == "concatenate":
        return F.concat(first, second)
    if strategy == "average":
        weights = (0.5, 0.5)
    elif strategy == "weighted_sum":
        if abs(first_weight + second_weight - 1.0) > 1e-6:
            raise ValueError("the weights must sum to 1")
        weights = (first_weight, second_weight)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    zero = F.lit(0.0)
    return F.zip_with(
        first.cast("array<double>"),
        second.cast("array<double>"),
        lambda a, b: weights[0] * F.coalesce(a, zero) + weights[1] * F.coalesce(b, zero),
    )


def fit_centres(df: DataFrame, vector: str, nlist: int = 128, seed: int = 42) -> np.ndarray:
    """Centres of ``nlist`` k-means cells."""
    prepared = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("__v"))
    model = KMeans(k=nlist, seed=seed, featuresCol="__v").fit(prepared)
    return np.array(model.clusterCenters())


def write_ivf(df: DataFrame, vector: str, centres: np.ndarray, path: str) -> DataFrame:
    """Store rows in one folder for each cell and return the stored table.

    A cell holds the vectors nearest to its centre, ties to the first; vectors
    that are NULL or of another width have none. Large cells are written by
    several tasks, small ones together.
    """
    points = np.asarray(centres, dtype=np.float64)

    @F.arrow_udf("int")
    def nearest(vectors: pa.Array) -> pa.Array:
        rows, found = _matrix(vectors, points.shape[1])
        cells = np.full(len(vectors), -1, dtype=np.int32)
        if len(rows):
            cells[rows] = _distances(points, found, "L2").argmin(axis=0)
        return pa.array(cells, mask=cells < 0)

    placed = df.withColumn("cell", nearest(F.col(vector).cast("array<double>")))
    placed.hint("rebalance", "cell").write.partitionBy("cell").parquet(path)
    return df.sparkSession.read.parquet(path)


def ivf_topk(
    cells: DataFrame,
    centres: np.ndarray,
    id_col: str,
    vector: str,
    query: Sequence[float],
    k: int,
    nprobe: int = 10,
) -> DataFrame:
    """Approximate search: only the folders of the nprobe nearest cells are read, exactly within them."""
    point = np.asarray(query, dtype=np.float64)
    near = np.argsort(((centres - point) ** 2).sum(axis=1), kind="stable")[:nprobe]
    probed = cells.filter(F.col("cell").isin([int(c) for c in near]))
    spark = cells.sparkSession
    one = spark.createDataFrame([(0, point.tolist())], "query_id long, vector array<double>")
    return vector_topk(probed, id_col, vector, one, k, "L2")


def ivf_topk_batch(
    cells: DataFrame,
    centres: np.ndarray,
    id_col: str,
    vector: str,
    queries: DataFrame,
    k: int,
    nprobe: int = 10,
    max_queries: int | None = None,
) -> DataFrame:
    """Approximate search for many (query_id, vector) at once: query_id, id, distance and rank.

    A query looks at the rows of its ``nprobe`` nearest cells.  The folders that a
    block of queries needs are scanned once; a row meets the queries that probe
    its cell and no others.
    """
    points = np.asarray(centres, dtype=np.float64)

    @F.arrow_udf("array<int>")
    def nearest(vectors: pa.Array) -> pa.Array:
        rows, found = _matrix(vectors, points.shape[1])
        probed: list = [None] * len(vectors)
        for row, own in zip(rows, _distances(found, points, "L2") if len(rows) else (), strict=True):
            probed[row] = np.argsort(own, kind="stable")[:nprobe].tolist()
        return pa.array(probed, pa.list_(pa.int32()))

    wide = F.col("vector").cast("array<double>").alias("vector")
    asked = cut_lineage(
        queries.select(F.col("query_id").cast("long"), wide).withColumn("probed", nearest("vector")).where("probed is not null")
    )
    number = asked.count()
    limit = max_queries or max(1, QUERY_BYTES // (8 * points.shape[1]))
    blocks, path = max(1, math.ceil(number / limit)), fresh_path(cells.sparkSession, "probed")
    schema = f"query_id long, id {cells.schema[id_col].dataType.simpleString()}, distance double"
    for block in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        needed = [r[0] for r in own.select(F.explode("probed")).distinct().collect()]  # cells, not rows
        rows = cells.filter(F.col("cell").isin(needed)).select(id_col, vector, "cell")
        with _sent(own, ["probed"]) as shared:
            rows.mapInArrow(_probing(shared, k), schema).write.mode("append").parquet(path)
    return top_per_query(cells.sparkSession.read.schema(schema).parquet(path), k)


def _probing(shared: Broadcast, k: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """k nearest rows per query of a task's cells."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, queries, probed = shared.value
        if not names:
            return
        asking: dict[int, list[int]] = {}
        for i, own in enumerate(probed):
            for cell in own:
                asking.setdefault(cell, []).append(i)
        best = [(np.empty(0), np.empty(0, dtype=object)) for _ in names]
        arrow_id = pa.int64()
        for batch in batches:
            arrow_id = batch.column(0).type
            rows, vectors = _matrix(batch.column(1), queries.shape[1])
            ids = batch.column(0).take(pa.array(rows)).to_numpy(zero_copy_only=False)
            cells = batch.column(2).to_numpy(zero_copy_only=False)[rows]
            for cell in np.unique(cells):
                inside, numbers = np.flatnonzero(cells == cell), asking.get(int(cell), [])
                for number in numbers:
                    scored = _distances(queries[number : number + 1], vectors[inside], "L2")[0]
                    held, held_ids = best[number]
                    both = np.concatenate([held, scored])
                    both_ids = np.concatenate([held_ids, ids[inside].astype(object)])
                    keep = _nearest(both, both_ids, k)
                    best[number] = both[keep], both_ids[keep]
        for name, (held, held_ids) in zip(names, best, strict=True):
            if len(held):
                columns = [pa.array([name] * len(held), pa.int64()), pa.array(list(held_ids), arrow_id), pa.array(held, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "id", "distance"])

    return run


# -- text -----------------------------------------------------------------------------------


def tokens(text: Column) -> Column:
    """Lower-case words: runs of letters and digits."""
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    return F.filter(words, lambda w: w != "")


def _words(query: str) -> list[str]:
    words = [w for w in "".join(c if c.isalnum() else " " for c in query.lower()).split() if w]
    if not words:
        raise ValueError("the query has no words")
    return list(dict.fromkeys(words))


def _joined(fields: Sequence[str]) -> Column:
    return F.concat_ws("\n", *[F.col(f) for f in fields])


def _with_counts(df: DataFrame, id_col: str, fields: Sequence[str], words: list[str]) -> DataFrame:
    """Document length and the count of each query word.

    The words are bound once per row and opened by a generator, so a filter on
    the counts is not pushed below the split and does not repeat it.
    """

    def count_of(held: Column, word: str) -> Column:
        return F.size(F.filter(held, lambda t: t == word))

    def counts(held: Column) -> Column:
        each = [count_of(held, word).alias(f"__n{i}") for i, word in enumerate(words)]
        return F.struct(F.size(held).alias("__len"), *each)

    bound = F.transform(F.array(tokens(_joined(fields))), counts)
    return df.select(id_col, F.inline(bound))


def _every(words: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"__n{i}") > 0 for i in range(len(words))])


def text_search_contains(
    df: DataFrame, id_col: str, fields: Sequence[str], query: str, limit: int
) -> DataFrame:
    """Rows with the text anywhere in one of the fields, in id order."""
    hit = reduce(lambda a, b: a | b, [F.col(f).contains(query) for f in fields])
    return df.filter(hit).orderBy(id_col).limit(limit)


def text_search_rank(
    df: DataFrame, id_col: str, fields: Sequence[str], query: str, k: int
) -> DataFrame:
    """Rows holding every word, ranked by how often the words occur."""
    words = _words(query)
    text = F.lower(_joined(fields))
    likely = df.filter(reduce(lambda a, b: a & b, [text.contains(w) for w in words]))
    counted = _with_counts(likely, id_col, fields, words).filter(_every(words))
    total = reduce(lambda a, b: a + b, [F.col(f"__n{i}") for i in range(len(words))])
    found = counted.select(id_col, total.alias("text_rank"))
    return found.orderBy(F.desc("text_rank"), id_col).limit(k)


# Fixed values of the BM25 formula.
BM25_K1 = 1.2
BM25_B = 0.75
BM25_IDF_FLOOR = 1e-6


def bm25_search(
    df: DataFrame, id_col: str, fields: Sequence[str], query: str, k: int
) -> DataFrame:
    """BM25 top k over rows holding every query word, all fields weighing the same.

    The text is read once, into a checkpoint of ids, lengths and word counts.
    Document counts and the mean length come back from it as one scalar
    subquery, and scoring keeps k rows per partition.
    """
    words = _words(query)
    counted = cut_lineage(_with_counts(df, id_col, fields, words))
    stats = counted.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.avg("__len").alias("mean"),
            *[F.count_if(F.col(f"__n{i}") > 0).alias(f"d{i}") for i in range(len(words))],
        ).alias("s")
    ).scalar()
    held = counted.filter(_every(words)).withColumn("__s", stats)
    damping = BM25_K1 * (1 - BM25_B + BM25_B * F.col("__len") / F.col("__s.mean"))
    score = F.lit(0.0)
    for i in range(len(words)):
        df_i, tf = F.col(f"__s.d{i}"), F.col(f"__n{i}")
        idf = F.log((F.col("__s.n") - df_i + 0.5) / (df_i + 0.5))
        idf = F.when(idf > 0, idf).otherwise(F.lit(BM25_IDF_FLOOR))
        score = score + idf * tf * (BM25_K1 + 1) / (tf + damping)
    scored = held.select(id_col, score.alias("score"))
    return scored.orderBy(F.desc("score"), id_col).limit(k)


def hybrid_search(
    df: DataFrame,
    id_col: str,
    vector: str,
    fields: Sequence[str],
    query_text: str,
    queries: DataFrame,
    k: int,
    metric: str = "L2",
) -> DataFrame:
    """Rows holding every query word, in order of vector distance."""
    words = _words(query_text)
    text = _joined(fields)
    likely = reduce(lambda a, b: a & b, [F.lower(text).contains(w) for w in words])
    wanted = F.array(*[F.lit(w) for w in words])
    every = F.size(F.array_intersect(wanted, tokens(text))) == len(words)
    return vector_topk(df.filter(likely & every), id_col, vector, queries, k, metric)
