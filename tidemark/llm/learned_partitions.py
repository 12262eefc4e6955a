"""Nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into parts of equal size with few
neighbours apart.  A small network learns which parts a vector's neighbours are
in.  It assigns every row to its most probable part, and sends a query to the
several most probable ones, whose rows are compared with it in double precision.
How many parts a query needs is measured on sample rows that the network hasn't
seen.

A part with too many rows is cut again in the same way, by a second network that
learns from a bounded sample of that part's rows; its number of parts to probe is
measured on sample rows of its own and on those that come from other parts.  So
the first level's parts may grow with the table while the last ones stay small.
A query whose parts hold too few rows for its list goes on to further parts.

Defined results: vectors that are NULL, zero or not finite take no part, nor do
rows without an id; a row repeated exactly counts once; only vectors of one
length are compared, those of less common lengths without partitions; with fewer
candidates than asked for, all are returned.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches
from tidemark.llm.vectors import clean_vectors, matrix
from tidemark.session import cut_lineage

#: At most this many rows are learned from; a part has at least so many of them.
SAMPLE_ROWS = 8_000
LEAST_SAMPLE_ROWS_PER_PART = 40
#: Rows that a part should have, as far as the sample allows; parts with more than SPLIT_ROWS are split again.
ROWS_PER_PART = 512
SPLIT_ROWS = 65_536
#: Numbers kept free for the parts of a part, more than a sample can make.
SUBPARTS = 4_096
GRAPH_NEIGHBOURS = 10
HIDDEN, EPOCHS, RATE = 128, 40, 2e-3
TARGET_RECALL = 0.94
BLOCK_ROWS = 2_048
NEIGHBOURS = 10


def graph(rows: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's k nearest other rows."""
    squares, near = (rows * rows).sum(axis=1), []
    for i in range(0, len(rows), 1000):
        gap = squares[None, :] - 2 * rows[i : i + 1000] @ rows.T
        gap[np.arange(len(gap)), np.arange(i, i + len(gap))] = np.inf
        near.append(np.argsort(gap, axis=1, kind="stable")[:, :k])
    return np.concatenate(near)


def bisect(rows: np.ndarray, near: np.ndarray, members: np.ndarray) -> np.ndarray:
    """Which half each member is in: a median cut, then swaps that bring neighbours together."""
    own = rows[members] - rows[members].mean(axis=0)
    axis = np.linalg.svd(own.T @ own, hermitian=True)[0][:, 0]
    side = np.zeros(len(members), dtype=bool)
    side[np.argsort(own @ axis, kind="stable")[len(members) // 2 :]] = True
    place = np.full(len(rows), -1)
    place[members] = np.arange(len(members))
    a = np.repeat(np.arange(len(members)), near.shape[1])
    b = place[near[members]].reshape(-1)
    a, b = a[b >= 0], b[b >= 0]
    ends, others = np.concatenate([a, b]), np.concatenate([b, a])
    share = 0.1
    cut = int((side[a] != side[b]).sum())
    while share > 0.001:
        apart = np.bincount(ends, side[ends] != side[others], len(members))
        gain = 2 * apart - np.bincount(ends, minlength=len(members))
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        most = max(1, int(share * len(members)))
        both = min(len(left), len(right), most)
        swap = int((gain[left[:both]] + gain[right[:both]] > 0).sum())
        if not swap:
            break
        tried = side.copy()
        tried[left[:swap]], tried[right[:swap]] = True, False
        now = int((tried[a] != tried[b]).sum())
        if now < cut:
            side, cut = tried, now
        else:
            share /= 2
    return side


def balanced_parts(rows: np.ndarray, near: np.ndarray, parts: int) -> np.ndarray:
    """Part of each row, by repeated halving; ``parts`` is a power of two."""
    part = np.zeros(len(rows), dtype=np.int64)
    while parts > 1:
        next_part = part * 2
        for p in np.unique(part):
            members = np.flatnonzero(part == p)
            next_part[members] += bisect(rows, near, members)
        part, parts = next_part, parts // 2
    return part


@dataclass
class Router:
    """Network with one hidden layer, and the number of parts that a query is sent to."""

    dims: int
    centre: np.ndarray
    scale: float
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: np.ndarray
    probes: int = 1

    def order(self, rows: np.ndarray) -> np.ndarray:
        """Parts of each row from the most probable on."""
        hidden = np.maximum((rows - self.centre) / self.scale @ self.first + self.first_bias, 0)
        return np.argsort(-(hidden @ self.second + self.second_bias), axis=1, kind="stable")


def train(rows: np.ndarray, target: np.ndarray, seed: int = 0) -> Router:
    """Network for the shares ``target`` (row, part), by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    dims, parts = rows.shape[1], target.shape[1]
    centre = rows.mean(axis=0)
    scale = float(np.sqrt(((rows - centre) ** 2).mean())) or 1.0
    x = (rows - centre) / scale
    weights = [
        rng.normal(size=(dims, HIDDEN)) * np.sqrt(2 / dims), np.zeros(HIDDEN),
        rng.normal(size=(HIDDEN, parts)) * np.sqrt(1 / HIDDEN), np.zeros(parts),
    ]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for batch in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            hidden = np.maximum(x[batch] @ weights[0] + weights[1], 0)
            logit = hidden @ weights[2] + weights[3]
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            out = (p / p.sum(axis=1, keepdims=True) - target[batch]) / len(batch)
            back = (out @ weights[2].T) * (hidden > 0)
            grads = [x[batch].T @ back, back.sum(axis=0), hidden.T @ out, out.sum(axis=0)]
            step += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                weights[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    return Router(dims, centre, scale, *weights)


@dataclass
class Routes:
    """The first level's router, and those of its parts that are split again."""

    top: Router
    below: dict[int, Router] = field(default_factory=dict)

    def parts(self, rows: np.ndarray, every: bool) -> list[list[int]]:
        """Each row's most probable part, or all those that it is sent to as a query."""
        order = self.top.order(rows)[:, : self.top.probes if every else 1]
        found: list[list[int]] = [[] for _ in rows]
        for part in np.unique(order).tolist():
            places = np.flatnonzero((order == part).any(axis=1))
            own = np.zeros((len(places), 1), dtype=np.int64)
            if part in self.below:
                router = self.below[part]
                own = router.order(rows[places])[:, : router.probes if every else 1]
            for i, subs in zip(places, (part * SUBPARTS + own).tolist(), strict=True):
                found[i] += subs
        return found

    def fill(self, row: np.ndarray, found: list[int], sizes: dict[int, int], least: int) -> list[int]:
        """``found`` and further parts, most probable first, until they hold ``least`` rows or all are named."""
        held, named = sum(sizes.get(p, 0) for p in found), set(found)
        found = list(found)
        for part in self.top.order(row[None, :])[0].tolist():
            for own in self.below[part].order(row[None, :])[0].tolist() if part in self.below else [0]:
                if held >= least:
                    return found
                number = part * SUBPARTS + own
                if number not in named and sizes.get(number):
                    found.append(number)
                    held += sizes[number]
        return found


def fit(
    sample: np.ndarray,
    rows: int,
    neighbours: int = NEIGHBOURS,
    target_recall: float = TARGET_RECALL,
    visitors: np.ndarray | None = None,
) -> Router:
    """Partitions for a table of ``rows`` rows from a sample of them.

    A fifth of the sample isn't learned from; as queries, these rows (and
    ``visitors``, rows from elsewhere) tell how many parts hold
    ``target_recall`` of their neighbours among all sample rows.
    """
    learned = max(1, len(sample) * 4 // 5)
    wanted = max(2, min(rows // ROWS_PER_PART, learned // LEAST_SAMPLE_ROWS_PER_PART))
    parts = 1 << (wanted.bit_length() - 1)
    if learned < 2 * LEAST_SAMPLE_ROWS_PER_PART:
        parts = 1
    own = sample[:learned]
    if parts == 1:
        flat = np.zeros((sample.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)
        return Router(sample.shape[1], own.mean(axis=0), 1.0, *flat)
    near = graph(own, GRAPH_NEIGHBOURS)
    part = balanced_parts(own, near, parts)
    target = np.zeros((learned, parts))
    line = np.arange(learned)
    target[line, part] += 1
    for j in range(near.shape[1]):
        target[line, part[near[:, j]]] += 1
    router = train(own, target / target.sum(axis=1, keepdims=True))
    held = np.arange(learned, len(sample))
    asked = sample[held] if visitors is None else np.concatenate([sample[held], visitors])
    gap = (sample * sample).sum(axis=1)[None, :] - 2 * asked @ sample.T
    gap[np.arange(len(held)), held] = np.inf
    nearest = np.argsort(gap, axis=1, kind="stable")[:, : min(neighbours, len(sample) - 1)]
    rank = np.argsort(router.order(asked), axis=1, kind="stable")
    needed = np.take_along_axis(rank, router.order(sample)[:, 0][nearest], axis=1)
    reached = [(needed < m).mean() for m in range(1, parts + 1)]
    router.probes = 1 + next(i for i, r in enumerate(reached) if r >= target_recall)
    return router


def build(
    vectors: DataFrame, neighbours: int, target_recall: float, split_rows: int = SPLIT_ROWS
) -> tuple[Routes, DataFrame] | None:
    """Routes for the most common vector length, and the rows placed by them; None without vectors."""
    sizes = vectors.groupBy("dims").agg(F.count(F.lit(1)).alias("n"))
    common = sizes.orderBy(F.col("n").desc(), "dims").first()
    if common is None:
        return None
    keyed = vectors.withColumnRenamed("vec_id", "key")
    same = vectors.where(F.col("dims") == common["dims"])
    sample = same.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").toArrow()
    rows = matrix(sample["v"], common["dims"])
    top = fit(rows, common["n"], neighbours, target_recall)
    placed = cut_lineage(_routed(keyed, Routes(top)))
    # one row for each part of the first level, 128 at most
    counts = placed.where("part >= 0").groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    crowded = {r["part"] // SUBPARTS: r["n"] for r in counts.where(F.col("n") > split_rows).collect()}
    if not crowded:
        return Routes(top), placed
    # both levels may lose some: each is allowed half
    each = 1 - (1 - target_recall) / 2
    top = fit(rows, common["n"], neighbours, each)
    routes = Routes(top, _below(placed, top, rows[max(1, len(rows) * 4 // 5) :], crowded, neighbours, each))
    return routes, cut_lineage(_routed(keyed, routes))


def _below(
    placed: DataFrame, top: Router, held: np.ndarray, crowded: dict[int, int], neighbours: int, target_recall: float
) -> dict[int, Router]:
    """A router for each crowded part, fitted in its own task on SAMPLE_ROWS of its rows at most.

    The routers that come back have a bounded size: 128 of them, each with
    HIDDEN x (dims + 128) weights of four bytes.
    """
    spark, dims = placed.sparkSession, top.dims
    sent = top.order(held)[:, : top.probes]
    visits = {p * SUBPARTS: held[(sent[:, 1:] == p).any(axis=1)] for p in crowded}
    sizes = spark.createDataFrame([(p * SUBPARTS, n) for p, n in crowded.items()], "part long, n long")
    # a share by hash leaves few rows more than wanted, so that no task has to sort a whole part
    span = 1 << 30
    print_ = F.xxhash64("key", F.lit(11))
    thin = placed.join(F.broadcast(sizes), "part").where(
        F.pmod(print_, F.lit(span)) < F.least(F.lit(1.0), F.lit(1.2 * SAMPLE_ROWS) / F.col("n")) * span
    )
    place = F.row_number().over(Window.partitionBy("part").orderBy(print_, "key", "v"))
    sample = thin.withColumn("place", place).where(F.col("place") <= SAMPLE_ROWS).select("part", "v", "n", "place")

    def learn(own: pa.Table) -> pa.Table:
        own = own.sort_by("place")
        part, n = own["part"][0].as_py(), own["n"][0].as_py()
        router = fit(matrix(own["v"], dims), n, neighbours, target_recall, visits[part])
        kept = io.BytesIO()
        shared = (router.centre, router.first, router.first_bias, router.second, router.second_bias)
        np.savez(kept, *(a.astype(np.float32) for a in shared), np.array([router.scale, router.probes]))
        return pa.table({"part": own["part"][:1], "router": pa.array([kept.getvalue()], pa.binary())})

    found = {}
    for row in sample.groupBy("part").applyInArrow(learn, "part long, router binary").toLocalIterator():
        centre, first, first_bias, second, second_bias, (scale, probes) = np.load(io.BytesIO(row["router"])).values()
        router = Router(dims, centre, float(scale), first, first_bias, second, second_bias, int(probes))
        found[row["part"] // SUBPARTS] = router
    return found


def _routed(vectors: DataFrame, routes: Routes, sizes: dict[int, int] | None = None, least: int = 0) -> DataFrame:
    """(key, v, part): the most probable part or, given the parts' ``sizes``, a row for each of the probed ones."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = batch.column(2).to_numpy(zero_copy_only=False)
            parts: list[list[int]] = [[-int(d)] for d in lengths]
            usual = np.flatnonzero(lengths == routes.top.dims)
            if len(usual):
                rows = matrix(batch.column(1).take(pa.array(usual)), routes.top.dims)
                for i, row, own in zip(usual, rows, routes.parts(rows, sizes is not None), strict=True):
                    parts[i] = own if sizes is None else routes.fill(row, own, sizes, least)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(parts, pa.list_(pa.int64()))], names=["key", "v", "parts"]
            )

    routed = vectors.select("key", "v", "dims").mapInArrow(run, "key long, v array<double>, parts array<long>")
    return routed.select("key", "v", F.explode("parts").alias("part"))


def _nearest_in_block(keep: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.array([], pa.int64())
        if not candidates.num_rows or not queries.num_rows:
            return pa.table({"look": empty, "vec_id": empty, "score": pa.array([], pa.float64())})
        dims = len(candidates["v"][0])
        order = np.argsort(candidates["key"].to_numpy(), kind="stable")
        ids, rows = candidates["key"].to_numpy()[order], matrix(candidates["v"], dims)[order]
        asked, own = queries["key"].to_numpy(), matrix(queries["v"], dims)
        squares = (rows * rows).sum(axis=1)
        looks, found, scores = [], [], []
        for key, query in zip(asked, own, strict=True):
            rough = squares - 2 * (rows @ query) + query @ query
            few = np.arange(len(ids))
            if len(few) > keep:
                limit = np.partition(rough, keep - 1)[keep - 1]
                few = np.flatnonzero(rough <= limit + 1e-9 * (abs(limit) + squares.max() + query @ query))
            gap = np.sqrt(((rows[few] - query) ** 2).sum(axis=1))
            best = np.argsort(gap, kind="stable")[:keep]
            looks.append(np.full(len(best), key))
            found.append(ids[few[best]])
            scores.append(gap[best])
        return pa.table({"look": np.concatenate(looks), "vec_id": np.concatenate(found), "score": np.concatenate(scores)})

    return run


def search(
    df: DataFrame,
    is_query,
    neighbours: int = NEIGHBOURS,
    target_recall: float = TARGET_RECALL,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest other rows found, by Euclidean distance.

    ``is_query`` is a condition on ``vec_id``.  Equal query vectors are searched once.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    vectors = cut_lineage(clean_vectors(df, vec_id, vector).dropDuplicates(["vec_id", "v"]))
    built = build(vectors, neighbours, target_recall, split_rows)
    if built is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = vectors.where(is_query).withColumn("print", F.xxhash64("v"))
    looks = asked.groupBy("print", "v", "dims").agg(F.min("vec_id").alias("key"))
    looks = cut_lineage(looks)
    routes, placed = built
    counts = cut_lineage(placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    # a number for each part, 128 x 128 at most
    held = {r["part"]: r["n"] for r in counts.where("part >= 0").collect()}
    sent = cut_lineage(_routed(looks, routes, held, neighbours + 1))
    blocks = counts.select("part", F.ceil(F.col("n") / BLOCK_ROWS).alias("row_blocks"))
    query_blocks = sent.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("query_blocks"))
    # a row for each part, 128 x 128 at most beside those of other lengths
    sizes = F.broadcast(blocks.join(query_blocks, "part"))
    candidates = placed.join(sizes, "part").select(
        "key", "v", "part",
        F.pmod(F.xxhash64("key"), F.col("row_blocks")).alias("row_block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1)).alias("query_block"),
    )
    queries = sent.join(sizes, "part").select(
        "key", "v", "part",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("row_blocks") - 1)).alias("row_block"),
        F.pmod(F.xxhash64("key"), F.col("query_blocks")).alias("query_block"),
    )
    cell = ["part", "row_block", "query_block"]
    found = candidates.groupBy(*cell).cogroup(queries.groupBy(*cell)).applyInArrow(
        _nearest_in_block(neighbours + 1), "look long, vec_id long, score double"
    )
    by_look = Window.partitionBy("look").orderBy("score", "vec_id")
    best = found.withColumn("place", F.row_number().over(by_look)).where(F.col("place") <= neighbours + 1)
    ids = asked.select(F.col("vec_id").alias("query_id"), "print", "v").join(
        looks.select("print", "v", F.col("key").alias("look")), ["print", "v"]
    ).select("query_id", "look")
    listed = best.groupBy("look").agg(F.array_sort(F.collect_list(F.struct("score", "vec_id"))).alias("hits"))
    hits = F.filter("hits", lambda h: h["vec_id"] != F.col("query_id"))
    return ids.join(listed, "look").select(
        "query_id", F.posexplode(F.slice(hits, 1, neighbours)).alias("place", "hit")
    ).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        F.col("hit.score").alias("score"),
    )
