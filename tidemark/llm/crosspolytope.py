"""Near-duplicate vectors by cross-polytope hashing, with verified links.

A vector is turned by three rounds of random signs and a fast Hadamard
transform; its hash is the signed axis nearest to it.  ``HASHES`` of them make a
bucket, ``TABLES`` independent buckets are made, and each vector also looks into
the ``PROBES`` next best buckets of each table.  Vectors that meet, one of them
in its own bucket, are candidates; their cosine in double precision decides.

Equal vectors are one class with a size, so copies are never paired.  Within a
bucket's blocks every candidate is compared, but only counts and one link per
member and root leave the task.  A pair that meets more than once is counted
where it meets first, which both of its vectors tell.

Defined results: NULL, zero and non-finite vectors link with nothing; vectors of
different lengths don't link; NULL ids keep their row with no links and no
component; a row repeated exactly is one vector and comes back as often as given.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.blocks import GROUP_ROWS, dealt_tasks, unit_pairs
from tidemark.llm.common import bounded_batches, merge_labels, sized
from tidemark.llm.components import components
from tidemark.llm.vectors import clean_vectors, matrix, unit_rows
from tidemark.session import cut_lineage

COSINE = 0.9
TABLES, HASHES, PROBES = 10, 3, 8
#: Axes of each hash that are tried for the probes.
AXES = 3
SEED = 20240229
PAIRS_AT_ONCE = 1 << 17
#: Numbers that are rotated together, so that they stay in a core's cache.
ROTATED_AT_ONCE = 1 << 16
#: Bits of a vector's sketch, and how many standard deviations above its mean a linked pair's distance may be.
SKETCH_BITS, SKETCH_DEVIATIONS = 128, 6.0


def hadamard(columns: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of columns whose length is a power of two, by sums and differences."""
    size, half = len(columns), 1
    while half < size:
        halves = columns.reshape(size // (2 * half), 2, half, -1)
        turned = np.empty_like(halves)
        np.add(halves[:, 0], halves[:, 1], out=turned[:, 0])
        np.subtract(halves[:, 0], halves[:, 1], out=turned[:, 1])
        columns = turned.reshape(columns.shape)
        half *= 2
    return columns / np.sqrt(size)


def rotations(dims: int) -> np.ndarray:
    """Random signs: (table, hash, round, axis)."""
    width = 1 << max(0, dims - 1).bit_length()
    rng = np.random.default_rng([SEED, dims])
    return rng.choice([-1.0, 1.0], size=(TABLES, HASHES, 3, width))


def buckets(rows: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Bucket numbers (row, table, probe) of unit rows; probe 0 is the row's own bucket.

    Only sums, differences and products by entry are used, so a row's buckets
    don't depend on the rows beside it.
    """
    width = signs.shape[-1]
    axes = min(AXES, 2 * width)
    choices = list(product(range(axes), repeat=HASHES))
    probes = min(PROBES, len(choices))
    out = np.empty((len(rows), len(signs), probes), dtype=np.int64)
    step = max(1, ROTATED_AT_ONCE // width)
    for first in range(0, len(rows), step):
        own = rows[first : first + step]
        padded = np.zeros((width, len(own)))
        padded[: own.shape[1]] = own.T
        for table, hashes in enumerate(signs):
            lost = np.zeros((len(choices), len(own)))
            code = np.zeros((len(choices), len(own)), dtype=np.int64)
            for h, rounds in enumerate(hashes):
                turned = padded
                for sign in rounds:
                    turned = hadamard(turned * sign[:, None])
                best, value = _foremost(np.concatenate([turned, -turned]).T.copy(), axes)
                loss = (value[0] - value) ** 2
                own_choice = [choice[h] for choice in choices]
                lost += loss[own_choice]
                code = code * (2 * width) + best[own_choice]
            order = np.argsort(lost.T.copy(), axis=1, kind="stable")[:, :probes]
            out[first : first + step, table] = np.take_along_axis(code.T, order, axis=1)
    return out


def _foremost(values: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and values (rank, row) of each row's ``count`` largest, the first of equal ones first; ``values`` is used up."""
    line = np.arange(len(values))
    best, value = np.empty((count, len(values)), dtype=np.int64), np.empty((count, len(values)))
    for k in range(count):
        best[k] = values.argmax(axis=1)
        value[k] = values[line, best[k]]
        values[line, best[k]] = -np.inf
    return best, value


def bucket_keys(code: np.ndarray, table: np.ndarray, dims: int) -> np.ndarray:
    """One number for (dims, table, code), small where there are few dimensions, so that it packs well.

    Up to 65,536 dimensions buckets share one only where the lengths differ by a multiple of 4096, which never link.
    """
    return (code * TABLES + table) * (1 << 12) + dims


def sketches(rows: np.ndarray) -> np.ndarray:
    """Sides of ``SKETCH_BITS`` random planes that each row lies on, as two whole numbers a row."""
    planes = np.random.default_rng([SEED, rows.shape[1], 1]).normal(size=(rows.shape[1], SKETCH_BITS))
    bits = np.packbits(rows @ planes > 0, axis=1)
    return bits.view(np.int64).reshape(len(rows), SKETCH_BITS // 64)


def sketch_bound(cosine: float) -> int:
    """Differing bits that a pair at ``cosine`` exceeds about once in 10 ** 8; nearer pairs differ in fewer."""
    share = float(np.arccos(np.clip(cosine, -1, 1))) / np.pi
    return int(np.ceil(SKETCH_BITS * share + SKETCH_DEVIATIONS * np.sqrt(SKETCH_BITS * share * (1 - share))))


def _hash_batches(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = batch.column(2).to_numpy(zero_copy_only=False)
        for dims in np.unique(lengths):
            rows = batch.filter(pa.array(lengths == dims))
            signs = rotations(int(dims))
            unit = unit_rows(matrix(rows.column(1), int(dims)))
            found, sketch = buckets(unit, signs), sketches(unit)
            n, tables, probes = found.shape
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(rows.column(0).to_numpy(zero_copy_only=False), tables * probes)),
                    pa.array(np.full(n * tables * probes, dims, dtype=np.int32)),
                    pa.array(bucket_keys(found, np.arange(tables)[None, :, None], int(dims)).reshape(-1)),
                    pa.array(np.tile(np.arange(probes) == 0, n * tables)),
                    pa.array(np.repeat(sketch[:, 0], tables * probes)),
                    pa.array(np.repeat(sketch[:, 1], tables * probes)),
                ],
                names=["rep", "dims", "key", "own", "left", "right"],
            )


def linked_pairs(classes: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """(rep, linked) with the sizes of the linked classes summed, and links (a, b) that join them.

    ``classes`` has (rep, v, dims, size): distinct vectors with a number and how many share them.
    Rows of a bucket meet twice: first their sketches, which travel in the bucket
    rows, then the vectors of those rows only that a sketch puts near another.
    """
    hashed = cut_lineage(
        classes.select("rep", "v", "dims").mapInArrow(
            _hash_batches, "rep long, dims int, key long, own boolean, left long, right long"
        )
    )
    shared = (
        hashed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("bucket_rows"), F.max("own").alias("own_there"))
        .where("bucket_rows > 1 and own_there")
        .drop("own_there")
    )
    met = cut_lineage(hashed.join(shared, "key"))
    bound = sketch_bound(cosine)

    def sift(table: pa.Table) -> pa.Table:
        return _sifted(table, bound).drop_columns(["left", "right", "task"])

    kept = "key long, rep long, dims int, own boolean, block int, low int, high int, unit long"
    near = dealt_tasks(met, "key", "rep").groupBy("task").applyInArrow(sift, kept)
    near, tasks = sized(near.join(classes.select("rep", "v", "size"), "rep"), GROUP_ROWS)

    def compare(table: pa.Table) -> pa.Table:
        outs = []
        lengths = table["dims"].to_numpy()
        for dims in np.unique(lengths):
            own = table.filter(pa.array(lengths == dims)) if len(np.unique(lengths)) > 1 else table
            outs.append(_compare(own, int(dims), cosine))
        return pa.concat_tables(outs) if outs else pa.table(
            {"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "linked": pa.array([], pa.int64())}
        )

    dealt = near.groupBy(F.pmod("unit", F.lit(tasks)).alias("task"))
    found = cut_lineage(dealt.applyInArrow(compare, "a long, b long, linked long"))
    counts = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("linked").alias("linked"))
    return counts, found.where("b is not null").select("a", "b")


def _sifted(table: pa.Table, bound: int) -> pa.Table:
    """Rows whose sketch differs from another's of their unit in at most ``bound`` bits."""
    table = table.sort_by([("unit", "ascending"), ("rep", "ascending"), ("own", "descending")])
    get = {c: table[c].to_numpy() for c in ("unit", "rep", "block", "low", "high", "own", "left", "right")}
    alive = np.zeros(len(get["unit"]), dtype=bool)
    for at, other in unit_pairs(get["unit"], get["block"], get["low"] != get["high"]):
        wanted = (get["own"][at] | get["own"][other]) & (get["rep"][at] != get["rep"][other])
        at, other = at[wanted], other[wanted]
        apart = np.bitwise_count(get["left"][at].view(np.uint64) ^ get["left"][other].view(np.uint64)).astype(np.int64)
        apart += np.bitwise_count(get["right"][at].view(np.uint64) ^ get["right"][other].view(np.uint64))
        alive[at[apart <= bound]] = True
        alive[other[apart <= bound]] = True
    return table.filter(pa.array(alive))


def _compare(table: pa.Table, dims: int, cosine: float) -> pa.Table:
    """Rows (a, NULL, linked): sizes linked to a; rows (a, b, NULL): a joined to b."""
    table = table.sort_by([("unit", "ascending"), ("rep", "ascending"), ("own", "descending")])
    get = {c: table[c].to_numpy() for c in ("unit", "rep", "block", "low", "high", "own", "size", "key")}
    nodes, first, node = np.unique(get["rep"], return_index=True, return_inverse=True)
    rows = unit_rows(matrix(table["v"].take(pa.array(first)), dims))
    size = get["size"][first]
    parent, linked = np.arange(len(nodes)), np.zeros(len(nodes), dtype=np.int64)
    signs = rotations(dims)
    codes, coded = buckets(rows[:0], signs), np.full(len(nodes), -1)
    for at, other in unit_pairs(get["unit"], get["block"], get["low"] != get["high"]):
        wanted = (get["own"][at] | get["own"][other]) & (node[at] != node[other])
        at, other = at[wanted], other[wanted]
        for i in range(0, len(at), PAIRS_AT_ONCE):
            x, y = at[i : i + PAIRS_AT_ONCE], other[i : i + PAIRS_AT_ONCE]
            near = np.einsum("ij,ij->i", rows[node[x]], rows[node[y]]) >= cosine
            x, y = x[near], y[near]
            if not len(x):
                continue
            new = np.unique(np.concatenate([node[x], node[y]]))
            new = new[coded[new] < 0]
            if len(new):
                coded[new] = len(codes) + np.arange(len(new))
                codes = np.concatenate([codes, buckets(rows[new], signs)])
            here = _first_meeting(codes[coded[node[x]]], codes[coded[node[y]]], get["key"][x], dims)
            x, y = node[x[here]], node[y[here]]
            parent = merge_labels(parent, x, y)
            linked += np.bincount(x, size[y], len(nodes)).astype(np.int64)
            linked += np.bincount(y, size[x], len(nodes)).astype(np.int64)
    member, counted = np.flatnonzero(parent != np.arange(len(nodes))), np.flatnonzero(linked)
    none = len(member) * [None], len(counted) * [None]
    return pa.table(
        {
            "a": pa.array(np.concatenate([nodes[member], nodes[counted]]), pa.int64()),
            "b": pa.array([*nodes[parent[member]].tolist(), *none[1]], pa.int64()),
            "linked": pa.array([*none[0], *linked[counted].tolist()], pa.int64()),
        }
    )


def _first_meeting(a: np.ndarray, b: np.ndarray, key: np.ndarray, dims: int) -> np.ndarray:
    """Whether the bucket ``key`` is the first place where the pairs meet, one of them in its own bucket."""
    a_in_b = (a[:, :, :1] == b).any(axis=2)
    b_in_a = (b[:, :, :1] == a).any(axis=2)
    first = (a_in_b | b_in_a).argmax(axis=1)
    line = np.arange(len(a))
    none = np.iinfo(np.int64).max
    least = np.minimum(
        np.where(a_in_b[line, first], a[line, first, 0], none), np.where(b_in_a[line, first], b[line, first, 0], none)
    )
    return bucket_keys(least, first, dims) == key


def near_duplicates(
    df: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    bounded_batches(df.sparkSession)
    vectors = clean_vectors(df, vec_id, vector).dropDuplicates(["vec_id", "v"])
    vectors = cut_lineage(vectors.withColumn("look", F.xxhash64("v")))
    classes = vectors.groupBy("look", "v", "dims").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("size")
    )
    classes = cut_lineage(classes.withColumn("rep", F.monotonically_increasing_id()))
    counts, links = linked_pairs(classes, cosine)
    placed = classes.join(components(links).withColumnRenamed("node", "rep"), "rep", "left")
    placed = placed.join(counts, "rep", "left").select(
        "look", "v", "first_id", F.coalesce("root", "rep").alias("root"),
        (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
    )
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_look = placed.join(named, "root").select("look", "v", "n_links", "component_id")
    every = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    every = every.withColumn("seen_look", F.when(F.col("vec_id").isNotNull(), F.xxhash64("v")))
    same = (F.col("seen_look") == F.col("look")) & (F.col("v") == F.col("same"))
    found = every.join(by_look.withColumnRenamed("v", "same"), same, "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
