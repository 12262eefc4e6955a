"""Prefix trie of conversations by the Euler-tour technique.

A node is a distinct sequence of first turns.  It is told by its depth and the
sum, over its turns, of a sha256 of place and content, kept as four numbers of 32
bits: sums are prefix sums, so a conversation of any length is worked on in
chunks of turns, and a shared prefix is one group whatever its share of the rows.

Every node has an enter and an exit arc.  An arc leads to the first child, the
next sibling or the parent's exit, which joins on (parent, rank among siblings)
tell, one row to one row.  The tour is ranked by list contraction: in each round
the arcs whose random number is less than both neighbours' leave, a third of
them, and are put back in reverse; the last ``LAST_ARCS`` are ranked in one task.
Leaves and savings of a subtree are then the difference of two prefix sums, at
its exit and its enter arc.

Defined results: rows with a NULL conversation belong to none; NULL roles and
texts are empty; NULL turns come first; turns with one number follow the digest
of their content; repeated rows are repeated turns; an empty table gives no rows.
Columns besides the named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.mixing import word_count
from tidemark.llm.prefix import CHUNK, chunk_offsets, prefix_sums
from tidemark.session import cut_lineage, fresh_path

#: The base of a conversation is the one whose number is a multiple of this; up to three of its turns are borrowed.
EVERY = 20
BORROWED = 4
#: So many arcs are ranked in one task; longer lists are contracted first.
LAST_ARCS = 16_384
#: Conversations whose numbers are written as one text before hashing.
LISTED = 512
PARTS = ("s0", "s1", "s2", "s3")
KEY = ("depth", *PARTS)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, digest, words) of the turns in order, without their texts."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.sha2(content, 256)).alias("digest"),
        word_count(text).alias("words"),
    )
    placed = prefix_sums(turns, ["conv_id"], ["turn", "digest"], {"place": F.lit(1).cast("long")})
    return placed.drop("turn")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, digest, words) and conversations (conv_id, length) after borrowing first turns.

    ``turns`` is read several times, so it should be a written table.  The first
    h = crc32(number) % 4 turns come from the conversation conv_id - conv_id % 20;
    own turns follow from number h + 1 on.
    """
    counted = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    base = F.col("conv_id") - F.col("conv_id") % EVERY
    asked = counted.select(
        "conv_id", "turns", base.alias("base"), (F.crc32(F.col("conv_id").cast("string")) % BORROWED).alias("h")
    )
    bases = counted.where(F.col("conv_id") % EVERY == 0).select(
        F.col("conv_id").alias("base"), F.col("turns").alias("base_turns")
    )
    taken = F.least("h", F.coalesce("base_turns", F.lit(0))).cast("long")
    own = F.greatest(F.col("turns") - F.col("h"), F.lit(0))
    convs = asked.join(bases, "base", "left").withColumn("taken", taken).withColumn("length", taken + own)
    convs = cut_lineage(convs)

    firsts = turns.where((F.col("conv_id") % EVERY == 0) & (F.col("place") < BORROWED))
    firsts = firsts.withColumnRenamed("conv_id", "base")
    heads = convs.select("conv_id", "base", "h").join(firsts, "base").where("place <= h")
    heads = heads.select("conv_id", F.col("place").alias("depth"), "digest", "words")
    # a conversation's numbers go once to each chunk of its turns, so that none is gathered for them
    chunk = F.sequence(F.lit(0).cast("long"), F.expr(f"(turns - 1) div {CHUNK}"))
    spread = convs.select("conv_id", "h", "taken", F.explode(chunk).alias("chunk"))
    tails = turns.withColumn("chunk", F.expr(f"(place - 1) div {CHUNK}")).join(spread, ["conv_id", "chunk"])
    tails = tails.where("place > h").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"), "digest", "words"
    )
    return heads.unionAll(tails), convs.select("conv_id", "length")


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Turns with the sums of their prefix (s0 to s3) and of the one before it (before_s0 to before_s3)."""
    sha = F.sha2(F.concat(F.col("depth").cast("string"), F.lit(":"), F.hex("digest")), 256)
    own = {f"own_{p}": F.conv(F.substring("sha", 8 * i + 1, 8), 16, 10).cast("long") for i, p in enumerate(PARTS)}
    chunked = turns.withColumn("sha", sha).withColumns(own).drop("sha", "digest")
    chunked = cut_lineage(chunked.withColumn("chunk", F.expr(f"(depth - 1) div {CHUNK}")))
    inside = Window.partitionBy("conv_id", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = chunked.withColumns({p: F.sum(f"own_{p}").over(inside) for p in PARTS})
    # one chunk needs no sums of earlier ones
    several = lengths.where(F.col("length") > CHUNK).select("conv_id")
    sums = chunked.where("chunk >= 0").join(several, "conv_id", "left_semi").groupBy("conv_id", "chunk")
    sums = sums.agg(*(F.sum(f"own_{p}").alias(f"from_{p}") for p in PARTS))
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(sums.withColumns({f"from_{p}": F.sum(f"from_{p}").over(earlier) for p in PARTS}))
    wide = local.join(offsets, ["conv_id", "chunk"], "left")
    limit = F.lit(1 << 32)
    total = {p: F.pmod(F.col(p) + F.coalesce(F.col(f"from_{p}"), F.lit(0)), limit) for p in PARTS}
    before = {f"before_{p}": F.pmod(F.col(p) - F.col(f"own_{p}"), limit) for p in PARTS}
    wide = wide.withColumns(total).withColumns(before)
    return wide.select("conv_id", "depth", "words", *PARTS, *before)


def ranked(links: DataFrame, last: int = LAST_ARCS) -> DataFrame:
    """(arc, at) for the one list of ``links`` (arc, next): places from 0, next NULL at the end."""
    here = links.select("arc", "next", F.lit(None).cast("long").alias("prev"), F.lit(0).cast("long").alias("gap"))
    back = links.where(F.col("next").isNotNull()).select(
        F.col("next").alias("arc"), F.lit(None).cast("long").alias("next"), F.col("arc").alias("prev"), F.lit(1).cast("long").alias("gap")
    )
    both = here.unionAll(back).groupBy("arc").agg(F.max("next").alias("next"), F.max("prev").alias("prev"), F.sum("gap").alias("gap"))
    rounds = [cut_lineage(both)]
    while rounds[-1].count() > last:
        arcs, number = rounds[-1], len(rounds)
        kept = arcs.where(~_leaves(number)).select(
            "arc", "next", "prev", "gap", *(F.lit(None).cast("long").alias(c) for c in ("new_next", "new_prev"))
        )
        empty = F.lit(None).cast("long")
        to_prev = F.struct(F.col("prev").alias("arc"), F.lit(0).cast("long").alias("gap"), F.col("next").alias("new_next"), empty.alias("new_prev"))
        to_next = F.struct(F.col("next").alias("arc"), F.col("gap").alias("gap"), empty.alias("new_next"), F.col("prev").alias("new_prev"))
        told = arcs.where(_leaves(number)).select(F.inline(F.array(to_prev, to_next)))
        told = told.select("arc", empty.alias("next"), empty.alias("prev"), "gap", "new_next", "new_prev")
        merged = kept.unionAll(told).groupBy("arc").agg(
            F.coalesce(F.max("new_next"), F.max("next")).alias("next"),
            F.coalesce(F.max("new_prev"), F.max("prev")).alias("prev"),
            F.sum("gap").alias("gap"),
        )
        rounds.append(cut_lineage(merged))

    spark, folder = links.sparkSession, fresh_path(links.sparkSession, "tour")
    paths = [f"{folder}/last"]
    rounds[-1].repartition(1).mapInArrow(_walked, "arc long, at long").write.parquet(paths[0])
    for number in range(len(rounds) - 1, 0, -1):
        known = spark.read.schema("arc long, at long").parquet(*paths)
        gone = rounds[number - 1].where(_leaves(number)).select("arc", "prev", "gap")
        back = gone.join(known.withColumnRenamed("arc", "prev"), "prev").select("arc", (F.col("at") + F.col("gap")).alias("at"))
        paths.append(f"{folder}/round-{number}")
        back.write.parquet(paths[-1])
    return spark.read.schema("arc long, at long").parquet(*paths)


def _leaves(number: int):
    """Whether an arc leaves in this round: its random number is less than both neighbours'."""
    own, before, after = (F.xxhash64(c, F.lit(number)) for c in ("arc", "prev", "next"))
    inner = F.col("prev").isNotNull() & F.col("next").isNotNull()
    return inner & (own < before) & (own < after)


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last arcs, at most ``LAST_ARCS``, followed from the first on."""
    following, gaps, first = {}, {}, None
    for batch in batches:
        columns = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("arc", "next", "prev", "gap"))
        for arc, after, before, gap in zip(*columns, strict=True):
            following[arc], gaps[arc] = after, gap
            if before is None:
                first = arc
    arcs, at, place = [], [], 0
    while first is not None:
        place += gaps[first]
        arcs.append(first)
        at.append(place)
        first = following[first]
    yield pa.RecordBatch.from_arrays([pa.array(arcs, pa.int64()), pa.array(at, pa.int64())], names=["arc", "at"])


def subtree_sums(arcs: DataFrame, values: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per node the sums of ``names`` over its subtree, from the ranked tour and the nodes' own values."""
    timed = arcs.select(F.expr("arc div 2").alias("node"), (F.col("arc") % 2 == 0).alias("enters"), "at")
    entered = timed.where("enters").join(values, "node")
    valued = entered.unionByName(timed.where("not enters"), allowMissingColumns=True)
    valued = cut_lineage(valued.withColumn("chunk", F.expr(f"at div {CHUNK}")))
    offsets = chunk_offsets(valued.groupBy("chunk").agg(*(F.sum(F.coalesce(F.col(n), F.lit(0))).alias(n) for n in names)), "chunk", names)
    offsets = cut_lineage(offsets.select("chunk", *(F.col(n).alias(f"from_{n}") for n in names)))
    inside = Window.partitionBy("chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = valued.withColumns({n: F.coalesce(F.sum(n).over(inside), F.lit(0)) for n in names}).join(offsets, "chunk")
    upto = {n: F.col(n) + F.col(f"from_{n}") for n in names}
    difference = [F.sum(F.when(F.col("enters"), -x).otherwise(x)).alias(n) for n, x in upto.items()]
    return local.groupBy("node").agg(*difference)


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the conversations (key, conv_id) that end at each node, in order of their numbers.

    Numbers are written out in pieces of ``LISTED``; a hash then goes over a
    node's pieces in order, so its task reads one row for each piece.
    """
    placed = prefix_sums(ends, KEY, ["conv_id"], {"nth": F.lit(1).cast("long")})
    piece = F.expr(f"(nth - 1) div {LISTED}")
    listed = placed.groupBy(*KEY, piece.alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    text = F.array_join(F.transform("ids", lambda c: c.cast("string")), ",")
    pieces = listed.select(*KEY, "piece", text.alias("text"))
    ordered = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece")
    return ordered.mapInArrow(_hashed, ", ".join(f"{c} long" for c in KEY) + ", ends_sha256 string")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None
    for batch in batches:
        out = []
        for *own, _, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = own, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield _digests(out)
    yield _digests([(*key, state.hexdigest())] if key is not None else [])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * (len(KEY) + 1)
    kinds = [pa.int64()] * len(KEY) + [pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[*KEY, "ends_sha256"])


def trie(turns: DataFrame, lengths: DataFrame, last: int = LAST_ARCS) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, depth from 1, digest, words).

    ``lengths`` has every conversation, those without turns too: (conv_id, length).
    """
    rows = cut_lineage(prefixes(turns, lengths))
    before = [f"before_{p}" for p in PARTS]
    inner = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("words").alias("words"),
        *(F.min(b).alias(b) for b in before),
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        *(zero.alias(k) for k in KEY), "conv_id", "n_convs", zero.alias("words"), *(none.alias(b) for b in before)
    )
    nodes = cut_lineage(inner.unionAll(root).withColumn("node", F.monotonically_increasing_id()))

    # children know their rank among siblings, and each 4096 of them meet their own copy of the parent
    above = [(F.col("depth") - 1).alias("p_depth"), *(F.col(b).alias(f"p_{p}") for b, p in zip(before, PARTS, strict=True))]
    parent_key = ["p_depth", *(f"p_{p}" for p in PARTS)]
    kids = nodes.where("depth > 0").select("node", "conv_id", *above)
    kids = prefix_sums(kids, parent_key, ["conv_id"], {"rank": F.lit(1).cast("long")})
    kids = cut_lineage(kids.withColumn("part", F.expr(f"(rank - 1) div {CHUNK}")))
    families = kids.groupBy(*parent_key).agg(F.count(F.lit(1)).alias("n_children"))
    same = [F.col(k) == F.col(f"p_{k}") for k in KEY]
    parents = nodes.select(*KEY, F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")).join(families, same)
    parents = cut_lineage(parents.select("parent", "parent_conv_id", "n_children", *parent_key))
    parts = F.explode(F.sequence(zero, F.expr(f"(n_children - 1) div {CHUNK}")))
    spread = parents.withColumn("part", parts).drop("n_children")
    linked = cut_lineage(kids.join(spread, [*parent_key, "part"]).select("node", "parent", "parent_conv_id", "rank"))

    down = nodes.select("node").join(linked.where("rank = 1").select(F.col("parent").alias("node"), F.col("node").alias("child")), "node", "left")
    down = down.select((F.col("node") * 2).alias("arc"), F.coalesce(F.col("child") * 2, F.col("node") * 2 + 1).alias("next"))
    sibling = linked.select("parent", (F.col("rank") - 1).alias("rank"), F.col("node").alias("sibling"))
    onward = linked.join(sibling, ["parent", "rank"], "left").select(
        (F.col("node") * 2 + 1).alias("arc"), F.coalesce(F.col("sibling") * 2, F.col("parent") * 2 + 1).alias("next")
    )
    end = nodes.where("depth = 0").select((F.col("node") * 2 + 1).alias("arc"), none.alias("next"))
    tour = ranked(down.unionAll(onward).unionAll(end), last)

    sized = parents.select(F.col("parent").alias("node"), "n_children")
    full = nodes.join(sized, "node", "left").withColumn("n_children", F.coalesce("n_children", zero))
    leaf = (F.col("n_children") == 0).cast("long").alias("n_leaves")
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")
    sums = subtree_sums(tour, full.select("node", leaf, saved), ["n_leaves", "saved_tokens"])

    ended = rows.join(lengths.where("length > 0"), "conv_id").where("depth = length").select(*KEY, "conv_id")
    ended = ended.unionAll(lengths.where("length = 0").select(*(zero.alias(k) for k in KEY), "conv_id"))
    digests = end_digests(ended)
    named = full.join(sums, "node").join(linked.select("node", "parent_conv_id"), "node", "left")
    return named.join(digests, list(KEY), "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame, last: int = LAST_ARCS) -> DataFrame:
    """The trie of the rebuilt conversations, a row per node."""
    turns, lengths = rebuild(cut_lineage(numbered_turns(conversations)))
    return trie(turns, lengths, last)
