"""Merkle manifest of a table by cogrouped subtree exchange.

Rows are leaves, ordered within their tree; a tree is cut into superblocks of
16 ** 3 consecutive nodes.  Upward, each superblock is reduced to its top node in
one ``applyInPandas`` group, and the tops are the next round's nodes, until every
tree has one node; the trees' roots, ordered by name, are reduced alike.
Downward, nodes and the outer path of their superblock are cogrouped, and one
function finishes the reduction, joins the inner path to the outer one and
folds every row up to the root.  A group never holds more than 4096 rows, whatever
share of the table one tree has.

A path is bytes, bottom up: for each run one byte for the own place, one for the
number of siblings, and the siblings' digests.

Defined results: a NULL value is encoded as ``-``; a NULL tree name comes first;
NULL order values come first; rows that agree in the order follow their leaf's
digest, so repeated rows stand side by side; an empty table gives no rows.
Columns besides the named ones are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tidemark.llm.prefix import prefix_sums
from tidemark.session import cut_lineage

FAN = 16
LEVELS = 3
DIGEST = 32


def leaf_digest(*values: Column) -> Column:
    """sha256, as bytes, of the values' encodings: ``-`` or byte count, colon and text."""
    texts = [v.cast("string") for v in values]
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*coded), 256))


def joined(digests: Sequence[bytes]) -> bytes:
    """Digest of a run: sha256 of its digests as hexadecimal text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def reduced(nodes: list[bytes], levels: int | None) -> list[list[bytes]]:
    """Nodes level by level, up to ``levels`` runs higher, or to a single node for None."""
    out = [nodes]
    while len(out[-1]) > 1 if levels is None else len(out) <= levels:
        out.append([joined(out[-1][i : i + FAN]) for i in range(0, len(out[-1]), FAN)])
    return out


def own_path(levels: list[list[bytes]], place: int) -> bytes:
    """The path of the node at ``place`` to the top of ``levels``."""
    path = []
    for nodes in levels[:-1]:
        first, at = place - place % FAN, place % FAN
        run = nodes[first : first + FAN]
        path.append(bytes([at, len(run) - 1]) + b"".join(run[:at]) + b"".join(run[at + 1 :]))
        place //= FAN
    return b"".join(path)


def steps(path: bytes) -> list[tuple[int, bytes]]:
    """(own place, siblings' digests) of a path, bottom up."""
    out, at = [], 0
    while at < len(path):
        end = at + 2 + DIGEST * path[at + 1]
        out.append((path[at], path[at + 2 : end]))
        at = end
    return out


def folded(node: bytes, path: bytes) -> bytes:
    """The root that ``node`` leads to with the siblings of its path."""
    for place, others in steps(path):
        cut = DIGEST * place
        node = hashlib.sha256((others[:cut] + node + others[cut:]).hex().encode()).digest()
    return node


def proof_digest(path: bytes) -> str:
    """sha256 of all siblings, bottom up, left to right."""
    return hashlib.sha256(b"".join(others for _, others in steps(path)).hex().encode()).hexdigest()


def _tops(rows: pd.DataFrame) -> pd.DataFrame:
    nodes = [bytes(n) for n in rows.sort_values("place")["node"]]
    return pd.DataFrame(
        {
            "tree": rows["tree"].iloc[:1].to_list(),
            "place": [int(rows["place"].iloc[0]) // FAN**LEVELS],
            "node": [reduced(nodes, LEVELS)[-1][0]],
            "alone": [reduced(nodes, None)[-1][0]],
        }
    )


def _with_blocks(nodes: DataFrame) -> GroupedData:
    return nodes.withColumn("block", F.expr(f"place div {FAN**LEVELS}")).groupBy("tree", "block")


def ascend(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of nodes (tree, place, node), lowest first, and (tree, node, round) of the trees' roots."""
    rounds, roots = [nodes], None
    while True:
        grouped = _with_blocks(rounds[-1].select("tree", "place", "node"))
        tops = cut_lineage(grouped.applyInPandas(_tops, "tree string, place long, node binary, alone binary"))
        # a tree that has a second superblock goes on
        more = tops.where("place = 1").select("tree")
        done = tops.join(more, "tree", "left_anti")
        done = done.select("tree", F.col("alone").alias("node"), F.lit(len(rounds) - 1).alias("round"))
        roots = done if roots is None else roots.unionAll(done)
        if more.isEmpty():
            return rounds, roots
        rounds.append(tops.join(more, "tree", "left_semi").drop("alone"))


def _paths(key, nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("place")
    first = int(nodes["place"].iloc[0])
    levels = reduced([bytes(n) for n in nodes["node"]], None if outer["top"].iloc[0] else LEVELS)
    above = bytes(outer["path"].iloc[0])
    paths = [own_path(levels, p - first) + above for p in nodes["place"]]
    return pd.DataFrame({"tree": nodes["tree"], "place": nodes["place"], "path": paths})


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The outer paths of the lowest round's superblocks: (tree, block, path, top).

    ``tops`` has (tree, path, round): the path above a tree's root and the round
    in which the tree is one superblock.
    """
    outer = None
    for number in range(len(rounds) - 1, -1, -1):
        own = tops.where(F.col("round") == number).select(
            "tree", F.lit(0).cast("long").alias("block"), "path", F.lit(True).alias("top")
        )
        outer = own if outer is None else outer.unionAll(own)
        if number:
            pair = _with_blocks(rounds[number].select("tree", "place", "node")).cogroup(outer.groupBy("tree", "block"))
            found = cut_lineage(pair.applyInPandas(_paths, "tree string, place long, path binary"))
            outer = found.select("tree", F.col("place").alias("block"), "path", F.lit(False).alias("top"))
    return outer


def _finish(key, leaves: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """A superblock's rows with their digests: inner path, outer path and fold at once."""
    leaves = leaves.sort_values("place")
    levels = reduced([bytes(n) for n in leaves["node"]], None if outer["top"].iloc[0] else LEVELS)
    above, subroot, root = (bytes(outer[c].iloc[0]) for c in ("path", "subroot", "root"))
    paths = [own_path(levels, i) + above for i in range(len(leaves))]
    claimed = [bytes(n if c is None else c) for n, c in zip(leaves["node"], leaves["claimed"], strict=True)]
    ends = [folded(c, p) for c, p in zip(claimed, paths, strict=True)]
    return pd.DataFrame(
        {
            "id": leaves["id"],
            "leaf": [bytes(n).hex() for n in leaves["node"]],
            "subroot": subroot.hex(),
            "root": root.hex(),
            "proof_sha256": [proof_digest(p) for p in paths],
            "folded_root": [e.hex() for e in ends],
            "verified": [e == root for e in ends],
            "proof": paths,
        }
    )


def manifest(
    rows: DataFrame, row_id: str, tree: str, leaf: Column, claimed: Column | None = None, proofs: bool = False
) -> DataFrame:
    """One row per row: its id, leaf, subroot, root, proof_sha256, folded_root, verified; ``proof`` if asked for.

    ``leaf`` and ``claimed`` are digests as bytes (``leaf_digest``).  Trees are
    built from ``leaf`` in the order of ``row_id``; what is folded is
    ``claimed``, where it isn't NULL, so ``verified`` tells whether it is what
    the manifest was made from.
    """
    name = F.coalesce(F.concat(F.lit("s"), F.col(tree).cast("string")), F.lit("n"))
    leaves = rows.select(
        F.col(row_id).alias("id"),
        name.alias("tree"),
        leaf.alias("node"),
        (F.lit(None).cast("binary") if claimed is None else claimed).alias("claimed"),
    )
    placed = prefix_sums(leaves, ["tree"], ["id", "node"], {"place": F.lit(1).cast("long")})
    placed = cut_lineage(placed.withColumn("place", F.col("place") - 1))
    rounds, subroots = ascend(placed)
    subroots = cut_lineage(subroots)

    upper = prefix_sums(subroots.select("tree", "node"), [], ["tree"], {"place": F.lit(1).cast("long")})
    upper = cut_lineage(upper.select(F.col("tree").alias("name"), (F.col("place") - 1).alias("place"), "node"))
    upper_rounds, roots = ascend(upper.select(F.lit("").alias("tree"), "place", "node"))
    top = roots.first()
    root = F.unhex(F.lit(top["node"].hex())) if top else F.lit(None).cast("binary")
    summit = roots.select("tree", F.unhex(F.lit("")).alias("path"), "round")
    outer = descend(upper_rounds, summit)
    pair = _with_blocks(upper_rounds[0].select("tree", "place", "node")).cogroup(outer.groupBy("tree", "block"))
    above = pair.applyInPandas(_paths, "tree string, place long, path binary").drop("tree")
    above = above.join(upper, "place").select(F.col("name").alias("tree"), "path")
    tops = cut_lineage(above.join(subroots, "tree").select("tree", "path", "round", F.col("node").alias("subroot")))

    outer = descend(rounds, tops).join(tops.select("tree", "subroot"), "tree").withColumn("root", root)
    kind = leaves.schema["id"].dataType.simpleString()
    pair = _with_blocks(placed).cogroup(outer.groupBy("tree", "block"))
    schema = (
        f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
        "verified boolean, proof binary"
    )
    if proofs:
        return pair.applyInPandas(_finish, schema).withColumnRenamed("id", row_id)
    finish = lambda key, a, b: _finish(key, a, b).drop(columns="proof")
    return pair.applyInPandas(finish, schema.removesuffix(", proof binary")).withColumnRenamed("id", row_id)
