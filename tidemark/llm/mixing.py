"""Mixing sources to target weights by hash-random keys, range sorts and prefix sums; DataFrame functions only.

Every document gets a key that is random but the same in each run (md5 of seed,
id and text).  Keys are spread evenly, so equal ranges of them hold about equally
many rows: a source is sorted range by range, a range's words are added up by a
window, and one row per range carries the sums on.  A source gives its documents
whole as often as its budget holds all its words, and the rest of the budget is
cut from the sorted documents at the exact word.

Targets: source number i (by code point, NULL last) weighs ``weights[i % n]``.
The mix has ``share`` times all words; a target is at most ``most`` times its
source's words, and what it can't take is shared out again by weight.

Defined results: NULL text has no words; NULL sources are one source; rows with
NULL ids are told apart by their texts; rows that agree on id, text and source
are interchangeable and each is counted; sources without words get target 0; an
empty table gives no rows.  Other columns of the documents travel only where
``carry`` names them, inside one struct ``document``, so no name can clash;
columns of maps can't be carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.prefix import prefix_sums
from tidemark.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Rows of a key range: so many at least, and more where that would make over 65,536 ranges.
RANGE_ROWS = 2048
RANGES = 65_536
#: The six separators of words.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words of a text, each shrunk to one letter and the letters counted; 0 for NULL."""
    letters = F.translate(F.regexp_replace(text, WORD, "x"), SPACES, "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("long")


def source_targets(
    sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``sources`` (source, source_size, more) with ``number`` and ``target``.

    Sharing the excess again until none is above its limit ends at one level:
    every source gets weight x level or its limit.  Ordered by limit per weight,
    the level is that of the first source that stays below its limit.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be above 0")
    numbered = prefix_sums(sources, [], [F.col("source").asc_nulls_last()], {"number": F.lit(1)})
    weight = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int")
    )
    limited = numbered.withColumn("weight", weight).withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    ratio = F.col("limit") / F.col("weight")
    filled = prefix_sums(
        limited.withColumn("ratio", ratio),
        [],
        ["ratio", "number"],
        {"limits": F.col("limit"), "weights": F.col("weight")},
    )
    filled = cut_lineage(filled)
    words, heavy = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    rest = F.lit(share * (words or 0)) - (F.col("limits") - F.col("limit"))
    left = F.lit(heavy or 0.0) - (F.col("weights") - F.col("weight"))
    below = filled.where(F.col("ratio") * left >= rest).select("ratio", "number", rest.alias("rest"), left.alias("left"))
    level = below.agg(F.min(F.struct("ratio", "number", "rest", "left"))).first()[0]
    target = F.col("limit")
    if level is not None:
        # the source itself is the first of those that share what is left
        target = F.least(target, F.col("weight") * F.lit(level["rest"]) / F.lit(level["left"]))
    return filled.withColumn("target", target).select(*sources.columns, "number", "target")


def mix(
    documents: DataFrame,
    *,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 0,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    carry: Sequence[str] = (),
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken and, if carried, ``document``.

    ``taken`` counts words, repeats included: the text ``taken // size`` times,
    then its first ``taken % size`` words.
    """
    whole = F.col(text).cast("string")
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), name, F.md5(F.coalesce(whole, F.lit("")))))
    carried = [F.struct(*(F.col(c) for c in carry)).alias("document")] if carry else []
    sized = cut_lineage(
        documents.select(
            F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"),
            word_count(whole).alias("size"),
            key.alias("key"),
            *carried,
        )
    )
    sources = cut_lineage(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows")))
    rows = sources.agg(F.sum("rows")).first()[0] or 0
    held = max(range_rows, -(-rows // RANGES))
    targets = source_targets(sources, weights, share, most)
    targets = cut_lineage(targets.withColumn("ranges", F.ceil(F.col("rows") / held).cast("long")).drop("rows"))

    named = targets.select(F.col("source").alias("named"), "number", "ranges")
    at = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("ranges")
    ranged = sized.join(named, F.col("source").eqNullSafe(F.col("named"))).withColumn(
        "range", F.shiftright(at, 32)
    ).drop("source", "named", "ranges")
    # rows that are wholly alike are one row until their shares are dealt out
    alike = ranged.groupBy("number", "range", "key", "size", "doc_id", *(["document"] if carry else []))
    alike = alike.agg(F.count(F.lit(1)).alias("copies"))
    order = ["key", "size", "doc_id", *(["document"] if carry else [])]
    earlier = Window.partitionBy("number", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("copies") * F.col("size")
    placed = alike.withColumn("inside", F.coalesce(F.sum(words).over(earlier), F.lit(0)))

    ahead = Window.partitionBy("number").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("number", "range").agg(F.sum("size").alias("words"))
    offsets = offsets.select("number", "range", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    offsets = offsets.join(targets.drop("ranges"), "number")

    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as long) div source_size")).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    before = F.col("ahead") + F.col("inside") + F.col("copy") * F.col("size")
    cut = F.least(F.greatest(rest - before, F.lit(0)), F.col("size"))
    each = placed.join(offsets, ["number", "range"]).withColumn(
        "copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    )
    return each.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (epochs * F.col("size") + cut).cast("long").alias("taken"),
        *(["document"] if carry else []),
    )


def mixed_texts(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: doc_id, source, epoch (from 0), words, and the text cut after so many words.

    ``mixed`` is the result of ``mix`` that carries ``text``.  Documents of which
    nothing is taken give no row.
    """
    epochs = F.expr("(taken + size - 1) div size")
    each = mixed.where("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)))
    words = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size"))
    each = each.withColumn("words", words).withColumn("whole", F.col("document")[text].cast("string"))
    # what follows the wanted words is the last piece of a split that stops after them
    trimmed = F.regexp_replace("whole", r"^[\x20\x09-\x0D]+", "")
    pieces = F.split(trimmed, r"[\x20\x09-\x0D]+", F.col("words").cast("int") + 1)
    behind = F.length(F.element_at(pieces, -1))
    start = F.rtrim(F.translate(F.substring(trimmed, F.lit(1), F.length(trimmed) - behind), SPACES, " " * len(SPACES)))
    cut = F.substring(trimmed, F.lit(1), F.length(start))
    return each.select(
        "doc_id", "source", "epoch", "words", F.when(F.col("words") < F.col("size"), cut).otherwise(F.col("whole")).alias("text")
    )
