"""Packing of tokenized documents into windows by non-negative least squares.

Documents are cut into whole windows and a rest shorter than a window.  The
histogram of rests (at most one number per length) is all that the driver
sees: shallow combinations of lengths that fill a window exactly are
enumerated, their repeat counts are solved by non-negative least squares,
rounded down to what the histogram holds, and what is left is packed greedily,
first in combinations that fill a window, then as one stream that is cut at
window ends.  The stream's last tokens go to windows of power-of-two lengths,
which need no padding.  Documents find their place by their rank among the
rests of the same length, so nothing is gathered per document.

Defined results: NULL and empty texts are documents of the end token alone; an
empty table gives no pieces; repeated rows are packed once each; NULL ids stay
NULL.  Any vocabulary and window may be given.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.bpe import WordBpe, encoder_of, shared
from tidemark.llm.common import bounded_batches, text_or_empty
from tidemark.session import cut_lineage

WINDOW = 2048
END_ID = 1
#: Combinations of three lengths are enumerated among this many lengths with the most tokens.
TRIPLE_LENGTHS = 96
SWEEPS = 60
#: Pieces of rests that are cut go to all tasks up to this many, some 100 bytes each; beyond it, by a shuffle.
BROADCAST_CUTS = 100_000


class LibraryBpe(WordBpe):
    """Words and cache as in the encoder, ids of a new word by the tokenizers library."""

    def __init__(self, spec: str):
        super().__init__(spec)
        self.model = Tokenizer.from_str(spec).model

    def id_type(self) -> str:
        """Bytes in which any id fits, the end token's included."""
        return "<u2" if max(END_ID, *self.tokens) < 1 << 16 else "<u4"

    def ids(self, word: str) -> list[int]:
        if word in self.special:
            return [self.special[word]]
        letters = self.letters
        return [t.id for t in self.model.tokenize("".join([letters[b] for b in word.encode("utf-8")]))]


@dataclass
class Plan:
    """Where the rests of each length go, by their rank.

    ``slots`` rows are (length, first rank, last rank + 1, first sequence, offset);
    ``stream`` rows are (length, first rank, first stream position).
    """

    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    stream: list[tuple[int, int, int]] = field(default_factory=list)
    stream_sequence: int = 0
    stream_tokens: int = 0


def combinations(histogram: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Two or three lengths of the histogram that fill the window exactly."""
    have = np.flatnonzero(histogram)
    present = set(have.tolist())
    found = {(window,)} if window in present else set()
    found |= {(a, window - a) for a in present if 2 * a <= window and window - a in present}
    heavy = sorted(have[np.argsort(-(have * histogram[have]), kind="stable")][:TRIPLE_LENGTHS].tolist())
    for i, a in enumerate(heavy):
        for b in heavy[i:]:
            if (c := window - a - b) > 0 and c in present:
                found.add(tuple(sorted((a, b, c))))
    return sorted(found)


def repeat_counts(columns: list[tuple[int, ...]], histogram: np.ndarray) -> np.ndarray:
    """Non-negative x with least squares of (uses of each length) - histogram, by coordinate descent."""
    x = np.zeros(len(columns))
    left = histogram.astype(float)
    uses = [np.unique(c, return_counts=True) for c in columns]
    for _ in range(SWEEPS):
        most = 0.0
        for j, (lengths, times) in enumerate(uses):
            step = max(float(times @ left[lengths]) / float(times @ times), -x[j])
            if step:
                x[j] += step
                left[lengths] -= step * times
                most = max(most, abs(step))
        if most < 0.25:
            break
    return x


def plan_windows(histogram: np.ndarray, window: int, first_sequence: int) -> Plan:
    """Slots for the rests counted in ``histogram`` (index: length)."""
    left = histogram.astype(np.int64).copy()
    rank = np.zeros_like(left)
    plan, sequence = Plan(), first_sequence

    def place(lengths: tuple[int, ...], count: int) -> None:
        nonlocal sequence
        offset = 0
        for length in lengths:
            start = int(rank[length])
            plan.slots.append((length, start, start + count, sequence, offset))
            rank[length] += count
            left[length] -= count
            offset += length
        sequence += count

    def available(lengths: tuple[int, ...]) -> int:
        return min(int(left[v]) // int(n) for v, n in zip(*np.unique(lengths, return_counts=True), strict=True))

    columns = combinations(histogram, window)
    solved = repeat_counts(columns, histogram)
    for j in np.argsort(-solved, kind="stable"):
        count = min(int(solved[j]), available(columns[j]))
        if count:
            place(columns[j], count)
    # greedy: the longest rest with the longest that still fit, as often as all of them last
    for length in range(window, 0, -1):
        while left[length]:
            lengths, gap = [length], window - length
            left[length] -= 1
            while gap:
                fits = np.flatnonzero(left[1 : gap + 1])
                if not len(fits):
                    break
                lengths.append(int(fits[-1]) + 1)
                left[lengths[-1]] -= 1
                gap -= lengths[-1]
            for v in lengths:
                left[v] += 1
            if gap:
                break
            place(tuple(lengths), max(1, available(tuple(lengths))))
    plan.stream_sequence = sequence
    for length in np.flatnonzero(left).tolist():
        plan.stream.append((length, int(rank[length]), plan.stream_tokens))
        plan.stream_tokens += length * int(left[length])
    return plan


def stream_pieces(start: int, length: int, total: int, window: int) -> list[tuple[int, int, int, int]]:
    """Cuts of a stream piece: (start within the piece, length, sequence number, offset).

    Whole windows first; the last ``total % window`` tokens fill windows of falling powers of two.
    """
    whole, out, at = total // window * window, [], start
    while at < start + length:
        if at < whole:
            sequence, begin, size = at // window, at // window * window, window
        else:
            sequence, begin, tail = whole // window, whole, total - whole
            while True:
                size = 1 << (tail.bit_length() - 1)
                if at < begin + size:
                    break
                sequence, begin, tail = sequence + 1, begin + size, tail - size
        end = min(start + length, begin + size)
        out.append((at - start, end - at, sequence, at - begin))
        at = end
    return out


def tokenized(df: DataFrame, spec_path: str, window: int, doc_id: str, text: str) -> DataFrame:
    """Per document: its ids, and its ranks within its task among whole windows and equal rests."""
    bounded_batches(df.sparkSession)
    spec = shared(df.sparkSession, spec_path)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches):
        encoder = encoder_of(spec, LibraryBpe)
        kept_as = encoder.id_type()
        cache = encoder.cached("bytes", lambda ids: np.array(ids, dtype="<u4").tobytes())
        part, number, wholes = TaskContext.get().partitionId(), 0, 0
        seen = np.zeros(window, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows: list[tuple] = []
            blobs = [b"".join([*cache.of(value), end]) for value in batch.column(1).to_pylist()]
            for blob in blobs:
                n = len(blob) // 4
                rest = n % window
                crcs = [zlib.crc32(blob[i : i + 4 * window]) for i in range(0, 4 * n, 4 * window)]
                rows.append((part, number, n, wholes, rest, int(seen[rest]), crcs))
                number, wholes = number + 1, wholes + n // window
                seen[rest] += 1
            *numbers, crcs = zip(*rows, strict=True)
            narrow = [np.frombuffer(blob, dtype="<u4").astype(kept_as).tobytes() for blob in blobs]
            columns = [
                batch.column(0),
                *(pa.array(x, pa.int64()) for x in numbers),
                pa.array(crcs, pa.list_(pa.int64())),
                pa.array(narrow, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "part", "row", "n", "whole_rank", "rest", "rest_rank", "crcs", "ids"]
    slim = df.select(df[doc_id].alias("doc_id"), text_or_empty(text).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(
        run,
        f"doc_id {kind}, part long, row long, n long, whole_rank long, rest long, rest_rank long, "
        "crcs array<long>, ids binary",
    )


def pack(
    df: DataFrame, spec_path: str, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece: its document, place in it, checksum of its ids, sequence and offset there."""
    kept = cut_lineage(tokenized(df, spec_path, window, doc_id, text))
    parts = kept.groupBy("part", "rest").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.floor(F.col("n") / window)).alias("wholes")
    )
    parts = cut_lineage(parts)
    totals = parts.groupBy("rest").agg(F.sum("rows").alias("rows"), F.sum("wholes").alias("wholes")).collect()
    histogram = np.zeros(window + 1, dtype=np.int64)
    for row in totals:
        histogram[row["rest"]] += row["rows"]
    histogram[0] = 0
    plan = plan_windows(histogram, window, sum(row["wholes"] for row in totals))

    earlier = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rest_from = parts.select("part", "rest", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rest_from"))
    by_part = parts.groupBy("part").agg(F.sum("wholes").alias("wholes"))
    whole_from = _running_offsets(by_part)
    slim = kept.drop("ids").join(rest_from, ["part", "rest"]).join(whole_from, "part")
    placed = slim.mapInArrow(_placer(plan, window), _placed_schema(kept))
    placed = cut_lineage(placed)
    uncut = placed.where(F.col("crc").isNotNull()).withColumnRenamed("crc", "ids_crc32").drop("part", "row")
    cuts = placed.where(F.col("crc").isNull()).drop("crc")
    # each window of the stream cuts one rest at most, into two pieces; its last ones more
    if 2 * (plan.stream_tokens // window + window.bit_length()) <= BROADCAST_CUTS:
        cuts = F.broadcast(cuts)
    ids = kept.select("part", "row", "ids")
    cut = ids.join(cuts, ["part", "row"]).mapInArrow(_checksums(uncut.columns), uncut.schema)
    return uncut.unionByName(cut).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def _running_offsets(by_part: DataFrame) -> DataFrame:
    """Whole windows before each task's own: summed in blocks of tasks first, then within a block."""
    block = F.floor(F.col("part") / 1000)
    blocked = by_part.withColumn("block", block)
    sums = blocked.groupBy("block").agg(F.sum("wholes").alias("block_wholes"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("block", F.coalesce(F.sum("block_wholes").over(before), F.lit(0)).alias("block_from"))
    inside = Window.partitionBy("block").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return blocked.withColumn("inside", F.coalesce(F.sum("wholes").over(inside), F.lit(0))).join(sums, "block").select(
        "part", (F.col("block_from") + F.col("inside")).alias("whole_from")
    )


def _placed_schema(kept: DataFrame) -> str:
    kind = kept.schema["doc_id"].dataType.simpleString()
    return (
        f"doc_id {kind}, part long, row long, start long, length long, crc long, doc_tokens long, "
        "sequence_id long, offset long"
    )


def _placer(plan: Plan, window: int):
    slots: dict[int, tuple[np.ndarray, list]] = {}
    for slot in plan.slots:
        slots.setdefault(slot[0], ([], []))[1].append(slot)
    slots = {k: (np.array([s[1] for s in v]), v) for k, (_, v) in slots.items()}
    stream = {length: (rank, position) for length, rank, position in plan.stream}

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            take, rows = [], []
            columns = ("part", "row", "n", "whole_rank", "whole_from", "rest", "rest_rank", "rest_from", "crcs")
            values = zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns), strict=True)
            for i, (part, row, n, whole_rank, whole_from, rest, rest_rank, rest_from, crcs) in enumerate(values):
                for j in range(n // window):
                    rows.append((part, row, j * window, window, crcs[j], n, whole_from + whole_rank + j, 0))
                if rest:
                    start, rank = n - rest, rest_from + rest_rank
                    if rest in stream and rank >= stream[rest][0]:
                        at = stream[rest][1] + (rank - stream[rest][0]) * rest
                        cuts = stream_pieces(at, rest, plan.stream_tokens, window)
                        for begin, length, sequence, offset in cuts:
                            crc = crcs[-1] if len(cuts) == 1 else None
                            rows.append(
                                (part, row, start + begin, length, crc, n, plan.stream_sequence + sequence, offset)
                            )
                    else:
                        firsts, own = slots[rest]
                        _, first, _, sequence, offset = own[int(np.searchsorted(firsts, rank, "right")) - 1]
                        rows.append((part, row, start, rest, crcs[-1], n, sequence + rank - first, offset))
                take.extend([i] * (len(rows) - len(take)))
            made = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
            names = ["doc_id", "part", "row", "start", "length", "crc", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(take, pa.int64())), *made], names=names)

    return run


def _checksums(names: list[str]):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            get = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            crcs = []
            for ids, start, length, n in zip(
                *(get[c].to_pylist() for c in ("ids", "start", "length", "doc_tokens")), strict=True
            ):
                own = np.frombuffer(ids, dtype=f"<u{len(ids) // n}")[start : start + length]
                crcs.append(zlib.crc32(own.astype("<u4").tobytes()))
            get["ids_crc32"] = pa.array(crcs, pa.int64())
            yield pa.RecordBatch.from_arrays([get[c] for c in names], names=names)

    return run
