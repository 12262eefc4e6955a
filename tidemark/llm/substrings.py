"""Removal of byte strings that a document with a smaller id has too.

Every string of ``length`` bytes holds an anchor: the least hashed run of
``ANCHOR`` bytes in it, the same one wherever the string stands.  Only anchors
travel, with a hash of all bytes that a string around them can cover.

1. Each chunk of documents sends one entry for each of its distinct (anchor,
   surrounding), with its smallest id.  Where a smaller id anywhere has the same
   surrounding, the whole of it is covered.
2. Anchors with several surroundings go on with the bytes of each, from its
   smallest document.  Their strings are sorted as suffixes by hash comparison
   and verified; a string whose smallest document is another one is covered.
3. Anchors with very many surroundings (a line that a large share of the
   documents have) would make one huge group.  They go on string by string, each
   chunk sending a distinct string once with its smallest id.

All of a document's covered bytes are then removed at once.  A group never
holds more than one entry of a key for each chunk.  Surroundings and the strings
of step 3 are told apart by 96 and 128 bits of independent hashes, the
strings of step 2 by their bytes.

Defined results: texts are UTF-8 bytes, NULL is empty; shorter documents lose
nothing; rows with one id never remove from each other; a NULL id neither
removes nor loses anything; every row comes back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, free_name, in_tasks, text_or_empty
from tidemark.llm.suffix_sort import Suffixes, powers

LENGTH = 50
ANCHOR = 20
CHUNK_BYTES = 3 << 20
#: Bytes of text whose anchors make a bucket.
ENTRY_BYTES = 8 << 20
#: Bytes of text whose questions (step 2 and 3) one task answers.
TASK_BYTES = 1 << 20
#: Chunks, buckets and answering tasks that one Spark task takes at most.
CHUNKS_PER_TASK, BUCKETS_PER_TASK, ANSWERS_PER_TASK = 16, 8, 32
#: Bytes that are hashed at a time.
STRIDE = 1 << 19
#: Surroundings of an anchor within a chunk, and in all, from which it goes on string by string.
CHUNK_HOT, ALL_HOT = 64, 20_000
COVERED, SEVERAL, HOT = 1, 2, 4
BASES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits of the number."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of each ``width`` neighbours, by doubling."""
    span = 1
    while 2 * span <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


class Hashes:
    """Prefix polynomial hashes of a byte array under both bases; ``tables`` are powers for its length at least."""

    def __init__(self, data: np.ndarray, tables: list[tuple[np.ndarray, np.ndarray]]):
        values = data.astype(np.uint64) + np.uint64(1)
        self.downs, self.prefixes = [down for _, down in tables], []
        for up, _ in tables:
            prefix = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(values * up[: len(data)], dtype=np.uint64, out=prefix[1:])
            self.prefixes.append(prefix)

    def of(self, which: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        prefix = self.prefixes[which]
        return (prefix[end] - prefix[start]) * self.downs[which][start]

    def every(self, which: int, size: int) -> np.ndarray:
        """Hash of the ``size`` bytes from each place on."""
        prefix = self.prefixes[which]
        return (prefix[size:] - prefix[:-size]) * self.downs[which][: len(prefix) - size]


class Chunk:
    """Anchors of a chunk's rows, its distinct entries and its strings at hot anchors.

    Rows are ordered by id, so the first place of an entry has its smallest id.
    """

    def __init__(self, texts: list[bytes], ids: np.ndarray, known: np.ndarray, length: int, buckets: int):
        self.length, self.left, self.strings = length, length - ANCHOR, None
        order = np.argsort(ids, kind="stable")
        self.order, self.ids = order, ids[order]
        sizes = np.array([len(texts[i]) for i in order], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.data = np.frombuffer(b"".join([texts[i] for i in order]), dtype=np.uint8)
        usable = np.flatnonzero((sizes >= length) & known[order])
        longest = int(sizes[usable].max()) if len(usable) else 0
        self.tables = [powers(base, max(longest, STRIDE) + 1) for base in BASES]
        found = []
        i = 0
        while i < len(usable):
            j = i + 1
            while j < len(usable) and self.offsets[usable[j] + 1] - self.offsets[usable[i]] <= STRIDE:
                j += 1
            found.append(self._anchors(usable[i:j], self.tables))
            i = j
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.uint64)] * 6
        self.anchor, self.around = columns[0], columns[1]
        self.row, self.at, self.low, self.end = (c.astype(np.int64) for c in columns[2:])
        self._entries(buckets)

    def _anchors(self, rows: np.ndarray, tables: list) -> tuple:
        """(anchor, surroundings' hash, row, place, surroundings' begin and end) within a stretch of rows.

        The surroundings are the strings whose least run the anchor is; they lie side by side.
        """
        first, last = self.offsets[rows[0]], self.offsets[rows[-1] + 1]
        data = self.data[first:last]
        hashes = Hashes(data, tables)
        grams = np.maximum(hashes.every(0, ANCHOR), np.uint64(1))
        begins, ends = self.offsets[rows] - first, self.offsets[rows + 1] - first
        inside = np.zeros(len(data) - self.length + 2, dtype=np.int8)
        np.add.at(inside, begins, 1)
        np.add.at(inside, ends - self.length + 1, -1)
        width = self.left + 1
        least = np.where(np.cumsum(inside[:-1]) > 0, _slide(grams, width, np.minimum), np.uint64(0))
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        at = np.flatnonzero(_slide(padded, width, np.maximum)[: len(grams)] == grams)
        own = np.lib.stride_tricks.sliding_window_view(padded, width)[at] == grams[at][:, None]
        low = at - self.left + own.argmax(axis=1)
        high = at - own[:, ::-1].argmax(axis=1) + self.length
        around = hashes.of(1, low, high) + mix((at - low).astype(np.uint64) << np.uint64(32) | (high - at).astype(np.uint64))
        row = rows[np.searchsorted(begins, at, "right") - 1]
        return mix(grams[at]), mix(around), row, at + first, low + first, high + first

    def _entries(self, buckets: int) -> None:
        """Distinct (anchor, surroundings) by bucket, anchor and surroundings."""
        both = mix(self.anchor + self.around * np.uint64(0x9E3779B97F4A7C15))
        by_both = np.argsort(both, kind="stable")
        ordered = both[by_both]
        new = np.ones(len(ordered), dtype=bool)
        new[1:] = ordered[1:] != ordered[:-1]
        first = by_both[new]
        by_anchor = np.argsort(self.anchor[first], kind="stable")
        self.first = first[by_anchor]
        number = np.empty(len(first), dtype=np.int64)
        number[by_anchor] = np.arange(len(first))
        self.entry = np.empty(len(both), dtype=np.int64)
        self.entry[by_both] = number[np.cumsum(new) - 1]
        anchor = self.anchor[self.first]
        kinds, start, times = np.unique(anchor, return_index=True, return_counts=True)
        self.crowded = np.repeat(times > CHUNK_HOT, times)
        sent = ~self.crowded
        sent[start] = True
        self.sent = np.flatnonzero(sent)
        self.spoken = np.repeat(np.arange(len(kinds)), times)
        self.speaker = np.searchsorted(self.sent, start)
        self.bucket = ((anchor >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)

    def entry_ids(self) -> np.ndarray:
        return self.ids[self.row[self.first]]

    def flags(self, sent_flags: np.ndarray) -> np.ndarray:
        """Flags of all entries from those of the sent ones; an anchor's hot flag holds for all its entries."""
        out = np.zeros(len(self.first), dtype=np.uint8)
        out[self.sent] = sent_flags
        if len(self.first):
            hot = (sent_flags[self.speaker] & HOT)[self.spoken]
            out = np.where(hot > 0, HOT, out).astype(np.uint8)
        return out

    def hot_strings(self, flags: np.ndarray) -> tuple:
        """(two hashes, smallest id) of distinct strings at hot anchors, and (string, place) of each."""
        if self.strings is None:
            self.strings = self._hot_strings(flags)
        return self.strings

    def _hot_strings(self, flags: np.ndarray) -> tuple:
        places = np.flatnonzero((flags[self.entry] & HOT) > 0)
        if not len(places):
            none = np.zeros(0, np.int64)
            return none, none, none, none, none
        low, high = self.low[places], self.end[places]
        count = high - low - self.length + 1
        start = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        row = np.repeat(self.row[places], count)
        start, unique = np.unique(start, return_index=True)
        row = row[unique]
        a, b = np.empty(len(start), np.uint64), np.empty(len(start), np.uint64)
        for r in np.unique(row):
            own = slice(*np.searchsorted(row, [r, r + 1]))
            begin, stop = self.offsets[r], self.offsets[r + 1]
            hashes = Hashes(self.data[begin:stop], self.tables)
            at = start[own] - begin
            a[own], b[own] = mix(hashes.of(0, at, at + self.length)), mix(hashes.of(1, at, at + self.length))
        order = np.lexsort((row, b, a))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
        string = np.empty(len(order), dtype=np.int64)
        string[order] = np.cumsum(new) - 1
        head = order[new]
        return a[head].view(np.int64), b[head].view(np.int64), self.ids[row[head]], string, start

    def covered(self, flags: np.ndarray, spans: dict, hot_flags: np.ndarray) -> np.ndarray:
        """Whether each byte of the chunk goes."""
        least = self.entry_ids()[self.entry]
        mine = self.ids[self.row]
        own_flags = flags[self.entry]
        cold = (own_flags & HOT) == 0
        whole = np.flatnonzero(cold & ((mine > least) | ((own_flags & COVERED) > 0)))
        starts, ends = [self.low[whole]], [self.end[whole]]
        if spans["entry"].size:
            by_entry = np.argsort(self.entry, kind="stable")
            first = np.searchsorted(self.entry[by_entry], spans["entry"], "left")
            times = np.searchsorted(self.entry[by_entry], spans["entry"], "right") - first
            which = by_entry[np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)]
            begin, stop = np.repeat(spans["start"], times), np.repeat(spans["end"], times)
            own = (mine[which] == least[which]) & cold[which]
            starts.append(self.at[which[own]] + begin[own])
            ends.append(self.at[which[own]] + stop[own])
        _, _, string_id, string, at = self.hot_strings(flags)
        if len(at):
            row = np.searchsorted(self.offsets, at, "right") - 1
            gone = (self.ids[row] > string_id[string]) | (hot_flags[string] > 0)
            starts.append(at[gone])
            ends.append(at[gone] + self.length)
        change = np.zeros(len(self.data) + 1, dtype=np.int32)
        np.add.at(change, np.concatenate(starts), 1)
        np.add.at(change, np.concatenate(ends), -1)
        return np.cumsum(change, out=change)[:-1] > 0


def _chunk(table: pa.Table, length: int, buckets: int) -> Chunk:
    ids = table["doc"].combine_chunks()
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
    return Chunk([t.encode("utf-8", "surrogatepass") for t in table["whole"].to_pylist()], numbers, known, length, buckets)


def _send(length: int, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        chunk = _chunk(table, length, buckets)
        sent = chunk.sent
        which = chunk.first[sent]
        anchor = (mix(chunk.anchor[which]) & np.uint64(0xFFFFFFFF)).astype("<u4")
        around, ids = chunk.around[which], chunk.ids[chunk.row[which]]
        hot = chunk.crowded[sent]
        bucket = chunk.bucket[sent]
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else []
        ends = [*starts[1:], len(bucket)]
        rows = [
            (int(bucket[a]), anchor[a:b].tobytes(), around[a:b].tobytes(), ids[a:b].tobytes(), np.packbits(hot[a:b]).tobytes())
            for a, b in zip(starts, ends, strict=False)
        ]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        number = table["chunk"][0].as_py()
        kinds = [pa.int64(), *[pa.binary()] * 4]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.Table.from_arrays([pa.array([number] * len(rows), pa.int64()), *arrays], names=["chunk", *ENTRY[1:]])

    return run


ENTRY = ["chunk", "bucket", "anchors", "arounds", "docs", "hots"]


def _numbers(table: pa.Table, column: str, dtype: str) -> np.ndarray:
    """Numbers of a binary column, one row's after the other's."""
    return np.frombuffer(b"".join(table[column].to_pylist()), dtype=dtype)


def _judge(table: pa.Table) -> pa.Table:
    """Flags for each entry of a bucket: smaller id elsewhere, several surroundings, very many."""
    table = table.sort_by("chunk")
    anchor = _numbers(table, "anchors", "<u4")
    around, ids = _numbers(table, "arounds", "<u8"), _numbers(table, "docs", "<i8")
    sizes = (pc.binary_length(table["anchors"]).to_numpy() // 4).tolist()
    hot = np.concatenate(
        [np.unpackbits(np.frombuffer(h, np.uint8))[:n] for h, n in zip(table["hots"].to_pylist(), sizes, strict=True)]
    ).astype(bool)
    order = np.lexsort((ids, around, anchor))
    a, c = anchor[order], around[order]
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    new_class = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
    class_of, anchor_of = np.cumsum(new_class) - 1, np.cumsum(new_anchor) - 1
    least = ids[order][new_class][class_of]
    classes = np.bincount(anchor_of[new_class])[anchor_of]
    crowded = (np.bincount(anchor_of, hot[order]) > 0)[anchor_of] | (classes > ALL_HOT)
    flag = np.where(ids[order] > least, COVERED, 0) | np.where(classes > 1, SEVERAL, 0)
    flags = np.empty(len(order), dtype=np.uint8)
    flags[order] = np.where(crowded, HOT, flag)
    cuts = np.cumsum(sizes)[:-1]
    return pa.table(
        {
            "chunk": table["chunk"],
            "kind": pa.array([0] * len(sizes), pa.int32()),
            "part": table["bucket"],
            "flags": pa.array([x.tobytes() for x in np.split(flags, cuts)], pa.binary()),
            "starts": pa.array([None] * len(sizes), pa.binary()),
            "ends": pa.array([None] * len(sizes), pa.binary()),
        }
    )


ANSWER = "chunk long, kind int, part long, flags binary, starts binary, ends binary"


def _sent_flags(chunk: Chunk, answers: pa.Table) -> np.ndarray:
    rows = answers.filter(pc.equal(answers["kind"], 0)).sort_by("part")
    return _numbers(rows, "flags", "u1")


def _ask(length: int, buckets: int):
    """Surroundings of anchors that have several, and strings of hot anchors."""

    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["key", "second", "doc", "chunk", "entry", "around", "left"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32()]
        if not table.num_rows:
            return pa.Table.from_arrays([pa.array([], k) for k in kinds], names=names)
        chunk = _chunk(table, length, buckets)
        number = table["chunk"][0].as_py()
        flags = chunk.flags(_sent_flags(chunk, answers))
        asked = np.flatnonzero(((flags & SEVERAL) > 0) & ((flags & (COVERED | HOT)) == 0))
        which = chunk.first[asked]
        low, end = chunk.low[which], chunk.end[which]
        a, b, ids, _, _ = chunk.hot_strings(flags)
        data = chunk.data.tobytes()
        arounds = [data[x:y] for x, y in zip(low.tolist(), end.tolist(), strict=True)]
        many = len(asked) + len(a)
        columns = [
            np.concatenate([chunk.anchor[which].view(np.int64), a]),
            np.concatenate([np.zeros(len(asked), np.int64), b]),
            np.concatenate([chunk.ids[chunk.row[which]], ids]),
            np.full(many, number),
            np.concatenate([asked, np.arange(len(a))]),
            [*arounds, *[None] * len(a)],
            np.concatenate([chunk.at[which] - low, np.full(len(a), -1)]),
        ]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


ASKED = "key long, second long, doc long, chunk long, entry long, around binary, left int"


def covered_strings(table: pa.Table, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of covered stretches, relative to the anchor, for rows of (key, around, left, doc)."""
    key, left, ids = (table[c].to_numpy() for c in ("key", "left", "doc"))
    arounds = table["around"].to_pylist()
    sizes = np.array([len(x) for x in arounds])
    width = int(sizes.max())
    rows = np.frombuffer(b"".join(x.ljust(width, b"\0") for x in arounds), dtype=np.uint8).reshape(-1, width)
    count = sizes - length + 1
    row = np.repeat(np.arange(len(arounds)), count)
    start = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    shift = start - left[row]
    order = np.lexsort((row, shift, key[row]))
    row, start, shift = row[order], start[order], shift[order]
    group = key[row]
    segment = np.cumsum(np.concatenate([[True], (group[1:] != group[:-1]) | (shift[1:] != shift[:-1])])) - 1
    suffixes = Suffixes(rows, row, start, length)
    sharing = suffixes.sharing(segment)
    row, start, shift, segment = row[sharing], start[sharing], shift[sharing], segment[sharing]
    suffixes.row, suffixes.start = row, start
    order, run = suffixes.equal_runs(segment)
    if not len(order):
        return order, order, order
    least = np.full(run[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, run, ids[row[order]])
    gone = order[ids[row[order]] > least[run]]
    gone = gone[np.lexsort((shift[gone], row[gone]))]
    row, shift = row[gone], shift[gone]
    if not len(row):
        return row, row, row
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (shift[1:] > shift[:-1] + length)])
    last = np.append(np.flatnonzero(new)[1:] - 1, len(row) - 1)
    return row[new], shift[new], shift[last] + length


def _answer(length: int):
    """Covered stretches of surroundings (kind 1), and whether strings have a smaller id (kind 2)."""

    def run(table: pa.Table) -> pa.Table:
        outs = []
        left = table["left"].to_numpy()
        if (left >= 0).any():
            own = table.filter(pa.array(left >= 0))
            row, start, end = covered_strings(own, length)
            chunk, entry = own["chunk"].to_numpy()[row], own["entry"].to_numpy()[row]
            outs += _packed(1, chunk, entry, start.astype("<i4"), end.astype("<i4"))
        if (left < 0).any():
            own = table.filter(pa.array(left < 0))
            a, b, ids = (own[c].to_numpy() for c in ("key", "second", "doc"))
            order = np.lexsort((ids, b, a))
            new = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
            least = ids[order][new][np.cumsum(new) - 1]
            gone = order[ids[order] > least]
            zero = np.zeros(len(gone), dtype="<i4")
            outs += _packed(2, own["chunk"].to_numpy()[gone], own["entry"].to_numpy()[gone], zero, zero)
        columns = list(zip(*outs, strict=True)) or [[]] * 6
        kinds = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 3]
        names = ["chunk", "kind", "part", "flags", "starts", "ends"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _packed(kind: int, chunk, entry, start, end) -> list[tuple]:
    """One row for each chunk, with its entries, starts and ends as bytes."""
    order = np.argsort(chunk, kind="stable")
    chunk, entry, start, end = chunk[order], entry[order].astype("<i8"), start[order], end[order]
    cuts = np.flatnonzero(np.concatenate([[True], chunk[1:] != chunk[:-1]])) if len(chunk) else []
    return [
        (int(chunk[a]), kind, 0, entry[a:b].tobytes(), start[a:b].tobytes(), end[a:b].tobytes())
        for a, b in zip(cuts, [*cuts[1:], len(chunk)], strict=False)
    ]


def _finish(length: int, buckets: int, rest: list[str], as_text: bool, fields: pa.Schema):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return fields.empty_table()
        chunk = _chunk(table, length, buckets)
        flags = chunk.flags(_sent_flags(chunk, answers))

        def joined(kind: int, column: str, dtype: str) -> np.ndarray:
            rows = answers.filter(pc.equal(answers["kind"], kind))
            return _numbers(rows, column, dtype).astype(np.int64)

        spans = {c: joined(1, b, d) for c, b, d in (("entry", "flags", "<i8"), ("start", "starts", "<i4"), ("end", "ends", "<i4"))}
        strings = joined(2, "flags", "<i8")
        hot_flags = np.zeros(int(strings.max()) + 1 if len(strings) else 0, dtype=np.uint8)
        hot_flags[strings] = 1
        many = len(chunk.hot_strings(flags)[0])
        hot_flags = np.concatenate([hot_flags, np.zeros(max(0, many - len(hot_flags)), np.uint8)])
        gone = chunk.covered(flags, spans, hot_flags)
        kept, found, sizes = [None] * table.num_rows, [None] * table.num_rows, [0] * table.num_rows
        for place, original in enumerate(chunk.order):
            a, b = chunk.offsets[place], chunk.offsets[place + 1]
            mask, data = gone[a:b], chunk.data[a:b]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
            found[original] = [{"start": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2], strict=True)]
            stays = data[~mask].tobytes() if len(edges) else data.tobytes()
            kept[original] = stays.decode("utf-8", "ignore") if as_text else stays
            sizes[original] = int(b - a)
        made = [pa.array(sizes, pa.int64()), pa.array(found, fields.field("spans").type), pa.array(kept, fields.field("kept").type)]
        return pa.Table.from_arrays([*(table[c] for c in rest), *made], names=fields.names)

    return run


def remove_repeats(
    df: DataFrame, length: int = LENGTH, as_text: bool = False, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns but the text, with (n_bytes, spans, kept): byte spans removed and the bytes that stay.

    ``as_text`` gives them as text, without the parts of characters that a cut leaves.
    """
    bounded_batches(df.sparkSession)
    rest = [c for c in df.columns if c != text]
    size = df.agg(F.sum(F.octet_length(text_or_empty(text)))).first()[0] or 0
    chunks, buckets = max(1, -(-size // CHUNK_BYTES)), max(1, -(-size // ENTRY_BYTES))
    renamed = [f"c{i}" for i in range(len(rest))]
    docs = df.select(
        *(F.col(f"`{c}`").alias(n) for c, n in zip(rest, renamed, strict=True)),
        F.col(doc_id).cast("long").alias("doc"),
        text_or_empty(text).alias("whole"),
    ).withColumn("chunk", F.pmod(F.xxhash64("doc", "whole"), F.lit(chunks)).cast("long"))
    by_chunk = in_tasks(docs, "chunk", chunks, CHUNKS_PER_TASK).groupBy("chunk")
    entries = by_chunk.applyInArrow(
        _send(length, buckets), "chunk long, bucket long, anchors binary, arounds binary, docs binary, hots binary"
    )
    flags = in_tasks(entries, "bucket", buckets, BUCKETS_PER_TASK).groupBy("bucket").applyInArrow(_judge, ANSWER)
    asked = by_chunk.cogroup(flags.groupBy("chunk")).applyInArrow(_ask(length, buckets), ASKED)
    tasks = max(1, -(-size // TASK_BYTES))
    dealt = asked.withColumn("task", F.pmod(F.xxhash64("key", "second"), F.lit(tasks)).cast("int"))
    answers = in_tasks(dealt, "task", tasks, ANSWERS_PER_TASK).groupBy("task").applyInArrow(_answer(length), ANSWER)
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*renamed).schema]
    schema = ", ".join(
        [*kinds, "n_bytes long", "spans array<struct<start:bigint,end:bigint>>", "kept " + ("string" if as_text else "binary")]
    )
    fields = pa.schema(
        [pa.field(n, pa.null()) for n in renamed]
        + [
            pa.field("n_bytes", pa.int64()),
            pa.field("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            pa.field("kept", pa.string() if as_text else pa.binary()),
        ]
    )
    both = flags.unionAll(answers)
    found = by_chunk.cogroup(both.groupBy("chunk")).applyInArrow(_finish(length, buckets, renamed, as_text, fields), schema)
    names = [free_name(df.drop(text), n) for n in ("n_bytes", "spans", "kept")]
    return found.toDF(*rest, *names)
