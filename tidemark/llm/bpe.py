"""Byte-pair encoding of words by a contiguous rank array, and decoding.

A word is held as its part boundaries with, beside each boundary, the rank of
the merge that would join the part starting there with the next one.  The
smallest rank is found by a scan, the boundary after it is deleted, and the
ranks of the two neighbouring places are looked up anew.  Encoded words
are kept in a bounded cache; texts are joined from them.

Defined results: a NULL or empty text has no ids, digest of the empty string;
special tokens written out in a text are taken as their ids, as the public
tokenizers library does; characters without a vocabulary entry are left out.
Rows keep their number and repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tidemark.llm.common import free_name, with_text_column

NO_MERGE = 1 << 60
GONE = -2
#: Longer words look for their smallest rank in a heap, as scans would take time in the square of the length.
SHORT_WORD = 200
CACHED_WORDS = 150_000

#: Fixed value: the pre-tokenizer's pattern, with white space and classes by Unicode property.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"

#: The same for lower-cased text of Latin-1 characters, which is in NFC as it stands.
LATIN = r"a-zªµºß-öø-ÿ", r"0-9²³¹¼-¾"
LATIN_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[{0}]+|[{1}]|[^ \t-\r\x85\xa0{0}{1}]+".format(*LATIN))
NOT_LATIN = re.compile("[^\x00-\xff]")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 for itself, others from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in set(kept) else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Vocabulary, merge ranks and a bounded cache of encoded words."""

    def __init__(self, spec: str):
        tokenizer = json.loads(spec)
        model = tokenizer["model"]
        self.vocab: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        letters = byte_letters()
        self.letters = letters
        self.inner = [self.vocab.get(x, -1) for x in letters]
        self.last = [self.vocab.get(x + end, -1) for x in letters]
        pairs = [(self.vocab[a], self.vocab[b], self.vocab[a + b]) for a, b in model["merges"]]
        self.merges = {(a, b): rank for rank, (a, b, _) in enumerate(pairs)}
        self.joined = [c for _, _, c in pairs]
        special = {t["content"]: t["id"] for t in tokenizer.get("added_tokens", ())}
        self.special = special
        self.special_at = (
            regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
            if special
            else None
        )
        self.pieces = regex.compile(PIECES)
        self.caches: dict[str, WordCache] = {}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in special.items()}

    def symbols(self, word: str) -> list[int]:
        """Vocabulary ids of the word's bytes, the last one with the end mark; -1 for none."""
        data = word.encode("utf-8")
        return [*(self.inner[b] for b in data[:-1]), self.last[data[-1]]]

    def parts(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges, least rank first and leftmost among equals."""
        if len(symbols) > SHORT_WORD:
            return self._parts_long(symbols)
        part, merges = list(symbols), self.merges
        ranks = [merges.get((a, b), NO_MERGE) for a, b in zip(part, part[1:], strict=False)]
        ranks.append(NO_MERGE)
        while (least := min(ranks)) < NO_MERGE:
            i = ranks.index(least)
            part[i] = self.joined[least]
            del part[i + 1], ranks[i + 1]
            ranks[i] = merges.get((part[i], part[i + 1]), NO_MERGE) if i + 1 < len(part) else NO_MERGE
            if i:
                ranks[i - 1] = merges.get((part[i - 1], part[i]), NO_MERGE)
        return part

    def _parts_long(self, symbols: list[int]) -> list[int]:
        part, size = list(symbols), len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < size and (rank := self.merges.get((part[i], part[j]))) is not None:
                heapq.heappush(heap, (rank, i, part[i], part[j]))

        for i in range(size):
            offer(i)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if part[i] != left or j >= size or part[j] != right:
                continue
            part[i], part[j] = self.joined[rank], GONE
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in part if p != GONE]

    def ids(self, word: str) -> list[int]:
        """Ids of one pre-tokenized word, or of a special token."""
        if word in self.special:
            return [self.special[word]]
        return [i for i in self.parts(self.symbols(word)) if i >= 0]

    def words(self, text: str) -> Iterable[str]:
        """The text's words in order; a special token stands for itself."""
        if self.special_at is None or not self.special_at.search(text):
            return self._split(text)
        out: list[str] = []
        for i, segment in enumerate(self.special_at.split(text)):
            out.extend([segment] if i % 2 else self._split(segment))
        return out

    def _split(self, text: str) -> list[str]:
        if text.isascii() or not NOT_LATIN.search(text):
            return LATIN_PIECES.findall(text.lower())
        # each character's own lower case: no rule for a sigma at a word's end
        return self.pieces.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)

    def encode(self, text: str) -> list[int]:
        return [i for word in self.words(text) for i in self.ids(word)]

    def cached(self, name: str, make: Callable[[list[int]], object]) -> WordCache:
        """The cache of that name."""
        if name not in self.caches:
            self.caches[name] = WordCache(self, make)
        return self.caches[name]


class WordCache(dict):
    """word -> what ``make`` returns for its ids; emptied when it has grown to its bound."""

    def __init__(self, bpe: WordBpe, make: Callable[[list[int]], object]):
        super().__init__()
        self.bpe, self.make = bpe, make

    def __missing__(self, word: str) -> object:
        found = self.make(self.bpe.ids(word))
        if len(word) <= SHORT_WORD:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = found
        return found

    def of(self, text: str) -> list:
        return list(map(self.__getitem__, self.bpe.words(text)))


def load(path: str) -> WordBpe:
    with open(path, encoding="utf-8") as file:
        return WordBpe(file.read())


def shared(spark: SparkSession, path: str) -> Broadcast:
    """The vocabulary file's text as a broadcast of a few MB, whatever the data."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast({"spec": file.read()})


def encoder_of(spec: Broadcast, kind: type[WordBpe] = WordBpe) -> WordBpe:
    """The encoder of this worker process, which keeps it and its cache from task to task."""
    kept = spec.value
    if kind.__name__ not in kept:
        kept[kind.__name__] = kind(kept["spec"])
    return kept[kind.__name__]


def encode(df: DataFrame, spec_path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """All columns plus the ids of the whole text as array<int>."""
    spec = shared(df.sparkSession, spec_path)

    def make():
        cache = encoder_of(spec).cached("bytes", lambda ids: np.array(ids, dtype="<i4").tobytes())

        def ids(texts: list[str]) -> pa.Array:
            blobs = [b"".join(cache.of(t)) for t in texts]
            offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in blobs])]).astype(np.int32)
            return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(blobs), dtype="<i4")))

        return ids

    return with_text_column(df, out, ArrayType(IntegerType()), make, text)


def decode(df: DataFrame, spec_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns plus the text of the id column: the tokens joined by one space, as without a decoder.

    A NULL is decoded to the empty text; ids without a token are left out.
    """
    spec = shared(df.sparkSession, spec_path)

    def texts(batches):
        bpe = encoder_of(spec)
        for batch in batches:
            if batch.num_rows:
                *kept, own = batch.columns
                found = pa.array([bpe.decode(x or ()) for x in own.to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*kept, found], names=places)

    wide = df.select(*(F.col(f"`{c}`") for c in df.columns), F.col(f"`{ids}`").alias(free_name(df, "own_ids")))
    places = [f"c{i}" for i in range(len(wide.columns))]
    fields = [StructField(p, f.dataType) for p, f in zip(places, df.schema, strict=False)]
    return wide.mapInArrow(texts, StructType([*fields, StructField(places[-1], StringType())])).toDF(*df.columns, out)


def digests(df: DataFrame, spec_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: number of ids, digest of the ids as text, digest of the text decoded from them.

    Ids and decoded text are joined from each distinct word's own, so neither
    is held for more than one document at a time.
    """
    spec = shared(df.sparkSession, spec_path)
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kind = StructType([StructField(names[0], LongType()), *(StructField(n, StringType()) for n in names[1:])])

    def make():
        bpe = encoder_of(spec)
        cache = bpe.cached("texts", lambda ids: _texts(bpe, ids))

        def found(texts: list[str]) -> pa.Array:
            counts, encoded, decoded = [], [], []
            for value in texts:
                own = [x for x in cache.of(value) if x]
                counts.append(sum([x[0] for x in own]))
                encoded.append(_sha256(" ".join([x[1] for x in own])))
                decoded.append(_sha256(" ".join([x[2] for x in own])))
            return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(encoded), pa.array(decoded)], names)

        return found

    slim = df.select(df[doc_id].alias("doc_id"), df[text].alias("text"))
    return with_text_column(slim, "found", kind, make).select("doc_id", *(f"found.{n}" for n in names))


def _texts(bpe: WordBpe, ids: list[int]) -> tuple[int, str, str] | None:
    return (len(ids), " ".join(map(str, ids)), bpe.decode(ids)) if ids else None


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()
