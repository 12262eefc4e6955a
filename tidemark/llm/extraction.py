"""Main text of pages by differencing each page with its nearest one.

Every page is cut into text blocks.  Within a host, pages are ordered by the
path of their address; a page's nearest is the neighbour in that order with the
longer common beginning.  The two pages' blocks are aligned by their longest
common subsequence, and shared blocks are template text, which goes.  Markup that
names its purpose (menus, forms, adverts, comments and the like) is no main text
whatever the other page says.  Where a page marks its article, blocks within are
the author's own words: a passage that two articles quote stays, but a line that
both neighbours have in the same place, counted from their articles' beginning or
end, is template and goes.  What lies outside goes too, unless the article holds
but a small share of the text that the nearest page doesn't have; then it is a
teaser, and the difference decides outside.  Where the nearest shares nearly all of a page, it is either a copy
of the article or has the same long template: the other neighbour in the order
tells, as only the template is in all three.  If that leaves nothing or there is
no other neighbour (a host's first and last page), the page stays as it is.  Three near copies side by side,
without a marked article, can't be told from a template.

Defined results: NULL and empty html give an empty text; pages without a host
form one group; a host's only page is cleaned by its markup alone; repeated rows
come back as often as given.
"""

from __future__ import annotations

import html
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ARROW_BYTES, bounded_batches, host_of, text_or_empty
from tidemark.session import fresh_path

#: What stands between the blocks of a text.
SEPARATOR = "\n\n"
#: From this share of a page's characters on, a shared text may be a copy of the same article.
COPY_SHARE = 0.8
#: An article with less than this share of a page's own characters is a teaser.
TEASER_SHARE = 0.3
#: Bits of an alignment's rows held at once.
ROW_BITS = 1 << 28

NAME = re.compile(r"<(/?)([A-Za-z][^\s/>]{0,99})(?=[\s/>])")
REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
NAMES = re.compile(r"(?<![\w:.-])(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
HIDDEN = re.compile(r"(?:^|\s)(?:hidden(?=[\s/>=]|$)|aria-hidden\s*=\s*[\"']?true)|display\s*:\s*none", re.I)
SPACE = re.compile(r"\s+")

# Elements by their purpose.
RAW = set("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter nobr picture "
    "q rp rt ruby s samp small source span strike strong sub sup time tt u var wbr".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CHROME = set(
    "nav footer aside form button select option fieldset dialog menu script style noscript template iframe "
    "textarea head title object canvas svg math audio video".split()
)
ARTICLE = {"article", "main"}

#: A chosen list: words of class, id and role that name an element as no main text.
PURPOSE = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice alert comment comments commentlist reply replies disqus discussion sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead topbar toolbar share sharing social related "
    "recommended newsletter subscribe signup login search popup modal overlay widget pagination pager skip "
    "complementary contentinfo navigation dialog".split()
)

#: Words that also name parts of an article's text; they count as whole names only.
COMMON = set("ad ads alert comment header menu notice related reply share side skip social".split())


class Brackets:
    """Where tags of a broken page end: every quote and bracket is looked at once, however many tags ask."""

    def __init__(self, markup: str):
        self.markup = markup
        self.places = [m.start() for m in re.finditer("[>\"']", markup)]
        self.ends: dict[int, int] = {}

    def end(self, at: int) -> int:
        """The place of the bracket that closes a tag whose attributes begin at ``at``; -1 if none does."""
        i, passed, end = bisect_left(self.places, at), [], -1
        while i < len(self.places):
            place = self.places[i]
            if place in self.ends:
                end = self.ends[place]
                break
            passed.append(place)
            if self.markup[place] == ">":
                end = place
                break
            shut = self.markup.find(self.markup[place], place + 1)
            if shut < 0:
                break
            i = bisect_left(self.places, shut + 1)
        self.ends.update(dict.fromkeys(passed, end))
        return end


def tokens(markup: str) -> Iterator[tuple[str | None, bool, str]]:
    """(tag, closing, attributes) of tags and (None, raw, text) of text, in time in proportion to the page.

    A sign that opens no tag is text.  Comments and declarations give nothing;
    one that never ends takes in the rest of the page, or its first sign is text.
    """
    at, size, brackets = 0, len(markup), None
    last, last_data = markup.rfind(">"), markup.rfind("]]>")
    while at < size:
        sign = markup.find("<", at)
        if sign != at:
            yield None, False, markup[at : size if sign < 0 else sign]
            if sign < 0:
                return
            at = sign
        if markup.startswith("<!--", at):
            end = markup.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        if at + 9 <= last_data and markup.startswith("<![CDATA[", at):
            end = markup.find("]]>", at + 9)
            yield None, True, markup[at + 9 : end]
            at = end + 3
            continue
        if at + 2 <= last and markup[at + 1] in "!?":
            at = markup.find(">", at + 2) + 1
            continue
        name = NAME.match(markup, at) if at < last else None
        if name:
            if brackets is None:
                rest = REST.match(markup, name.end())
                if rest is None:
                    brackets = Brackets(markup)
                end = rest.end() - 1 if rest else -1
            else:
                end = brackets.end(name.end())
            if end >= 0:
                yield name[2].lower(), bool(name[1]), markup[name.end() : end]
                at = end + 1
                continue
        yield None, False, "<"
        at += 1


def names_purpose(attributes: str, article: bool) -> bool:
    """Whether a class, id, role or itemprop names an element as no main text.

    Whole names count; of a class outside an article, the first and last word too.
    """
    for name, value in NAMES.findall(attributes):
        for whole in value.strip("\"'").lower().split():
            if whole in PURPOSE:
                return True
            words = re.split(r"[^a-z]+", whole)
            if name.lower() == "class" and not article and {words[0], words[-1]} & (PURPOSE - COMMON):
                return True
    return False


def blocks(markup: str) -> list[tuple[str, bool, bool]]:
    """Text blocks in page order: (text, named as no main text, inside a marked article)."""
    out: list[tuple[str, bool, bool]] = []
    pieces: list[str] = []
    stack: list[tuple[str, bool, bool]] = []
    chrome = article = False
    skip_to = ""

    def flush() -> None:
        if pieces:
            text = SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                out.append((text, chrome, article))

    for tag, closing, rest in tokens(markup):
        if tag is None:
            if not skip_to:
                pieces.append(html.escape(rest) if closing else rest)
            continue
        if skip_to:
            if closing and tag == skip_to:
                skip_to = ""
            continue
        if tag == "br" or tag == "img":
            pieces.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if closing:
            if tag in VOID:
                continue
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    if stack[depth][1:] != (chrome, article):
                        flush()
                    chrome, article = stack[depth][1:]
                    del stack[depth:]
                    break
            continue
        if tag in VOID or rest.endswith("/") and tag not in INLINE and tag in RAW:
            continue
        if tag in RAW:
            skip_to = tag
            continue
        inner_chrome, inner_article = chrome, article
        if tag in ARTICLE or (rest and re.search(r"articleBody|role\s*=\s*[\"']?main\b", rest)):
            inner_article = True
        elif tag in CHROME or tag == "header" and not article:
            inner_chrome = True
        elif rest and tag not in ("html", "body"):
            if names_purpose(rest, article) or HIDDEN.search(rest):
                inner_chrome = True
        if (inner_chrome, inner_article) != (chrome, article):
            flush()
        if tag in ("p", "li", "td", "th", "tr", "option", "dt", "dd"):  # end at the next of their kind
            while stack and stack[-1][0] == tag:
                chrome, article = stack.pop()[1:]
        stack.append((tag, chrome, article))
        chrome, article = inner_chrome, inner_article
    flush()
    return out


def shared_lines(own: list[str], other: list[str]) -> set[int]:
    """Places in ``own`` of a longest common subsequence with ``other``.

    Common beginnings and ends are set aside first.
    """
    least = min(len(own), len(other))
    ahead = next((i for i in range(least) if own[i] != other[i]), least)
    least -= ahead
    behind = next((i for i in range(least) if own[-1 - i] != other[-1 - i]), least)
    inner = _aligned(own[ahead : len(own) - behind], other[ahead : len(other) - behind])
    return {*range(ahead), *(ahead + i for i in inner), *range(len(own) - behind, len(own))}


def _lengths(own: list[str], other: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each beginning of ``own`` with all of ``other``."""
    where: dict[str, int] = {}
    for i, line in enumerate(own):
        where[line] = where.get(line, 0) | 1 << i
    full = row = (1 << len(own)) - 1
    for line in other:
        if line in where:
            hit = row & where[line]
            row = ((row + hit) | (row - hit)) & full
    packed = np.frombuffer(row.to_bytes(-(-len(own) // 8), "little"), np.uint8)
    unset = 1 - np.unpackbits(packed, bitorder="little")[: len(own)]
    return np.concatenate([[0], np.cumsum(unset, dtype=np.int64)])


def _aligned(own: list[str], other: list[str]) -> set[int]:
    """As ``shared_lines``, by bit-parallel rows; where they would take much memory, by halves of ``other``."""
    if len(own) * len(other) <= ROW_BITS or len(other) < 2:
        return _aligned_rows(own, other)
    middle = len(other) // 2
    upper = _lengths(own, other[:middle]) + _lengths(own[::-1], other[middle:][::-1])[::-1]
    cut = int(np.argmax(upper))
    return _aligned(own[:cut], other[:middle]) | {cut + i for i in _aligned(own[cut:], other[middle:])}


def _aligned_rows(own: list[str], other: list[str]) -> set[int]:
    where: dict[str, int] = {}
    for i, line in enumerate(own):
        where[line] = where.get(line, 0) | 1 << i
    kept = [line for line in other if line in where]
    full = (1 << len(own)) - 1
    rows = [full]
    for line in kept:
        row = rows[-1]
        hit = row & where[line]
        rows.append(((row + hit) | (row - hit)) & full)
    found, i, j = set(), len(own), len(kept)
    while i and j:
        if own[i - 1] == kept[j - 1]:
            i, j = i - 1, j - 1
            found.add(i)
        elif rows[j] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return found


Blocks = list[tuple[str, bool, bool]]


def same_places(own: Blocks, other: Blocks) -> set[int]:
    """Places in ``own`` of article lines that stand as far from the beginning or end of ``other``'s article."""
    mine = [i for i, (_, chrome, article) in enumerate(own) if article and not chrome]
    theirs = [text for text, chrome, article in other if article and not chrome]
    ahead = {i for i, text in zip(mine, theirs, strict=False) if own[i][0] == text}
    return ahead | {i for i, text in zip(mine[::-1], theirs[::-1], strict=False) if own[i][0] == text}


def main_lines(own: Blocks, near: Blocks | None, second: Blocks | None = None) -> list[str]:
    """Blocks that stay when the page is compared with its nearest page, and with its other neighbour."""
    lines = [text for text, _, _ in own]
    shared = shared_lines(lines, [b[0] for b in near]) if near else set()
    plain = [i for i, (_, chrome, _) in enumerate(own) if not chrome]

    def size(places) -> int:
        return sum(len(lines[i]) for i in places)

    article = [i for i in plain if own[i][2]]
    if article:
        template = same_places(own, near) & same_places(own, second) if near and second else set()
        if size(template) >= COPY_SHARE * size(article):
            template = set()
        kept = [i for i in article if i not in template]
        outside = [i for i in plain if not own[i][2] and i not in shared] if near else []
        if size(kept) < TEASER_SHARE * size(kept + outside):
            kept = sorted(kept + outside)
        return [lines[i] for i in kept]
    if size(i for i in plain if i in shared) >= COPY_SHARE * size(plain):
        shared = shared & shared_lines(lines, [b[0] for b in second]) if second else set()
        if shared.issuperset(plain):
            shared = set()
    return [lines[i] for i in plain if i not in shared]


def _common(a: str, b: str) -> int:
    for i, (x, y) in enumerate(zip(a, b, strict=False)):
        if x != y:
            return i
    return min(len(a), len(b))


def _coded(own: Blocks) -> list[str]:
    """Blocks as lines: a digit for both flags and the text, which has no line end."""
    return [f"{2 * chrome + article}{text}" for text, chrome, article in own]


def _blocks_of(lines: list[str] | None) -> Blocks | None:
    return None if lines is None else [(x[1:], x[0] in "23", x[0] in "13") for x in lines]


def _pack(own: Blocks) -> bytes:
    """Blocks on their way through the shuffle."""
    return zlib.compress("\n".join(_coded(own)).encode(), 1)


def _unpack(data: bytes) -> Blocks:
    lines = zlib.decompress(data).decode()
    return _blocks_of(lines.split("\n")) if lines else []


def _packer(edges: list[tuple[str, str, int]]):
    """Pages with their blocks in place of the markup, and the number of the range that their address is in."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                host, path, key = (batch.column(i).to_pylist() for i in range(3))
                ranges = [bisect_right(edges, x) for x in zip(host, path, key, strict=True)]
                packed = pa.array([_pack(blocks(m)) for m in batch.column(5).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:5], packed, pa.array(ranges, pa.int32())],
                    names=[*batch.schema.names[:5], "packed", "range"],
                )

    return run


def _edges(read: DataFrame, count: int) -> list[tuple[str, str, int]]:
    """First address of each range but the first, of ``count`` about equal ones; only addresses are read."""
    if count < 2:
        return []
    order = ["host", "path", "key"]
    dealt = read.select(*order).repartitionByRange(count, *order)
    firsts = dealt.groupBy(F.spark_partition_id()).agg(F.min(F.struct(*order)).alias("first")).collect()
    return sorted(tuple(r["first"]) for r in firsts)[1:]


def _nearer(row: tuple, before: tuple | None, after: tuple | None) -> tuple[tuple | None, tuple | None]:
    """The neighbours, (host, path, ...), in the row's own host: the longer common path first, the earlier of equals."""
    near = [x for x in (before, after) if x is not None and x[0] == row[0]]
    near.sort(key=lambda x: -_common(row[1], x[1]))
    return (*near, None, None)[:2]


def _border_pairs(borders: list) -> list[tuple[int, int | None, int | None]]:
    """(key, key of the nearest, key of the other neighbour) of the tasks' first (kind 0), last (1) and only (2) rows, in order of the tasks."""
    own = [(r["host"], r["path"], r["key"]) for r in borders]
    pairs = []
    for i, r in enumerate(borders):
        inner = None if r["inner_key"] is None else (r["host"], r["inner_path"], r["inner_key"])
        before = inner if r["kind"] == 1 else own[i - 1] if i else None
        after = inner if r["kind"] == 0 else own[i + 1] if i + 1 < len(own) else None
        near, second = _nearer(own[i], before, after)
        pairs.append((r["key"], near and near[2], second and second[2]))
    return pairs


def _neighbours(batches):
    """Texts of pages that come sorted by host and path; a task's first and last page are left for later.

    Rows (kind 3) have their text.  The others have their blocks, and the neighbour they have in the task.
    """
    part, rows, held = TaskContext.get().partitionId(), [], []

    def made(page, near, second) -> tuple:
        host, path, key, page_id, url, own = page
        text = SEPARATOR.join(main_lines(own, near and near[5], second and second[5]))
        return (part, 3, key, page_id, url, text, *[None] * 6)

    def border(kind, page, inner) -> tuple:
        host, path, key, page_id, url, own = page
        inner = inner if inner and inner[0] == host else None
        near = (inner[2], inner[1], _coded(inner[5])) if inner else (None, None, None)
        return (part, kind, key, page_id, url, None, host, path, _coded(own), *near)

    def batch_of(rows) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        kinds = [pa.int64(), pa.int32(), pa.int64(), page_kind, pa.string(), pa.string(), pa.string(), pa.string()]
        kinds += [pa.list_(pa.string()), pa.int64(), pa.string(), pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=COLUMNS)

    page_kind, seen, characters = None, 0, 0
    for batch in batches:
        page_kind = batch.column(3).type
        for *page, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append((*page, _unpack(packed)))
            seen += 1
            if len(held) == 3:
                before, page, after = held
                rows.append(made(page, *_nearer(page, before, after)))
                characters += len(rows[-1][5])
                del held[0]
                if characters > ARROW_BYTES:  # a batch of packed pages may hold many times its bytes of text
                    yield batch_of(rows)
                    rows, characters = [], 0
            elif seen == 2:
                rows.append(border(0, held[0], held[1]))
        if rows:
            yield batch_of(rows)
            rows, characters = [], 0
    if seen == 1:
        yield batch_of([border(2, held[0], None)])
    elif seen:
        yield batch_of([border(1, held[1], held[0])])


COLUMNS = (
    "part kind key page_id url text host path lines inner_key inner_path inner_lines".split()
)


def _differences(batches):
    for batch in batches:
        if batch.num_rows:
            columns = [batch.column(i).to_pylist() for i in range(2, 5)]
            texts = [SEPARATOR.join(main_lines(*map(_blocks_of, three))) for three in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", markup: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Pages are dealt by range of host and path and sorted, so that a large host
    spreads over tasks and neighbours lie side by side.  Each task's first and
    last page meet their neighbours of other tasks afterwards: their addresses in
    the driver, two for each task, and their blocks by a join.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    address = F.coalesce(F.col("url"), F.lit(""))
    read = pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).cast("string").alias("url"),
        text_or_empty(markup).alias("markup"),
    ).select(
        host_of(F.col("url")).alias("host"),
        F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?([^#]*)", 1).alias("path"),
        F.monotonically_increasing_id().alias("key"),
        "page_id",
        "url",
        "markup",
    )
    order, kind = ["host", "path", "key"], read.schema["page_id"].dataType.simpleString()
    edges = _edges(read, max(1, read.rdd.getNumPartitions()))
    packed = read.mapInArrow(
        _packer(edges), f"host string, path string, key long, page_id {kind}, url string, packed binary, range int"
    )
    dealt = packed.repartitionById(len(edges) + 1, F.col("range")).drop("range").sortWithinPartitions(*order)
    schema = (
        f"part long, kind int, key long, page_id {kind}, url string, text string, host string, path string, "
        "lines array<string>, inner_key long, inner_path string, inner_lines array<string>"
    )
    path = fresh_path(spark, "pages")
    dealt.mapInArrow(_neighbours, schema).write.option("compression", "zstd").parquet(path)
    cut = spark.read.parquet(path)
    borders = cut.where("kind < 3")
    listed = borders.select("part", "kind", "key", "host", "path", "inner_key", "inner_path")
    pairs = spark.createDataFrame(_border_pairs(listed.orderBy("part", "kind").collect()), "key long, near long, second long")
    met, others = borders.join(pairs, "key"), []
    for name in ("near", "second"):
        met = met.join(borders.select(F.col("key").alias(name), F.col("lines").alias(f"{name}_lines")), name, "left")
        inner = F.when(F.col(name) == F.col("inner_key"), F.col("inner_lines"))
        others.append(inner.otherwise(F.col(f"{name}_lines")).alias(f"{name}_lines"))
    met = met.select("page_id", "url", "lines", *others)
    late = met.mapInArrow(_differences, f"page_id {kind}, url string, text string")
    found = cut.where("kind = 3").select("page_id", "url", "text").unionAll(late)
    return found.withColumn("n_chars", F.length("text").cast("long"))
