"""Tables that a SQL text reads, as a column expression.

The text is cut into tokens by one pattern, so that comments, strings and quoted
names are whole before anything is looked for in them; a fold over the tokens then
follows FROM lists and joins, bracket by bracket.  Both run in Arrow batches, so a
column of queries is scanned in parallel like any other: the texts of a batch are cut
together, and the fold is a table of moves that takes all of them one token on at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The tokens of a query, and the words that matter to its FROM lists.
COMMENT = rb"--[^\n]*+|/\*(?s:.*?)(?:\*/|\Z)"
TEXT = rb"'[^']*+(?:''[^']*+)*+(?:'|\Z)"
QUOTED = rb"\"[^\"]*+(?:\"\"[^\"]*+)*+\"|`[^`]*+`|\[[^\[\]]*+\]"
DIGITS = "".join(c for c in map(chr, range(0x20000)) if c.isnumeric() and not c.isalpha())  # Unicode's class N
WORD = rf"[^\W{DIGITS}][\w$]*+"
NUMBER = rf"[{DIGITS}][\w.]*+"
FROM_FUNCTIONS = ("EXTRACT", "SUBSTRING", "TRIM", "OVERLAY", "POSITION")
CLAUSES = (
    "SELECT", "WHERE", "GROUP", "HAVING", "ORDER", "LIMIT", "OFFSET", "FETCH", "WINDOW", "QUALIFY",
    "UNION", "INTERSECT", "EXCEPT", "MINUS", "VALUES", "SET", "RETURNING",
)
BEFORE_TABLE = ("LATERAL", "ONLY", "TABLE")

#: Places of a bracket level: outside FROM, at a table's place, after a table, in a function that has a FROM of its own.
OUTSIDE, WANTED, LISTED, OWN_FROM = 0, 1, 2, 3

#: Kinds of the words and signs that matter, 0 is any other word. Those from FROM to TABLE name no table.
OPENS, CLOSES, COMMA, DOT, FROM, JOIN, CLAUSE, TABLE, WITH, RECURSIVE, AS, FUNCTION, DISTINCT = range(1, 14)
KINDS = {
    OPENS: ("(",), CLOSES: (")",), COMMA: (",",), DOT: (".",), FROM: ("FROM",), JOIN: ("JOIN", "STRAIGHT_JOIN"),
    CLAUSE: CLAUSES, TABLE: BEFORE_TABLE, WITH: ("WITH",), RECURSIVE: ("RECURSIVE",), AS: ("AS", "MATERIALIZED"),
    FUNCTION: FROM_FUNCTIONS, DISTINCT: ("DISTINCT",),
}
OTHER, SIGN, QUOTE = 0, 14, 15  # SIGN stands for all that has no name, QUOTE for a quoted name
KIND_OF = {word: kind for kind, words in KINDS.items() for word in words} | {"!": SIGN, '"': QUOTE}

#: What the token before leaves behind: nothing, a table's name, or such a name and a dot.
PLAIN, FRESH, DOTTED = 0, 1, 2

# What is hidden from the cut, a lone quote too; each alternative begins with a fixed sign, so that the search is short.
HIDDEN = re.compile(b"(" + COMMENT + b"|" + TEXT + b"|" + QUOTED + b'|")')
WORDS = re.compile(f"({WORD}|[(),.\"])|{NUMBER}|[^ \t\n\x0b\f\r]")

# Signs of ASCII texts by class, which cuts them into pieces; the pieces that are keys, and what they are.
BLANK, SINGLE, LETTER = 0, 1, 2
CLASS = np.full(256, SINGLE, np.uint8)
CLASS[[*b" \t\n\x0b\f\r"]] = BLANK
CLASS[[c for c in range(128) if chr(c).isalnum() or c == ord("_")]] = LETTER
KEYS, KEY_KINDS = pa.array(KIND_OF), np.array([*KIND_OF.values(), OTHER], np.uint8)

# Bytes of texts that are cut together, and how many of them, the longest, are folded one by one.
SLICE_BYTES, ALONE = 1 << 20, 32


def _state(level: int, before: int, flag: int) -> int:
    """Number of a state; a token's kind is added to find its move."""
    return ((level * 14 + before) * 3 + flag) * 16


def _moves() -> tuple[list[int], list[int], dict[int, tuple]]:
    """Next state by state and kind, inverted where more is to be done; the state after the bracket's end; the deeds.

    For names: does it go on the last table, is it a table, does it start a CTE, does it
    start one if there is a list of them at this depth.  For an opening bracket: does it
    make the last table a function, can it begin a CTE's body.
    """
    moves, after, deeds = [], [], {}
    for level in (OUTSIDE, WANTED, LISTED, OWN_FROM):
        for before in range(14):
            for flag in (PLAIN, FRESH, DOTTED):
                state = _state(level, before, flag)
                for kind in range(16):
                    named = kind not in (OPENS, CLOSES, COMMA, DOT, SIGN)
                    goes_on = named and flag == DOTTED
                    table = named and not goes_on and level == WANTED and not FROM <= kind <= TABLE
                    starts = named and before in (WITH, RECURSIVE) and kind != RECURSIVE
                    lists = named and before == COMMA and level == OUTSIDE
                    is_from = kind == FROM and level != OWN_FROM and before != DISTINCT
                    if kind == OPENS:
                        new = WANTED if level == WANTED else OWN_FROM if before == FUNCTION else OUTSIDE
                    elif is_from or kind == JOIN or kind == COMMA and level == LISTED:
                        new = WANTED
                    elif table:
                        new = LISTED
                    elif kind == CLAUSE and level != OWN_FROM:
                        new = OUTSIDE
                    else:
                        new = level
                    left = FRESH if goes_on or table else DOTTED if kind == DOT and flag == FRESH else PLAIN
                    move = _state(new, kind if kind < SIGN else OTHER, left)
                    deed = (flag == FRESH, before == AS) if kind == OPENS else (goes_on, table, starts, lists)
                    if any(deed):
                        deeds[state + kind] = deed
                    moves.append(~move if any(deed) or kind in (OPENS, CLOSES) else move)
                    after.append(_state(LISTED if level == WANTED else level, CLOSES, PLAIN))
    return moves, after, deeds


MOVES, AFTER, DEEDS = _moves()
NEXT, BEHIND, NOTED = np.array(MOVES, np.int32), np.array(AFTER, np.int32), np.isin(np.arange(len(MOVES)), [*DEEDS])


def _plain(text: bytes) -> tuple[bytes, list[bytes]]:
    """A text without comments, its strings as ! and its quoted names as \", and these names."""
    parts, quoted = HIDDEN.split(text), []
    for place in range(1, len(parts), 2):
        part = parts[place]
        first = part[:1]
        if first == b"-" or first == b"/":
            parts[place] = b" "
        elif first == b"'" or len(part) < 3:
            parts[place] = b"!"
        else:
            parts[place] = b'"'
            quoted.append(part)
    return b"".join(parts), quoted


def _cut(plains: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes, np.ndarray]:
    """Kinds, starts and ends of the tokens of ASCII texts, the bytes that they stand in, and each text's first token.

    Every byte belongs to a piece: a run of letters and digits, a sign or a run of blanks.
    What follows a number up to the next sign but a dot is part of it.
    """
    data = b"\n".join(plains)
    raw = data.upper()
    signs = np.frombuffer(raw, np.uint8)
    classes = CLASS[signs]
    begins = np.r_[True, (classes[1:] != classes[:-1]) | (classes[1:] == SINGLE)][: len(data)]
    starts = np.flatnonzero(begins)
    edges = np.r_[starts, len(data)].astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(raw))
    key = pc.fill_null(pc.index_in(pieces, KEYS), -1).to_numpy(zero_copy_only=False)
    first, kind = signs[starts], classes[starts]
    number = (kind == LETTER) & (first <= ord("9"))
    kinds = np.where((key < 0) & ((kind == SINGLE) | number), SIGN, KEY_KINDS[key])
    kept = kind != BLANK
    dot = first == ord(".")
    if (number[:-1] & dot[1:]).any():
        linked = (kind == LETTER) | dot
        run = np.cumsum(~(linked & np.r_[False, linked[:-1]])) - 1
        before = np.cumsum(number) - number
        opening = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        kept &= ~linked | (before == before[opening][run])
    starts, ends = starts[kept], edges[1:][kept]
    lengths = np.fromiter(map(len, plains), np.int64, len(plains))
    firsts = np.searchsorted(starts, np.cumsum(lengths + 1) - lengths - 1)
    return kinds[kept], starts, ends, data, firsts


def _alone(kinds: Iterable[int], first: int = 0) -> list[tuple[int, int, int]]:
    """The deeds of one text: place, state and kind, depth."""
    moves, noted, state, upper = MOVES, [], _state(OUTSIDE, OTHER, PLAIN), []
    for place, kind in enumerate(kinds, first):
        met = state + kind
        state = moves[met]
        if state < 0:
            state = ~state
            if met in DEEDS:
                noted.append((place, met, len(upper)))
            if kind == OPENS:
                upper.append(AFTER[met])
            elif kind == CLOSES and upper:
                state = upper.pop()
    return noted


def _together(kinds: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The deeds of many texts, all of them one token on in each step; the few longest go alone."""
    counts = np.diff(np.r_[firsts, len(kinds)])
    order = np.argsort(-counts, kind="stable")
    alone, order = order[:ALONE], order[ALONE:]
    notes = [note for i in alone for note in _alone(kinds[firsts[i] : firsts[i] + counts[i]].tolist(), firsts[i])]
    noted = [np.array(notes, np.int64).reshape(-1, 3)]
    firsts, counts = firsts[order], counts[order]
    falling = -counts
    state, depth = np.full(len(order), _state(OUTSIDE, OTHER, PLAIN), np.int32), np.zeros(len(order), np.int64)
    upper = np.empty(len(kinds), np.int32)  # a text's states stand from its first token's place on
    for step in range(counts[0] if len(order) else 0):
        rows = np.searchsorted(falling, -step)  # those that go on
        places = firsts[:rows] + step
        met = state[:rows] + kinds[places]
        move = NEXT[met]
        state[:rows] = move ^ (move >> 31)
        acts = np.flatnonzero(move < 0)
        met = met[acts]
        does = NOTED[met]
        if does.any():
            noted.append(np.stack((places[acts[does]], met[does], depth[acts[does]]), axis=1))
        opens, closes = met % 16 == OPENS, acts[met % 16 == CLOSES]
        opened, closed = acts[opens], closes[depth[closes] > 0]
        upper[firsts[opened] + depth[opened]] = BEHIND[met[opens]]
        depth[opened] += 1
        depth[closed] -= 1
        state[closed] = upper[firsts[closed] + depth[closed]]
    noted = np.concatenate(noted)
    return noted[np.argsort(noted[:, 0], kind="stable")]


def _tables(noted: Iterable[tuple[int, int, str]]) -> list[str]:
    """Tables of a text from its deeds in order: state and kind, depth, name."""
    out, own, candidate, at = [], set(), None, 0
    for met, depth, name in noted:
        if met % 16 == OPENS:
            calls, follows = DEEDS[met]
            if calls:
                out.pop()  # a function that gives rows is no table
            if follows and candidate is not None and at == depth + 1:
                own.add(candidate.lower())
            continue
        goes_on, table, starts, lists = DEEDS[met]
        if starts or lists and depth < at:
            candidate, at = name, depth + 1
        if goes_on:
            out[-1] += f".{name}"
        elif table:
            out.append(name)
    return list(dict.fromkeys([name for name in out if name.lower() not in own] if own else out))


def _unquoted(name: bytes) -> str:
    return name[1:-1].replace(b'""', b'"').decode("utf-8", "replace")


def _tables_of_simple(plains: list[bytes], quoted: list[list[bytes]]) -> Iterator[list[str]]:
    """Tables of texts of ASCII signs, which are cut together."""
    kinds, starts, ends, data, firsts = _cut(plains)
    text, (places, met, depth) = data.decode(), _together(kinds, firsts).T
    names = [text[low:high] for low, high in zip(starts[places].tolist(), ends[places].tolist(), strict=True)]
    all_quoted, number = [name for own in quoted for name in own], np.cumsum(kinds == QUOTE) - 1
    for note in np.flatnonzero(kinds[places] == QUOTE).tolist():
        names[note] = _unquoted(all_quoted[number[places[note]]])
    met, depth, bounds = met.tolist(), depth.tolist(), np.searchsorted(places, np.r_[firsts, len(kinds)]).tolist()
    for low, high in zip(bounds, bounds[1:]):
        yield _tables(zip(met[low:high], depth[low:high], names[low:high], strict=True))


def _tables_of_other(plain: bytes, quoted: list[bytes]) -> list[str]:
    """Tables of a text with other letters or $, cut by the pattern."""
    words = [word or "!" for word in WORDS.findall(plain.decode("utf-8", "replace"))]
    kinds, own = [KIND_OF.get(word.upper(), OTHER) for word in words], iter(quoted)
    names = [_unquoted(next(own)) if kind == QUOTE else word for kind, word in zip(kinds, words, strict=True)]
    return _tables((met, depth, names[place]) for place, met, depth in _alone(kinds))


def _tables_of_slice(texts: list[tuple[bytes, list[bytes]]]) -> list[list[str]]:
    simple = [plain.isascii() and b"$" not in plain for plain, _ in texts]
    cut = [text for text, ascii_only in zip(texts, simple, strict=True) if ascii_only]
    found = _tables_of_simple([plain for plain, _ in cut], [quoted for _, quoted in cut])
    return [next(found) if ascii_only else _tables_of_other(*text) for text, ascii_only in zip(texts, simple, strict=True)]


def _tables_of_texts(texts: pa.Array) -> pa.Array:
    """Tables of a batch of texts, slice by slice; NULL stays NULL."""
    found, held, size = [], [], 0
    for text in texts.drop_null().cast(pa.large_binary()).to_pylist():
        held.append(_plain(text))
        size += len(text)
        if size > SLICE_BYTES:
            found.extend(_tables_of_slice(held))
            held, size = [], 0
    found.extend(_tables_of_slice(held))
    found = iter(found)
    return pa.array((next(found) if known else None for known in texts.is_valid().to_pylist()), pa.list_(pa.string()))


def tables_of_query(sql: Column) -> Column:
    """All tables named after FROM and JOIN at any depth, each once, in order; CTE names are none.

    Names of several parts are joined by dots, quotes are taken off.  A NULL text
    gives NULL, one without tables an empty array.  As a Python function it can't stand
    inside a lambda.
    """
    return F.arrow_udf(_tables_of_texts, "array<string>")(sql)


def datasets_of_query(namespace: Column, database: Column, sql: Column) -> Column:
    """Identities (namespace, name) of a query's tables; a name without a database gets ``database``."""
    full = lambda t: F.when((F.coalesce(database, F.lit("")) == "") | t.contains("."), t).otherwise(
        F.concat(database, F.lit("."), t)
    )
    return F.transform(tables_of_query(sql), lambda t: F.struct(namespace.alias("namespace"), full(t).alias("name")))
