"""JSON texts that the reader refuses as a whole, cut into pieces that it takes.

The brackets outside strings tell where a text can be cut. One walk over the brackets of a text
knows which of them are open. Objects that stand in a list of records or replies are cut out at
fixed depths: each becomes a piece of its own, and a mark stands in its place in the piece around
it. So pieces are never deeper than a few levels, however deep the text. A text is walked where its
row is: nothing is shuffled, and a task holds little more than a batch of texts.

Two walks make the same cuts. :func:`cut_text` takes any text, bracket by bracket. :class:`Cuts` takes
runs of texts at once with array steps and leaves what is not plain to the other: texts with something
behind their end, a backslash outside strings, or a piece that is deep or large itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# The members that hold records or replies.
LISTS = ["replies", "children", "data", ""]
# Depths at which objects are cut out, beside the topmost lists. A level of replies is two or
# three brackets deep, so no level passes all of three neighbouring depths.
EVERY = 21
ROOT = "0:0"

# What lies between two brackets: strings and all else.
_BETWEEN = r'(?s:(?:"(?:[^"\\]++|\\.)*+"|[^"\[\]{}]++)*+)'
_BRACKET = re.compile(rf"({_BETWEEN})([\[\]{{}}])")
_REST = re.compile(_BETWEEN)
_KEY = re.compile(r'"([^"\\]*)"[ \t\r\n]*:[ \t\r\n]*\Z')
# A key that opens a list lies within so many characters before it.
_NEAR = 200
# Stands for a text whose brackets or quotes do not match; no JSON either.
_UNSOUND = [(ROOT, 0, "?")]


def cut_text(text: str, mark: str, every: int) -> list[tuple[str, int, str]]:
    """``piece, level, text`` of one text; see :func:`cut_documents`."""
    # Of an open bracket: its closing one, whether it is an object in a list, the name of the piece
    # that it begins, and the key of a list (None: the object or list has none that counts).
    stack: list[tuple[str, bool, str | None, str | None]] = []
    # Of the pieces that are open: name, level, parts of their text.
    around: list[tuple[str, int, list[str]]] = [(ROOT, 0, [])]
    pieces, numbers = [], {}
    at = start = items = 0
    while found := _BRACKET.match(text, at):
        between, bracket = found.groups()
        here, at = found.end() - 1, found.end()
        if bracket in "[{":
            parent = stack[-1] if stack else None
            key = name = None
            item = bracket == "{" and parent is not None and parent[0] == "]"
            if bracket == "[":
                named = _KEY.search(between[-_NEAR:]) if parent is not None and parent[0] == "}" else None
                key = named.group(1) if named else ("" if parent is None or parent[0] == "]" else None)
            depth = len(stack) + 1
            if item and (depth <= 3 or depth % every < 3) and parent[3] in LISTS:
                rank = len(around)
                numbers[rank] = numbers.get(rank, 0) + 1
                name = f"{rank}:{numbers[rank]}"
                around[-1][2].append(f'{text[start:here]}{{"{mark}":"{name}"}}')
                around.append((name, items, []))
                start = here
            items += item
            stack.append(("]" if bracket == "[" else "}", item, name, key))
            continue
        if not stack or stack[-1][0] != bracket:
            return _UNSOUND
        _, item, name, _ = stack.pop()
        items -= item
        if name is not None:
            _, level, parts = around.pop()
            pieces.append((name, level, "".join(parts) + text[start:at]))
            start = at
    # A quote without an end lies in nothing that matches.
    if stack or not text or _REST.match(text, at).end() != len(text):
        return _UNSOUND
    pieces.append((ROOT, 0, "".join(around[0][2]) + text[start:]))
    return pieces


def cut_documents(docs: DataFrame, text: str, mark: str, every: int | None = None) -> DataFrame:
    """``doc, piece, level, text`` of the texts of ``docs`` (``doc``, unique, and the text).

    ``level`` counts the lists of records or replies around the piece, ``ROOT`` is the piece
    that holds the beginning. ``{"<mark>":"<piece>"}`` stands where a piece was cut out. A text
    that is no JSON gives pieces that are none either. Objects are cut out at three of ``every``
    depths (default: ``EVERY``), so at all of them up to three.
    """
    every = every or EVERY
    cut = F.udf(lambda t: cut_text(t, mark, every), "array<struct<piece:string,level:int,text:string>>", useArrow=False)
    return docs.select("doc", F.inline(cut(text)))


# --- runs of texts at once --------------------------------------------------------------------

# What :class:`Cuts` says of a text: it is cut, its brackets or quotes do not match, it is for ``cut_text``.
CUT, UNSOUND, ODD = 0, 1, 2
# Bytes of a run; a longer text is a run of its own.
RUN_BYTES = 1 << 20
# A piece that is deeper or larger than this may be refused by the reader.
SAFE_DEPTH = 500
SAFE_BYTES = 1 << 24
# Blank bytes before a run, so that what stands before a bracket can be looked at.
_PAD = 16
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 13, 32]] = True
_IS_BRACKET = np.zeros(256, bool)
_IS_BRACKET[[91, 93, 123, 125]] = True


def _nest(opens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Levels of balanced brackets, and of each pair its opening, its closing one and the opening one around (-1: none)."""
    level = np.cumsum(np.where(opens, 1, -1), dtype=np.int32)
    level += ~opens
    small = level.astype(np.uint16) if len(level) and level.max() < 1 << 16 else level
    # At one level opening and closing brackets take turns.
    order = np.argsort(small, kind="stable")
    begin, end = order[0::2], order[1::2]
    # A bracket that does not follow an opening one has the parent of its elder sibling, the one before it at its level.
    first = np.where(opens[begin - 1], np.arange(len(begin)), 0)
    parent = begin[np.maximum.accumulate(first)] - 1 if len(begin) else begin
    parent[: np.count_nonzero(level[begin] == 1)] = -1
    return level, begin, end, parent


class Cuts:
    """Where the texts of a run are cut; ``state`` of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, every: int):
        self.count = n = len(offsets) - 1
        self.bytes = b = np.concatenate([np.full(_PAD, 32, np.uint8), data])
        self.offsets = at = offsets + _PAD
        self.state = state = np.full(n, CUT, np.int8)
        outside = self._outside_strings()
        place = np.flatnonzero(_IS_BRACKET[b])
        place = place[outside[place]]
        place = self._sound_brackets(place)
        kind = b[place]
        opens = (kind & 2) != 0
        level, begin, end, parent = _nest(opens)
        wrong = (kind[begin] ^ kind[end]) != 6
        if wrong.any():
            # Brackets of two sorts that close each other.
            state[np.unique(np.searchsorted(at, place[begin[wrong]], "right") - 1)] = UNSOUND
            place = place[state[np.searchsorted(at, place, "right") - 1] == CUT]
            kind = b[place]
            opens = (kind & 2) != 0
            level, begin, end, parent = _nest(opens)
        self._trailing(place, level, opens)
        is_list = kind[begin] == 91
        in_list, in_object = (parent >= 0) & (kind[parent] == 91), (parent >= 0) & (kind[parent] == 123)
        listed = np.zeros(len(place), bool)
        listed[begin[is_list & ~in_object]] = True
        named = begin[is_list & in_object]
        listed[named[self._is_named(place[named], place[named - 1])]] = True
        item = ~is_list & in_list
        cut = item & listed[parent] & ((level[begin] <= 3) | (level[begin] % every < 3))
        within = np.zeros(len(place), np.int8)
        within[begin[item]], within[end[item]] = 1, -1
        self._segments(place, level, begin[cut], end[cut], parent[cut], np.cumsum(within, dtype=np.int32))

    def _outside_strings(self) -> np.ndarray:
        """Of each byte whether it lies in no string."""
        b, at, state = self.bytes, self.offsets, self.state
        turns = b == 34
        slashes = np.flatnonzero(b == 92)
        if len(slashes):
            new = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
            length = np.diff(np.append(new, len(slashes)))
            after = slashes[new] + length
            turns[after[(length % 2 == 1) & (after < len(b))]] = False
        quotes = np.flatnonzero(turns)
        seen = np.searchsorted(quotes, at)
        state[np.diff(seen) % 2 == 1] = UNSOUND
        state[np.diff(at) == 0] = UNSOUND
        # Each text begins outside of strings.
        marks = turns.astype(np.uint8)
        odd = np.flatnonzero(np.diff(seen) % 2 == 1)
        ends = at[odd + 1]
        ends = ends[ends < len(b)]
        np.bitwise_xor.at(marks, ends, 1)
        outside = np.bitwise_xor.accumulate(marks) == 0
        if len(slashes):
            # An escape across two texts, or outside of strings, is for the other walk.
            strange = slashes[outside[slashes]]
            state[np.searchsorted(at, strange, "right") - 1] = ODD
            state[np.flatnonzero((b[at[:-1] - 1] == 92) & (np.arange(self.count) > 0))] = ODD
        return outside

    def _sound_brackets(self, place: np.ndarray) -> np.ndarray:
        """The brackets of texts that close all they open."""
        state = self.state
        first = np.searchsorted(place, self.offsets)
        opens = (self.bytes[place] & 2) != 0
        depth = np.cumsum(np.where(opens, 1, -1), dtype=np.int64)
        before = np.append(0, depth)[first]
        some = np.flatnonzero(np.diff(first) > 0)
        low = np.zeros(self.count, np.int64)
        if len(some):
            low[some] = np.minimum.reduceat(depth, first[some]) - before[some]
        bad = (state == CUT) & ((np.diff(before) != 0) | (low < 0) | (np.diff(first) == 0))
        state[bad] = UNSOUND
        state[np.diff(self.offsets) > 1 << 28] = ODD
        return place if (state == CUT).all() else place[np.repeat(state == CUT, np.diff(first))]

    def _trailing(self, place: np.ndarray, level: np.ndarray, opens: np.ndarray) -> None:
        """Texts with more than blanks behind their first value are for the other walk."""
        first = np.searchsorted(place, self.offsets)
        some = np.flatnonzero(np.diff(first) > 0)
        roots = np.append(0, np.cumsum(opens & (level == 1)))[first]
        self.state[np.diff(roots) > 1] = ODD
        last = place[first[some + 1] - 1] + 1
        for text, begin in zip(some[last < self.offsets[some + 1]], last[last < self.offsets[some + 1]]):
            if not _BLANK[self.bytes[begin : self.offsets[text + 1]]].all():
                self.state[text] = ODD

    def _is_named(self, place: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether lists that begin there are members of one of the names ``LISTS``; ``before``: the bracket before each."""
        b = self.bytes
        quote = self._back(self._back(place, before), before, ord(":")) - 1
        found = (quote > before) & (b[quote] == 34) & (place - quote <= _NEAR)
        hit = np.zeros(len(place), bool)
        for name in LISTS:
            begin = quote - len(name) - 1
            same = found & (begin > before) & (place - begin <= _NEAR)
            for k, c in enumerate(f'"{name}'.encode()):
                same[same] = b[begin[same] + k] == c
            hit |= same
        return hit

    def _back(self, place: np.ndarray, before: np.ndarray, over: int | None = None) -> np.ndarray:
        """``place`` moved back over blanks, beyond the byte ``over`` (nowhere without it)."""
        place = place.copy()
        if over is not None:
            there = self.bytes[place - 1] == over
            place = np.where(there, place - 1, before)
        for _ in range(_NEAR):
            blank = _BLANK[self.bytes[place - 1]] & (place - 1 > before)
            if not blank.any():
                break
            place -= blank
        return place

    def _segments(self, place: np.ndarray, level: np.ndarray, begin: np.ndarray, end: np.ndarray, lists: np.ndarray, within: np.ndarray) -> None:
        """The stretches between two cuts in the order of the text, and the piece that each belongs to.

        Pieces are numbered by where they begin; the first one of a text is what holds its beginning.
        """
        n, at = self.count, self.offsets
        cuts = len(begin)
        where = np.concatenate([begin, end])
        by = np.argsort(where, kind="stable")
        opens = by < cuts
        where = where[by]
        rank, inner, _, around = _nest(opens)
        bytes_ = place[where] + ~opens
        text = np.searchsorted(at, place[where], "right") - 1
        # Boundaries: the beginning of each text, then its cuts.
        events = np.arange(2 * cuts) + text + 1
        starts = np.arange(n) + np.searchsorted(text, np.arange(n))
        total = n + 2 * cuts
        self.start, first = np.zeros(total + 1, np.int64), np.zeros(total, np.int64)
        self.start[starts], self.start[events], self.start[-1] = at[:-1], bytes_, at[-1]
        first[starts], first[events] = np.searchsorted(place, at[:-1]), where + ~opens
        self.begins = np.zeros(total, bool)
        self.begins[starts] = True
        self.opens = np.zeros(total + 1, bool)
        self.opens[events] = opens
        number = np.cumsum(self.begins | self.opens[:-1]) - 1
        self.pieces = n + cuts
        parent = np.full(2 * cuts, -1)
        parent[inner] = around
        # The piece around a cut: that of the cut around it, or the first one of its text.
        piece_at = number[events]
        outer = np.where(parent >= 0, piece_at[parent], number[starts][text]) if cuts else piece_at
        closing = np.zeros(2 * cuts, np.int64)
        if cuts:
            # A closing cut leads back to the piece around the one that it closes.
            order = np.argsort(rank, kind="stable")
            closing[order[1::2]] = outer[order[0::2]]
            piece_at = np.where(opens, piece_at, closing)
        self.owner = np.zeros(total, np.int64)
        self.owner[starts], self.owner[events] = number[starts], piece_at
        self.text = np.zeros(self.pieces, np.int64)
        self.text[number[starts]], self.text[number[events[opens]]] = np.arange(n), text[opens]
        self.rank, self.level, base = np.zeros(self.pieces, np.int64), np.full(self.pieces, -1), np.zeros(self.pieces, np.int64)
        mine = number[events[opens]]
        self.rank[mine], self.level[mine], base[mine] = rank[opens], within[where[opens]] - 1, level[where[opens]]
        # Marks in each piece; -1 if they stand in several lists.
        self.kids, held = np.bincount(outer[opens], minlength=self.pieces), np.zeros(self.pieces, np.int64)
        lists = lists[by[opens]]
        held[outer[opens]] = lists
        self.kids[outer[opens][held[outer[opens]] != lists]] = -1
        deep = np.maximum.reduceat(np.append(level, 0), np.minimum(first, len(level))) - base[self.owner] if total else base
        size = np.bincount(self.owner, np.diff(self.start), self.pieces)
        self.state[self.text[self.owner[deep > SAFE_DEPTH]]] = np.maximum(self.state[self.text[self.owner[deep > SAFE_DEPTH]]], ODD)
        large = self.text[size > SAFE_BYTES]
        self.state[large] = np.where(self.state[large] == CUT, ODD, self.state[large])

    def _texts(self, chosen: np.ndarray, marks: pa.Array, marked: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Stretches ``chosen``, each with its mark behind it where ``marked``: their ends among the parts, and the parts."""
        parts = pa.Array.from_buffers(pa.large_binary(), len(self.start) - 1, [None, pa.py_buffer(self.start), pa.py_buffer(self.bytes)])
        size = 1 + marked
        ends = np.cumsum(size)
        index = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
        index[ends - size] = chosen
        index[ends[marked] - 1] = len(parts) + np.arange(int(marked.sum()))
        return ends, pa.concat_arrays([parts, marks.cast(pa.large_binary())]).take(pa.array(index))

    def cut(self, mark: str) -> tuple[np.ndarray, pa.Array]:
        """All pieces of the texts that are cut: their numbers, and their texts with marks where other pieces stood."""
        chosen = np.flatnonzero(self.state[self.text[self.owner]] == CUT)
        chosen = chosen[np.argsort(self.owner[chosen], kind="stable")]
        marked = self.opens[chosen + 1]
        inner = self.owner[chosen[marked] + 1]
        first = np.searchsorted(self.text, np.arange(self.count))
        names = pa.array(inner - first[self.text[inner]]).cast(pa.string())
        marks = pc.binary_join_element_wise(f'{{"{mark}":"1:', names, '"}', "")
        ends, parts = self._texts(chosen, marks, marked)
        pieces, begin = np.unique(self.owner[chosen], return_index=True)
        bounds = np.append(ends[begin] - (1 + marked[begin]), ends[-1:] if len(ends) else 0).astype(np.int64)
        return pieces, _joined(parts, bounds)

    def heads(self, mark: str) -> pa.Array:
        """Of each text that is cut the first piece with the pieces cut out of it, and with marks for those cut out of them."""
        chosen = np.flatnonzero((self.state[self.text[self.owner]] == CUT) & (self.rank[self.owner] <= 1))
        after = np.minimum(chosen + 1, len(self.owner) - 1)
        marked = self.opens[chosen + 1] & (self.rank[self.owner[after]] == 2)
        ends, parts = self._texts(chosen, pa.array([f'{{"{mark}":""}}'] * int(marked.sum()), pa.string()), marked)
        cut = self.state == CUT
        last = np.searchsorted(self.text[self.owner[chosen]], np.arange(self.count), "right")
        bounds = np.append(0, np.append(0, ends)[last]).astype(np.int64)
        texts = _joined(parts, bounds)
        return pc.if_else(pa.array(cut), texts, pa.scalar(None, texts.type))


def _joined(parts: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Texts that reach from one of ``bounds`` among the parts to the next."""
    if not len(parts):
        return pa.array([""] * (len(bounds) - 1), pa.large_string())
    _, offsets, data = parts.buffers()
    places = np.frombuffer(offsets, np.int64, len(parts) + 1, 8 * parts.offset)[bounds]
    return pa.Array.from_buffers(pa.large_string(), len(bounds) - 1, [None, pa.py_buffer(places), data])


def _runs(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of runs of whole texts; nulls count as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    _, off, body = texts.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, 8 * texts.offset) if n else np.zeros(1, np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + RUN_BYTES, "right")) - 1
        to = min(max(to, at + 1), n)
        yield data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def _over_runs(run: Callable[[Cuts], pa.Array], kind: str, every: int) -> Callable[[Column], Column]:
    def over(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for data, offsets in _runs(texts):
                yield run(Cuts(data, offsets, every))

    over.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(over, kind)


def _struct(state: np.ndarray, name: str, column: pa.Array) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(state.astype(np.int32)), column], ["state", name])


def text_states(text: Column) -> Column:
    """``CUT``, ``UNSOUND`` or ``ODD`` of each text; the brackets of an empty text or a null count as unsound."""
    return _over_runs(lambda cuts: pa.array(cuts.state.astype(np.int32)), "int", EVERY)(text)


def text_heads(text: Column, mark: str) -> Column:
    """The state of each text and its ``head``: its records with what lies deep in them cut out."""
    return _over_runs(lambda cuts: _struct(cuts.state, "head", cuts.heads(mark).cast(pa.string())), "struct<state:int,head:string>", EVERY)(text)


def text_pieces(docs: DataFrame, text: str, mark: str, every: int) -> DataFrame:
    """A row per piece of the texts of ``docs``: the other columns, ``level`` (-1: the first piece), ``kids``, ``text``.

    ``kids`` counts the marks in a piece, -1 if they stand in several lists. An odd text has one row, without a
    piece; an unsound one has none.
    """
    names = [c for c in docs.columns if c != text]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, others = 0, [batch.column(c) for c in names]
            for data, offsets in _runs(batch.column(text)):
                cuts = Cuts(data, offsets, every)
                chosen, texts = cuts.cut(mark)
                odd = np.flatnonzero(cuts.state == ODD)
                rows = pa.array(np.concatenate([cuts.text[chosen], odd]) + done)
                none = pa.nulls(len(odd), pa.int32())
                made = [pa.concat_arrays([pa.array(a[chosen].astype(np.int32)), none]) for a in (cuts.level, cuts.kids)]
                made.append(pa.concat_arrays([texts.cast(pa.string()), pa.nulls(len(odd), pa.string())]))
                yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in others), *made], [*names, "level", "kids", "text"])
                done += cuts.count

    made = StructType([*(docs.schema[c] for c in names), StructField("level", IntegerType()), StructField("kids", IntegerType()), StructField("text", StringType())])
    return docs.mapInArrow(cut, made)
