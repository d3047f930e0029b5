"""Byte-level BPE from a table of ranks: encoding with a hierarchical-bitmap rank queue, and decoding.

A text is cut into pre-tokens by a pattern. A pre-token starts as a linked list of its bytes; the
neighbours whose bytes together have a rank wait in that rank's bucket. Bitmaps over the ranks, 64
to a word and words of words above them, tell the lowest waiting rank by a few find-first-set
steps. The leftmost position of its bucket is merged with its neighbour, and the two pairs that
change are queued anew; an entry whose pair has changed since is stale and skipped. A merge costs
the depth of the bitmaps and the logarithm of its bucket at most, so a pre-token of any length is
done in about linear time. Pre-tokens that are new to a worker are done together: their bytes lie
side by side without pairs across their borders, and one queue orders the merges of all of them.

Null and empty texts have no ids. Special tokens are ordinary text. Bytes that are not UTF-8 count
as the replacement character. Every byte must be in the table.
"""

from __future__ import annotations

import base64
import uuid
from collections import ChainMap
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession

from threadmill.llm.common import over_batches, resident

#: Pre-tokens whose ids a worker remembers, in each of two generations, and the bytes of the longest.
REMEMBERED, REMEMBERED_BYTES = 400_000, 64
#: Pre-tokens that are looked up together.
STEP_TOKENS = 1 << 17


class RankQueue:
    """Positions waiting under whole numbers below ``size``: a bucket per number, bitmaps that tell the lowest."""

    def __init__(self, size: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels = [[0] * (-(-size // 64))]
        while len(self.levels[-1]) > 1:
            self.levels.append([0] * (-(-len(self.levels[-1]) // 64)))

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            heappush(bucket, position)
        else:
            self.fill(rank, [position])

    def fill(self, rank: int, positions: list[int]) -> None:
        """A new bucket of rising positions."""
        self.buckets[rank] = positions
        for level in self.levels:
            word = rank >> 6
            had = level[word]
            level[word] = had | 1 << (rank & 63)
            if had:
                return
            rank = word

    def lowest(self) -> int:
        """The lowest rank with a bucket, -1 if there is none."""
        top = self.levels[-1][0]
        if not top:
            return -1
        rank = (top & -top).bit_length() - 1
        for level in reversed(self.levels[:-1]):
            word = level[rank]
            rank = rank << 6 | (word & -word).bit_length() - 1
        return rank

    def drop(self, rank: int) -> None:
        """Forget a bucket that is empty."""
        del self.buckets[rank]
        for level in self.levels:
            level[rank >> 6] &= ~(1 << (rank & 63))
            rank >>= 6
            if level[rank]:
                return


class Codec:
    """Ids of bytes and back, for one table of ranks and one pattern."""

    def __init__(self, tokens: list[tuple[bytes, int]], pattern: str):
        self.ranks = dict(tokens)
        self.longest = max(map(len, self.ranks), default=0)
        size = max(self.ranks.values(), default=0) + 1
        self.queue = RankQueue(size)
        self.pattern = regex.compile(pattern)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        by_id = [b""] * size
        for token, rank in tokens:
            by_id[rank] = token
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.ones, self.twos = np.full(256, -1, np.int64), np.full(65536, -1, np.int64)
        for token, rank in tokens:
            if len(token) == 1:
                self.ones[token[0]] = rank
            elif len(token) == 2:
                self.twos[token[0] << 8 | token[1]] = rank

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit numbers; the merges of all of them share one queue."""
        out = [b""] * len(pieces)
        rest = []
        for nth, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is None and piece:
                rest.append(nth)
            elif piece:
                out[nth] = whole.to_bytes(4, "little")
        if not rest:
            return out
        text = b"".join([pieces[nth] for nth in rest])
        ends = np.cumsum([len(pieces[nth]) for nth in rest])
        ids, first = self._merge(text, ends)
        raw, at = ids.astype("<u4").tobytes(), (4 * first).tolist()
        for nth, a, b in zip(rest, at, at[1:]):
            out[nth] = raw[a:b]
        return out

    def _merge(self, text: bytes, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts that are left, and the number of parts before each piece."""
        n, ranks, queue, longest = len(text), self.ranks, self.queue, self.longest
        data = np.frombuffer(text, np.uint8).astype(np.int64)
        if (self.ones[data] < 0).any():
            raise KeyError("a byte that the table of ranks lacks")
        pairs = np.full(n, -1, np.int64)
        pairs[:-1] = self.twos[data[:-1] << 8 | data[1:]]
        pairs[ends - 1] = -1
        waiting = np.flatnonzero(pairs >= 0)
        waiting = waiting[np.argsort(pairs[waiting], kind="stable")]
        new = np.flatnonzero(np.diff(pairs[waiting], prepend=-1))
        for positions, rank in zip(np.split(waiting, new[1:]), pairs[waiting[new]].tolist()):
            queue.fill(rank, positions.tolist())
        edge = bytearray(n + 1)  # where a piece begins, and the end
        for e in ends.tolist():
            edge[e] = 1
        edge[0] = 1
        # after[i]: where the part behind the one at i starts; before[i]: where the one before it starts;
        # pair[i]: the rank both have together; ident[i]: its id, -1 once it is part of another.
        after, before, pair, ident = list(range(1, n + 1)), list(range(-1, n)), pairs.tolist(), self.ones[data].tolist()
        rank_of, push = ranks.get, queue.push
        while (rank := queue.lowest()) >= 0:
            bucket = queue.buckets[rank]
            while bucket:
                i = heappop(bucket)
                if pair[i] != rank:
                    continue  # stale
                gone = after[i]
                end = after[i] = after[gone]
                ident[i], ident[gone] = rank, -1
                pair[gone] = pair[i] = -1
                lower = rank
                if not edge[end]:
                    before[end] = i
                    stop = after[end]
                    if stop - i <= longest and (joint := rank_of(text[i:stop])) is not None:
                        pair[i] = joint
                        push(joint, i)
                        lower = joint
                if not edge[i]:
                    left = before[i]
                    pair[left] = -1
                    if end - left <= longest and (joint := rank_of(text[left:end])) is not None:
                        pair[left] = joint
                        push(joint, left)
                        if joint < lower:
                            lower = joint
                if lower < rank:
                    break  # a merge made a pair that goes before this bucket
            if not bucket:
                queue.drop(rank)
        ids = np.array(ident, np.int64)
        kept = ids >= 0
        return ids[kept], np.concatenate([[0], np.cumsum(kept)[ends - 1]])

    def _known(self, found: list[list[str]]) -> dict[str, bytes]:
        """A table with the ids of all these pre-tokens.

        Two generations are remembered: when the young one is full it becomes the old one, and
        what is met again moves up. Frequent pre-tokens stay, memory is bounded, long ones are not kept.
        """
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = set().union(*found).difference(young)
        known = new.intersection(old)
        young.update(zip(known, map(old.__getitem__, known)))
        new = list(new - known)
        raw = [w.encode("utf-8", "replace") for w in new]
        fresh = dict(zip(new, self.merged(raw)))
        long = [w for w, r in zip(new, raw) if len(r) > REMEMBERED_BYTES]
        if not long:
            young.update(fresh)
            return young
        kept = {w: fresh[w] for w in long}
        young.update((w, f) for w, f in fresh.items() if w not in kept)
        return ChainMap(young, kept)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers; every match of the pattern on its own."""
        out: list[bytes] = []
        held: list[list[str]] = []
        size = 0

        def flush() -> None:
            known = self._known(held).__getitem__
            out.extend(b"".join(map(known, f)) for f in held)
            held.clear()

        for text in texts:
            if len(text) > 4 * STEP_TOKENS:
                flush()
                found, parts = (m.group() for m in self.pattern.finditer(text)), []
                while part := list(islice(found, STEP_TOKENS)):
                    parts.append(b"".join(map(self._known([part]).__getitem__, part)))
                out.append(b"".join(parts))
                size = 0
                continue
            held.append(self.pattern.findall(text))
            size += len(held[-1])
            if size > STEP_TOKENS:
                flush()
                size = 0
        flush()
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, one after the other."""
        size = self.lengths[ids]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        return self.bytes[np.arange(total) + np.repeat(self.starts[ids] - end + size, size)]


def load(path: str) -> list[tuple[bytes, int]]:
    """A table of ranks: a token in base 64 and its rank a line."""
    with open(path, "rb") as lines:
        return [(base64.b64decode(token), int(rank)) for token, rank in (line.split() for line in lines if line.strip())]


def share(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The table at ``path`` of the driver, for all tasks; it has the size of the vocabulary."""
    return spark.sparkContext.broadcast((uuid.uuid4().hex, load(path), pattern))


def _codec(shared: Broadcast) -> Codec:
    """One codec per worker and table."""
    key, tokens, pattern = shared.value
    return resident(key, lambda: Codec(tokens, pattern))


def encode(text: Column, shared: Broadcast) -> Column:
    """The ids of each text, an array of int; null as for an empty text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(shared)
        for texts in batches:
            texts = texts.cast(pa.large_string()).cast(pa.large_binary())
            found = codec.encode([t.decode("utf-8", "replace") if t else "" for t in texts.to_pylist()])
            ends = np.cumsum([0] + [len(f) // 4 for f in found]).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(found), "<i4")))

    return over_batches(run, "array<int>", keeps=True)(text)


def decode(ids: Column, shared: Broadcast) -> Column:
    """The bytes that ids stand for, as binary; null ids as none."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(shared)
        for lists in batches:
            lists = lists.fill_null([]) if lists.null_count else lists
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            size = np.concatenate([[0], np.cumsum(codec.lengths[flat])])[ends].astype(np.int32)
            raw = codec.decode(flat)
            yield pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(size), pa.py_buffer(raw)])

    return over_batches(run, "binary", keeps=True)(ids)
