"""Terms over batches of text: runs of given bytes, their CRC-32 and 64-bit hashes, word runs as features.

Everything works on byte places of many texts at once; the loops go over the bytes of the longest
short term, not over terms. Memory grows with the terms of one step, see ``common.text_steps``.
"""

from __future__ import annotations

import zlib

import numpy as np
import xxhash

from threadmill.llm.common import mix

#: Terms of more bytes are hashed one by one.
LOOPED_BYTES = 32

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of a term once A-Z are in lower case: digits, a-z, and all of other scripts.
_INSIDE = np.zeros(256, bool)
_INSIDE[0x30:0x3A] = _INSIDE[0x61:0x7B] = _INSIDE[0x80:] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


class Terms:
    """Maximal runs of term bytes; ``start`` and ``end`` are places in ``data``, terms of text i are ``first[i]:first[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = _LOWER[data]
        n = len(data)
        # A place outside each text on both sides, so that runs of neighbours stay apart.
        inside = np.zeros(n + 1, np.int8)
        inside[:n] = _INSIDE[self.data]
        edges = np.flatnonzero(np.diff(inside, prepend=np.int8(0)))
        start, end = edges[::2], edges[1::2]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        cuts = cuts[(inside[cuts - 1] > 0) & (inside[cuts] > 0)] if len(cuts) else cuts
        if len(cuts):
            start, end = np.union1d(start, cuts), np.union1d(end, cuts)
        self.start, self.end = start, end
        self.first = np.searchsorted(self.start, offsets)

    def owner(self) -> np.ndarray:
        """The text each term belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def joined(self) -> None:
        """Put one space between neighbouring terms and nothing else, so that runs of terms are slices."""
        size = self.end - self.start
        at = np.concatenate([[0], np.cumsum(size + 1)])
        out = np.full(at[-1], 32, np.uint8)
        step = np.arange(at[-1]) - np.repeat(at[:-1], size + 1)
        letter = step < np.repeat(size, size + 1)
        out[letter] = self.data[(np.repeat(self.start, size + 1) + step)[letter]]
        self.data, self.start, self.end = out, at[:-1], at[:-1] + size

    def runs(self, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, text) of all runs of 1 to ``most`` neighbouring terms of a text; places in joined terms."""
        owner, parts = self.owner(), []
        if most > 1:
            self.joined()
        n = len(owner)
        for k in range(min(most, n)):
            same = owner[: n - k] == owner[k:]
            parts.append((self.start[: n - k][same], self.end[k:][same], owner[: n - k][same]))
        if not parts:
            return self.start, self.end, owner
        return tuple(np.concatenate(p) for p in zip(*parts))


def _by_size(start: np.ndarray, end: np.ndarray):
    """Terms from long to short: their order, starts in that order, and how many have more than k bytes."""
    size = np.minimum(end - start, LOOPED_BYTES + 1).astype(np.uint16)
    order = np.argsort(LOOPED_BYTES + 1 - size, kind="stable")
    longer = len(size) - np.cumsum(np.bincount(size, minlength=LOOPED_BYTES + 2))
    return order, start[order], longer


def crc32(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each slice."""
    order, first, longer = _by_size(start, end)
    state = np.full(len(start), 0xFFFFFFFF, np.uint32)
    for k in range(LOOPED_BYTES):
        n = longer[k]
        if not n:
            break
        part = state[:n]
        state[:n] = _CRC[(part ^ data[first[:n] + k]) & np.uint32(255)] ^ (part >> np.uint32(8))
    state ^= np.uint32(0xFFFFFFFF)
    out = np.empty(len(start), np.uint32)
    out[order] = state
    for i in order[: longer[LOOPED_BYTES]]:
        out[i] = zlib.crc32(data[start[i] : end[i]])
    return out


def hash64(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of each slice."""
    order, first, longer = _by_size(start, end)
    state = np.zeros(len(start), np.uint64)
    for k in range(LOOPED_BYTES):
        n = longer[k]
        if not n:
            break
        state[:n] = (state[:n] + data[first[:n] + k] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    out = np.empty(len(start), np.uint64)
    out[order] = mix(state)
    for i in order[: longer[LOOPED_BYTES]]:
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]].tobytes())
    return out
