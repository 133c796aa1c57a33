"""Words of many texts at once, as arrays: no Python object per word.

A word is a stretch without the bytes 20 and 09-0D, lower-cased (A-Z).  Its hash is
sum(T[byte i] * M^i) mod 2^64 over its bytes, mixed; prefix sums over all texts give every
word's sum, times the inverse power of its start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
M = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
EMPTY = np.uint64(0x5851F42D4C957F2D)  # hash that stands for "no word"
BLOCK = 1 << 20  # bytes worked on at a time; a longer text is a block of its own


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        up, down = np.full(n, M, np.uint64), np.full(n, INVERSE, np.uint64)
        up[0] = down[0] = 1
        tables = np.cumprod(up), np.cumprod(down)  # wraps around, as it should
        if n > 2 * BLOCK:
            return tables  # of one very long text; not kept
        _powers = tables
    return _powers


class Words:
    """``data`` (all texts, a line feed behind each), ``start`` and ``end`` of each word, its
    64-bit ``hash``, ``line`` (counted over all texts) and, by text, ``first_line``."""

    def __init__(self, texts: list[bytes]):
        raw = b"\n".join([*texts, b""]).translate(LOWER)
        self.data = np.frombuffer(raw, np.uint8)
        self.first_line = np.concatenate([[0], np.cumsum([t.count(b"\n") + 1 for t in texts])])
        space = _SPACE[self.data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]  # the last byte is a blank
        up, down = _power_tables(len(raw) + 1)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_BYTE[self.data] * up[:len(raw)])])
        self.hash = _mix((sums[self.end] - sums[self.start]) * down[self.start])
        self.line = np.cumsum(self.data == 10)[self.start] if len(raw) else np.empty(0, np.int64)

    def last(self, n: int) -> np.ndarray:
        """The last ``n`` bytes of each word as one number (fewer for shorter words)."""
        out = np.zeros(len(self.start), np.int64)
        for i in range(1, n + 1):
            at = self.end - i
            out = out * 257 + np.where(at >= self.start, self.data[np.maximum(at, 0)].astype(np.int64) + 1, 0)
        return out


def blocks(texts: Iterable[str | None], limit: int = BLOCK) -> Iterator[tuple[int, list[bytes]]]:
    """Texts as bytes in blocks of about ``limit`` bytes, each with the number of its first text."""
    some: list[bytes] = []
    size = first = 0
    for i, t in enumerate(texts):
        b = (t or "").encode()
        if some and size + len(b) > limit:
            yield first, some
            some, size, first = [], 0, i
        some.append(b)
        size += len(b) + 1
    if some:
        yield first, some
