"""Whole texts of Arrow batches as blocks of bytes, with vectorised words and range hashes.

A block joins some documents with a line feed between them, so one numpy call covers many short
texts.  A block ends once it holds ``limit`` bytes; a single longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 17
#: Rows of an Arrow batch that are unpacked at once.
PART_ROWS = 256
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
#: White space between words: 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    for shift in (32, 29, 32):
        x ^= x >> np.uint64(shift)
        x *= _MIX
    return x ^ (x >> np.uint64(31))


_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))
_powers: dict[str, np.ndarray] = {}


def _power_table(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the table grows as needed."""
    table = _powers.get(name)
    if table is None or len(table) < n:
        steps = np.full(max(n, BLOCK_BYTES * 2), base, dtype=np.uint64)
        steps[0] = 1
        table = _powers[name] = np.cumprod(steps)
    return table[:n]


class RangeHash:
    """64-bit hashes of any byte ranges of a block, each from two lookups."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[data] * _power_table("up", _BASE, n), out=self.prefix[1:])
        self.down = _power_table("down", _BASE_INVERSE, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.down[start] + (end - start).astype(np.uint64))


class Block:
    """Documents ``first .. first + len(starts)`` of a batch as one array of bytes."""

    def __init__(self, texts: list[bytes], first: int = 0):
        self.first = first
        self.texts = texts
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
        self.ends = self.starts + sizes
        self.data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of every word ``[^\\x20\\x09-\\x0D]+``."""
        inside = np.zeros(len(self.data) + 2, dtype=np.int8)
        inside[1:-1] = ~SPACE[self.data]
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return start, end, np.searchsorted(self.starts, start, side="right") - 1

    def count(self, flag: np.ndarray) -> np.ndarray:
        """Set flags per document."""
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return total[self.ends] - total[self.starts]


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of few rows, which bounds what a task unpacks at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def texts_of(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a missing text is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text) + 1
        if size >= limit:
            yield Block(texts[first : i + 1], first)
            first, size = i + 1, 0
    if first < len(texts):
        yield Block(texts[first:], first)
