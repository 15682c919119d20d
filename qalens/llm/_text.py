"""Whole-batch word splitting and hashing with numpy, shared by the operators of
this subpackage.

An Arrow string column is one byte buffer plus offsets, so the words of thousands of
texts are found and hashed by a few dozen array operations instead of a Python loop per
word. Batches are cut into chunks of about ``CHUNK_BYTES`` so a task's memory does not
depend on how many texts a batch holds (a single longer text is one chunk).
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
#: Text of a batch that is turned into Python strings at a time.
PART_BYTES = 2 << 20
_U = np.uint64


def byte_class(separators: str | bytes) -> np.ndarray:
    """True for every byte that is part of a word."""
    out = np.ones(256, dtype=bool)
    out[list(separators if isinstance(separators, bytes) else separators.encode("latin-1"))] = False
    return out


#: ``[^\x20\x09-\x0D]+``
SPACE_WORDS = byte_class(b" \t\n\x0b\x0c\r")
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after lower-casing A-Z)
ALNUM_WORDS = byte_class(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
IDENTITY = np.arange(256, dtype=np.uint8)
LOWER_ASCII = IDENTITY.copy()
LOWER_ASCII[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (a bijection of 64-bit words), element-wise."""
    x = np.asarray(x, dtype=_U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def tidy(scan):
    """``scan``, a function of a task's batches, giving freed memory back when it ends: an idle
    Python worker goes on living, and what it holds counts against its executor."""

    def run(batches):
        try:
            yield from scan(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
                ctypes.CDLL(None).malloc_trim(0)

    return run


_GOLDEN = _U(0x9E3779B97F4A7C15)


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit words."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=_U) + _U(seed) * _U(1 << 32)) * _GOLDEN)


_BYTE = stream(11, 256)
_place = stream(12, 256) | _U(1)
_ROOT = _U(0xD1342543DE82EF95)
_ROOT_INV = _U(pow(0xD1342543DE82EF95, -1, 1 << 64))
_powers = np.ones(1, dtype=_U)
_inverse = np.ones(1, dtype=_U)


def _places(n: int) -> np.ndarray:
    global _place
    if n > len(_place):
        _place = stream(12, max(n, 2 * len(_place))) | _U(1)
    return _place


def _root_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if n > len(_powers):
        n = max(n, 2 * len(_powers))
        _powers, _inverse = np.full(n, _ROOT, dtype=_U), np.full(n, _ROOT_INV, dtype=_U)
        _powers[0] = _inverse[0] = 1
        _powers, _inverse = np.multiply.accumulate(_powers), np.multiply.accumulate(_inverse)
    return _powers, _inverse


@dataclass
class Words:
    """The words of rows ``lo:hi`` of a batch. Word ``w`` is ``data[start[w]:end[w]]``;
    row ``r`` (from ``lo``) has the words ``first[r]:first[r + 1]``."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(self.hi - self.lo), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes (after the byte translation)."""
        size = self.end - self.start
        if not len(size):
            return np.empty(0, dtype=_U)
        at = np.cumsum(size) - size
        place = np.arange(int(at[-1] + size[-1])) - np.repeat(at, size)
        inside = place + np.repeat(self.start, size)
        value = _BYTE[self.data[inside]] * _places(int(size.max()))[place]
        return mix(np.add.reduceat(value, at) + size.astype(_U) * _GOLDEN)

    def window_starts(self, n: int) -> np.ndarray:
        """Words at which a window of ``n`` words of one row starts."""
        room = np.maximum(self.counts - (n - 1), 0)
        at = np.cumsum(room) - room
        return np.arange(int(room.sum())) - np.repeat(at, room) + np.repeat(self.first[:-1], room)


def window_hashes(word_hash: np.ndarray, starts: np.ndarray, n: int | np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``n`` words from each start, by differences of prefix sums."""
    up, down = _root_powers(len(word_hash) + 1)
    prefix = np.zeros(len(word_hash) + 1, dtype=_U)
    np.cumsum(word_hash * up[: len(word_hash)], out=prefix[1:])
    return mix((prefix[starts + n] - prefix[starts]) * down[starts] + _U(0x5851F42D4C957F2D))


def _split(data: np.ndarray, offsets: np.ndarray, lo: int, hi: int, is_word: np.ndarray, translate: np.ndarray) -> Words:
    base, stop = int(offsets[lo]), int(offsets[hi])
    off = offsets[lo : hi + 1] - base
    chunk = translate[data[base:stop]]
    inside = is_word[chunk]
    edge = np.zeros(len(chunk) + 1, dtype=bool)
    edge[off] = True
    before = np.concatenate(([False], inside[:-1])) if len(inside) else inside
    after = np.concatenate((inside[1:], [False])) if len(inside) else inside
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(lo, hi, chunk, off, start, end, np.searchsorted(start, off))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.null_count == 0 else column.cast(pa.large_binary()).fill_null(b"")
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8), offsets


def word_chunks(
    column: pa.Array,
    is_word: np.ndarray = SPACE_WORDS,
    translate: np.ndarray = IDENTITY,
    chunk_bytes: int = CHUNK_BYTES,
) -> Iterator[Words]:
    """The column's words, chunk by chunk, covering every row."""
    if not len(column):
        return
    data, offsets = string_buffers(column)
    lo, rows = 0, len(column)
    while lo < rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + chunk_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield _split(data, offsets, lo, hi, is_word, translate)
        lo = hi


def text_parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``PART_BYTES`` of the column's text, covering every row."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PART_BYTES, side="right"))
        hi = min(batch.num_rows, max(lo + 1, hi))
        yield batch.slice(lo, hi - lo)
        lo = hi


def cover(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    """True at each of ``n`` places that some ``[start, start + length)`` covers."""
    step = np.zeros(n + 1, dtype=np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + lengths, -1)
    return np.cumsum(step[:-1]) > 0
