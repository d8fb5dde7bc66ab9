"""Texts of an Arrow batch as flat code point arrays, in blocks of bounded size.

Everything that reads characters works on these blocks, so that the memory of a task follows
``BLOCK_CHARS`` (or the longest single text) and not the size of a batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_CHARS = 1 << 18
CODE_POINTS = 0x110000
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def texts_of(column: pa.Array) -> list[str]:
    """Values of a string array; null counts as empty."""
    return [value or "" for value in column.to_pylist()]


def blocks(texts: list[str], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts with about ``limit`` characters in all, with the number of the first."""
    for start, end in _cuts(map(len, texts), limit):
        yield start, texts[start:end]


def text_blocks(column: pa.Array, limit: int = BLOCK_CHARS) -> Iterator[tuple[int, list[str]]]:
    """``blocks`` of a string array; null counts as empty. Only one block is held as Python strings."""
    sizes = pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False).tolist()
    for start, end in _cuts(sizes, limit):
        yield start, texts_of(column.slice(start, end - start))


def _cuts(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    start, size, end = 0, 0, 0
    for end, more in enumerate(sizes, 1):
        if size and size + more > limit:
            yield start, end - 1
            start, size = end - 1, 0
        size += more
    if start < end:
        yield start, end


def give_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, a function over a task's batches, that returns freed memory to the system at its end, where Arrow and
    the C library can. Python workers outlive their tasks, and wait beside the JVM while it joins and sorts."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return whole


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All characters in one array, and the offsets of the texts in it."""
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(text) for text in texts], out=offsets[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), offsets


@lru_cache(1)
def word_characters() -> np.ndarray:
    """Which code points belong to words: letters, digits and the underscore."""
    table = np.fromiter((chr(i).isalnum() for i in range(CODE_POINTS)), bool, CODE_POINTS)
    table[ord("_")] = True
    return table


@lru_cache(1)
def letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(CODE_POINTS)), bool, CODE_POINTS)


def runs(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true flags; runs never cross the border of a text."""
    n = len(flags)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = flags.copy()
    starts[1:] &= ~flags[:-1] | first[1:n]
    ends = flags.copy()
    ends[:-1] &= ~flags[1:] | first[1:n]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def mix(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


BASE = 0x5851F42D4C957F2D | 1
INVERSE = pow(BASE, -1, 1 << 64)


@lru_cache(2)
def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size, base, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


def run_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each run of characters, from prefix sums of a polynomial modulo 2**64."""
    size = 1 << max(19, int(len(codes)).bit_length())
    up, down = _powers(BASE, size), _powers(INVERSE, size)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + GOLDEN) * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def list_array(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
