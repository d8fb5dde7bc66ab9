"""Deterministic hashes and MinHash signatures.

A shingle is hashed once with MD5 inside the JVM, and all permutations are derived from that as
``(a*h + b) mod p``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1
CHUNK = 1 << 20


def base_hash(value: Column) -> Column:
    """MD5-based hash of a string, in ``[0, PRIME)``."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("bigint") % F.lit(PRIME)


def unit_hash(seed: object, *parts: Column) -> Column:
    """Hash of ``seed`` and ``parts``, in ``[0, 2**32)``; the same in any SQL engine with MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[part.cast("string") for part in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def affine_parameters(permutations: int) -> list[tuple[int, int]]:
    """Multiplier and offset of each permutation, derived from its number."""

    def draw(kind: str, index: int) -> int:
        return int(hashlib.md5(f"{kind}:{index}".encode()).hexdigest()[:8], 16)

    return [(draw("a", i) % (PRIME - 1) + 1, draw("b", i) % PRIME) for i in range(permutations)]


def permuted_hash(value: Column, seed: int) -> Column:
    """The hash of ``value`` under permutation ``seed`` of the affine family."""
    a, b = affine_parameters(seed + 1)[seed]
    return (base_hash(value) * F.lit(a) + F.lit(b)) % F.lit(PRIME)


def _list_bounds(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Row offsets starting at zero, and the flattened values, of a list array."""
    offsets = np.asarray(column.offsets)
    return offsets - offsets[0], column.flatten()


def _row_minima(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Minimum of each non-empty row."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    return np.minimum.reduceat(values, starts)


def _signature_array(matrix: np.ndarray, value_type: pa.DataType) -> pa.Array:
    rows, width = matrix.shape
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.ravel(), value_type))


def _affine_minima(offsets: np.ndarray, hashes: np.ndarray, params: list[tuple[int, int]]) -> np.ndarray:
    rows = len(offsets) - 1
    out = np.zeros((rows, len(params)), dtype=np.int32)
    filled = np.diff(offsets) > 0
    if not filled.any():
        return out
    for column, (a, b) in enumerate(params):
        mixed = hashes * a + b
        # x mod (2**31 - 1) by folding the high bits down twice
        mixed = (mixed & PRIME) + (mixed >> 31)
        mixed = (mixed & PRIME) + (mixed >> 31)
        mixed[mixed == PRIME] = 0
        out[filled, column] = _row_minima(mixed, offsets)
    return out


def _blocks(offsets: np.ndarray):
    """Row ranges of roughly ``CHUNK`` values each, so that temporaries stay small."""
    start = 0
    rows = len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + CHUNK, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def affine_signature(hashes: Column, permutations: int) -> Column:
    """MinHash signature (array<int>) of an array of base hashes; zeros for an empty array."""
    params = affine_parameters(permutations)

    @F.arrow_udf("array<int>")
    def signature(column: pa.Array) -> pa.Array:
        offsets, values = _list_bounds(column)
        flat = np.asarray(values).astype(np.int64, copy=False)
        parts = [
            _affine_minima(offsets[lo : hi + 1] - offsets[lo], flat[offsets[lo] : offsets[hi]], params)
            for lo, hi in _blocks(offsets)
        ]
        matrix = np.concatenate(parts) if parts else np.zeros((0, permutations), np.int32)
        return _signature_array(matrix, pa.int32())

    return signature(hashes)


def shingle_hashes(tokens: Column, size: int) -> Column:
    """Base hash of every word shingle; repeats are harmless because only minima are taken."""
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(tokens) - size),
        lambda i: base_hash(F.array_join(F.slice(tokens, i + 1, size), " ")).cast("int"),
    )
    return F.when(F.size(tokens) >= size, hashed).otherwise(F.array().cast("array<int>"))


def equal_positions(left: str, right: str, permutations: int) -> Column:
    """How many positions of two signature columns agree, as unrolled compiled comparisons."""
    return F.expr(" + ".join(f"int(get({left}, {i}) = get({right}, {i}))" for i in range(permutations)))


def signature_similarity(left: Column, right: Column) -> Column:
    """Share of equal positions; zero when the arrays are empty or differ in length."""
    hits = F.aggregate(
        F.zip_with(left, right, lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x
    )
    valid = (F.size(left) > 0) & (F.size(left) == F.size(right))
    return F.when(valid, hits / F.size(left)).otherwise(F.lit(0.0))
