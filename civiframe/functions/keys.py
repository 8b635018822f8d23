"""Surrogate and technical keys."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

# the key function travels with the plan, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The public 32-bit Murmur3 constants and the string seed of the stored keys.
_C1 = np.uint32(0xCC9E2D51)
_C2 = np.uint32(0x1B873593)
_ROUND_ADD = np.uint32(0xE6546B64)
_FINAL_1 = np.uint32(0x85EBCA6B)
_FINAL_2 = np.uint32(0xC2B2AE35)
_STRING_SEED = np.uint32(0xF7CA7FD2)


def _rotate(v: np.ndarray, bits: int) -> np.ndarray:
    return (v << np.uint32(bits)) | (v >> np.uint32(32 - bits))


def _scramble(block: np.ndarray) -> np.ndarray:
    return _rotate(block * _C1, 15) * _C2


def _xor_shift(v: np.ndarray, bits: int) -> np.ndarray:
    return v ^ (v >> np.uint32(bits))


def _murmur(units: np.ndarray, first: np.ndarray, size: np.ndarray, step: int) -> np.ndarray:
    """Murmur3 of many texts at once. ``units`` holds the UTF-16 units of all of them;
    a text starts at ``first`` and runs ``size`` units in steps of 1 or -1."""
    h = np.full(len(size), _STRING_SEED, dtype=np.uint32)
    for pair in range(int(size.max(initial=0)) // 2):
        rows = np.flatnonzero(size // 2 > pair)
        at = first[rows] + 2 * pair * step
        block = (units[at] << np.uint32(16)) + units[at + step]
        h[rows] = _rotate(h[rows] ^ _scramble(block), 13) * np.uint32(5) + _ROUND_ADD
    odd = np.flatnonzero(size % 2 == 1)
    h[odd] ^= _scramble(units[first[odd] + (size[odd] - 1) * step])
    h ^= size.astype(np.uint32)
    return _xor_shift(_xor_shift(_xor_shift(h, 16) * _FINAL_1, 13) * _FINAL_2, 16)


@F.pandas_udf(LongType())
def _key_of_text(texts: pd.Series) -> pd.Series:
    encoded = [t.encode("utf-16-be") for t in texts]
    size = np.array([len(e) // 2 for e in encoded], dtype=np.int64)
    # one spare unit keeps indices valid for empty texts
    units = np.frombuffer(b"".join(encoded) + b"\0\0", dtype=">u2").astype(np.uint32)
    first = np.cumsum(size) - size
    high = _murmur(units, first, size, 1).astype(np.uint64)
    low = _murmur(units, first + size - 1, size, -1).astype(np.uint64)
    return pd.Series(((high << np.uint64(32)) | low).astype(np.int64))


def surrogate_key(*parts: Column) -> Column:
    """Stable 64-bit key of the joined parts: Murmur3 of the text in the high word, of
    the reversed text in the low word. A null part reads ``null``.

    The only Python in the package: 32-bit wrap-around products have no built-in, so
    whole Arrow batches go through numpy.
    """
    return _key_of_text(F.concat(*[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]))


def technical_key(*parts: Column) -> Column:
    return F.concat_ws("_", *[p.cast("string") for p in parts])


def measure_id(*parts: Column) -> Column:
    return F.concat_ws(" | ", *[p.cast("string") for p in parts])
