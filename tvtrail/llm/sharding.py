"""Sharding by a keyed permutation of global row numbers.

Rows are numbered 0..n-1 in a declared order.  A Feistel network permutes the
smallest even-bit domain holding n; values outside 0..n-1 are permuted again
until they fall inside (cycle walking), which makes it a permutation of the row
numbers.  Shard and slot are remainder and quotient of the permuted number, so
the shuffle needs no sort, shards differ by one row at most, and where a row
went, or which row sits in a slot, is a computation and not a lookup.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tvtrail.llm.common import number_rows, packed, row_hash, unpacked

ROUNDS = 6
SEED = 20240104


def _mix(x: np.ndarray) -> np.ndarray:
    """Public 64-bit finaliser with two multiplications (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> np.ndarray:
    return _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _half_bits(n: int) -> int:
    return max(1, -(-(n - 1).bit_length() // 2))


def _network(x: np.ndarray, bits: int, keys: np.ndarray, back: bool) -> np.ndarray:
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    left, right = x >> shift, x & mask
    for key in keys[::-1] if back else keys:
        if back:
            left, right = right ^ (_mix(left + key) & mask), left
        else:
            left, right = right, left ^ (_mix(right + key) & mask)
    return (left << shift) | right


def permute(numbers: np.ndarray, n: int, seed: int = SEED, back: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 that ``seed`` picks, or its inverse."""
    x = numbers.astype(np.uint64)
    bits, keys = _half_bits(n), _keys(seed)
    with np.errstate(over="ignore"):
        walking = np.arange(len(x))
        while len(walking):
            x[walking] = _network(x[walking], bits, keys, back)
            walking = walking[x[walking] >= n]
    return x.astype(np.int64)


def place_of(numbers: np.ndarray, n: int, shards: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of row numbers."""
    at = permute(numbers, n, seed)
    return at % shards, at // shards


def row_at(shard: np.ndarray, slot: np.ndarray, n: int, shards: int, seed: int = SEED) -> np.ndarray:
    """Row number that sits in a slot of a shard."""
    return permute(np.asarray(slot) * shards + np.asarray(shard), n, seed, back=True)


def shard(df: DataFrame, order: str = "doc_id", shards: int = 16, seed: int = SEED) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (int) and ``slot`` (bigint from 0).

    Rows are numbered by ``order`` (nulls first), rows of equal order by a hash of
    all their columns; rows equal in everything are interchangeable.  Columns
    named shard or slot are replaced.  An empty table stays empty.
    """
    own = packed(df, _key=F.col(f"`{order}`"), _tie=row_hash(df))
    numbered = number_rows(own, ["_key", "_tie"], "shard-rows")
    n = numbered.count()

    @F.arrow_udf("struct<shard:int,slot:bigint>")
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            where, slot = place_of(batch.to_numpy(zero_copy_only=False), n, shards, seed)
            yield pa.StructArray.from_arrays(
                [pa.array(where, pa.int32()), pa.array(slot, pa.int64())], ["shard", "slot"])

    placed = numbered.withColumn("_place", place("_number"))
    return unpacked(placed, shard=F.col("_place.shard"), slot=F.col("_place.slot"))
