"""The first or last row of each key, without sorting what is not in question."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def extreme(rows: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str], last: bool = True) -> DataFrame:
    """(keys, payload) of the row of each key that comes last (or first) in ``order``.

    The first column of ``order`` is a number that is never null.  Its extremum per key is found by hashing, and
    only rows that have it are compared in full, which takes a sort for their texts.  The rows of a
    key meet its extremum at their own value of the number, so a hot key is spread over tasks.
    A null key counts as a key.
    """
    number = order[0]
    names = {k: f"_k{n}" for n, k in enumerate(keys)}
    best = rows.groupBy(*[F.col(k).alias(n) for k, n in names.items()]).agg(
        (F.max if last else F.min)(number).alias("_best"))
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(best[n]) for k, n in names.items()])
    winners = rows.join(best, same & (rows[number] == best["_best"]), "left_semi")
    pick = F.max_by if last else F.min_by
    chosen = winners.groupBy(*keys).agg(pick(F.struct(*payload), F.struct(*order)).alias("_row"))
    return chosen.select(*keys, "_row.*")
