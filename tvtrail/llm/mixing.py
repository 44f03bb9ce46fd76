"""Mixing sources to target weights by balanced sampling with the cube method.

Every source has a target of words; ``target / size of the source`` says how often a
document is to be taken on average.  Its whole part is taken outright, its fraction
is an inclusion probability.  The flight of the cube method moves the probabilities
of a few documents at a time along the null space of the balancing constraints, sums
of documents and of words, until one of them is 0 or 1, so both totals of the source
stay as they were.  Two dozen undecided documents of all sizes land: the larger ones are
rounded one by one, each to the side that leaves less to make up for, and of all ways to
decide the smallest dozen the one nearest to the totals is chosen.

Flights run in blocks of bounded size inside a source.  What a block leaves undecided,
two documents at most, flies on with that of other blocks, so a source of any size ends
with one small landing.
"""

from __future__ import annotations

import functools
import itertools
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tvtrail.llm.common import number_rows, packed, row_hash, settle, unpacked

BLOCK_ROWS = 20_000
MOST_COPIES = 3
LANDING = 24
EXACT = 12
_NEAR = 1e-9


def word_count(text: Column) -> Column:
    """Words between blanks; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) -> with ``target``: all words shared out by weight, capped.

    Sources by code point, null last, weigh 1, 2, 3, 1, ...  A target stops at ``most``
    times the size of its source; the excess goes to the others by weight until no
    target is above.  Sources reach their cap in the order of size per weight, so running
    sums over the sources in that order give the share at which the next one is capped.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sizes.withColumn("_weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    by_ratio = Window.orderBy(F.col("source_size") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    size, weight, cap = F.col("source_size"), F.col("_weight"), F.col("source_size") * most
    # The share of this source if exactly the ones before it are capped.
    left = F.sum(size).over(whole) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    share = left * weight / F.sum(weight).over(after)
    levels = weighted.withColumn("_share", share).withColumn("_capped", F.col("_share") > cap)
    # The first source that is not capped sets the level of all that follow.
    level = F.min(F.when(~F.col("_capped"), F.struct(
        (F.col("source_size") / weight).alias("ratio"), F.col("source").isNull().alias("last"), F.col("source").alias("source"),
        (F.col("_share") / weight).alias("level")))).over(whole)["level"]
    target = F.when(F.col("_capped") | level.isNull(), cap).otherwise(F.least(level * weight, cap))
    return levels.withColumn("target", target.cast("double")).drop("_weight", "_share", "_capped")


def fly(chances: list[float], words: list[int], rest: int = 0) -> list[float]:
    """Flight phase: at most two of the chances stay between 0 and 1, besides the last ``rest``.

    Keeps the sum of chances and the sum of chance times words.
    """
    chances = list(chances)
    open_ = []
    for n in range(len(chances) - rest):
        if not _NEAR < chances[n] < 1 - _NEAR:
            chances[n] = float(round(chances[n]))
            continue
        open_.append(n)
        while len(open_) == 3:
            a, b, c = open_
            move = (words[b] - words[c], words[c] - words[a], words[a] - words[b])
            if not any(move):
                move = (1, -1, 0)  # equal sizes: any exchange keeps both sums
            _move(chances, open_, move)
            open_ = [n for n in open_ if 0.0 < chances[n] < 1.0]
    if len(open_) == 2 and words[open_[0]] == words[open_[1]]:
        _move(chances, open_, (1, -1))
    return chances


def _move(chances: list[float], places: list[int], move: tuple[int, ...]) -> None:
    """Go along ``move`` to the nearer face of the cube; ties go forward."""
    ahead = min((1 - chances[n] if m > 0 else chances[n]) / abs(m) for n, m in zip(places, move) if m)
    back = min((chances[n] if m > 0 else 1 - chances[n]) / abs(m) for n, m in zip(places, move) if m)
    way = ahead if ahead <= back else -back
    for n, m in zip(places, move):
        x = chances[n] + way * m
        chances[n] = 0.0 if x < _NEAR else 1.0 if x > 1 - _NEAR else x


def land(chances: list[float], words: list[int]) -> list[float]:
    """Decide the open ones so that words, then documents, come nearest to their sums."""
    decided = [float(round(c)) for c in chances]
    open_ = sorted((n for n, c in enumerate(chances) if _NEAR < c < 1 - _NEAR), key=lambda n: -words[n])
    owed_words = owed_docs = 0.0
    for n in open_[:-EXACT]:
        decided[n] = float(owed_words + chances[n] * words[n] > words[n] / 2)
        owed_words += (chances[n] - decided[n]) * words[n]
        owed_docs += chances[n] - decided[n]
    last = open_[-EXACT:]
    want_words = owed_words + sum(chances[n] * words[n] for n in last)
    want_docs = owed_docs + sum(chances[n] for n in last)
    best = min(
        itertools.product((0.0, 1.0), repeat=len(last)),
        key=lambda way: (abs(sum(w * words[n] for w, n in zip(way, last)) - want_words), abs(sum(way) - want_docs), way))
    for value, n in zip(best, last):
        decided[n] = value
    return decided


_SCHEMA = "_number bigint, _source string, _size bigint, _chance double, _blocks bigint"


def _next_blocks(blocks: int, block_rows: int) -> int:
    return max(1, math.ceil(2 * blocks / block_rows))


def sample(rows: DataFrame, most_blocks: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Chances of 0 or 1 for every row of (_number, _source, _size, _chance, _blocks).

    ``_blocks`` is how many blocks the row's source flies in at first, ``most_blocks`` the
    most of any source.  A block leaves two open rows at most, so the levels grow with the
    logarithm of the rows.
    """

    def flight(group: pd.DataFrame) -> pd.DataFrame:
        # Large documents fly first, so that small ones are left.
        group = group.sort_values(["_size", "_number"], ascending=[False, True], ignore_index=True)
        blocks, rest = int(group["_blocks"].iloc[0]), 0
        if blocks == 1:  # keep some of every size for the landing
            rest = min(LANDING - 2, len(group))
            kept = [len(group) * n // rest for n in range(rest)]
            group = pd.concat([group.drop(index=kept), group.loc[kept]])
        words = group["_size"].tolist()
        chances = fly(group["_chance"].tolist(), words, rest)
        return group.assign(
            _chance=land(chances, words) if blocks == 1 else chances, _blocks=_next_blocks(blocks, block_rows))

    decided, level = [], rows
    is_open = (F.col("_chance") > 0) & (F.col("_chance") < 1)
    while True:
        block = F.pmod(F.xxhash64("_number", "_blocks"), F.col("_blocks"))
        flown = settle(
            level.withColumn("_block", block).groupBy("_source", "_block").applyInPandas(
                lambda group: flight(group)[["_number", "_source", "_size", "_chance", "_blocks"]], _SCHEMA),
            "mixing-level")
        if most_blocks == 1:
            return functools.reduce(DataFrame.unionByName, [*decided, flown])
        decided.append(flown.where(~is_open))
        level, most_blocks = flown.where(is_open), _next_blocks(most_blocks, block_rows)


def mix(
    docs: DataFrame, size: Column, source: str = "source", key: str = "doc_id", most: int = MOST_COPIES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``docs`` with size, source_size, target, copies (how often to take it) and taken (words).

    ``size`` is the words of a row (``word_count``).  Reruns agree: rows are numbered by
    key and a hash of the row, and rows equal in everything are interchangeable.  A null
    source is a source of its own; a source without words is not taken.  Result columns
    replace columns of the same names.
    """
    rows = number_rows(packed(
        docs, _key=F.col(f"`{key}`"), _tie=row_hash(docs), _size=size,
        _source=F.col(f"`{source}`").cast("string")), ["_key", "_tie"], "mixing-rows")
    sizes = settle(rows.groupBy(F.col("_source").alias("source")).agg(
        F.sum("_size").alias("source_size"), F.ceil(F.count(F.lit(1)) / block_rows).alias("_blocks")), "mixing-sources")
    rate = F.col("target") / F.col("source_size")
    goal = settle(
        targets(sizes, most).withColumn("_rate", F.when(F.col("source_size") > 0, rate).otherwise(0.0))
        .withColumn("_whole", F.floor("_rate")), "mixing-targets")
    most_blocks = sizes.agg(F.max("_blocks")).first()[0] or 1
    chances = rows.join(goal, F.col("_source").eqNullSafe(F.col("source"))).select(
        "_number", "_source", "_size", (F.col("_rate") - F.col("_whole")).alias("_chance"), "_blocks")
    decided = sample(chances, most_blocks, block_rows).select("_number", F.col("_chance").cast("bigint").alias("_extra"))
    copies = F.col("_whole") + F.col("_extra")
    # Hashed on the decisions at any size, so that the rows are not sorted.
    mixed = rows.join(decided.hint("shuffle_hash"), "_number").join(goal, F.col("_source").eqNullSafe(F.col("source")))
    return unpacked(
        mixed, size=F.col("_size"), source_size=F.col("source_size"), target=F.col("target"), copies=copies,
        taken=F.col("_size") * copies)
