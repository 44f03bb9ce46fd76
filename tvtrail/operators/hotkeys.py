"""Ordered per-key operators that survive a key holding a large share of all rows.

A window over ``partitionBy(user)`` puts one user into one task.  A user with more than
``SLICE_ROWS`` rows is cut into slices of whole seconds that hold about that many rows
each, the window runs per (user, slice), and what a slice needs from its neighbours is
carried over from a one-row-per-slice summary.  Results are exact either way; only the
task layout changes.

The limit is a number of rows and does not depend on the total.  Slices are cut where
the running count of a user's rows passes a multiple of the limit, so a stray time or a
burst costs nothing: a slice holds fewer rows than the limit plus those of one second.
The list of hot users and the summaries grow with the data, so they stay tables and
Spark's own size check decides whether to broadcast them.  A null key is a key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from tvtrail.session import stored

SLICE_ROWS = 2_000_000

SLICE = "_slice"
COLD = -1
# Steps of a binary search over a key's slices, 2 ** 31 at most.
_STEPS = [1 << n for n in range(30, -1, -1)]


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Equality of keys of two frames, where null equals null; ``right`` has them as _k0, _k1, ..."""
    tests = [left[k].eqNullSafe(right[f"_k{n}"]) for n, k in enumerate(keys)]
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def _keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_k{n}" for n, k in enumerate(keys)})


def _places(starts: Column) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.size(starts).cast("bigint") - 1)


@dataclass(frozen=True)
class HotKeys:
    """Which values of ``key`` are hot, and where their slices begin.

    ``slices`` has one row per hot key: the key and ``_starts``, ascending times.
    """

    key: str
    slices: DataFrame | None = None

    def __bool__(self) -> bool:
        return self.slices is not None

    def pieces(self) -> DataFrame:
        """(key, SLICE) of every slice."""
        return self.slices.select(
            self.key, F.explode(_places(F.col("_starts"))).alias(SLICE))

    def split(self, df: DataFrame, ts: str) -> DataFrame:
        """Add the slice of each row; ``COLD`` for rows of ordinary keys."""
        if not self:
            return df
        starts = F.col("_starts")

        def step(at: Column, size: Column) -> Column:
            begun = (at + size <= F.size(starts)) & (F.get(starts, at + size - 1) <= F.col(ts))
            return F.when(begun, at + size).otherwise(at)

        # The last slice that has begun; times before all of them belong to the first.
        place = F.aggregate(F.array(*[F.lit(n) for n in _STEPS]), F.lit(0), step)
        inside = F.greatest(place - 1, F.lit(0))
        named = _keyed(self.slices, [self.key])
        return (
            df.join(named, _same(df, named, [self.key]), "left")
            .withColumn(SLICE, F.when(starts.isNull(), F.lit(COLD)).otherwise(inside).cast("bigint"))
            .drop("_starts", "_k0")
        )

    def parts(self, *keys: str) -> list[str]:
        return [*keys, SLICE] if self else list(keys)


NO_HOT_KEYS = HotKeys(key="")


def find_hot_keys(df: DataFrame, key: str, ts: str, slice_rows: int = SLICE_ROWS) -> HotKeys:
    """Count rows per key (map-side combined) and cut those with more than ``slice_rows``.

    Ordinary data needs one job that returns one row.  Only where some key is hot, its
    rows are counted per second and the running count is cut.  ``df`` is read up to
    three times then, so it should be a stored frame.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    if (counts.agg(F.max("_rows")).first()[0] or 0) <= slice_rows:
        return HotKeys(key)
    hot = _keyed(counts.where(F.col("_rows") > slice_rows).select(key), [key])
    rows = df.where(F.col(ts).isNotNull()).select(key, F.col(ts).cast("bigint").alias("_at"))
    seconds = rows.join(hot, _same(rows, hot, [key]), "left_semi").groupBy(key, "_at").agg(
        F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    piece = F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / slice_rows)
    begins = seconds.withColumn("_piece", piece).groupBy(key, "_piece").agg(F.min("_at").alias("_begin"))
    slices = begins.groupBy(key).agg(F.sort_array(F.collect_list("_begin")).alias("_starts"))
    return HotKeys(key, stored(slices, "hot-keys"))


def strictly_before(keys: list[str], ts: str) -> WindowSpec:
    """Rows of the same keys with a smaller ``ts``."""
    return (
        Window.partitionBy(*keys).orderBy(F.col(ts).asc())
        .rangeBetween(Window.unboundedPreceding, -1)
    )


def strictly_after(keys: list[str], ts: str) -> WindowSpec:
    """Rows of the same keys with a greater ``ts``.

    A descending sort keeps the frame growing by one row at a time; an ascending
    frame that reaches to the end would be recomputed for every row.
    """
    return (
        Window.partitionBy(*keys).orderBy(F.col(ts).desc())
        .rangeBetween(Window.unboundedPreceding, -1)
    )


def _slice_ends(df: DataFrame, keys: list[str], ends: list[Column], carried: list) -> DataFrame:
    """Summarise each slice to one row, look across the slices of a key, join back.

    ``carried`` maps the window over a key's slices to the columns to hand on.
    """
    summary = df.where(F.col(SLICE) != COLD).groupBy(*keys, SLICE).agg(*ends)
    order = Window.partitionBy(*keys).orderBy(SLICE)
    handed = _keyed(summary.select(*keys, SLICE, *[make(order) for make in carried]), [*keys, SLICE])
    return df.join(handed, _same(df, handed, [*keys, SLICE]), "left").drop(*[f"_k{n}" for n in range(len(keys) + 1)])


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    before: dict[str, Column],
    after: dict[str, Column],
    hot: HotKeys,
) -> DataFrame:
    """``lag`` of the ``before`` values and ``lead`` of the ``after`` values per key.

    ``order`` must begin with the time the slices were cut by.
    """
    window = Window.partitionBy(*hot.parts(*keys)).orderBy(*order)
    # Boxed, so that a null value differs from a missing neighbour.
    boxed = [(n, F.struct(v.alias("v")), F.lag, F.max_by) for n, v in before.items()]
    boxed += [(n, F.struct(v.alias("v")), F.lead, F.min_by) for n, v in after.items()]
    if not hot:
        return df.withColumns({n: step(box).over(window)["v"] for n, box, step, _ in boxed})
    out = _slice_ends(
        df, keys,
        [nearest(box, F.struct(*order)).alias(n) for n, box, _, nearest in boxed],
        [lambda w, n=n, step=step: step(F.col(n)).over(w).alias(f"_c_{n}") for n, _, step, _ in boxed],
    )
    local = {f"_l_{n}": step(box).over(window) for n, box, step, _ in boxed}
    out = out.withColumns(local)
    found = {n: F.coalesce(F.col(f"_l_{n}"), F.col(f"_c_{n}"))["v"] for n, *_ in boxed}
    return out.withColumns(found).drop(*local, *[f"_c_{n}" for n, *_ in boxed])


def latest_before(
    df: DataFrame, keys: list[str], ts: str, values: dict[str, Column], hot: HotKeys
) -> DataFrame:
    """Greatest non-null value among the rows of a key strictly before ``ts``."""
    window = strictly_before(hot.parts(*keys), ts)
    if not hot:
        return df.withColumns({n: F.max(v).over(window) for n, v in values.items()})

    def earlier(w):
        return w.rowsBetween(Window.unboundedPreceding, -1)

    out = _slice_ends(
        df, keys,
        [F.max(v).alias(n) for n, v in values.items()],
        [lambda w, n=n: F.max(n).over(earlier(w)).alias(f"_c_{n}") for n in values],
    )
    local = {f"_l_{n}": F.max(v).over(window) for n, v in values.items()}
    out = out.withColumns(local)
    found = {n: F.greatest(F.col(f"_l_{n}"), F.col(f"_c_{n}")) for n in values}
    return out.withColumns(found).drop(*local, *[f"_c_{n}" for n in values])


def join_per_key(facts: DataFrame, dim: DataFrame, hot: HotKeys, how: str = "inner") -> DataFrame:
    """Join facts with a table that has one row per key.

    Rows of hot keys on the table side are copied once per slice, so the facts
    of a hot key spread over as many tasks as it has slices.
    """
    if not hot:
        return facts.join(dim, hot.key or dim.columns[0], how)
    named = _keyed(hot.slices, [hot.key])
    slices = F.when(F.col("_starts").isNotNull(), _places(F.col("_starts"))).otherwise(
        F.array(F.lit(COLD).cast("bigint")))
    spread = (
        dim.join(named, _same(dim, named, [hot.key]), "left")
        .withColumn(SLICE, F.explode(slices))
        .drop("_starts", "_k0")
    )
    return facts.join(spread, [hot.key, SLICE], how)
