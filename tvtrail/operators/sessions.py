"""Viewing sessions from start, stop, heartbeat and power-on records.

Input: one row per record with ``user_id``, ``ts`` (epoch seconds), ``state``,
``play`` (a start) and ``rid`` (tie breaker), plus any payload columns.  All
windows share one partitioning by user, so sessionising costs one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tvtrail.functions.labels import is_viewing, max_seconds
from tvtrail.functions.times import DAY_SECONDS, day_start, from_epoch
from tvtrail.operators.hotkeys import (
    COLD, SLICE, HotKeys, neighbours, strictly_after, strictly_before,
)
from tvtrail.schemas import HEART, INIT, LIVE

# --- fixed values -----------------------------------------------------------
ASSUMED_SECONDS = 300        # length of a session nothing is known about
HEARTBEAT_GRACE = 1200       # a last heartbeat this close to the end proves the end
MIN_SECONDS = 3
_OWN = ("user_id", "ts", "state", "play", "rid")


def pair_starts(log: DataFrame, hot: HotKeys) -> DataFrame:
    """``stop_ts`` of a start: the very next record of its type, if that is a stop."""
    following = F.struct(F.col("ts").alias("ts"), F.col("play").alias("play"))
    out = neighbours(
        log, ["user_id", "state"], ["ts", "play", "rid"], before={}, after={"_next": following}, hot=hot
    )
    stopped = F.when(~F.col("_next.play"), F.col("_next.ts"))
    return out.withColumn("stop_ts", F.when(F.col("play"), stopped)).drop("_next")


def paired_sessions(log: DataFrame, hot: HotKeys) -> DataFrame:
    """Starts with their explicit stop, null where it has to be inferred."""
    rows = hot.split(log.where(is_viewing(F.col("state"))), "ts")
    return pair_starts(rows, hot).where("play").withColumnRenamed("ts", "start_ts").drop("play")


def _with_context(rows: DataFrame, parts: list[str]) -> DataFrame:
    """Per row, strictly before it: the last heartbeat ``_h`` and two chains.

    ``_p`` is the last power-on ``i1``, the heartbeat ``h1`` before that, the
    power-on ``i2`` before that and the heartbeat ``h2`` before that.  ``_hc`` is
    the same from the last heartbeat on (``h1, i2, h2``), with the heartbeat
    ``h0`` before it.  Each pass hands a power-on or heartbeat what is known
    before it to the rows after it, so the chains need no lookups: a maximum
    over structs that begin with the time picks the latest row.
    """
    ts, earlier = F.col("ts"), strictly_before(parts, "ts")
    heart, init = F.col("state") == HEART, F.col("state") == INIT

    def latest(test: Column, **known: Column) -> Column:
        fields = [value.alias(name) for name, value in known.items()]
        return F.max(F.when(test, F.struct(*fields))).over(earlier)

    rows = rows.withColumn("_h", F.max(F.when(heart, ts)).over(earlier))
    rows = rows.withColumn("_i", latest(init, i2=ts, h2=F.col("_h")))
    rows = rows.withColumn(
        "_hc", latest(heart, h1=ts, i2=F.col("_i.i2"), h2=F.col("_i.h2"), h0=F.col("_h"))
    )
    return rows.withColumn(
        "_p", latest(init, i1=ts, h1=F.col("_hc.h1"), i2=F.col("_hc.i2"), h2=F.col("_hc.h2"))
    ).drop("_i")


def _rows_from_later_slices(rows: DataFrame, hot: HotKeys) -> DataFrame:
    """What the last start in a slice has to know of the slices after it.

    An inferred end depends only on what happens up to the next start.  So of
    each slice just the part before its first start matters, and only to the
    nearest earlier slice that holds a start.  Of that part the chains keep at
    most eight rows; with the first start itself they are added to that slice.
    """
    end = F.lit(1 << 60)
    slices = hot.pieces().select(
        "user_id", SLICE, end.alias("ts"), F.lit("").alias("state"), F.lit(False).alias("play"),
    )
    own = ["user_id", SLICE, "ts", "state", "play"]
    marked = rows.where(F.col(SLICE) != COLD).select(*own).unionByName(slices)
    marked = _with_context(marked, ["user_id", SLICE])
    stops = F.col("play") | (F.col("ts") == end)
    known = F.struct("ts", "_h", "_hc", "_p")
    first = marked.where(stops).groupBy("user_id", SLICE).agg(F.min_by(known, "ts").alias("_f"))
    has_start = F.col("_f.ts") < end
    earlier = Window.partitionBy("user_id").orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    target = F.max(F.when(has_start, F.col(SLICE))).over(earlier)

    def row(time: str, state: str, play: bool = False) -> Column:
        return F.struct(
            F.col(time).alias("ts"), F.lit(state).alias("state"), F.lit(play).alias("play")
        )

    kept = F.array(
        row("_f._h", HEART), row("_f._hc.h0", HEART), row("_f._hc.i2", INIT), row("_f._hc.h2", HEART),
        row("_f._p.i1", INIT), row("_f._p.h1", HEART), row("_f._p.i2", INIT), row("_f._p.h2", HEART),
        F.when(has_start, row("_f.ts", LIVE, True)),
    )
    kept = F.filter(kept, lambda r: r["ts"].isNotNull())
    return (
        first.withColumn("_target", target)
        .where(F.col("_target").isNotNull())
        .select("user_id", F.col("_target").alias(SLICE), F.explode(kept).alias("_r"))
        .select("user_id", SLICE, "_r.*", F.lit(True).alias("_added"))
    )


def _inferred_end(start: Column, limit: Column) -> Column:
    """End of a start without a stop, from the context at the candidate end."""
    candidate = F.coalesce(F.col("_start"), F.col("_last"))
    end = candidate["ts"]
    i1, h1, i2, h2, h0 = (candidate["at"][n] for n in ("i1", "h1", "i2", "h2", "h0"))
    assumed = start + ASSUMED_SECONDS

    def after_start(time: Column) -> Column:
        return F.coalesce(time > start, F.lit(False))

    restarted = (
        F.when(~after_start(h1), assumed)
        .when(after_start(i2) & after_start(h2), h2)
        .otherwise(h1)
    )
    heard = F.when(end - h0 <= HEARTBEAT_GRACE, end).otherwise(h0)
    return (
        F.when(end.isNull(), assumed)
        .when(after_start(i1), restarted)
        .when(after_start(h0), heard)
        .when(end - start > limit, assumed)
        .otherwise(end)
    )


def sessions(log: DataFrame, hot: HotKeys) -> DataFrame:
    """One row per start: ``start_ts``, ``end_ts``, ``inferred`` and the payload.

    The candidate end is the next start of any type, else the last heartbeat.  The
    payload goes along with starts only: heartbeats, power-ons and stops, by far the
    most rows, are five narrow columns in the shuffle and the windows.
    """
    payload = [c for c in log.columns if c not in _OWN]
    rows = log.where(is_viewing(F.col("state")) | F.col("state").isin(HEART, INIT))
    if payload:
        rows = rows.select(*_OWN, F.when(F.col("play"), F.struct(*payload)).alias("_payload"))
    rows = hot.split(rows, "ts")
    if hot:
        added = _rows_from_later_slices(rows, hot)
        rows = rows.withColumn("_added", F.lit(False)).unionByName(added, allowMissingColumns=True)
    parts = hot.parts("user_id")
    rows = _with_context(rows, parts)
    here = F.struct(F.col("ts").alias("ts"), F.struct(
        F.col("_p.i1").alias("i1"), F.col("_p.h1").alias("h1"), F.col("_p.i2").alias("i2"),
        F.col("_p.h2").alias("h2"), F.col("_h").alias("h0"),
    ).alias("at"))
    later = strictly_after(parts, "ts")
    rows = rows.withColumns({
        "_start": F.min(F.when(F.col("play"), here)).over(later),
        "_last": F.max(F.when(F.col("state") == HEART, here)).over(later),
    }).drop("_h", "_hc", "_p")
    if hot:
        rows = rows.where(~F.col("_added")).drop("_added")
    rows = pair_starts(rows.where(is_viewing(F.col("state"))), hot).where("play")
    start = F.col("ts")
    found = (
        rows.withColumn("inferred", F.col("stop_ts").isNull())
        .withColumn(
            "end_ts",
            F.coalesce(F.col("stop_ts"), _inferred_end(start, max_seconds(F.col("state")))),
        )
        .withColumnRenamed("ts", "start_ts")
        .drop("_start", "_last", "stop_ts", "play")
    )
    return found.select("*", "_payload.*").drop("_payload") if payload else found


def of_day(found: DataFrame, dt: str, limit: Column | None = None) -> DataFrame:
    """Sessions of acceptable length that touch the day from its own side."""
    length = F.col("end_ts") - F.col("start_ts")
    first = day_start(dt)
    following = first + DAY_SECONDS

    def on_day(time: str) -> Column:
        return (F.col(time) >= first) & (F.col(time) < following)

    touches = (on_day("end_ts") & (F.col("start_ts") < following)) | (
        on_day("start_ts") & (F.col("end_ts") >= first)
    )
    limit = max_seconds(F.col("state")) if limit is None else limit
    return found.where((length >= MIN_SECONDS) & (length <= limit) & touches)


def clamp_to_day(found: DataFrame, dt: str) -> DataFrame:
    first = day_start(dt)
    return found.withColumns({
        "start_ts": F.greatest(F.col("start_ts"), first),
        "end_ts": F.least(F.col("end_ts"), first + DAY_SECONDS - 1),
    })


def day_sessions(log: DataFrame, dt: str, hot: HotKeys) -> DataFrame:
    """Sessions of one day, cut to it, with printable times."""
    cut = clamp_to_day(of_day(sessions(log, hot), dt), dt)
    # Cutting moves starts, so hot users are sliced again by the new ones.
    cut = hot.split(cut.drop(SLICE), "start_ts")
    return cut.withColumns({
        "play_start_time": from_epoch(F.col("start_ts")),
        "play_end_time": from_epoch(F.col("end_ts")),
    })
