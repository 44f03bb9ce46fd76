"""Active users of a day and the daily user pool."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tvtrail.functions.text import choose_new
from tvtrail.functions.times import DAY_SECONDS, day_start, shift_day
from tvtrail.operators.extremes import extreme
from tvtrail.schemas import (
    DEFAULT_REGION, INIT, PARTITION_COLUMNS, POOL_ATTRIBUTES, POOL_COLUMNS,
)


def last_power_on(events: DataFrame, dt: str) -> DataFrame:
    """The last power-on of the day per user."""
    first = day_start(dt)
    rows = events.where(
        (F.col("state") == INIT) & (F.col("ts") >= first) & (F.col("ts") < first + DAY_SECONDS)
    )
    return extreme(rows, ["user_id"], ["ts", "rid"], [c for c in rows.columns if c != "user_id"])


def active_users(events: DataFrame, dt: str, platform: str, source_type: str = "sdk") -> DataFrame:
    """One row per user seen on the day.

    Attributes are those of the user's last power-on of the day, so they belong to one
    state of the box.  For a user without one the region is null (unknown), so that it
    cannot replace a known one in the pool, and the other attributes are blank.
    """
    others = [name for name in POOL_ATTRIBUTES if name != "regionid"]
    last = last_power_on(events.select("user_id", "state", "ts", "rid", *POOL_ATTRIBUTES), dt)
    return (
        events.select("user_id").distinct()
        .join(last.select("user_id", *POOL_ATTRIBUTES), "user_id", "left")
        .select("user_id", "regionid", *[F.coalesce(name, F.lit("")).alias(name) for name in others])
        .withColumns({
            "dt": F.lit(dt), "platform": F.lit(platform), "source_type": F.lit(source_type),
        })
    )


def online_day(active: DataFrame) -> DataFrame:
    return active.select(
        F.col("user_id").alias("uuid"),
        F.coalesce("regionid", F.lit(DEFAULT_REGION)).alias("regionid"),
        "apk_version", *PARTITION_COLUMNS,
    )


def _as_new() -> dict[str, Column]:
    """Pool columns of an active user nobody knew before."""
    return {
        "regionid": F.coalesce("regionid", F.lit(DEFAULT_REGION)),
        "status": F.lit(""),
        "start_date": F.col("dt"),
        "end_date": F.lit(""),
        "create_date": F.col("dt"),
        "uuid": F.col("user_id"),
    }


def new_users(active: DataFrame, previous: DataFrame) -> DataFrame:
    """Active users yesterday's pool does not know, in the pool layout."""
    fresh = active.join(previous.select("user_id"), "user_id", "left_anti")
    return fresh.withColumns(_as_new()).select(*POOL_COLUMNS)


def merge_pool(active: DataFrame, previous: DataFrame, dt: str) -> DataFrame:
    """Today's pool: new users plus everybody carried forward with today's non-blank attributes.

    One full outer join, so either side is read once.
    """
    today = active.withColumns(_as_new() | {"_region": F.col("regionid")}).select(*POOL_COLUMNS, "_region")
    today = today.select("user_id", *[F.col(c).alias(f"_n_{c}") for c in POOL_COLUMNS if c != "user_id"], "_region")
    known = previous.select(*POOL_COLUMNS).withColumn("_known", F.lit(True))
    joined = known.join(today, "user_id", "full_outer")
    carried = {a: choose_new(F.col(a), F.col("_region" if a == "regionid" else f"_n_{a}")) for a in POOL_ATTRIBUTES}
    carried |= {"status": F.lit(""), "end_date": F.lit(""), "uuid": F.col("user_id"), "dt": F.lit(dt)}
    return joined.select("user_id", *[
        F.when(F.col("_known"), carried.get(c, F.col(c))).otherwise(F.col(f"_n_{c}")).alias(c)
        for c in POOL_COLUMNS if c != "user_id"
    ]).select(*POOL_COLUMNS)


def yesterday(dt: str) -> str:
    return shift_day(dt, -1)
