"""When each box was last seen where, carried from day to day.

Trailing distinct counts need no window of days: a box belongs to the last 90 days if the last
day it was seen is one of them.  The state has one row per box, a map from (region, platform,
source) to the last day.  A day is merged by one join on the box, and a number of boxes is a
filter and a count; what left the window is forgotten.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tvtrail.functions.times import shift_day
from tvtrail.operators.reports import KEYS, WINDOW_DAYS
from tvtrail.schemas import DEFAULT_REGION

COLUMNS = ("uuid", "seen")


def _places(rows: DataFrame, last: Column) -> DataFrame:
    """One row per box.  Rows are reduced to one per box and place before the map is built."""
    per_place = rows.where(F.col("uuid").isNotNull()).groupBy("uuid", *KEYS).agg(last.alias("last"))
    entry = F.struct(F.struct(*KEYS).alias("place"), F.col("last"))
    return per_place.groupBy("uuid").agg(F.map_from_entries(F.collect_list(entry)).alias("seen"))


def state_of(online: DataFrame, dt: str, days: int = WINDOW_DAYS) -> DataFrame:
    """The state after ``dt``, from all days of its window."""
    window = online.where(F.col("dt").between(shift_day(dt, -days), dt))
    return _places(window, F.max("dt"))


def advance(state: DataFrame, online: DataFrame, dt: str, days: int = WINDOW_DAYS) -> DataFrame:
    """The state after ``dt`` from that of an earlier day and the rows of the days since, ``dt`` among them.

    The state is not shuffled if it is bucketed by box.  Merging a day twice changes nothing.
    """
    # Days after dt are not known yet when a day is run again.
    today = _places(online.where(F.col("dt") <= dt), F.max("dt")).withColumnRenamed("seen", "now")
    joined = state.join(today, "uuid", "full_outer")
    both = F.map_zip_with("seen", "now", lambda place, before, now: F.greatest(before, now))
    merged = F.when(F.col("now").isNull(), F.col("seen")).when(F.col("seen").isNull(), F.col("now")).otherwise(both)
    kept = F.map_filter(merged, lambda place, last: last >= shift_day(dt, -days))
    return joined.select("uuid", kept.alias("seen")).where(F.size("seen") > 0)


def _places_of(state: DataFrame, dt: str, days: int) -> DataFrame:
    seen = state.select("uuid", F.explode("seen").alias("place", "last"))
    return seen.where(F.col("last").between(shift_day(dt, -days), dt)).select("uuid", "place.*")


def distinct_users(state: DataFrame, dt: str, days: int = WINDOW_DAYS) -> DataFrame:
    """Boxes per region, platform and source over the trailing days; a count, since no place stands twice."""
    return _places_of(state, dt, days).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("stbnum"))


def residual_region(
    state: DataFrame, dt: str, days: int = WINDOW_DAYS, platform: str = "HNYD", source: str = "sdk",
    region: str = DEFAULT_REGION,
) -> DataFrame:
    """All boxes of a platform and source minus those seen in another region: a filter on the rows of boxes."""
    def here(place: Column, last: Column) -> Column:
        return (place["platform"] == platform) & (place["source_type"] == source) & last.between(shift_day(dt, -days), dt)

    found = state.select(F.map_keys(F.map_filter("seen", here)).alias("places")).where(F.size("places") > 0)
    elsewhere = F.exists("places", lambda place: F.coalesce(place["regionid"] != region, F.lit(False)))
    return found.agg(F.count_if(~elsewhere).alias("stbnum")).select(
        "stbnum", F.lit(region).alias("regionid"), F.lit(platform).alias("platform"), F.lit(source).alias("source_type"))
