"""Watched seconds per minute of the day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tvtrail.functions.times import day_start
from tvtrail.schemas import ALL_REGIONS

MINUTES = 1440
ALL_CHANNELS = "-1"


def minute_seconds(found: DataFrame, dt: str, keys: list[str]) -> DataFrame:
    """Seconds watched per key and minute, one row for each of the 1,440 minutes.

    ``found`` holds sessions cut to the day (``start_ts``, ``end_ts``).  A session
    is four numbers, however long it is: the seconds in its first and last
    minute, and +60 / -60 where its whole minutes begin and end.  They are summed
    per (key, minute) on the map side; a running sum over at most 1,440 rows per
    key then restores the whole minutes.
    """
    first = day_start(dt)
    start, end = F.col("start_ts") - first, F.col("end_ts") - first
    at, to = F.floor(start / 60), F.floor(end / 60)
    zero = F.lit(0).cast("bigint")

    def part(minute: Column, seconds: Column, step: Column) -> Column:
        return F.struct(
            minute.cast("bigint").alias("minute"),
            seconds.cast("bigint").alias("seconds"),
            step.cast("bigint").alias("step"),
        )

    parts = F.when(at == to, F.array(part(at, end - start, zero))).otherwise(
        F.array(
            part(at, (at + 1) * 60 - start, zero),
            part(at + 1, zero, F.lit(60)),
            part(to, end - to * 60, F.lit(-60)),
        )
    )
    sums = (
        found.select(*keys, F.explode(parts).alias("_p"))
        .groupBy(*keys, F.col("_p.minute").alias("minute"))
        .agg(F.sum("_p.seconds").alias("seconds"), F.sum("_p.step").alias("step"))
    )
    spine = sums.select(*keys).distinct().withColumn(
        "minute", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(MINUTES - 1).cast("bigint")))
    )
    # Added up and not joined, so that null keys keep their seconds.
    filled = (
        spine.withColumns({"seconds": zero, "step": zero}).unionByName(sums)
        .groupBy(*keys, "minute").agg(F.sum("seconds").alias("seconds"), F.sum("step").alias("step"))
    )
    running = Window.partitionBy(*keys).orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    whole = F.sum("step").over(running)
    return filled.select(*keys, "minute", (F.col("seconds") + whole).alias("duration")).where(
        F.col("minute") < MINUTES
    )


def minute_label(minute: Column) -> Column:
    return F.concat(
        F.lpad(F.floor(minute / 60).cast("string"), 2, "0"),
        F.lpad((minute % 60).cast("string"), 2, "0"),
        F.lit("00"),
    )


def with_totals(minutes: DataFrame) -> DataFrame:
    """Add all channels (-1), all areas (14300) and both, in one aggregation."""
    keep = ["minute", "platform", "source_type"]
    channel, area = F.col("conf_channel_id"), F.col("area_code")
    cube = minutes.groupingSets(
        [[channel, area, *keep], [area, *keep], [channel, *keep], keep],
        channel, area, *keep,
    ).agg(
        F.sum("duration").alias("duration"),
        F.grouping(channel).alias("_c"),
        F.grouping(area).alias("_a"),
    )
    return cube.withColumns({
        "conf_channel_id": F.when(F.col("_c") == 1, F.lit(ALL_CHANNELS)).otherwise(channel),
        "area_code": F.when(F.col("_a") == 1, F.lit(ALL_REGIONS)).otherwise(area),
    }).drop("_c", "_a")


def minute_report(found: DataFrame, dt: str) -> DataFrame:
    """The published minute table of one day."""
    keys = ["conf_channel_id", "area_code", "platform", "source_type"]
    totals = with_totals(minute_seconds(found, dt, keys))
    return totals.select(
        "conf_channel_id", "area_code", minute_label(F.col("minute")).alias("view_time"),
        F.concat(F.lit(dt), "platform", "source_type").alias("combination"),
        "duration", F.lit(dt).alias("dt"), "source_type", "platform",
    )
