"""Dictionary tables, reduced to one row per key with a fixed choice of value.

None of them is collected or hinted: they stay tables, and the size threshold
of Spark decides between broadcasting and shuffling.  Their users take a ``keep``:
a job stores each reduced dictionary once, so that a hot key of its joins can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def one_per_key(table: DataFrame, key: str, value: str) -> DataFrame:
    return (
        table.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))
    )


def channels(dict_channel: DataFrame, key: str = "channel_name") -> DataFrame:
    """Channel id reported by a box -> configured id and name."""
    return (
        dict_channel.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("channel_id"))
        .agg(
            F.min("conf_channel_id").alias("conf_channel_id"),
            F.min("conf_channel_name").alias("conf_channel_name"),
        )
    )


def media_names(media: DataFrame) -> DataFrame:
    return one_per_key(media, "media_id", "media_name").withColumnRenamed(
        "media_name", "dict_media_name"
    )


def category_names(media: DataFrame) -> DataFrame:
    return one_per_key(media, "category_id", "category_name")


def media_categories(media: DataFrame) -> DataFrame:
    """Every (media, category) with its channel."""
    return (
        media.where(F.col("media_id").isNotNull())
        .groupBy("media_id", "category_id")
        .agg(F.min("channel_id").alias("channel_id"))
    )


def upload_categories(uploads: DataFrame) -> DataFrame:
    """Category id sent by a box -> real category and channel, ``up_known`` true.

    Blank ids are no ids.  Of several rows the smallest that names a category counts.
    """
    best = F.min(F.when(F.col("c_cid").isNotNull(), F.struct("c_cid", "pc_cid")))
    return (
        uploads.where(F.coalesce("identityno", F.lit("")) != "")
        .groupBy("identityno")
        .agg(best.alias("b"))
        .select(
            "identityno", F.col("b.c_cid").alias("up_category"), F.col("b.pc_cid").alias("up_channel"),
            F.lit(True).alias("up_known"),
        )
    )
