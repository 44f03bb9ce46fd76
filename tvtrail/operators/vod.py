"""Category and channel of an on-demand view."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tvtrail.operators.words import starting_with
from tvtrail.schemas import PARTITION_COLUMNS
from tvtrail.session import Keep, as_it_is
from tvtrail.sources.dictionaries import (
    category_names, media_categories, media_names, upload_categories,
)

PRIMARY, SECONDARY = "0", "1"


def review_categories(categories: DataFrame, review: DataFrame) -> DataFrame:
    """Category ids whose name starts with a review word (``category_name``).

    Runs on the dictionary, which is far smaller than the views.
    """
    listed = starting_with(
        categories.select(F.col("category_name").alias("_name")), review, "category_name"
    )
    return categories.join(
        listed, categories["category_name"] == listed["_name"], "left_semi"
    ).select("category_id")


def resolve_categories(
    vod: DataFrame,
    media: DataFrame,
    uploads: DataFrame,
    review: DataFrame | None = None,
    keep: Keep = as_it_is,
) -> DataFrame:
    """One row per view and category, with one primary row per view and channel.

    A sent category is looked up; an unknown or missing one is replaced by every
    category of the media.  Which category of a (media, channel) is primary does
    not depend on the view, so the flag is computed on the dictionary and the
    views themselves are never grouped.
    """
    names = keep(category_names(media), "category-names")
    banned = None if review is None else keep(review_categories(names, review), "review-categories")
    category = F.coalesce("category_id", F.lit(""))
    options = media_categories(media).withColumns({
        "_category": category,
        "_channel": F.when(category == "", F.lit("")).otherwise(
            F.coalesce("channel_id", F.lit(""))
        ),
        "_banned": F.lit(False),
    })
    if banned is not None:
        listed = banned.select(F.col("category_id").alias("_b"))
        options = options.join(listed, options["_category"] == listed["_b"], "left").withColumn(
            "_banned", F.col("_b").isNotNull()
        )
    first = Window.partitionBy("media_id", "_channel", "_banned").orderBy("_category")
    primary = F.when(F.row_number().over(first) == 1, F.lit(PRIMARY)).otherwise(F.lit(SECONDARY))
    options = keep(options.select(
        F.col("media_id").alias("_media"), "_category", "_channel", primary.alias("_flag")
    ), "media-categories")

    views = vod.join(keep(media_names(media), "media-names"), "media_id", "left").withColumn(
        "media_name",
        F.when(
            F.coalesce("media_name", F.lit("")) == "", F.coalesce("dict_media_name", F.lit(""))
        ).otherwise(F.col("media_name")),
    )
    known = keep(upload_categories(uploads), "upload-categories")
    views = views.join(known, views["category_id"] == known["identityno"], "left")
    unmapped = F.col("up_known").isNull()
    rows = views.join(
        options, (views["media_id"] == options["_media"]) & unmapped, "left"
    ).withColumns({
        "category_id": F.coalesce(F.when(unmapped, F.col("_category")).otherwise(F.col("up_category")), F.lit("")),
        "channel_id": F.when(unmapped, F.coalesce("_channel", F.lit(""))).otherwise(
            F.coalesce("up_channel", F.lit(""))
        ),
        "flag": F.coalesce("_flag", F.lit(PRIMARY)),
    })
    if banned is not None:
        rows = rows.join(banned, "category_id", "left_anti")
    return (
        rows.join(names, "category_id", "left")
        .withColumn("category_name", F.coalesce("category_name", F.lit("")))
        .select(
            "uuid", "regionid", "play_start_time", "play_end_time", "media_id", "media_name",
            "category_id", "category_name", "apk_version", "media_uuid", "channel_id", "flag",
            "rid", *PARTITION_COLUMNS,
        )
    )
