"""On-demand views reported by the apps: cleaning, deduplication, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tvtrail.functions.labels import MAX_SECONDS_ON_DEMAND
from tvtrail.functions.regions import telecom_region
from tvtrail.functions.times import from_epoch, to_epoch
from tvtrail.operators.sessions import clamp_to_day, of_day
from tvtrail.operators.words import containing
from tvtrail.session import Keep, as_it_is

COLUMNS = (
    "uuid", "regionid", "play_start_time", "play_end_time", "media_id", "media_name",
    "category_id", "apk_version", "pro_id", "clum_id",
)
REVIEW, MATCHED, UNMATCHED = "2", "0", "1"


def views_of_day(parsed: DataFrame, dt: str) -> DataFrame:
    """VOD records of the day, 3 s to 4 h long, starts and ends not yet cut."""
    timed = F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull()
    rows = parsed.where((F.col("data_type") == "vod") & timed)
    return of_day(rows, dt, F.lit(MAX_SECONDS_ON_DEMAND)).withColumn(
        "regionid", telecom_region(F.col("uuid"))
    ).select(*COLUMNS)


def occurring_once(rows: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Rows that have no exact copy; all copies of a repeated row are dropped."""
    return rows.groupBy(*columns).count().where(F.col("count") == 1).drop("count")


def _first(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key.  The rank filter also runs before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") == 1).drop("_rank")


def deduplicate(rows: DataFrame) -> DataFrame:
    """Repeated reports of one view: same end keeps the earliest start, then same
    start keeps the latest end."""
    once = occurring_once(rows)
    same_end = [
        "uuid", "regionid", "play_end_time", "media_id", "media_name", "category_id",
        "apk_version", "pro_id", "clum_id",
    ]
    same_start = [
        "uuid", "play_start_time", "media_id", "category_id", "apk_version", "pro_id", "clum_id",
    ]
    rows = _first(once, same_end, [F.col("play_start_time").asc()])
    return _first(
        rows, same_start,
        [F.col("play_end_time").desc(), F.col("media_name").asc(), F.col("regionid").asc()],
    )


def cut_to_day(rows: DataFrame, dt: str) -> DataFrame:
    timed = rows.withColumns({
        "start_ts": to_epoch(F.col("play_start_time")),
        "end_ts": to_epoch(F.col("play_end_time")),
    })
    return clamp_to_day(timed, dt).withColumns({
        "play_start_time": from_epoch(F.col("start_ts")),
        "play_end_time": from_epoch(F.col("end_ts")),
    }).drop("start_ts", "end_ts")


def app_views(parsed: DataFrame, dt: str) -> DataFrame:
    return cut_to_day(deduplicate(views_of_day(parsed, dt)), dt)


def is_free(asset: Column) -> Column:
    """1 where a real asset id is present."""
    present = asset.isNotNull() & ~asset.isin("", "null")
    return F.when(present, F.lit("1")).otherwise(F.lit("0"))


def with_review_flag(
    rows: DataFrame, categories: DataFrame, review: DataFrame, keep: Keep = as_it_is
) -> DataFrame:
    """``review`` true where the category name contains a review word."""
    names = categories.select(F.col("nns_category_name").alias("_name"))
    listed = keep(containing(names, review, "category_name").withColumn("review", F.lit(True)), "review-names")
    return (
        rows.join(listed, rows.category_name == listed["_name"], "left")
        .drop("_name")
        .withColumn("review", F.coalesce("review", F.lit(False)))
    )


def _media(assets: DataFrame) -> DataFrame:
    return assets.select(
        F.col("thremdeiaid").alias("media_id"), F.col("uuid").alias("media_uuid"),
        "cp", "dxmedia", "midianame",
    ).distinct()


def _channel_names(categories: DataFrame) -> DataFrame:
    return categories.select(
        F.upper("nns_id").alias("_h_channel"), F.col("nns_name").alias("channel_name")
    ).distinct()


def _placements(categories: DataFrame) -> DataFrame:
    return categories.select(
        F.upper("nns_id").alias("_channel"), F.col("nns_category_id").alias("_known"),
        F.col("nns_category_name").alias("category_name"),
    ).distinct()


def _with_names(
    rows: DataFrame, channel: str, category: str, assets_of: str, categories: DataFrame, products: DataFrame, keep: Keep
) -> DataFrame:
    """The category's name, the product's asset and the channel's name."""
    known = keep(_placements(categories), "app-placements")
    owned = keep(products.select("asset_id").distinct(), "app-products")
    names = keep(_channel_names(categories), "app-channels")
    rows = rows.join(known, (rows[channel] == known["_channel"]) & (rows[category] == known["_known"]), "left")
    rows = rows.join(owned, rows[assets_of] == owned["asset_id"], "left")
    return rows.join(names, rows[channel] == names["_h_channel"], "left")


def _named(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "media_name": F.coalesce("midianame", "media_name", F.lit("")),
        "media_uuid": F.coalesce("media_uuid", F.lit("")),
        "cp": F.coalesce("cp", F.lit("")),
        "category_name": F.coalesce("category_name", F.lit("")),
        "channel_name": F.coalesce("channel_name", F.lit("")),
        "isfree": is_free(F.col("asset_id")),
    })


RESULT = (
    "uuid", "regionid", "play_start_time", "play_end_time", "media_id", "media_name",
    "category_id", "category_name", "apk_version", "media_uuid", "cp", "pro_id", "channel_id",
    "channel_name", "isfree",
)


def with_sent_category(
    views: DataFrame, assets: DataFrame, categories: DataFrame, products: DataFrame, keep: Keep = as_it_is
) -> DataFrame:
    """Views that name their category: four dictionary joins, then distinct."""
    rows = views.where(F.col("category_id") != "").distinct().withColumn(
        "_up", F.upper("clum_id")
    )
    rows = rows.join(keep(_media(assets), "app-media"), "media_id", "left")
    rows = _with_names(rows, "_up", "category_id", "dxmedia", categories, products, keep)
    rows = rows.withColumn("channel_id", F.coalesce("_up", F.lit("")))
    return _named(rows).select(*RESULT).distinct()


def with_found_category(
    views: DataFrame,
    assets: DataFrame,
    assists: DataFrame,
    categories: DataFrame,
    products: DataFrame,
    keep: Keep = as_it_is,
) -> DataFrame:
    """Views without a category: every placement of the media.

    The channel restricts the placements only when the view names one, which is
    an equi-join on the media with a residual condition.
    """
    placed = assists.select(
        F.col("nns_video_id").alias("_video"),
        F.upper("nns_assist_id").alias("_placed"),
        F.col("nns_category_id").alias("_category"),
    )
    rows = views.where(F.col("category_id") == "").distinct().drop("category_id")
    rows = rows.join(keep(_media(assets), "app-media"), "media_id", "left")
    any_channel = F.coalesce("clum_id", F.lit("")) == ""
    rows = rows.join(
        placed,
        (rows["media_id"] == placed["_video"])
        & (any_channel | (placed["_placed"] == F.upper("clum_id"))),
        "left",
    )
    rows = _with_names(rows, "_placed", "_category", "dxmedia", categories, products, keep)
    rows = rows.withColumns({
        "category_id": F.col("_category"),
        "channel_id": F.when(F.col("_placed") == "", F.upper("clum_id")).otherwise(F.col("_placed")),
    })
    return _named(rows).select(*RESULT)


def flag_sent(rows: DataFrame, categories: DataFrame, review: DataFrame, keep: Keep = as_it_is) -> DataFrame:
    flag = F.when(F.col("review"), F.lit(REVIEW)).otherwise(F.lit(MATCHED))
    return with_review_flag(rows, categories, review, keep).withColumn("flag", flag).drop("review")


def flag_found(rows: DataFrame, categories: DataFrame, review: DataFrame, keep: Keep = as_it_is) -> DataFrame:
    """Review rows get 2; of the others one row per view and channel gets 0, the rest 1.

    Rows of one view and channel are as many as the media has placements there.
    """
    checked = with_review_flag(rows, categories, review, keep)
    order = [F.col(c).asc_nulls_last() for c in (
        "category_id", "category_name", "regionid", "media_name", "apk_version", "pro_id",
        "media_uuid", "cp", "channel_name", "isfree",
    )]
    window = Window.partitionBy(
        "uuid", "play_start_time", "play_end_time", "media_id", "channel_id", "review"
    ).orderBy(*order)
    flag = (
        F.when(F.col("review"), F.lit(REVIEW))
        .when(F.row_number().over(window) == 1, F.lit(MATCHED))
        .otherwise(F.lit(UNMATCHED))
    )
    return checked.withColumn("flag", flag).drop("review")


def app_results(
    views: DataFrame,
    assets: DataFrame,
    assists: DataFrame,
    categories: DataFrame,
    products: DataFrame,
    review: DataFrame,
    keep: Keep = as_it_is,
) -> DataFrame:
    sent = flag_sent(with_sent_category(views, assets, categories, products, keep), categories, review, keep)
    found = flag_found(
        with_found_category(views, assets, assists, categories, products, keep), categories, review, keep
    )
    return sent.unionByName(found)
