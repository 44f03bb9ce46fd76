"""Daily fact tables: sessions and records joined with the user pool."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tvtrail.functions.text import label_if_blank, major_version, search_key_name
from tvtrail.operators.hotkeys import SLICE, HotKeys, join_per_key, neighbours
from tvtrail.operators.words import without_prefixes
from tvtrail.schemas import (
    DEFAULT_REGION, ERROR, FIRST_LIVE, LAST_LIVE, LIVE, LOOK_BACK, ORDER, PAGE_VIEW,
    PARTITION_COLUMNS, TIME_SHIFT, VOD,
)
from tvtrail.session import Keep, as_it_is
from tvtrail.sources.dictionaries import channels, media_names

POOL_KEYS = ("user_id", "regionid", "apk_version", *PARTITION_COLUMNS)


def with_channel_names(events: DataFrame, dict_channel: DataFrame, keep: Keep = as_it_is) -> DataFrame:
    """Configured channel code and name; ``live_flag`` -1 where none is known."""
    known = keep(channels(dict_channel), "channels")
    code = F.coalesce("conf_channel_id", F.lit(""))
    return (
        events.drop("conf_channel_code", "channel_name", "live_flag")
        .join(known, "channel_id", "left")
        .withColumns({
            "conf_channel_code": code,
            "channel_name": F.coalesce("conf_channel_name", F.lit("")),
            "live_flag": F.when(code == "", F.lit("-1")).otherwise(F.lit("0")),
        })
        .drop("conf_channel_id", "conf_channel_name")
    )


def with_search_names(pages: DataFrame, media: DataFrame, keep: Keep = as_it_is) -> DataFrame:
    """Media name of a page view, and the part of it the keyword covered."""
    return (
        pages.drop("media_name", "keyname")
        .join(keep(media_names(media), "media-names"), "media_id", "left")
        .withColumn("media_name", F.coalesce("dict_media_name", F.lit("")))
        .withColumn("keyname", search_key_name(F.col("media_name"), F.col("key")))
        .drop("dict_media_name")
    )


def with_pool(facts: DataFrame, pool: DataFrame, hot: HotKeys) -> DataFrame:
    """Keep facts of pool users and take region, version and partition from it."""
    own = [c for c in facts.columns if c not in POOL_KEYS or c == "user_id"]
    return join_per_key(facts.select(*own), pool.select(*POOL_KEYS), hot, "inner")


def live_neighbours(found: DataFrame, hot: HotKeys) -> DataFrame:
    """Channel and time of the viewing of the same type before and after each one.

    ``last_end_time`` and ``next_start_time`` keep their published meaning
    (previous start, next end); ``previous_end_time`` and
    ``following_start_time`` hold what those names promise.
    """
    keys, order = ["user_id", "state"], ["start_ts", "end_ts", "rid"]
    view = F.struct("conf_channel_code", "play_start_time", "play_end_time")
    out = neighbours(found, keys, order, {"_before": view}, {"_after": view}, hot)
    return out.withColumns({
        "last_code": label_if_blank(F.col("_before.conf_channel_code"), FIRST_LIVE),
        "last_end_time": F.col("_before.play_start_time"),
        "next_code": label_if_blank(F.col("_after.conf_channel_code"), LAST_LIVE),
        "next_start_time": F.col("_after.play_end_time"),
        "previous_end_time": F.col("_before.play_end_time"),
        "following_start_time": F.col("_after.play_start_time"),
    }).drop("_before", "_after")


_LIVE_COLUMNS = (
    "user_id", "regionid", "play_start_time", "play_end_time", "channel_id", "channel_name",
    "conf_channel_code", "apk_version", "live_flag", "is_timeshift", "last_code",
    "last_end_time", "next_code", "next_start_time", "previous_end_time",
    "following_start_time", *PARTITION_COLUMNS,
)


_SHOWN = (
    "user_id", "state", "start_ts", "end_ts", "play_start_time", "play_end_time", "channel_id",
    "channel_name", "conf_channel_code", "live_flag",
)


def _without_repeats(rows: DataFrame) -> DataFrame:
    """Remove exact repeats of time-shift sessions; live sessions all stay.

    Repeats differ in nothing but their tie breaker, and the smallest one is kept.
    Records sent twice share even that, so live rows are never grouped.  The rows
    are partitioned by user already, so this does not shuffle.
    """
    extra = [c for c in (SLICE,) if c in rows.columns]
    same = Window.partitionBy(*_SHOWN, *extra).orderBy("rid")
    place = F.row_number().over(same)
    return (
        rows.select(*_SHOWN, *extra, "rid").withColumn("_place", place)
        .where((F.col("state") == LIVE) | (F.col("_place") == 1)).drop("_place")
    )


def live_facts(found: DataFrame, pool: DataFrame, hot: HotKeys) -> DataFrame:
    """Live viewing and time-shift, each with neighbours within its own kind."""
    rows = _without_repeats(found.where(F.col("state").isin(LIVE, TIME_SHIFT)))
    rows = live_neighbours(rows, hot).withColumn(
        "is_timeshift", F.when(F.col("state") == TIME_SHIFT, F.lit("1")).otherwise(F.lit("0"))
    )
    return with_pool(rows, pool, hot).select(*_LIVE_COLUMNS)


def timeshift_facts(found: DataFrame, pool: DataFrame, hot: HotKeys) -> DataFrame:
    rows = _without_repeats(found.where(F.col("state") == TIME_SHIFT))
    return with_pool(rows, pool, hot).select(
        "user_id", "regionid", "play_start_time", "play_end_time", "channel_id",
        "apk_version", "channel_name", *PARTITION_COLUMNS,
    )


def lookback_facts(found: DataFrame, pool: DataFrame, hot: HotKeys) -> DataFrame:
    rows = found.where(F.col("state") == LOOK_BACK)
    return with_pool(rows, pool, hot).select(
        "user_id", "regionid", "play_start_time", "play_end_time", "media_id", "media_name",
        "conf_channel_code", "channel_id", "channel_name", "apk_version", *PARTITION_COLUMNS,
    )


def vod_facts(found: DataFrame, pool: DataFrame, hot: HotKeys) -> DataFrame:
    rows = found.where(F.col("state") == VOD)
    return with_pool(rows, pool, hot).select(
        F.col("user_id").alias("uuid"), "regionid", "play_start_time", "play_end_time",
        "media_id", "media_name", "category_id", "apk_version", "channel_id", "rid",
        *PARTITION_COLUMNS,
    )


def pageview_facts(events: DataFrame, pool: DataFrame, hot: HotKeys) -> DataFrame:
    """Page views.  The four interface columns are blank for boxes that send none."""
    rows = hot.split(events.where(F.col("state") == PAGE_VIEW), "ts")
    return with_pool(rows, pool, hot).select(
        "user_id", "regionid", "sp_code", "pagepath", "nextpagepath", "pagename",
        "event_type", "special_id", "page_id", "way", "offset_name", "offset_id", "key",
        "keyname", "media_id", "media_name", "category_id", "channel_id", "apk_version",
        "offset_group", "media_group", "create_time", "interface_properties",
        "interface_identification", "request_classification", "serial_number",
        *PARTITION_COLUMNS,
    )


def topic_visits(events: DataFrame, pool: DataFrame, hot: HotKeys) -> DataFrame:
    rows = events.where((F.col("state") == PAGE_VIEW) & (F.col("special_id") != ""))
    return with_pool(hot.split(rows, "ts"), pool, hot).select(
        F.col("user_id").alias("userid"), "regionid", F.col("special_id").alias("subject_id"),
        F.col("create_time").alias("time"), *PARTITION_COLUMNS,
    )


def error_facts(events: DataFrame, pool: DataFrame, hot: HotKeys) -> DataFrame:
    rows = hot.split(events.where(F.col("state") == ERROR), "ts")
    return with_pool(rows, pool, hot).select(
        "apk_version", F.col("user_id").alias("uuid"), "error_code", "error_detail",
        F.col("create_time").alias("oper_time"), *PARTITION_COLUMNS,
    )


def order_facts(events: DataFrame, pool: DataFrame, hot: HotKeys) -> DataFrame:
    rows = hot.split(events.where(F.col("state") == ORDER), "ts")
    return with_pool(rows, pool, hot).select(
        "user_id", "boss_id", F.lit("").alias("order_type"), "status", "apk_version",
        major_version(F.col("apk_version")).alias("parent_apk_version"), "create_time",
        "product_name", "product_price", "media_id", "media_name", "category_id",
        "channel_id", "pagepath", "nextpagepath", *PARTITION_COLUMNS,
    )


def favourite_facts(favourites: DataFrame, pool: DataFrame, dt: str, hot: HotKeys) -> DataFrame:
    """Favourite clicks; users missing from the pool get the default region."""
    rows = hot.split(favourites.where(F.col("state") == VOD), "ts")
    rows = rows.drop("regionid", "apk_version")
    known = pool.select("user_id", "regionid", "apk_version")
    return join_per_key(rows, known, hot, "left").select(
        F.coalesce("apk_version", F.lit("")).alias("apk_version"),
        F.col("user_id").alias("uuid"),
        F.coalesce("regionid", F.lit(DEFAULT_REGION)).alias("regionid"),
        "media_id", "media_name", "status", "create_time", "vodstate",
        F.lit(dt).alias("dt"), "platform", "source_type",
    )


def with_assets(vod: DataFrame, assets: DataFrame, origin: str = "ltmedia") -> DataFrame:
    """Second-level media of the asset dictionary, blank where unknown."""
    second = assets.select(
        F.col("thremdeiaid").alias("media_id"),
        F.col("uuid").alias("media_uuid"),
        F.col("midianame").alias("media_second_name"),
        F.col("ydmedia").alias("asset_id"),
        F.col(origin).alias("orgin_id"),
    )
    added = ("media_uuid", "media_second_name", "asset_id", "orgin_id")
    return vod.join(second, "media_id", "left").withColumns(
        {c: F.coalesce(c, F.lit("")) for c in added}
    )


def drop_test_users(df: DataFrame, prefixes: DataFrame, column: str) -> DataFrame:
    """Remove ids that start with a listed prefix (``prefixes``: key_word)."""
    return without_prefixes(df, column, prefixes, "key_word")
