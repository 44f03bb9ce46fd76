"""Lines sent by the apps: JSON heartbeats and loose key/value VOD records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tvtrail.functions.labels import check_platform
from tvtrail.functions.regions import telecom_region, unicom_region
from tvtrail.functions.text import blank_to_empty
from tvtrail.schemas import DEFAULT_REGION
from tvtrail.session import Keep, as_it_is
from tvtrail.sources.rejects import NO_BOX, NO_JSON, NO_PAIRS, NO_TIME

_CORRUPT = "_corrupt"

VOD_TEXT_KEYS = {
    "uuid": "user_id", "media_id": "sndlvl_id", "media_name": "sndlvl_name",
    "category_id": "cat_id", "apk_version": "apk_version", "pro_id": "pro_id",
    "clum_id": "clum_id", "data_type": "data_type",
}


def parse_online(lines: DataFrame, rejects: bool = False) -> DataFrame:
    """Heartbeat JSON; lines that are no JSON or name no box are dropped.

    With ``rejects`` they stay, without values, and ``reject`` names their reason.
    The generator makes each line be parsed once; as a projection the parse
    would be repeated in the filter, once per use.
    """
    named = F.col("uuid").isNotNull() & F.col("uuid").rlike(r"\S")
    if not rejects:
        parsed = F.array(F.from_json("value", "uuid string, apk_version string"))
        return lines.select(F.inline(parsed)).where(named)
    parsed = F.array(F.from_json("value", f"uuid string, apk_version string, {_CORRUPT} string", {
        "columnNameOfCorruptRecord": _CORRUPT}))
    rows = lines.select(F.inline(parsed))
    reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit(NO_JSON)).when(~F.coalesce(named, F.lit(False)), F.lit(NO_BOX))
    good = reason.isNull()
    return rows.select(
        F.when(good, F.col("uuid")).alias("uuid"), F.when(good, F.col("apk_version")).alias("apk_version"), reason.alias("reject"))


def online_regions(
    online: DataFrame,
    platform: str,
    areas: DataFrame | None = None,
    renames: DataFrame | None = None,
    keep: Keep = as_it_is,
) -> DataFrame:
    """Region by the platform's rule.

    HNDX: id prefix.  HNLT: ``areas`` (userid, areacode), then phone prefix.
    HNYD: default region, and ids renamed through ``renames`` (userid, stbid).
    """
    check_platform(platform)
    if platform == "HNDX":
        return online.withColumn("regionid", telecom_region(F.col("uuid")))
    if platform == "HNLT":
        known = keep(areas.groupBy("userid").agg(F.min("areacode").alias("areacode")), "area-codes")
        joined = online.join(known, online.uuid == known.userid, "left")
        return joined.withColumn(
            "regionid", unicom_region(F.col("uuid"), F.col("areacode"))
        ).select(*online.columns, "regionid")
    return remap_ids(online, renames, "uuid", keep).withColumn("regionid", F.lit(DEFAULT_REGION))


def remap_ids(df: DataFrame, renames: DataFrame, column: str, keep: Keep = as_it_is) -> DataFrame:
    """Replace an id by its new one; ids without a new one stay."""
    known = keep(renames.groupBy(F.trim("userid").alias("_old")).agg(
        F.min(F.trim("stbid")).alias("_new")
    ), "renames")
    return (
        df.join(known, df[column] == known["_old"], "left")
        .withColumn(column, F.coalesce("_new", column))
        .select(*df.columns)
    )


# --- fixed values: the app's time format ---------------------------------------
APP_TIME_PATTERN = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"


def _app_view(pairs: Column, rejects: bool) -> Column:
    def text(key: str) -> Column:
        return F.coalesce(F.substring_index(F.try_element_at(pairs, F.lit(key)), ":", 1), F.lit(""))

    def seconds(key: str) -> Column:
        raw = F.try_element_at(pairs, F.lit(key))
        return F.unix_timestamp(F.when(raw.rlike(APP_TIME_PATTERN), raw.try_cast("timestamp")))

    def time(key: str) -> Column:
        digits = F.translate(F.try_element_at(pairs, F.lit(key)), "- :", "")
        return F.when(seconds(key).isNotNull(), digits).otherwise(F.lit(""))

    columns = {name: text(key) for name, key in VOD_TEXT_KEYS.items()}
    columns["media_id"] = blank_to_empty(columns["media_id"])
    columns["play_start_time"] = time("play_start_time")
    columns["play_end_time"] = time("play_end_time")
    columns["start_ts"] = seconds("play_start_time")
    columns["end_ts"] = seconds("play_end_time")
    if rejects:
        keys = F.array(*[F.lit(key) for key in (*VOD_TEXT_KEYS.values(), "play_start_time", "play_end_time")])
        timed = columns["start_ts"].isNotNull() & columns["end_ts"].isNotNull()
        columns["reject"] = F.when(~F.arrays_overlap(F.map_keys(pairs), keys), F.lit(NO_PAIRS)).when(
            (columns["data_type"] == "vod") & ~timed, F.lit(NO_TIME))
    return F.struct(*[column.alias(name) for name, column in columns.items()])


def parse_app_vod(lines: DataFrame, rejects: bool = False) -> DataFrame:
    """Key/value VOD records with their times as text and as epoch seconds.

    Times that do not parse are empty, and null as seconds.  Quotes, backslashes
    and braces are ignored; of a repeated key the last value counts (a session
    setting of ``tvtrail.session``).  A time keeps its colons, any other value
    ends at its first.  The generator makes each line be taken apart once, not
    once per filter on a column.  With ``rejects`` a further column names the reason of a line
    without any known key, and of a VOD record whose start or end cannot be read.
    """
    pairs = F.array(F.str_to_map(F.translate(F.col("value"), '"\\{}', ""), F.lit(","), F.lit(":")))
    return lines.select(F.inline(F.transform(pairs, lambda line: _app_view(line, rejects))))
