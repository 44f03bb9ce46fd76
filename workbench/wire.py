"""Events rendered as raw device lines, so that the parsers have text to read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from workbench import frames
from workbench.frames import AREA_CODES

PREFIX = "2024-01-01 06:50:19 - 10.0.0.1 - "
VERSION = "concat('A.', k % 4, '.', k % 3, '.1')"
CHANNEL, MEDIA, STATUS = "concat('CH', k % 10)", "concat('M', k)", "string(k % 2)"
NAME, UPLOAD = "concat('media ', k)", "concat('UP', k % 20)"
AREA = "get(array({}), cast(k % {} as int))".format(
    ",".join(f"'{c}'" for c in AREA_CODES), len(AREA_CODES)
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.events(spark, sf_dir)


def _row(*fields: str) -> str:
    return f"concat_ws('|', {', '.join(fields)})"


def _time(milliseconds: bool = False) -> str:
    """Device time; unreadable for some keys, month 13 for one."""
    fmt = r"yyyy-MM-dd\'T\'HH:mm:ss" + (".SSSZ" if milliseconds else "Z")
    return (
        "CASE WHEN k IN (17, 34, 36, 51) THEN 'BAD' WHEN k = 19 THEN '2024-13-01T00:00:00+0000' "
        f"ELSE date_format(timestamp_seconds(s), '{fmt}') END"
    )


def _code(code: str) -> str:
    """Type code, with a date and address before it for keys 40 to 49."""
    return f"CASE WHEN k BETWEEN 40 AND 49 THEN '{PREFIX}{code}' ELSE '{code}' END"


def _head(code: str, ms: bool = False) -> list[str]:
    return [_code(code), "concat('MAC', uid)", "user_id", "'003'", _time(ms)]


def init_record(milliseconds: bool = False) -> str:
    return _row(
        _code("0x01"), "concat('MK', k % 3)", "concat('MAC', uid)", "concat('MD', k % 6)", VERSION,
        "concat('4.', k % 4)", "'003'", "concat('10.0.0.', k)", "concat('ACC', uid)", "user_id",
        "user_id", "'android'", _time(milliseconds), "'HNYD'", AREA, "'v1'", *["''"] * 8,
    )


def live_record(play: str) -> str:
    flag = f"CASE WHEN {play} THEN '0' ELSE '1' END"
    return _row(*_head("0x03"), "''", "'http'", CHANNEL, "'News'", "'0'", "'watch'", flag, "''", "''", "''")


def vod_record(word: str) -> str:
    """23 fields; one short for some keys."""
    tail = f"CASE WHEN k IN (21, 41, 61) THEN '||' ELSE concat('|||', {CHANNEL}) END"
    return _row(
        *_head("0x04"), "''", MEDIA, NAME, "'9'", "'26'", "'1282000'", UPLOAD, "'http'", "'5'", STATUS,
        "'1'", "'spid'", word, "concat('fs', k % 3)", tail,
    )


def lookback_record(word: str) -> str:
    return _row(
        *_head("0x05"), "''", MEDIA, CHANNEL, "'20240101'", "'22:22'", "'2600000'", NAME, word, "'0'",
        "''", "''", "''",
    )


def timeshift_record(word: str) -> str:
    return _row(*_head("0x06"), "''", "'http'", CHANNEL, word, "'07:18:35'", "''", "''", "''")


def page_record(telecom: bool = False) -> str:
    fields = [
        *_head("0x07", telecom), "concat('sp', k % 3)", "''", "concat('P', k % 40)",
        "concat('act', k % 6)", "''", "CASE WHEN k % 13 = 0 THEN '' ELSE concat('page_', k % 40) END",
        "CASE WHEN k % 11 <> 0 THEN '' ELSE concat('SP', k % 5) END", STATUS, "concat('ON', k % 4)",
        "concat('OI', k % 4)", "concat('CAT', k % 15)", MEDIA,
        "CASE WHEN k % 4 = 0 THEN '' ELSE concat('key', k) END",
        "CASE WHEN k % 4 = 1 THEN 'key_search' ELSE 'home_page' END",
        "'22'", "'btn'", "''", "''", "concat('OG', k % 2)", "concat('MG', k % 2)", CHANNEL,
    ]
    if telecom:
        fields += ["'v2'", "'g1'", "concat('SN', k)", "concat('IP', k % 2)", "concat('II', k % 3)",
                   "concat('RC', k % 4)"]
    return _row(*fields)


def order_record(milliseconds: bool = False) -> str:
    return _row(
        *_head("0x09", milliseconds), "''", "concat('act', k % 6)", "''", "concat('prod', k % 8)",
        "concat('B', k)", "string(k)", MEDIA, NAME, UPLOAD, "'http'", "'x'", "'buy_ok'", STATUS, "''",
        "''", CHANNEL,
    )


def error_record() -> str:
    return _row(*_head("0x11"), "''", "'act'", "''", "concat('E', k)", "''", "''")


def heart_record() -> str:
    return _row(*_head("0x10"), "''", "''")


def mobile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per event; views, clicks and orders pack two records in a line."""
    play = "type = 'view'"
    word = f"CASE WHEN {play} THEN 'play' ELSE 'exit' END"
    viewing = (
        f"CASE k % 4 WHEN 0 THEN {live_record(play)} WHEN 1 THEN {vod_record(word)} "
        f"WHEN 2 THEN {lookback_record(word)} ELSE {timeshift_record(word)} END"
    )
    favourite = vod_record("'button_favorite'")
    line = rf"""CASE
        WHEN type IN ('view', 'click') THEN concat({viewing}, '\\x0A', {page_record()})
        WHEN type = 'signup' THEN {init_record()}
        WHEN type = 'purchase' THEN concat({order_record()}, '\\x0A', {favourite})
        WHEN k % 3 = 0 THEN {error_record()}
        ELSE {heart_record()} END"""
    return events(spark, sf_dir).select(F.expr(line).alias("value"), "event_id", "s", "type")


def telecom_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telecom boxes send power-ons, wide page views and orders with milliseconds."""
    line = f"""CASE
        WHEN type IN ('view', 'click') THEN {page_record(True)}
        WHEN type = 'signup' THEN {init_record(True)}
        WHEN type = 'purchase' THEN {order_record(True)}
        ELSE {page_record(False)} END"""
    return events(spark, sf_dir).select(F.expr(line).alias("value"), "event_id", "type")


def online_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App heartbeats, with broken lines, blank and missing ids and repeats."""
    line = f"""CASE k % 10
        WHEN 0 THEN 'not json'
        WHEN 1 THEN '{{"uuid":" ","apk_version":"A.1"}}'
        WHEN 2 THEN '{{"apk_version":"A.1"}}'
        ELSE concat('{{"uuid":"', user_id, '","apk_version":"', {VERSION}, '"}}') END"""
    return events(spark, sf_dir).select(F.expr(line).alias("value"))


def app_vod_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App VOD records.  Some are sent again: exactly, with a later end, or with a
    later start."""
    copies = """explode(CASE k % 10 WHEN 0 THEN array(0, 1) WHEN 1 THEN array(0, 2)
        WHEN 2 THEN array(0, 3) ELSE array(0) END)"""
    start = "s + CASE WHEN c = 3 THEN 60 ELSE 0 END"
    end = "s + k * 200 + CASE WHEN c = 2 THEN 60 ELSE 0 END"
    channel = """CASE WHEN k % 4 = 0 THEN '' ELSE get(
        array('economy', 'small', 'large', 'standard', 'promo', 'medium'), cast(k % 6 as int)) END"""
    pairs = {
        "user_id": "user_id",
        "play_start_time": f"date_format(timestamp_seconds({start}), 'yyyy-MM-dd HH:mm:ss')",
        "play_end_time": f"date_format(timestamp_seconds({end}), 'yyyy-MM-dd HH:mm:ss')",
        "sndlvl_id": f"CASE WHEN k % 29 = 0 THEN 'null' ELSE {MEDIA} END",
        "sndlvl_name": NAME,
        "cat_id": "CASE WHEN k % 3 = 0 THEN '' ELSE concat('CAT', k % 25) END",
        "apk_version": VERSION,
        "pro_id": "concat('PR', k % 3)",
        "clum_id": channel,
        "data_type": "CASE WHEN k % 31 = 0 THEN 'live' ELSE 'vod' END",
    }
    body = ", ".join(f"concat('\"{key}\":\"', {value}, '\"')" for key, value in pairs.items())
    e = events(spark, sf_dir).where("type = 'view'").withColumn("c", F.expr(copies))
    return e.select(F.expr(f"concat('{{', concat_ws(',', {body}), '}}')").alias("value"))
