"""Pipe-delimited device records into the canonical event.

Every record kind has its own positional layout, given below as data.  The kind
of a record is decided once; each canonical column is then read from the
position its kind names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tvtrail.functions.regions import mobile_region, telecom_region
from tvtrail.functions.text import page_event_kind
from tvtrail.functions.times import LOG_FORMAT, device_timestamp
from tvtrail.schemas import (
    DEFAULT_REGION, ERROR, EVENT_TEXT_COLUMNS, HEART, INIT, LIVE, LOOK_BACK, ORDER,
    PAGE_VIEW, TIME_SHIFT, VOD,
)
from tvtrail.sources.rejects import NO_TIME, REJECT, SHORT

# Kinds that share the wire code of VOD.
FAVOURITE = "favourite"

# --- fixed values: the wire format -----------------------------------------
RECORD_SEPARATOR = r"\\x0A"      # regex for the four literal characters \x0A
FIELD_SEPARATOR = r"\|"
WATCH = "watch"
PLAY, EXIT, ADD_FAVOURITE = "play", "exit", "button_favorite"
LIVE_START, LIVE_STOP = "0", "1"

MOBILE_LAYOUT = {
    VOD: {"media_id": 6, "media_name": 7, "episodes": 8, "category_id": 11, "channel_id": 22},
    LOOK_BACK: {"media_id": 6, "channel_id": 7, "media_name": 11},
    PAGE_VIEW: {
        "sp_code": 5, "page_id": 7, "pagepath": 8, "nextpagepath": 9, "pagename": 10,
        "special_id": 11, "way": 12, "offset_name": 13, "offset_id": 14, "category_id": 15,
        "media_id": 16, "key": 17, "event_type": 18, "offset_group": 23, "media_group": 24,
        "channel_id": 25,
    },
    INIT: {
        "manufacturers": 1, "mac": 2, "model": 3, "apk_version": 4, "system_version": 5,
        "ip": 7, "user_account": 8, "os": 11, "regionid": 14, "sdk_version": 15,
    },
    ORDER: {
        "pagepath": 6, "nextpagepath": 7, "product_name": 8, "boss_id": 9,
        "product_price": 10, "media_id": 11, "media_name": 12, "category_id": 13,
        "confirmation": 16, "status": 17, "channel_id": 20,
    },
    ERROR: {"error_code": 8},
}

FAVOURITE_LAYOUT = {
    FAVOURITE: {"media_id": 6, "media_name": 7, "status": 14, "vodstate": 18},
    INIT: {"apk_version": 4, "regionid": 14},
}

TELECOM_LAYOUT = {
    PAGE_VIEW: {
        "sp_code": 5, "page_id": 7, "pagepath": 8, "nextpagepath": 9, "pagename": 10,
        "special_id": 11, "way": 12, "offset_name": 13, "offset_id": 14, "category_id": 15,
        "key": 17, "event_type": 18, "offset_group": 23, "media_group": 24,
        "channel_id": 25, "serial_number": 28, "interface_properties": 29,
        "interface_identification": 30, "request_classification": 31,
    },
    INIT: {"apk_version": 4, "regionid": 9},
    ORDER: {"product_name": 8, "media_name": 12, "status": 17},
}


def split_packed(lines: DataFrame, value: str = "value") -> DataFrame:
    """One row per record; a line may pack several records."""
    return lines.withColumn(value, F.explode(F.split(value, RECORD_SEPARATOR)))


def fields_of(record: Column) -> Column:
    """Positional fields, trailing blanks kept."""
    return F.split(record, FIELD_SEPARATOR, -1)


def field(fields: Column, index: int | Column) -> Column:
    """A field, empty where the record is too short."""
    at = F.lit(index) if isinstance(index, int) else index
    return F.coalesce(F.get(fields, at), F.lit(""))


def type_code(first: Column) -> Column:
    """Type code without the date and address some devices put before it."""
    prefixed = F.contains(first, F.lit("-")) & F.contains(first, F.lit("."))
    return F.when(prefixed, F.regexp_extract(first, r".*(0x.*)$", 1)).otherwise(first)


def _records(lines: DataFrame, kind, value: str, milliseconds: bool, rejects: bool = False) -> DataFrame:
    """Columns ``f``, ``code``, ``kind``, ``at`` and ``ts`` per valid record.

    With ``rejects``, bad records stay too, as kind REJECT with their reason in ``reject``.

    A record is taken apart once, inside the generator.  Filters on its columns
    stop there; written as plain projections they would be pushed below and
    split every record once per use.
    """

    def describe(f: Column) -> Column:
        code = type_code(field(f, 0))
        return F.struct(f.alias("f"), code.alias("code"))

    def classify(r: Column) -> Column:
        f, code = r["f"], r["code"]
        raw = F.when(code == INIT, F.get(f, F.lit(12))).otherwise(F.get(f, F.lit(4)))
        return F.struct(
            f.alias("f"), code.alias("code"), kind(f, code).alias("kind"),
            device_timestamp(raw, milliseconds).alias("at"),
        )

    parts = F.transform(F.split(value, RECORD_SEPARATOR), fields_of)
    found = F.transform(F.transform(parts, describe), classify)
    records = lines.select(*[c for c in lines.columns if c != value], F.inline(found))
    long_enough = (F.col("code") != INIT) | (F.size("f") >= 15)
    timed = records.withColumn("ts", F.unix_timestamp("at"))
    if not rejects:
        return timed.where(long_enough & F.col("at").isNotNull())
    reason = F.when(~long_enough, F.lit(SHORT)).when(F.col("at").isNull(), F.lit(NO_TIME))
    marked = timed.withColumn("reject", reason)
    return marked.withColumn("kind", F.when(F.col("reject").isNotNull(), F.lit(REJECT)).otherwise(F.col("kind")))


def split_records(
    lines: DataFrame, value: str = "value", milliseconds: bool = False, rejects: bool = False
) -> DataFrame:
    """Records with a valid device time: fields ``f``, ``code``, time ``at``, ``ts``.

    A power-on record carries its time in another field; one that is too short
    for that field has no valid time and is dropped like any other bad record.
    With ``rejects``, bad records are kept and ``reject`` names their reason.
    """
    return _records(lines, _mobile_kind, value, milliseconds, rejects)


def _position(fields: Column, word: Column) -> Column:
    """0-based position of the first field equal to ``word``."""
    return (F.array_position(fields, word) - 1).cast("int")


def _mobile_kind(f: Column, code: Column) -> Column:
    n = F.size(f)
    from_end = [F.coalesce(F.get(f, n - back), F.lit("")) for back in range(6)]
    return (
        F.when(
            (code == LIVE) & (n >= 15) & from_end[4].isin(LIVE_START, LIVE_STOP)
            & (from_end[5] == WATCH), LIVE)
        .when((code == VOD) & (n == 23) & field(f, 17).isin(PLAY, EXIT), VOD)
        .when((code == LOOK_BACK) & (n >= 17) & field(f, 12).isin(PLAY, EXIT), LOOK_BACK)
        .when((code == TIME_SHIFT) & (n >= 13) & from_end[5].isin(PLAY, EXIT), TIME_SHIFT)
        .when((code == PAGE_VIEW) & (n >= 26), PAGE_VIEW)
        .when((code == INIT) & (n >= 15), INIT)
        .when((code == ORDER) & (n >= 21), ORDER)
        .when((code == ERROR) & (n >= 9), ERROR)
        .otherwise(HEART)
    )


def _favourite_kind(f: Column, code: Column) -> Column:
    n = F.size(f)
    return (
        F.when((code == VOD) & (n >= 20) & (field(f, 17) == ADD_FAVOURITE), FAVOURITE)
        .when((code == INIT) & (n >= 15), INIT)
        .otherwise(ERROR)
    )


def _telecom_kind(f: Column, code: Column) -> Column:
    n = F.size(f)
    return (
        F.when((code == PAGE_VIEW) & (n >= 32), PAGE_VIEW)
        .when((code == INIT) & (n >= 15), INIT)
        .when((code == ORDER) & (n >= 21), ORDER)
        .otherwise(ERROR)
    )


def _layout_columns(f: str, kind: str, layout: dict) -> dict[str, Column]:
    """Each canonical column, read from where the record's kind keeps it."""
    columns = {}
    for name in EVENT_TEXT_COLUMNS:
        rules = [
            f"WHEN {kind} = '{record_kind}' THEN coalesce(get({f}, {positions[name]}), '')"
            for record_kind, positions in layout.items()
            if name in positions
        ]
        columns[name] = F.expr(f"CASE {' '.join(rules)} ELSE '' END") if rules else F.lit("")
    columns["is_timeshift"] = F.lit("0")
    return columns


def _events(records, kind, columns, play, platform, source_type, milliseconds=False):
    f = F.col("f")
    user = F.when(kind == INIT, field(f, 9)).when(kind == REJECT, F.lit("")).otherwise(field(f, 2))
    bad = [c for c in ("code", "reject") if "reject" in records.columns]
    state = F.when(kind == FAVOURITE, F.lit(VOD)).otherwise(kind)
    fmt = LOG_FORMAT + "SSS" if milliseconds else LOG_FORMAT
    return records.select(
        state.alias("state"),
        user.alias("user_id"),
        F.date_format("at", fmt).alias("create_time"),
        F.col("ts"),
        play.alias("play"),
        *[columns[name].alias(name) for name in EVENT_TEXT_COLUMNS],
        F.lit(platform).alias("platform"),
        F.lit(source_type).alias("source_type"),
        F.xxhash64("f").alias("rid"), *bad,
    )


def parse_mobile(
    lines: DataFrame, platform: str = "HNYD", source_type: str = "sdk", rejects: bool = False
) -> DataFrame:
    """All record kinds of the mobile boxes; anything unknown is a heartbeat.

    ``rid``, a hash of the record text, breaks ties between equal times the same
    way on every run.  With ``rejects``, bad records are rows of state REJECT that name no
    user, and every row has its type ``code`` and its reason ``reject``, null for good ones.
    """
    records = _records(lines, _mobile_kind, "value", False, rejects)
    f, kind = F.col("f"), F.col("kind")
    columns = _layout_columns("f", "kind", MOBILE_LAYOUT)

    watch = _position(f, F.lit(WATCH))
    shift_word = F.get(f, F.size(f) - 5)
    shift = _position(f, shift_word)
    columns["channel_id"] = (
        F.when(kind == LIVE, field(f, watch - 3))
        .when(kind == TIME_SHIFT, field(f, shift - 1))
        .otherwise(columns["channel_id"])
    )
    columns["is_timeshift"] = F.when(kind == TIME_SHIFT, F.lit("1")).otherwise(F.lit("0"))
    columns["event_type"] = page_event_kind(columns["event_type"])
    columns["regionid"] = F.when(kind == INIT, mobile_region(field(f, 14))).otherwise(
        F.lit(DEFAULT_REGION)
    )
    play = (
        F.when(kind == LIVE, field(f, watch + 1) == LIVE_START)
        .when(kind == VOD, field(f, 17) == PLAY)
        .when(kind == LOOK_BACK, field(f, 12) == PLAY)
        .when(kind == TIME_SHIFT, shift_word == PLAY)
        .otherwise(F.lit(False))
    )
    return _events(records, kind, columns, play, platform, source_type)


def parse_favourites(
    lines: DataFrame, platform: str = "HNYD", source_type: str = "sdk", rejects: bool = False
) -> DataFrame:
    records = _records(lines, _favourite_kind, "value", False, rejects)
    f, kind = F.col("f"), F.col("kind")
    columns = _layout_columns("f", "kind", FAVOURITE_LAYOUT)
    columns["regionid"] = F.when(kind == INIT, mobile_region(field(f, 14))).otherwise(
        F.lit(DEFAULT_REGION)
    )
    return _events(records, kind, columns, F.lit(False), platform, source_type)


def parse_telecom(
    lines: DataFrame, platform: str = "HNDX", source_type: str = "sdk", rejects: bool = False
) -> DataFrame:
    """Telecom boxes: millisecond times, wider page views."""
    records = _records(lines, _telecom_kind, "value", True, rejects)
    f, kind = F.col("f"), F.col("kind")
    columns = _layout_columns("f", "kind", TELECOM_LAYOUT)
    columns["regionid"] = F.when(kind == INIT, telecom_region(field(f, 9))).otherwise(
        F.lit(DEFAULT_REGION)
    )
    return _events(records, kind, columns, F.lit(False), platform, source_type, milliseconds=True)


def power_on_records(
    lines: DataFrame, dt: str, platform: str, source_type: str = "sdk", rejects: bool = False
) -> DataFrame:
    """The daily power-on fact, one row per power-on record.

    With ``rejects``, bad records of any type are rows too, with ``code`` and ``reject``.
    """
    records = split_records(lines, rejects=rejects)
    records = records.where((F.col("code") == INIT) | F.col("reject").isNotNull() if rejects else F.col("code") == INIT)
    f = F.col("f")
    return records.select(
        field(f, 9).alias("uuid"),
        F.date_format("at", LOG_FORMAT).alias("powertime"),
        mobile_region(field(f, 14)).alias("regionid"),
        field(f, 4).alias("apk_version"),
        F.lit(dt).alias("dt"),
        F.lit(platform).alias("platform"),
        F.lit(source_type).alias("source_type"),
        *(["code", "reject"] if rejects else []),
    )


def positional_pages(lines: DataFrame, rejects: bool = False) -> DataFrame:
    """User, time and the name in field 10 of every record, whatever its type.

    The in/out path report reads page-view and order logs this way.
    """
    f = F.col("f")
    return split_records(lines, rejects=rejects).select(
        F.lit(PAGE_VIEW).alias("state"), field(f, 2).alias("user_id"), "ts",
        F.xxhash64("f").alias("rid"), field(f, 10).alias("pagename"),
        *(["code", "reject"] if rejects else []),
    )


def record_widths(lines: DataFrame, code: str) -> DataFrame:
    """Which field counts occur for a type code (profiling)."""
    first = split_packed(lines).withColumn("f", fields_of(F.col("value")))
    return (
        first.where(field(F.col("f"), 0) == code)
        .select(F.size("f").cast("bigint").alias("width"))
        .distinct()
    )
