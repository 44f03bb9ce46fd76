"""Names and layouts shared by the whole package."""

from __future__ import annotations

# --- fixed values: record type codes of the wire format -------------------
INIT = "0x01"
LIVE = "0x03"
VOD = "0x04"
LOOK_BACK = "0x05"
TIME_SHIFT = "0x06"
PAGE_VIEW = "0x07"
ORDER = "0x09"
HEARTBEAT = "0x10"
ERROR = "0x11"
HEART = "0x100"

VIEWING = (LIVE, VOD, LOOK_BACK, TIME_SHIFT)

# --- fixed values: platforms and sources ----------------------------------
PLATFORMS = ("HNLT", "HNYD", "HNDX")
SOURCES = ("c3", "apk", "sdk")

DEFAULT_REGION = "14301"
ALL_REGIONS = "14300"

# --- fixed values: labels written into the reports ------------------------
FIRST_LIVE = "开始直播"
LAST_LIVE = "结束直播"
BOOT_PAGE = "开机精选"
OTHER_PAGE = "other"

PARTITION_COLUMNS = ("dt", "platform", "source_type")

# Text columns of the canonical event besides state, user_id and create_time.
EVENT_TEXT_COLUMNS = (
    "regionid", "conf_channel_code", "live_flag", "is_timeshift", "manufacturers",
    "mac", "model", "ip", "system_version", "user_account", "media_id", "media_name",
    "episodes", "category_id", "vodstate", "sdk_version", "os", "apk_version",
    "sp_code", "page_id", "pagepath", "nextpagepath", "pagename", "special_id", "way",
    "offset_name", "offset_id", "key", "keyname", "event_type", "offset_group",
    "media_group", "channel_id", "channel_name", "interface_properties",
    "interface_identification", "request_classification", "serial_number",
    "product_name", "boss_id", "product_price", "status", "confirmation",
    "error_code", "error_detail",
)

POOL_ATTRIBUTES = (
    "regionid", "apk_version", "mac", "manufacturers", "model", "system_version",
    "ip", "user_account", "os",
)

POOL_COLUMNS = (
    "user_id", "regionid", "status", "start_date", "end_date", "create_date",
    "apk_version", "mac", "manufacturers", "model", "system_version", "ip",
    "user_account", "uuid", "os", "dt", "platform", "source_type",
)
