"""Platform, source and type rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tvtrail.schemas import HEART, INIT, LOOK_BACK, PLATFORMS, VIEWING, VOD

# --- fixed values: report label by (platform, source) -------------------------
REPORT_SOURCES = {
    ("HNDX", "apk"): "HNDX_APK",
    ("HNDX", "c3"): "HNDX_C3",
    ("HNDX", "all"): "HNDX_ALL",
    ("HNLT", "all"): "HNLT_ALL",
    ("HNLT", "sdk"): "HNLT_SDK",
    ("HNLT", "apk"): "HNLT_APK",
    ("HNYD", "sdk"): "HNYD_SDK",
    ("HNYD", "apk"): "HNYD_APK",
    ("HNYD", "all"): "HNYD_ALL",
}

# --- fixed values: longest accepted session, seconds ---------------------------
MAX_SECONDS_ON_DEMAND = 14400
MAX_SECONDS_OTHER = 28800


def check_platform(platform: str) -> str:
    if platform not in PLATFORMS:
        raise ValueError(f"unknown platform {platform!r}, expected one of {PLATFORMS}")
    return platform


def report_source(platform: Column, source: Column, strict: bool = True) -> Column:
    """Report label; a null source counts as all, an unknown pair is an error."""
    rule = F
    for (known_platform, known_source), label in REPORT_SOURCES.items():
        rule = rule.when(
            (platform == known_platform) & (F.coalesce(source, F.lit("all")) == known_source),
            F.lit(label),
        )
    if not strict:
        return rule.otherwise(F.lit(None).cast("string"))
    return rule.otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("no report source for"), platform, source)).cast("string")
    )


def max_seconds(state: Column) -> Column:
    return F.when(state.isin(VOD, LOOK_BACK), F.lit(MAX_SECONDS_ON_DEMAND)).otherwise(
        F.lit(MAX_SECONDS_OTHER)
    )


def is_viewing(state: Column) -> Column:
    return state.isin(*VIEWING)


def is_active_record(state: Column) -> Column:
    return ~state.isin(HEART, INIT)
