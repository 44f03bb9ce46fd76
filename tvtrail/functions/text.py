"""Small text rules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def blank_to_empty(value: Column) -> Column:
    """Null, blank and the words null/NULL become the empty text."""
    unusable = value.isNull() | ~value.rlike(r"\S") | value.isin("null", "NULL")
    return F.when(unusable, F.lit("")).otherwise(value)


def choose_new(old: Column, new: Column) -> Column:
    """The new value unless it is null or empty."""
    return F.coalesce(F.nullif(new, F.lit("")), old)


def major_version(version: Column) -> Column:
    """Everything before the third dot, or empty when there is no third dot."""
    return F.coalesce(F.regexp_extract(version, r"^(.*?\..*?\..*?)\.", 1), F.lit(""))


def label_if_blank(value: Column, label: str) -> Column:
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit(label)).otherwise(value)


def page_event_kind(kind: Column) -> Column:
    return F.when(F.contains(kind, F.lit("search")), F.lit("search")).otherwise(kind)


def search_key_name(media_name: Column, keyword: Column) -> Column:
    """Media name cut to the length of the typed keyword."""
    name, typed = F.trim(media_name), F.trim(keyword)
    cut = F.when(F.length(name) < F.length(typed), name).otherwise(
        F.substring(media_name, F.lit(1), F.length(typed))
    )
    usable = (F.coalesce(media_name, F.lit("")) != "") & (F.coalesce(keyword, F.lit("")) != "")
    return F.when(usable, cut).otherwise(F.lit(""))
