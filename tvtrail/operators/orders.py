"""Orders attributed to the page that led to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tvtrail.functions.text import major_version
from tvtrail.operators.hotkeys import HotKeys, join_per_key, latest_before
from tvtrail.schemas import ORDER, PAGE_VIEW

ACCEPTED = "1"


def order_last_page(events: DataFrame, hot: HotKeys) -> DataFrame:
    """Accepted orders with the last page viewed up to the same second.

    A blank page name counts as a page.  Pages of the order's own second come
    before it, so the strict look-back runs on ``2 * ts`` with orders moved half
    a second later.
    """
    rows = events.where(F.col("state").isin(ORDER, PAGE_VIEW))
    is_page = F.col("state") == PAGE_VIEW
    rows = hot.split(rows, "ts").withColumn(
        "_at", F.col("ts") * 2 + F.when(is_page, F.lit(0)).otherwise(F.lit(1))
    )
    seen = F.struct("ts", "rid", F.coalesce("pagename", F.lit("")).alias("name"))
    rows = latest_before(rows, ["user_id"], "_at", {"_page": F.when(is_page, seen)}, hot)
    accepted = (F.col("state") == ORDER) & (F.col("status") == ACCEPTED)
    return (
        rows.where(accepted)
        .withColumn("pagename", F.coalesce("_page.name", F.lit("")))
        .drop("_page", "_at")
    )


def order_relations(events: DataFrame, pool: DataFrame, hot: HotKeys, parent: bool = True) -> DataFrame:
    """The published order relation.  ``parent`` shortens the version."""
    found = order_last_page(events, hot).drop("regionid", "apk_version", "dt", "platform")
    users = pool.select("user_id", "regionid", "apk_version", "dt", "platform")
    joined = join_per_key(found, users, hot, "inner")
    version = major_version(F.col("apk_version")) if parent else F.col("apk_version")
    return joined.select(
        "user_id", "regionid", "media_name", version.alias("apk_version"), "product_name",
        "pagename", F.substring("create_time", 9, 14).alias("create_time"), "dt", "platform",
    )
