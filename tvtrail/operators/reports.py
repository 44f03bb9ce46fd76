"""Report rollups and checks between systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tvtrail.functions.labels import report_source
from tvtrail.functions.times import shift_day
from tvtrail.schemas import ALL_REGIONS, DEFAULT_REGION

WINDOW_DAYS = 90
KEYS = ("regionid", "platform", "source_type")


def _window(online: DataFrame, dt: str, days: int) -> DataFrame:
    return online.where(F.col("dt").between(shift_day(dt, -days), dt))


def distinct_users(online: DataFrame, dt: str, days: int = WINDOW_DAYS) -> DataFrame:
    """Distinct boxes per region, platform and source over the trailing days."""
    seen = _window(online, dt, days).select("uuid", *KEYS).where(F.col("uuid").isNotNull()).distinct()
    return seen.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("stbnum"))


def residual_region(
    online: DataFrame, dt: str, days: int = WINDOW_DAYS, platform: str = "HNYD", source: str = "sdk",
    region: str = DEFAULT_REGION,
) -> DataFrame:
    """All boxes minus those seen in another region.

    A box counts when no row places it elsewhere, so one pass per box replaces
    the two distinct counts and their difference.
    """
    rows = _window(online, dt, days).where(
        (F.col("platform") == platform) & (F.col("source_type") == source)
        & F.col("uuid").isNotNull()
    )
    elsewhere = F.max(F.coalesce(F.col("regionid") != region, F.lit(False))).alias("_elsewhere")
    per_box = rows.groupBy("uuid").agg(elsewhere)
    return per_box.agg(
        F.coalesce(F.sum(F.when(F.col("_elsewhere"), 0).otherwise(1)), F.lit(0))
        .cast("bigint").alias("stbnum")
    ).select(
        "stbnum", F.lit(region).alias("regionid"), F.lit(platform).alias("platform"),
        F.lit(source).alias("source_type"),
    )


def stb_report(online: DataFrame, dt: str, days: int = WINDOW_DAYS) -> DataFrame:
    """Box numbers per area, platform and source with their totals.

    The default region of the mobile sdk is the residual.  ``<platform>_ALL`` sums
    the sources, area 14300 sums the areas; both totals come from one
    aggregation over the base rows.
    """
    return rollup(distinct_users(online, dt, days), residual_region(online, dt, days), dt)


def rollup(base: DataFrame, residual: DataFrame, dt: str) -> DataFrame:
    """The report of a day from the counts per area, platform and source, and the residual."""
    replaced = (
        (F.col("regionid") == DEFAULT_REGION)
        & (F.col("platform") == "HNYD") & (F.col("source_type") == "sdk")
    )
    kept = base.where(~F.coalesce(replaced, F.lit(False))).select("stbnum", *KEYS)
    rows = kept.unionByName(residual.where(F.col("stbnum") > 0)).where(
        F.col("regionid") != ALL_REGIONS
    )
    region, platform, source = (F.col(c) for c in KEYS)
    totals = rows.groupingSets(
        [[region, platform, source], [region, platform], [platform, source], [platform]],
        region, platform, source,
    ).agg(
        F.sum("stbnum").alias("stb_num"),
        F.grouping(region).alias("_r"),
        F.grouping(source).alias("_s"),
    )
    kind = F.when(F.col("_s") == 1, F.lit("all")).otherwise(source)
    return totals.select(
        F.lit(dt).alias("create_date"),
        F.when(F.col("_r") == 1, F.lit(ALL_REGIONS)).otherwise(region).alias("area_code"),
        platform,
        report_source(platform, kind).alias("source_type"),
        F.col("stb_num").cast("bigint").alias("stb_num"),
    )


def rows_to_insert(candidates: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """One candidate row for each key the target does not have yet, the smallest.

    Rows without a key, or with a null in it, are left out.
    """
    others = [c for c in candidates.columns if c not in keys]
    whole = candidates.dropna(subset=keys)
    if others:
        one = whole.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*")
    else:
        one = whole.select(*keys).distinct()
    return one.select(*candidates.columns).join(target.select(*keys), keys, "left_anti")


def new_relations(found: DataFrame, known: DataFrame) -> DataFrame:
    """One box id per user, for users without a stored relation."""
    best = found.groupBy("userid").agg(F.max("stbid").alias("stbid"))
    return best.join(known.select("userid"), "userid", "left_anti").select("userid", "stbid")


def count_differences(left: DataFrame, right: DataFrame, limit: int = 100) -> DataFrame:
    """Days (dt, count) on which two systems differ by more than ``limit``.

    A day the right side lacks always differs.
    """
    other = right.select("dt", F.col("count").alias("other_count"))
    joined = left.join(other, "dt", "left").withColumn("diff", F.col("count") - F.col("other_count"))
    return joined.where(F.coalesce("diff", F.lit(2 * limit)) > limit).select(
        "dt", "count", "other_count", "diff"
    )


def non_null_count(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).agg(F.count(F.lit(1)).alias("pv"))


def page_names(pageviews: DataFrame) -> DataFrame:
    """Distinct page ids and names worth publishing."""
    return pageviews.where(F.coalesce("pagename", F.lit("")) != "").select(
        "page_id", F.col("pagename").alias("page_name")
    ).distinct()


def media_names(pageviews: DataFrame) -> DataFrame:
    """Distinct media ids and names of page views."""
    return pageviews.where(
        (F.coalesce("media_id", F.lit("")) != "") & (F.coalesce("media_name", F.lit("")) != "")
    ).select("media_id", "media_name").distinct()


def path_page_names(paths: DataFrame) -> DataFrame:
    """Distinct page names of the path table, with a blank id."""
    names = F.explode(F.array("page_name", "page_name2", "page_name3")).alias("page_name")
    return paths.select(names).where(F.coalesce("page_name", F.lit("")) != "").distinct().select(
        F.lit("").alias("page_id"), "page_name"
    )
