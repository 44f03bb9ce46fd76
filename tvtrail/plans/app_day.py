"""The apps' daily jobs: heartbeats to online users, VOD records to VOD facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tvtrail.functions.labels import check_platform
from tvtrail.functions.times import halo_days
from tvtrail.operators import app_vod, facts
from tvtrail.plans.mobile_day import Job
from tvtrail.session import prepare, stored, stored_once, working_tables
from tvtrail.sources import app_lines, files, rejects


def online_users(
    spark: SparkSession,
    logs: str,
    warehouse: str,
    dt: str,
    platform: str,
    test_users: DataFrame,
    areas: DataFrame | None = None,
    renames: DataFrame | None = None,
    allow_missing: bool = False,
) -> None:
    job = Job(prepare(spark), warehouse, dt, check_platform(platform), "apk")
    lines = files.read_lines(spark, [f"{logs}/itvrun_online/dt={dt}/*"], optional=allow_missing)
    with working_tables(spark):
        # Counted before the region rule: heartbeats repeat all day, and bad lines share a row per reason.
        parsed = app_lines.parse_online(lines, rejects=True)
        counted = stored(parsed.groupBy("uuid", "apk_version", "reject").agg(F.count(F.lit(1)).alias("lines")), "online")
        job.write_rejects("app-online", rejects.line_rejects(counted, "online", "lines"), rejects.ONLINE_REASONS, F.col("lines"))
        seen = counted.where(F.col("reject").isNull()).select("uuid", "apk_version")
        rows = app_lines.online_regions(seen, platform, areas, renames, stored_once()).select(
            "uuid", "regionid", "apk_version", F.lit(dt).alias("dt"),
            F.lit(platform).alias("platform"), F.lit("apk").alias("source_type"),
        )
        kept = facts.drop_test_users(rows.distinct(), test_users, "uuid")
        job.write(kept, "mid_online_day")


def vod(
    spark: SparkSession,
    logs: str,
    warehouse: str,
    dt: str,
    test_users: DataFrame,
    assets: DataFrame,
    assists: DataFrame,
    categories: DataFrame,
    products: DataFrame,
    review_words: DataFrame,
    platform: str = "HNDX",
    allow_missing: bool = False,
) -> None:
    """Results of an app day; its tables of the steps are removed at the end."""
    with working_tables(spark):
        _vod(spark, logs, warehouse, dt, test_users, assets, assists, categories, products, review_words,
             platform, allow_missing)


def _vod(
    spark, logs, warehouse, dt, test_users, assets, assists, categories, products, review_words, platform, allow_missing,
) -> None:
    job = Job(prepare(spark), warehouse, dt, check_platform(platform), "apk")
    patterns = [f"{logs}/itvrun_vod/dt={day}/*" for day in halo_days(dt)]
    lines = files.read_lines(spark, patterns, optional=allow_missing)
    checked = stored(app_lines.parse_app_vod(lines, rejects=True), "app-lines")
    job.write_rejects("app-vod", rejects.line_rejects(checked, "vod"), rejects.APP_VOD_REASONS)
    parsed = facts.drop_test_users(checked.where(F.col("reject").isNull()).drop("reject"), test_users, "uuid")
    views = stored(app_vod.app_views(parsed, dt), "app-views")
    named = facts.with_assets(
        views.withColumnRenamed("clum_id", "channel_id").drop("pro_id"), assets, "dxmedia"
    )
    labels = {"dt": F.lit(dt), "platform": F.lit(platform), "source_type": F.lit("apk")}
    job.write(named.withColumns(labels), "mid_vod_day")
    results = app_vod.app_results(views, assets, assists, categories, products, review_words, stored_once())
    job.write(results.withColumns(labels), "res_vod_day")
