"""The telecom boxes' daily job: page views, order relations and paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tvtrail.functions.labels import check_platform
from tvtrail.operators import facts, orders, pool as pools
from tvtrail.operators.hotkeys import find_hot_keys
from tvtrail.plans.mobile_day import PATH_PARTITION, Job, path_tables
from tvtrail.schemas import INIT, ORDER, PAGE_VIEW
from tvtrail.session import prepare, stored, working_tables
from tvtrail.sources import files, records, rejects


def users_of_day(events: DataFrame, dt: str) -> DataFrame:
    """One row per switched-on user; joins with it keep one row per record."""
    return pools.last_power_on(events, dt).select(
        "user_id", "regionid", "apk_version", F.lit(dt).alias("dt"), "platform", "source_type"
    )


def run(
    spark: SparkSession, logs: str, warehouse: str, dt: str, platform: str, test_users: DataFrame,
    allow_missing: bool = False,
) -> None:
    """Order logs are read where they exist; the job does without them otherwise."""
    job = Job(prepare(spark), warehouse, dt, check_platform(platform), allow_missing=allow_missing)
    with working_tables(spark):
        _process(job, logs, platform, test_users)


def _process(job: Job, logs: str, platform: str, test_users: DataFrame) -> None:
    dt = job.dt
    lines = files.read_days(job.spark, logs, [INIT, PAGE_VIEW, ORDER], [dt], job.allow_missing)
    parsed = records.parse_telecom(lines, platform, rejects=True)
    parsed = stored(facts.drop_test_users(parsed, test_users, "user_id"), "telecom-events")
    job.write_rejects("telecom", rejects.record_rejects(parsed))
    events = parsed.where(F.col("reject").isNull()).drop("code", "reject")
    hot = find_hot_keys(events, "user_id", "ts")
    pool = stored(users_of_day(events, dt), "telecom-users")
    job.write(facts.pageview_facts(events, pool, hot), "mid_pageview_day")
    relations = orders.order_relations(events, pool, hot, parent=False)
    job.write(relations, "mid_order_releva", PATH_PARTITION)
    path_tables(job, events, pool, hot)
