"""The mobile boxes' daily job: raw logs to facts, pool and path reports.

Every table is written to ``<warehouse>/<table>`` and its partition replaced, so
the job can be run again for a day.  Steps that several tables read (parsed
events, day sessions, pool, path counts) are written once to the shared folder,
read back, and removed when the job ends.  A missing day of logs, or a missing pool
of yesterday, is an error unless the caller allows gaps.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tvtrail import sinks
from tvtrail.functions.labels import check_platform
from tvtrail.functions.times import OWN, near_day
from tvtrail.operators import facts, orders, paths, pool as pools, sessions, vod
from tvtrail.operators.hotkeys import HotKeys, find_hot_keys
from tvtrail.schemas import (
    ERROR, HEART, HEARTBEAT, INIT, LIVE, LOOK_BACK, ORDER, PAGE_VIEW, PARTITION_COLUMNS, POOL_COLUMNS,
    TIME_SHIFT, VOD,
)
from tvtrail.session import Keep, prepare, stored, stored_once, working_tables
from tvtrail.sources import buckets, files, records, rejects

ALL_CODES = [INIT, LIVE, VOD, LOOK_BACK, TIME_SHIFT, PAGE_VIEW, ORDER, ERROR, HEARTBEAT]
STATES = ("init", "fav", "all", "live", "timeshift", "vod", "lookback", "pageview", "order", "error")
PATH_PARTITION = ("dt", "platform")
REJECT_PARTITION = (*PARTITION_COLUMNS, "job")


@dataclass(frozen=True)
class Dictionaries:
    """Dictionary tables as DataFrames; the caller chooses their store."""

    channels: DataFrame         # channel_name, conf_channel_id, conf_channel_name
    media: DataFrame            # media_id, media_name, category_id, category_name, channel_id
    uploads: DataFrame          # identityno, c_cid, pc_cid
    assets: DataFrame           # thremdeiaid, uuid, midianame, ydmedia, ltmedia, dxmedia, cp
    test_users: DataFrame       # key_word
    review_words: DataFrame     # category_name


@dataclass(frozen=True)
class Job:
    spark: SparkSession
    warehouse: str
    dt: str
    platform: str = "HNYD"
    source_type: str = "sdk"
    allow_missing: bool = False

    def path(self, table: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{table}"

    def write(self, df: DataFrame, table: str, partitions=PARTITION_COLUMNS) -> None:
        sinks.overwrite_partitions(df, self.path(table), partitions)

    def write_rejects(self, name: str, rows: DataFrame, reasons=rejects.RECORD_REASONS, n=None) -> None:
        """Publish how many records the job ``name`` could not use, by type and reason."""
        counts = rejects.report(rows, reasons, n).withColumns({
            "dt": F.lit(self.dt), "platform": F.lit(self.platform), "source_type": F.lit(self.source_type), "job": F.lit(name)})
        sinks.overwrite_partitions(counts, self.path("bad_records"), REJECT_PARTITION, files=1)

    def read(self, table: str, dt: str | None = None) -> DataFrame:
        return files.read_partition(
            self.spark, self.path(table), dt or self.dt, self.platform, self.source_type
        )


def pool_folder(job: Job, dt: str) -> str:
    return f"{job.path('user_info_pool')}/dt={dt}/platform={job.platform}/source_type={job.source_type}"


def previous_pool(job: Job) -> DataFrame:
    """Yesterday's pool, bucketed by user if it was written so; empty before the first day.

    If only older days are stored, going on would lose their users.
    """
    days = files.stored_days(job.spark, job.path("user_info_pool"), job.platform, job.source_type)
    yesterday = pools.yesterday(job.dt)
    if yesterday in days:
        labels = {"dt": F.lit(yesterday), "platform": F.lit(job.platform), "source_type": F.lit(job.source_type)}
        return buckets.read(job.spark, pool_folder(job, yesterday), "user_id").withColumns(labels).select(*POOL_COLUMNS)
    earlier = [day for day in days if day < yesterday]
    if earlier and not job.allow_missing:
        raise FileNotFoundError(f"no user pool of {yesterday}; the last one is of {earlier[-1]}")
    return job.spark.createDataFrame([], ", ".join(f"{c} string" for c in POOL_COLUMNS))


def power_ons(job: Job, logs: str) -> None:
    lines = files.read_days(job.spark, logs, [INIT], [job.dt], job.allow_missing)
    rows = stored(records.power_on_records(lines, job.dt, job.platform, job.source_type, rejects=True), "power-ons")
    job.write(rows.where(F.col("reject").isNull()).drop("code", "reject"), "res_power_on_day")
    job.write_rejects("power-on", rejects.record_rejects(rows))


def favourites(job: Job, logs: str) -> None:
    lines = files.read_days(job.spark, logs, [VOD], [job.dt], job.allow_missing)
    parsed = stored(records.parse_favourites(lines, job.platform, job.source_type, rejects=True), "favourites")
    job.write_rejects("favourites", rejects.record_rejects(parsed))
    rows = parsed.where(F.col("reject").isNull()).drop("code", "reject")
    hot = find_hot_keys(rows, "user_id", "ts")
    job.write(facts.favourite_facts(rows, job.read("user_info_pool"), job.dt, hot), "mid_fav_day")


def parsed_events(job: Job, logs: str, test_users: DataFrame) -> DataFrame:
    """Three days of records, stored by place of the day and type: most steps read one of either.

    Bad records are among them, as a state of their own.  Boxes whose clock is wrong send days of all
    kinds; these share one folder.
    """
    lines = files.read_log_days(job.spark, logs, job.dt, ALL_CODES, allow_missing=job.allow_missing)
    events = records.parse_mobile(lines, job.platform, job.source_type, rejects=True)
    kept = facts.drop_test_users(events, test_users, "user_id").withColumn("near", near_day(F.col("ts"), job.dt))
    return stored(kept, "events", ("near", "state"))


def good_events(events: DataFrame) -> DataFrame:
    return events.where(F.col("state") != rejects.REJECT).drop("code", "reject")


def of_day(events: DataFrame) -> DataFrame:
    """Records of the day of the job."""
    return events.where(F.col("near") == OWN).drop("near")


def active_day(events: DataFrame, found: DataFrame) -> DataFrame:
    """What the active users are counted from: the day's records and sessions."""
    today = of_day(events).where(F.col("state").isin(PAGE_VIEW, ERROR, ORDER, HEART, INIT))
    return today.select("user_id", "state", "ts", "rid", *pools.POOL_ATTRIBUTES).unionByName(
        found.select("user_id", "state"), allowMissingColumns=True
    )


def user_pool(job: Job, events: DataFrame, found: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Write the pool of the day, bucketed by user: merging a day shuffles its active users only."""
    active = stored(
        pools.active_users(active_day(events, found), job.dt, job.platform, job.source_type),
        "active",
    )
    job.write(pools.online_day(active), "mid_online_day")
    n = buckets.setting(job.spark)
    stored_before = buckets.bucket_count(job.spark, pool_folder(job, pools.yesterday(job.dt)))
    merged = pools.merge_pool(active, previous_pool(job) if previous is None else previous, job.dt)
    buckets.write(
        merged.drop(*PARTITION_COLUMNS), pool_folder(job, job.dt), "user_id", n, aligned=previous is None and stored_before == n)
    return job.read("user_info_pool")


def vod_tables(job: Job, found: DataFrame, pool: DataFrame, d: Dictionaries, hot: HotKeys, keep: Keep) -> None:
    views = stored(facts.with_assets(facts.vod_facts(found, pool, hot), d.assets), "vod")
    job.write(views.drop("rid"), "mid_vod_day")
    resolved = vod.resolve_categories(views, d.media, d.uploads, d.review_words, keep)
    job.write(resolved.drop("rid"), "res_vod_day")


def path_tables(job: Job, events: DataFrame, pool: DataFrame, hot: HotKeys) -> None:
    counts = paths.path_counts(events, pool, hot)
    job.write(counts, "mid_path_statis", PATH_PARTITION)
    # The report reads the table just written instead of counting again.
    counts = files.read_partition(job.spark, job.path("mid_path_statis"), job.dt, job.platform)
    top = paths.top_paths(counts).unionByName(paths.top_paths(counts, end=True))
    job.write(top, "mid_path_statis_result", PATH_PARTITION)


def run(
    spark: SparkSession,
    logs: str,
    warehouse: str,
    dt: str,
    platform: str,
    state: str,
    dictionaries: Dictionaries,
    previous: DataFrame | None = None,
    source_type: str = "sdk",
    allow_missing: bool = False,
) -> None:
    """Run the parts ``state`` names: one record type, ``init``, ``fav`` or ``all``.

    ``previous`` replaces yesterday's partition of the pool table.  With
    ``allow_missing``, absent log folders and an absent pool of yesterday count as empty.
    """
    if state not in STATES:
        raise ValueError(f"unknown state {state!r}, expected one of {STATES}")
    job = Job(prepare(spark), warehouse, dt, check_platform(platform), source_type, allow_missing)
    with working_tables(spark):
        if state in ("init", "all"):
            power_ons(job, logs)
        if state not in ("init", "fav"):
            _process(job, logs, state, dictionaries, previous)
        # After the pool of the day, which favourites are joined with.
        if state in ("fav", "all"):
            favourites(job, logs)


def _process(job: Job, logs: str, state: str, d: Dictionaries, previous: DataFrame | None) -> None:
    if previous is None:
        previous_pool(job)  # a gap is an error before any work is done
    parsed = parsed_events(job, logs, d.test_users)
    job.write_rejects("mobile", rejects.record_rejects(parsed))
    events = good_events(parsed)
    hot = find_hot_keys(events, "user_id", "ts")
    keep = stored_once()
    found = stored(
        facts.with_channel_names(sessions.day_sessions(events.drop("near"), job.dt, hot), d.channels, keep), "sessions"
    )
    pool = user_pool(job, events, found, previous)

    day = of_day(events)

    def wanted(*names: str) -> bool:
        return state == "all" or state in names

    if wanted("live", "timeshift"):
        job.write(facts.live_facts(found, pool, hot), "mid_chnl_day")
        job.write(facts.timeshift_facts(found, pool, hot), "mid_timeshift_day")
    if wanted("vod"):
        vod_tables(job, found, pool, d, hot, keep)
    if wanted("lookback"):
        job.write(facts.lookback_facts(found, pool, hot), "mid_tvod_day")
    if wanted("pageview"):
        pages = facts.with_search_names(day.where(F.col("state") == PAGE_VIEW), d.media, keep)
        job.write(facts.pageview_facts(pages, pool, hot), "mid_pageview_day")
        job.write(facts.topic_visits(day, pool, hot), "mid_subject")
        path_tables(job, day, pool, hot)
    if wanted("order"):
        job.write(facts.order_facts(day, pool, hot), "mid_order_day")
        job.write(orders.order_relations(day, pool, hot), "mid_order_releva", PATH_PARTITION)
    if wanted("error"):
        job.write(facts.error_facts(day, pool, hot), "mid_error_day")
