"""Daily reports over the fact tables: minutes, box numbers, channel flow, names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tvtrail import sinks
from tvtrail.functions.labels import check_platform
from tvtrail.functions.times import to_epoch
from tvtrail.operators import flow, last_seen, minutes, paths, pool as pools, reports
from tvtrail.operators.hotkeys import find_hot_keys
from tvtrail.plans.mobile_day import PATH_PARTITION, Job
from tvtrail.schemas import ORDER, PAGE_VIEW
from tvtrail.session import prepare, stored, working_tables
from tvtrail.sources import buckets, files, records, rejects


# --- fixed values: columns of the programme guide, and the names published for some ---
PROGRAMME_SOURCE = (
    "id", "day", "start_date", "stop_date", "channel_code", "program_name", "channel_name", "title",
)
PROGRAMME_COLUMNS = {"day": "dt", "start_date": "start_time", "stop_date": "end_time"}


def minute_report(spark: SparkSession, warehouse: str, dt: str, platform: str, source_type: str) -> None:
    """Watched seconds per minute from matched live viewing."""
    job = Job(prepare(spark), warehouse, dt, check_platform(platform), source_type)
    live = job.read("mid_chnl_day").where(F.col("live_flag") == "0")
    found = live.select(
        F.col("conf_channel_code").alias("conf_channel_id"), F.col("regionid").alias("area_code"),
        to_epoch(F.col("play_start_time")).alias("start_ts"),
        to_epoch(F.col("play_end_time")).alias("end_ts"), "platform", "source_type",
    )
    job.write(minutes.minute_report(found, dt), "kd_live_minute")


def box_state(job: Job, rebuild: bool = False) -> DataFrame:
    """When each box was last seen, after the day of the job; written to ``box_last_seen``.

    Yesterday's state and the day's online users give it.  Without that state, or to ``rebuild``, all
    days of the window are read, as after a correction of earlier days.
    """
    online = files.read_partition(job.spark, job.path("mid_online_day"))
    before, now = (f"{job.path('box_last_seen')}/dt={dt}" for dt in (pools.yesterday(job.dt), job.dt))
    n, known = buckets.setting(job.spark), buckets.bucket_count(job.spark, before)
    if rebuild or known is None:
        state = last_seen.state_of(online, job.dt)
    else:
        state = last_seen.advance(
            buckets.read(job.spark, before, "uuid"), online.where(F.col("dt") == job.dt), job.dt)
    buckets.write(state, now, "uuid", n, aligned=not rebuild and known == n)
    return buckets.read(job.spark, now, "uuid")


def box_numbers(spark: SparkSession, warehouse: str, dt: str, rebuild: bool = False) -> None:
    job = Job(prepare(spark), warehouse, dt)
    state = box_state(job, rebuild)
    report = reports.rollup(last_seen.distinct_users(state, dt), last_seen.residual_region(state, dt), dt)
    sinks.overwrite_partitions(report, job.path("stb_num_day"), ("create_date",))


def in_out_paths(
    spark: SparkSession, logs: str, warehouse: str, dt: str, platform: str, allow_missing: bool = False
) -> None:
    """Paths into and out of each page."""
    job = Job(prepare(spark), warehouse, dt, check_platform(platform))
    lines = files.read_days(spark, logs, [PAGE_VIEW, ORDER], [dt], allow_missing)
    with working_tables(spark):
        parsed = stored(records.positional_pages(lines, rejects=True), "pages")
        job.write_rejects("in-out-paths", rejects.record_rejects(parsed))
        pages = parsed.where(F.col("reject").isNull()).drop("code", "reject")
        counts = paths.in_out_counts(pages, find_hot_keys(pages, "user_id", "ts"))
        labels = {"dt": F.lit(dt), "platform": F.lit(platform)}
        job.write(counts.withColumns(labels), "res_full_path", PATH_PARTITION)


def path_period(spark: SparkSession, warehouse: str, first: str, last: str, platform: str) -> None:
    """Top paths of all days from ``first`` to ``last``, from the stored counts of the days."""
    job = Job(prepare(spark), warehouse, last, check_platform(platform))
    days = files.read_partition(spark, job.path("mid_path_statis"), platform=platform).where(F.col("dt").between(first, last))
    with working_tables(spark):
        counts = stored(paths.add_counts(days), "period-counts")
        top = paths.top_paths(counts).unionByName(paths.top_paths(counts, end=True))
        labels = {"dt": F.lit(last), "since": F.lit(first), "platform": F.lit(platform)}
        job.write(top.withColumns(labels), "path_period_result", ("since", "dt", "platform"))


def channel_flow(
    spark: SparkSession, views: DataFrame, guide: DataFrame, out: str
) -> None:
    """``views``: stbid, day, starttime, endtime, content.  ``guide``: day, starttime,
    endtime of the main channel's programmes."""
    prepare(spark)
    named = flow.named_views(views)
    if "rid" not in named.columns:
        named = named.withColumn("rid", F.xxhash64(*sorted(views.columns)))
    with working_tables(spark):
        named = stored(named, "channel-views")
        hot = find_hot_keys(named, "stbid", "start_ts")
        counts = flow.flow_counts(flow.flow_events(named, flow.programme_times(guide), hot, stored))
        sinks.write_text(flow.flow_lines(flow.flow_report(counts)), out)


def programme_table(spark: SparkSession, guide: DataFrame, name: str, path: str | None = None) -> None:
    sinks.save_table(flow.programme_times(guide), name, path)


# Where new names come from: fact table, its rows, the table of known names, its key.
NAMES = {
    "pages": ("mid_pageview_day", reports.page_names, "page_names", ("page_id",)),
    "media": ("mid_pageview_day", reports.media_names, "media_names", ("media_id",)),
    # Path pages have a blank id; there the name is what tells them apart.
    "path-pages": ("mid_path_statis", reports.path_page_names, "page_names", ("page_id", "page_name")),
}


def new_names(spark: SparkSession, warehouse: str, dt: str, platform: str, kind: str) -> None:
    """Append the names of a day that the table of names lacks."""
    source, names, known, keys = NAMES[kind]
    job = Job(prepare(spark), warehouse, dt, check_platform(platform))
    found = names(files.read_partition(spark, job.path(source), dt, platform))
    if files.existing_paths(spark, [job.path(known)]):
        target = spark.read.parquet(job.path(known))
    else:
        target = spark.createDataFrame([], found.schema)
    sinks.insert_missing(found, target, job.path(known), list(keys))


def new_relations(found: DataFrame, known: DataFrame, fmt: str, **target: str) -> None:
    """Append the relations another store lacks, e.g. ``fmt='jdbc'``."""
    sinks.append_external(reports.new_relations(found, known), fmt, **target)


def programme_rows(programmes: DataFrame) -> DataFrame:
    """A programme guide with the columns it is published with."""
    return programmes.select(*[F.col(name).alias(PROGRAMME_COLUMNS.get(name, name)) for name in PROGRAMME_SOURCE])


def copy_programmes(
    spark: SparkSession, source: dict[str, str], table: str, fmt: str, **target: str
) -> None:
    """Copy the programme guide ``table`` from one store to another."""
    rows = files.read_jdbc(spark, source, f"select {', '.join(PROGRAMME_SOURCE)} from {table}")
    sinks.append_external(programme_rows(rows), fmt, **target)
