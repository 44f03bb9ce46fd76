"""Command line of the daily jobs.

    spark-submit ... -m tvtrail mobile --logs L --warehouse W --dictionaries D --dt 20240102 --platform HNYD

Dictionaries are tables below one folder, named as in ``DICTIONARIES``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from tvtrail.plans import app_day, mobile_day, reports_day, telecom_day
from tvtrail.session import build

DICTIONARIES = (
    "dict_channel", "dict_cms_media", "upload_category", "dict_second_media_vod", "test_user_prev",
    "dict_category_filter", "hnlt_user_areacode", "t_hnyd_rela", "app_placement",
    "app_category", "dict_prodasset",
)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tvtrail")
    jobs = parser.add_subparsers(dest="job", required=True)
    options = {
        "mobile": ("logs", "warehouse", "dictionaries", "dt", "platform"),
        "telecom": ("logs", "warehouse", "dictionaries", "dt", "platform"),
        "app-online": ("logs", "warehouse", "dictionaries", "dt", "platform"),
        "app-vod": ("logs", "warehouse", "dictionaries", "dt"),
        "in-out-paths": ("logs", "warehouse", "dt", "platform"),
        "path-period": ("warehouse", "since", "dt", "platform"),
        "minutes": ("warehouse", "dt", "platform", "source-type"),
        "box-numbers": ("warehouse", "dt"),
        "names": ("warehouse", "dt", "platform", "kind"),
        "channel-flow": ("views", "guide", "out"),
        "programmes": ("guide", "table"),
        "relations": ("found", "known", "out"),
        "copy-programmes": ("source-url", "source-table", "target-url", "target-table"),
    }
    for name, needed in options.items():
        job = jobs.add_parser(name)
        for option in needed:
            job.add_argument(f"--{option}", required=True)
        if name == "mobile":
            job.add_argument("--state", default="all", choices=mobile_day.STATES)
            job.add_argument("--source-type", default="sdk")
        if "logs" in needed:
            job.add_argument("--allow-missing", action="store_true", help="absent log folders count as empty")
        if name == "box-numbers":
            job.add_argument("--rebuild", action="store_true", help="count from all days, after a correction of earlier ones")
        if name == "programmes":
            job.add_argument("--path", help="folder of the table; managed by the catalog without it")
        job.add_argument("--time-zone", default="UTC", help="zone of the reporting day")
    return parser


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    dt = getattr(args, "dt", None)
    spark = spark or build(f"tvtrail-{args.job}-{dt or 'all'}", time_zone=args.time_zone)
    source_type = "apk" if args.job.startswith("app-") else "sdk"
    platform = getattr(args, "platform", "HNDX")

    def table(name: str) -> DataFrame:
        """A dictionary, cut to the day, platform and source it has columns for."""
        found = spark.read.parquet(f"{args.dictionaries}/{name}")
        wanted = {"dt": args.dt, "platform": platform, "operator": platform, "source_type": source_type}
        for column, value in wanted.items():
            if column in found.columns:
                found = found.where(F.col(column).cast("string") == value)
        return found

    if args.job == "mobile":
        dictionaries = mobile_day.Dictionaries(
            channels=table("dict_channel"), media=table("dict_cms_media"),
            uploads=table("upload_category"), assets=table("dict_second_media_vod"),
            test_users=table("test_user_prev"), review_words=table("dict_category_filter"),
        )
        mobile_day.run(
            spark, args.logs, args.warehouse, args.dt, args.platform, args.state, dictionaries,
            source_type=args.source_type, allow_missing=args.allow_missing,
        )
    elif args.job == "telecom":
        telecom_day.run(
            spark, args.logs, args.warehouse, args.dt, args.platform, table("test_user_prev"), args.allow_missing
        )
    elif args.job == "app-online":
        areas = table("hnlt_user_areacode") if args.platform == "HNLT" else None
        renames = table("t_hnyd_rela") if args.platform == "HNYD" else None
        app_day.online_users(
            spark, args.logs, args.warehouse, args.dt, args.platform, table("test_user_prev"), areas, renames,
            args.allow_missing,
        )
    elif args.job == "app-vod":
        app_day.vod(
            spark, args.logs, args.warehouse, args.dt, table("test_user_prev"),
            table("dict_second_media_vod"), table("app_placement"), table("app_category"),
            table("dict_prodasset"), table("dict_category_filter"), allow_missing=args.allow_missing,
        )
    elif args.job == "in-out-paths":
        reports_day.in_out_paths(
            spark, args.logs, args.warehouse, args.dt, args.platform, args.allow_missing)
    elif args.job == "path-period":
        reports_day.path_period(spark, args.warehouse, args.since, args.dt, args.platform)
    elif args.job == "minutes":
        reports_day.minute_report(spark, args.warehouse, args.dt, args.platform, args.source_type)
    elif args.job == "box-numbers":
        reports_day.box_numbers(spark, args.warehouse, args.dt, args.rebuild)
    elif args.job == "names":
        reports_day.new_names(spark, args.warehouse, args.dt, args.platform, args.kind)
    elif args.job == "channel-flow":
        reports_day.channel_flow(spark, spark.read.parquet(args.views), spark.read.parquet(args.guide), args.out)
    elif args.job == "programmes":
        reports_day.programme_table(spark, spark.read.parquet(args.guide), args.table, args.path)
    elif args.job == "relations":
        found, known = spark.read.parquet(args.found), spark.read.parquet(args.known)
        reports_day.new_relations(found, known, "parquet", path=args.out)
    else:
        reports_day.copy_programmes(
            spark, {"url": args.source_url}, args.source_table, "jdbc", url=args.target_url, dbtable=args.target_table)


if __name__ == "__main__":
    main()
