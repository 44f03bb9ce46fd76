"""The daily jobs end to end, on logs rendered from the smallest driver tables."""

import os

import pytest
from pyspark.sql import functions as F

from tvtrail.operators import hotkeys
from tvtrail.plans import app_day, mobile_day, reports_day, telecom_day
from tvtrail.session import shared_folder
from tvtrail.sources import files
from workbench import frames, wire

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def logs(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("logs"))
    mobile = wire.mobile_lines(spark, SF).withColumn("dt", frames.day_of(F.col("s"))).cache()
    kinds = {"0x01": "type = 'signup'", "0x03": "type in ('view', 'click')", "0x09": "type = 'purchase'",
             "0x11": "type = 'error'"}
    for code, test in kinds.items():
        mobile.where(test).select("value", "dt").write.partitionBy("dt").text(f"{root}/mobile/sdk_{code}")
    mobile.where("type = 'purchase'").select("value", "dt").write.partitionBy("dt").text(f"{root}/mobile/sdk_0x04")
    telecom = wire.telecom_lines(spark, SF)
    for code, test in {"0x01": "type = 'signup'", "0x07": "type in ('view', 'click')"}.items():
        telecom.where(test).select("value").write.text(f"{root}/telecom/sdk_{code}/dt={frames.DAY}")
    wire.app_vod_lines(spark, SF).write.text(f"{root}/apps/itvrun_vod/dt={frames.DAY}")
    wire.online_lines(spark, SF).write.text(f"{root}/apps/itvrun_online/dt={frames.DAY}")
    return root


def dictionaries(spark):
    return mobile_day.Dictionaries(
        channels=frames.dict_channel(spark, SF), media=frames.dict_media(spark, SF),
        uploads=frames.upload_map(spark, SF), assets=frames.assets(spark, SF),
        test_users=frames.test_prefixes(spark, SF), review_words=frames.review_words(spark, SF))


def scratch_tables(spark):
    folder = shared_folder(spark).removeprefix("file:")
    return sorted(os.listdir(folder))


def rows(spark, warehouse, table):
    df = files.read_partition(spark, f"{warehouse}/{table}")
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


MOBILE_TABLES = (
    "res_power_on_day", "mid_fav_day", "mid_online_day", "user_info_pool", "mid_chnl_day", "mid_timeshift_day",
    "mid_vod_day", "res_vod_day", "mid_tvod_day", "mid_pageview_day", "mid_subject", "mid_path_statis",
    "mid_path_statis_result", "mid_order_day", "mid_order_releva", "mid_error_day",
)


def test_mobile_day(spark, logs, tmp_path, monkeypatch):
    out = str(tmp_path / "warehouse")
    args = (spark, f"{logs}/mobile", out, frames.DAY, "HNYD", "all", dictionaries(spark),
            frames.previous_pool(spark, SF))
    with pytest.raises(FileNotFoundError):  # not every record type has a folder here
        mobile_day.run(*args)
    args = (*args, "sdk", True)
    before = scratch_tables(spark)
    mobile_day.run(*args)
    assert scratch_tables(spark) == before  # what the steps wrote is removed
    first = {table: rows(spark, out, table) for table in MOBILE_TABLES}
    assert all(first[t] for t in MOBILE_TABLES if t not in ("mid_chnl_day", "mid_timeshift_day", "mid_tvod_day")), {
        t: len(r) for t, r in first.items()}
    pool = files.read_partition(spark, f"{out}/user_info_pool", frames.DAY, "HNYD", "sdk")
    assert pool.count() == pool.select("user_id").distinct().count()
    assert not pool.where("start_date = dt and (user_id like 'test%' or user_id like 'YX1%')").count()
    counts = files.read_partition(spark, f"{out}/mid_path_statis").agg(F.sum("ct")).first()[0]
    top = files.read_partition(spark, f"{out}/mid_path_statis_result").groupBy("type").agg(F.sum("ct").alias("n"))
    assert {r.type: r.n for r in top.collect()} == {"0": counts, "1": counts}

    mobile_day.run(*args)
    assert {table: rows(spark, out, table) for table in MOBILE_TABLES} == first

    # Every user treated as hot gives the same tables.
    seen = []

    def forced(df, key, ts):
        seen.append(hotkeys.find_hot_keys(df, key, ts, slice_rows=3))
        return seen[-1]

    monkeypatch.setattr(mobile_day, "find_hot_keys", forced)
    mobile_day.run(*args)
    assert any(seen) and {table: rows(spark, out, table) for table in MOBILE_TABLES} == first

    reports_day.minute_report(spark, out, frames.DAY, "HNYD", "sdk")
    reports_day.box_numbers(spark, out, frames.DAY)
    numbers = spark.read.parquet(f"{out}/stb_num_day")
    total = numbers.where("area_code = '14300' and source_type = 'HNYD_ALL'").first().stb_num
    assert total == files.read_partition(spark, f"{out}/mid_online_day").count()


def test_a_gap_in_the_pool_is_an_error(spark, logs, tmp_path):
    out = str(tmp_path / "warehouse")
    pool = frames.previous_pool(spark, SF)
    pool.withColumn("dt", F.lit("20231230")).write.partitionBy("dt", "platform", "source_type").parquet(f"{out}/user_info_pool")
    job = mobile_day.Job(spark, out, frames.DAY, "HNYD")
    with pytest.raises(FileNotFoundError, match="20231230"):
        mobile_day.previous_pool(job)
    assert mobile_day.previous_pool(mobile_day.Job(spark, out, frames.DAY, "HNYD", "sdk", True)).count() == 0
    assert mobile_day.previous_pool(mobile_day.Job(spark, out, "20231231", "HNYD")).count() == pool.count()
    assert mobile_day.previous_pool(mobile_day.Job(spark, out, "20231230", "HNYD")).count() == 0  # a rerun of the first day


def test_new_names(spark, tmp_path):
    from tvtrail import __main__ as cli

    out = str(tmp_path)
    day = {"dt": F.lit(frames.DAY), "platform": F.lit("HNYD"), "source_type": F.lit("sdk")}
    views = spark.createDataFrame(
        [("P1", "b", "M1", "m"), ("P1", "a", "M1", "n"), ("P2", "", "M2", ""), (None, "c", "", "x")],
        "page_id string, pagename string, media_id string, media_name string").withColumns(day)
    views.write.partitionBy(*day).parquet(f"{out}/mid_pageview_day")
    paths = spark.createDataFrame([("a", "z", "")], "page_name string, page_name2 string, page_name3 string")
    paths.withColumns({c: day[c] for c in ("dt", "platform")}).write.partitionBy("dt", "platform").parquet(f"{out}/mid_path_statis")
    for kind in ("pages", "media", "path-pages", "pages", "path-pages"):  # twice adds nothing
        cli.main(["names", "--warehouse", out, "--dt", frames.DAY, "--platform", "HNYD", "--kind", kind], spark)
    assert sorted(map(tuple, spark.read.parquet(f"{out}/page_names").select("page_id", "page_name").collect())) == [
        ("", "a"), ("", "z"), ("P1", "a")]
    assert [tuple(r) for r in spark.read.parquet(f"{out}/media_names").select("media_id", "media_name").collect()] == [("M1", "m")]


def test_flow_programme_and_relation_commands(spark, tmp_path):
    from tvtrail import __main__ as cli
    from tvtrail.operators import flow

    views = frames.channel_views(spark, SF)
    views.write.parquet(f"{tmp_path}/views")
    flow.guide_spine(frames.log_days(spark, SF)).write.parquet(f"{tmp_path}/guide")
    cli.main(["channel-flow", "--views", f"{tmp_path}/views", "--guide", f"{tmp_path}/guide", "--out", f"{tmp_path}/flow"], spark)
    assert spark.read.text(f"{tmp_path}/flow").count()
    cli.main(["programmes", "--guide", f"{tmp_path}/guide", "--table", "guide_by_command", "--path", f"{tmp_path}/epg"], spark)
    assert spark.table("guide_by_command").count() == spark.read.parquet(f"{tmp_path}/guide").count()
    spark.createDataFrame([("u1", "a"), ("u2", "c")], "userid string, stbid string").write.parquet(f"{tmp_path}/found")
    spark.createDataFrame([("u2",)], "userid string").write.parquet(f"{tmp_path}/known")
    cli.main(["relations", "--found", f"{tmp_path}/found", "--known", f"{tmp_path}/known", "--out", f"{tmp_path}/new"], spark)
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/new").collect()] == [("u1", "a")]


def test_programme_rows(spark):
    row = {"id": 1, "day": "d", "start_date": "s", "stop_date": "e", "channel_code": "c", "program_name": "p",
           "channel_name": "n", "title": "t", "more": "x"}
    got = reports_day.programme_rows(spark.createDataFrame([row]))
    assert got.columns == ["id", "dt", "start_time", "end_time", "channel_code", "program_name", "channel_name", "title"]


def test_unknown_state_and_platform(spark, tmp_path):
    for platform, state in (("HNYD", "nope"), ("XX", "all")):
        with pytest.raises(ValueError):
            mobile_day.run(spark, "x", str(tmp_path), frames.DAY, platform, state, None, None)


def test_telecom_day(spark, logs, tmp_path):
    """Without an order folder."""
    out = str(tmp_path / "warehouse")
    telecom_day.run(spark, f"{logs}/telecom", out, frames.DAY, "HNDX", frames.test_prefixes(spark, SF))
    views = files.read_partition(spark, f"{out}/mid_pageview_day")
    assert views.count() and views.where("length(create_time) <> 17").count() == 0
    assert views.where("serial_number = ''").count() == 0
    assert files.read_partition(spark, f"{out}/mid_path_statis").count()


def test_in_out_paths(spark, logs, tmp_path):
    out = str(tmp_path / "warehouse")
    reports_day.in_out_paths(spark, f"{logs}/mobile", out, frames.DAY, "HNYD", allow_missing=True)
    counts = files.read_partition(spark, f"{out}/res_full_path", frames.DAY, "HNYD")
    both = {r.lr: r.n for r in counts.groupBy("lr").agg(F.sum("ct").alias("n")).collect()}
    assert both[0] == both[1] > 0


def test_command_line(spark, logs, tmp_path):
    from tvtrail import __main__ as cli

    folder = str(tmp_path / "dictionaries")
    frames.test_prefixes(spark, SF).write.parquet(f"{folder}/test_user_prev")
    out = str(tmp_path / "warehouse")
    cli.main(["app-online", "--logs", f"{logs}/apps", "--warehouse", out, "--dictionaries", folder,
              "--dt", frames.DAY, "--platform", "HNDX"], spark)
    assert files.read_partition(spark, f"{out}/mid_online_day", frames.DAY, "HNDX", "apk").count()
    for name, df in {
        "dict_channel": frames.dict_channel(spark, SF), "dict_cms_media": frames.dict_media(spark, SF),
        "upload_category": frames.upload_map(spark, SF), "dict_second_media_vod": frames.assets(spark, SF),
        "dict_category_filter": frames.review_words(spark, SF).withColumn("operator", F.lit("HNYD")),
    }.items():
        df.write.parquet(f"{folder}/{name}")
    for day, starts in (("20240101", {"20240101"}), (frames.DAY, {"20240101", frames.DAY})):
        cli.main(["mobile", "--logs", f"{logs}/mobile", "--warehouse", out, "--dictionaries", folder,
                  "--dt", day, "--platform", "HNYD", "--state", "error", "--allow-missing"], spark)
        pool = files.read_partition(spark, f"{out}/user_info_pool", day, "HNYD", "sdk")
        assert {r.start_date for r in pool.select("start_date").distinct().collect()} <= starts
        assert pool.where("start_date = '20240101'").count()
    cli.main(["box-numbers", "--warehouse", out, "--dt", frames.DAY], spark)
    assert spark.read.parquet(f"{out}/stb_num_day").count()


def test_app_day(spark, logs, tmp_path):
    out = str(tmp_path / "warehouse")
    app_day.online_users(spark, f"{logs}/apps", out, frames.DAY, "HNDX", frames.test_prefixes(spark, SF))
    online = files.read_partition(spark, f"{out}/mid_online_day", frames.DAY, "HNDX", "apk")
    assert online.count() and online.where("uuid like 'test%'").count() == 0
    app_day.vod(spark, f"{logs}/apps", out, frames.DAY, frames.test_prefixes(spark, SF), frames.assets(spark, SF),
                frames.app_placements(spark, SF), frames.app_categories(spark, SF), frames.products(spark, SF),
                frames.review_words(spark, SF), allow_missing=True)  # the neighbouring days
    facts = files.read_partition(spark, f"{out}/mid_vod_day")
    results = files.read_partition(spark, f"{out}/res_vod_day")
    assert results.select("uuid").distinct().count() == facts.select("uuid").distinct().count()
    assert {r.flag for r in results.select("flag").distinct().collect()} <= {"0", "1", "2"}


def test_channel_flow(spark, tmp_path):
    from tvtrail.operators import flow

    guide = flow.guide_spine(frames.log_days(spark, SF))
    reports_day.channel_flow(spark, frames.channel_views(spark, SF), guide, str(tmp_path / "flow"))
    lines = spark.read.text(str(tmp_path / "flow"))
    assert lines.count() % (len(flow.IN_LABELS) + len(flow.OUT_LABELS)) == 0 and lines.count()


def test_programme_table_and_inserts(spark, tmp_path):
    guide = spark.createDataFrame([("20240101", "230000", "010000")], "day string, starttime string, endtime string")
    reports_day.programme_table(spark, guide, "epg_fix_test", str(tmp_path / "epg"))
    assert spark.table("epg_fix_test").first().endtime == "20240102010000"
    found = spark.createDataFrame([("u1", "a"), ("u1", "b"), ("u2", "c")], "userid string, stbid string")
    known = spark.createDataFrame([("u2",)], "userid string")
    reports_day.new_relations(found, known, "parquet", path=str(tmp_path / "rela"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "rela")).collect()] == [("u1", "b")]
