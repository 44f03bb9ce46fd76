from pyspark.sql import functions as F

from tvtrail.operators import app_vod, facts, pool, reports, vod, words
from tvtrail.schemas import POOL_ATTRIBUTES, POOL_COLUMNS

DAY, D = "20240102", 1704153600


def events(spark, *rows):
    """rows: (user, state, ts, region, version)"""
    blank = [F.lit("").alias(a) for a in POOL_ATTRIBUTES if a not in ("regionid", "apk_version")]
    df = spark.createDataFrame(
        [(*r, i) for i, r in enumerate(rows)],
        "user_id string, state string, ts bigint, regionid string, apk_version string, rid bigint")
    return df.select("*", *blank)


def test_unknown_region_does_not_replace_a_known_one(spark):
    log = events(spark, ("old", "0x100", D, "14301", ""), ("old2", "0x01", D, "14309", "A.2"),
                 ("new", "0x100", D, "14301", ""), ("new2", "0x01", D, "14303", ""))
    active = pool.active_users(log, DAY, "HNYD")
    row = {c: "" for c in POOL_COLUMNS} | {"start_date": "20230101", "create_date": "20230101",
                                           "platform": "HNYD", "source_type": "sdk", "dt": "20240101"}
    known = [row | {"user_id": u, "regionid": "14305", "apk_version": "A.1"} for u in ("old", "old2", "gone")]
    previous = spark.createDataFrame(known).select(*POOL_COLUMNS)
    merged = {r.user_id: r for r in pool.merge_pool(active, previous, DAY).collect()}
    assert {u: (r.regionid, r.apk_version, r.start_date, r.dt) for u, r in merged.items()} == {
        "old": ("14305", "A.1", "20230101", DAY), "old2": ("14309", "A.2", "20230101", DAY),
        "gone": ("14305", "A.1", "20230101", DAY), "new": ("14301", "", DAY, DAY), "new2": ("14303", "", DAY, DAY)}


def test_attributes_are_those_of_the_last_power_on(spark):
    """A later power-on wins although its texts sort lower; its blanks are its own."""
    log = events(spark, ("u", "0x01", D + 8, "14309", "A.9.1"), ("u", "0x01", D + 20, "14302", "A.10.0"),
                 ("u", "0x100", D + 30, "14301", ""), ("w", "0x01", D + 8, "14309", "A.9"), ("w", "0x01", D + 9, "14302", ""))
    got = {r.user_id: (r.regionid, r.apk_version) for r in pool.active_users(log, DAY, "HNYD").collect()}
    assert got == {"u": ("14302", "A.10.0"), "w": ("14302", "")}


def test_pool_merge_joins_once(spark):
    log = events(spark, ("u", "0x01", D + 8, "14309", "A.9.1"))
    previous = spark.createDataFrame([], ", ".join(f"{c} string" for c in POOL_COLUMNS))
    plan = pool.merge_pool(pool.active_users(log, DAY, "HNYD"), previous, DAY)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and plan.count("Join") == 3  # users with their last power-on, in two steps


def test_last_power_on_needs_the_day(spark):
    log = events(spark, ("u", "0x01", D + 5, "14302", "A"), ("u", "0x01", D + 90000, "14303", "B"),
                 ("u", "0x01", D + 9, "14304", "C"), ("v", "0x01", D - 1, "14305", "D"))
    assert [(r.user_id, r.apk_version) for r in pool.last_power_on(log, DAY).collect()] == [("u", "C")]


def test_box_numbers(spark):
    rows = [("a", "14301", DAY, "HNYD", "sdk"), ("a", "14302", DAY, "HNYD", "sdk"), ("b", "14301", DAY, "HNYD", "sdk"),
            ("c", "14301", "20231004", "HNYD", "sdk"), ("d", "14301", "20231003", "HNYD", "sdk"),
            ("a", "14302", DAY, "HNYD", "apk"), ("z", "14303", DAY, "HNDX", "c3")]
    online = spark.createDataFrame(rows, "uuid string, regionid string, dt string, platform string, source_type string")
    got = {(r.area_code, r.source_type): r.stb_num for r in reports.stb_report(online, DAY).collect()}
    assert got == {
        ("14301", "HNYD_SDK"): 2, ("14302", "HNYD_SDK"): 1, ("14302", "HNYD_APK"): 1, ("14303", "HNDX_C3"): 1,
        ("14301", "HNYD_ALL"): 2, ("14302", "HNYD_ALL"): 2, ("14303", "HNDX_ALL"): 1, ("14300", "HNYD_SDK"): 3,
        ("14300", "HNYD_APK"): 1, ("14300", "HNDX_C3"): 1, ("14300", "HNYD_ALL"): 4, ("14300", "HNDX_ALL"): 1}


def test_words(spark):
    names = spark.createDataFrame([("test1",), ("atest",), ("x",), ("",), (None,), ("abcx",)], "_name string")
    listed = spark.createDataFrame([("test",), ("x",), ("",), (None,)], "w string")
    assert {r[0] for r in words.starting_with(names, listed, "w").collect()} == {"test1", "x"}
    assert {r[0] for r in words.containing(names, listed, "w").collect()} == {"test1", "atest", "x", "abcx"}
    none = listed.where("false")
    assert words.starting_with(names, none, "w").count() == 0
    assert facts.drop_test_users(names, none.withColumnRenamed("w", "key_word"), "_name").count() == names.count()


def test_prefix_filter_reads_its_input_once(spark, tmp_path):
    names = spark.createDataFrame([("test1",), ("atest",), ("x",), ("",), (None,), ("te",)], "_name string")
    listed = spark.createDataFrame([("test",), ("x",), ("",), (None,), ("x",)], "key_word string")
    names.write.parquet(str(tmp_path / "names"))
    kept = facts.drop_test_users(spark.read.parquet(str(tmp_path / "names")), listed, "_name")
    assert sorted((r[0] for r in kept.collect()), key=str) == ["", None, "atest", "te"]
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_upload_ids_need_an_id_and_a_category(spark):
    media = spark.createDataFrame([("m", "n", "CAT7", "c", "ch")],
        "media_id string, media_name string, category_id string, category_name string, channel_id string")
    uploads = spark.createDataFrame([("UP1", None, None), ("UP1", "CAT1", "ch1"), ("", "WRONG", "w"), (None, "WRONG", "w"),
        ("UP2", None, "ch2")], "identityno string, c_cid string, pc_cid string")
    columns = ("uuid", "regionid", "play_start_time", "play_end_time", "media_id", "media_name", "category_id",
               "apk_version", "media_uuid", "channel_id", "dt", "platform", "source_type")
    views = [dict.fromkeys(columns, "") | {"uuid": u, "media_id": "m", "category_id": c, "rid": i}
             for i, (u, c) in enumerate([("a", "UP1"), ("b", ""), ("c", "UP2"), ("d", None)])]
    schema = ", ".join(f"{c} string" for c in columns) + ", rid int"
    rows = spark.createDataFrame([tuple(v[c] for c in (*columns, "rid")) for v in views], schema)
    got = vod.resolve_categories(rows, media, uploads)
    assert sorted((r.uuid, r.category_id) for r in got.collect()) == [
        ("a", "CAT1"), ("b", "CAT7"), ("c", ""), ("d", "CAT7")]


def test_a_view_of_review_categories_only_disappears(spark):
    media = spark.createDataFrame(
        [("m1", "n", "c1", "review x", "ch"), ("m1", "n", "c2", "good", "ch"), ("m1", "n", "c3", "fine", "ch"),
         ("m2", "n", "c1", "review x", "ch")],
        "media_id string, media_name string, category_id string, category_name string, channel_id string")
    uploads = spark.createDataFrame([("up", "c9", "ch9")], "identityno string, c_cid string, pc_cid string")
    review = spark.createDataFrame([("review",)], "category_name string")
    columns = ("uuid", "regionid", "play_start_time", "play_end_time", "media_id", "media_name", "category_id",
               "apk_version", "media_uuid", "channel_id", "dt", "platform", "source_type")
    views = [dict.fromkeys(columns, "") | {"uuid": u, "media_id": m, "category_id": c, "rid": i}
             for i, (u, m, c) in enumerate([("a", "m1", ""), ("b", "m2", ""), ("c", "m9", ""), ("d", "m1", "up"), ("e", "m1", "?")])]
    got = vod.resolve_categories(spark.createDataFrame(views), media, uploads, review)
    assert sorted((r.uuid, r.category_id, r.channel_id, r.flag) for r in got.collect()) == [
        ("a", "c2", "ch", "0"), ("a", "c3", "ch", "1"), ("c", "", "", "0"), ("d", "c9", "ch9", "0"),
        ("e", "c2", "ch", "0"), ("e", "c3", "ch", "1")]


def test_deduplication(spark):
    base = {c: "x" for c in app_vod.COLUMNS}
    rows = [base | {"uuid": u, "play_start_time": b, "play_end_time": e} for u, b, e in [
        ("copy", "1", "9"), ("copy", "1", "9"), ("end", "1", "9"), ("end", "2", "9"), ("start", "1", "8"), ("start", "1", "9")]]
    got = app_vod.deduplicate(spark.createDataFrame(rows).select(*app_vod.COLUMNS))
    assert sorted((r.uuid, r.play_start_time, r.play_end_time) for r in got.collect()) == [
        ("end", "1", "9"), ("start", "1", "9")]


def test_reconciliation_and_inserts(spark):
    left = spark.createDataFrame([("d1", 500), ("d2", 100), ("d3", 90)], "dt string, count bigint")
    right = spark.createDataFrame([("d1", 100), ("d2", 50)], "dt string, count bigint")
    got = reports.count_differences(left, right)
    assert sorted((r.dt, r.diff) for r in got.collect()) == [("d1", 400), ("d3", None)]
    new = reports.rows_to_insert(
        spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string"),
        spark.createDataFrame([(2,)], "k int"), ["k"])
    assert [tuple(r) for r in new.collect()] == [(1, "a")]
    twice = spark.createDataFrame([("p", "x"), ("p", "w"), (None, "y"), ("q", None)], "k string, v string")
    one = reports.rows_to_insert(twice, twice.where("false"), ["k"])
    assert sorted(map(tuple, one.collect())) == [("p", "w"), ("q", None)]
