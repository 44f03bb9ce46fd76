"""Dictionary joins split a media, channel, box or category that a third of all rows share."""

import re

import pytest
from pyspark.sql import functions as F

from tvtrail.operators import app_vod, facts, vod
from tvtrail.session import stored, stored_once, working_tables
from tvtrail.sources import app_lines

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def shuffling(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(prefix, n=400):
    """Every third row has the one key, the others one of many."""
    return F.when(F.col("id") % 3 == 0, F.lit(f"{prefix}0")).otherwise(F.concat(F.lit(prefix), (F.col("id") % n).cast("string")))


def skewed(df, *keys):
    """How many joins on each key were split, in the plan that ran."""
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    split = re.findall(r"SortMergeJoin\(skew=true\) \[[^\]]*\]", execution.executedPlan().toString())
    return {k: sum(bool(re.search(rf"[\[ ]{k}#", line)) for line in split) for k in keys}


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def views(spark):
    rows = spark.range(ROWS)
    text = {c: F.concat(F.lit(c), F.col("id").cast("string")) for c in (
        "uuid", "regionid", "play_start_time", "play_end_time", "apk_version", "media_uuid", "rid", "dt", "platform", "source_type")}
    blank = {"media_name": F.lit(""), "category_id": F.when(F.col("id") % 2 == 0, F.lit("up0")).otherwise(F.lit("")), "channel_id": F.lit("")}
    return stored(rows.select(hot("m").alias("media_id"), *[c.alias(n) for n, c in (text | blank).items()]), "views")


def media(spark):
    rows = spark.range(1200)
    return rows.select(
        F.concat(F.lit("m"), (F.col("id") % 400).cast("string")).alias("media_id"), F.concat(F.lit("name "), F.col("id").cast("string")).alias("media_name"),
        F.concat(F.lit("c"), (F.col("id") % 9).cast("string")).alias("category_id"), F.concat(F.lit("cat "), (F.col("id") % 9).cast("string")).alias("category_name"),
        F.concat(F.lit("h"), (F.col("id") % 3).cast("string")).alias("channel_id"))


def test_categories(shuffling):
    spark = shuffling
    uploads = spark.createDataFrame([("up0", "c1", "h9"), ("up1", "c2", "h8")], "identityno string, c_cid string, pc_cid string")
    review = spark.createDataFrame([("cat 3",)], "category_name string")
    with working_tables(spark):
        rows = views(spark)
        kept = vod.resolve_categories(rows, media(spark), uploads, review, stored_once())
        plain = vod.resolve_categories(rows, media(spark), uploads, review)
        split, unsplit = (skewed(df, "media_id", "category_id") for df in (kept, plain))
        # Why the dictionaries are stored: beside a side that is aggregated in the plan, nothing is split.
        assert all(split[k] > unsplit[k] for k in split) and split["category_id"] == 3
        same(kept, plain)


def test_channels_and_search_names(shuffling):
    spark = shuffling
    with working_tables(spark):
        long = F.repeat(F.sha2(F.col("id").cast("string"), 256), 2)
        rows = stored(spark.range(ROWS).select(hot("CH").alias("channel_id"), hot("m").alias("media_id"), F.lit("na").alias("key"), long.alias("t")), "pages")
        known = spark.range(900).select(
            F.concat(F.lit("CH"), (F.col("id") % 400).cast("string")).alias("channel_name"),
            F.col("id").cast("string").alias("conf_channel_id"), F.col("id").cast("string").alias("conf_channel_name"))
        kept, plain = (facts.with_channel_names(rows, known, *k) for k in ((stored_once(),), ()))
        assert skewed(kept, "channel_id")["channel_id"]
        same(kept, plain)
        kept, plain = (facts.with_search_names(rows, media(spark), *k) for k in ((stored_once(),), ()))
        assert skewed(kept, "media_id")["media_id"]
        same(kept, plain)


def test_renames_and_areas(shuffling):
    spark = shuffling
    with working_tables(spark):
        rows = stored(spark.range(ROWS).select(hot("u").alias("uuid"), F.sha2(F.col("id").cast("string"), 512).alias("apk_version")), "boxes")
        renames = spark.range(800).select(
            F.concat(F.lit(" u"), (F.col("id") % 400).cast("string")).alias("userid"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("stbid"))
        kept, plain = (app_lines.online_regions(rows, "HNYD", None, renames, *k) for k in ((stored_once(),), ()))
        assert skewed(kept, "uuid")["uuid"]
        same(kept, plain)
        areas = renames.select(F.trim("userid").alias("userid"), F.lit("0731").alias("areacode"))
        kept, plain = (app_lines.online_regions(rows, "HNLT", areas, None, *k) for k in ((stored_once(),), ()))
        assert skewed(kept, "uuid")["uuid"]
        same(kept, plain)


def test_app_results(shuffling):
    spark = shuffling
    with working_tables(spark):
        text = {c: F.sha2(F.concat(F.lit(c), F.col("id").cast("string")), 256) for c in ("uuid", "play_start_time", "play_end_time", "media_name")}
        rows = stored(spark.range(ROWS).select(
            hot("m").alias("media_id"), *[c.alias(n) for n, c in text.items()], F.lit("r").alias("regionid"), F.lit("1").alias("apk_version"),
            F.lit("p").alias("pro_id"), F.when(F.col("id") % 2 == 0, F.lit("c1")).otherwise(F.lit("")).alias("category_id"),
            F.when(F.col("id") % 4 < 2, F.lit("h1")).otherwise(F.lit("")).alias("clum_id")), "app-views")
        number = spark.range(400)
        assets = number.select(*[F.concat(F.lit(p), F.col("id").cast("string")).alias(c) for p, c in (
            ("m", "thremdeiaid"), ("x", "uuid"), ("n", "midianame"), ("d", "dxmedia"), ("cp", "cp"))])
        categories = spark.range(9).select(*[F.concat(F.lit(p), (F.col("id") % 3).cast("string")).alias(c) for p, c in (
            ("h", "nns_id"), ("name ", "nns_name"))], F.concat(F.lit("c"), F.col("id").cast("string")).alias("nns_category_id"),
            F.concat(F.lit("cat "), F.col("id").cast("string")).alias("nns_category_name"))
        assists = number.select(F.concat(F.lit("m"), F.col("id").cast("string")).alias("nns_video_id"), F.lit("h1").alias("nns_assist_id"), F.lit("c4").alias("nns_category_id"))
        products = number.select(F.concat(F.lit("d"), F.col("id").cast("string")).alias("asset_id"))
        review = spark.createDataFrame([("at 4",)], "category_name string")
        args = (rows, assets, assists, categories, products, review)
        keep = stored_once()
        kept = app_vod.app_results(*args, keep)
        assert all(skewed(kept, "media_id", "dxmedia", "_up", "_placed", "category_name").values())
        same(kept, app_vod.app_results(*args))
        # Both branches read the same stored tables.
        files = [f for f in kept.inputFiles() if "app-media" in f]
        assert files and len({f.split("app-media-")[1].split("/")[0] for f in files}) == 1
