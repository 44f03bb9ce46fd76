"""The driver's tables as log records, dictionaries and fact tables.

``events`` is the log.  Its 30 days are compressed by ten, so it fills the three
days 2024-01-01..03 that a job for 2024-01-02 reads.  ``workbench/sql.py`` states
the same mapping in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tvtrail.functions.regions import MOBILE_AREAS, mobile_region, telecom_region
from tvtrail.functions.times import day_of, from_epoch
from tvtrail.session import prepare

DAY = "20240102"
EPOCH = 1704067200          # 2024-01-01 00:00:00 UTC
COMPRESS = 10

USER_PREFIXES = ("YX", "JH", "0736", "U", "732", "07312", "wg", "test")
AREA_CODES = (*MOBILE_AREAS, "14303", "99999", "")
VIEW_STATES = ("0x03", "0x04", "0x05", "0x06")
PLATFORM_OF = ("HNYD", "HNLT", "HNDX")


def pick(values, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int"))


def text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark, "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def user_name(number: Column) -> Column:
    return F.concat(pick(USER_PREFIXES, number), number.cast("string"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, uid, user_id, k, type, real_s (epoch seconds), s (log seconds)."""
    raw = table(spark, sf_dir, "events")
    real = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return raw.select(
        F.col("event_id"),
        F.col("user_id").alias("uid"),
        user_name(F.col("user_id")).alias("user_id"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("event_type").alias("type"),
        real.alias("real_s"),
        (F.lit(EPOCH) + F.floor((real - EPOCH) / COMPRESS)).alias("s"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed log records: what the parser yields for one record per event."""
    e = events(spark, sf_dir)
    k, kind = F.col("k"), F.col("type")
    viewing = kind.isin("view", "click")
    on, order, error = kind == "signup", kind == "purchase", (kind == "error") & (k % 3 == 0)
    state = (
        F.when(viewing, pick(VIEW_STATES, k))
        .when(on, F.lit("0x01")).when(order, F.lit("0x09")).when(error, F.lit("0x11"))
        .otherwise(F.lit("0x100"))
    )

    def only(test: Column, value: Column) -> Column:
        return F.when(test, value).otherwise(F.lit(""))

    category = F.when(k % 5 == 0, F.lit("")).when(k % 5 <= 2, text("UP", k % 20)).otherwise(
        text("CAT", k % 15)
    )
    return e.select(
        F.col("event_id").alias("rid"),
        "user_id",
        F.col("s").alias("ts"),
        from_epoch(F.col("s")).alias("create_time"),
        state.alias("state"),
        (kind == "view").alias("play"),
        only(viewing, text("CH", k % 10)).alias("channel_id"),
        only(viewing | order, text("M", k)).alias("media_id"),
        only((viewing | order) & (k % 7 != 0), text("media ", k)).alias("media_name"),
        only(viewing | order, category).alias("category_id"),
        F.when(on, mobile_region(pick(AREA_CODES, k))).otherwise(F.lit("14301")).alias("regionid"),
        only(on & (k % 9 != 0), version(k)).alias("apk_version"),
        only(on, text("MAC", F.col("uid"))).alias("mac"),
        only(on, text("MK", k % 3)).alias("manufacturers"),
        only(on, text("MD", k % 6)).alias("model"),
        only(on, text("4.", k % 4)).alias("system_version"),
        only(on, text("10.0.0.", k)).alias("ip"),
        only(on & (k % 4 != 0), text("ACC", F.col("uid"))).alias("user_account"),
        only(on, F.lit("android")).alias("os"),
        only(order, text("prod", k % 8)).alias("product_name"),
        only(order, text("B", k)).alias("boss_id"),
        only(order, k.cast("string")).alias("product_price"),
        only(order, (k % 2).cast("string")).alias("status"),
        only(order, F.lit("buy_ok")).alias("confirmation"),
        only(order, text("act", k % 6)).alias("pagepath"),
        F.lit("").alias("nextpagepath"),
        only(error, text("E", k)).alias("error_code"),
        F.lit("").alias("error_detail"),
        F.lit("").alias("pagename"),
        F.lit("HNYD").alias("platform"),
        F.lit("sdk").alias("source_type"),
        "k",
    )


def version(k: Column) -> Column:
    return F.concat(text("A.", k % 4), text(".", k % 3), F.lit(".1"))


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views: every view and click event opens a page."""
    e = events(spark, sf_dir).where(F.col("type").isin("view", "click"))
    k = F.col("k")

    def but(skip: Column, value: Column) -> Column:
        return F.when(skip, F.lit("")).otherwise(value)

    blank = F.lit("")
    return e.select(
        F.col("event_id").alias("rid"), "user_id", F.col("s").alias("ts"),
        from_epoch(F.col("s")).alias("create_time"),
        F.lit("0x07").alias("state"), F.lit(False).alias("play"),
        text("sp", k % 3).alias("sp_code"), text("P", k % 40).alias("page_id"),
        text("act", k % 6).alias("pagepath"), blank.alias("nextpagepath"),
        but(k % 13 == 0, text("page_", k % 40)).alias("pagename"),
        but(k % 11 != 0, text("SP", k % 5)).alias("special_id"),
        (k % 2).cast("string").alias("way"), text("ON", k % 4).alias("offset_name"),
        text("OI", k % 4).alias("offset_id"), text("CAT", k % 15).alias("category_id"),
        text("M", k).alias("media_id"),
        F.when(k % 4 == 0, blank).otherwise(F.substring(F.lit("abcdefghijkl"), F.lit(1), k % 12)).alias("key"),
        F.when(k % 4 == 1, F.lit("key_search")).otherwise(F.lit("home_page")).alias("event_type"),
        text("OG", k % 2).alias("offset_group"), text("MG", k % 2).alias("media_group"),
        text("CH", k % 10).alias("channel_id"),
        blank.alias("interface_properties"), blank.alias("interface_identification"),
        blank.alias("request_classification"), blank.alias("serial_number"),
        F.lit("HNYD").alias("platform"), F.lit("sdk").alias("source_type"),
    )


def path_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views, power-ons and orders, the columns paths and orders need."""
    keep = ["rid", "user_id", "ts", "create_time", "state", "pagename"]
    order = ["status", "product_name", "media_name"]
    rows = log(spark, sf_dir).where(F.col("state").isin("0x01", "0x09"))
    pages = page_views(spark, sf_dir).select(*keep)
    return rows.select(*keep, *order).unionByName(pages, allowMissingColumns=True)


def day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records of the reporting day (viewing records enter as sessions)."""
    return log(spark, sf_dir).where(day_of(F.col("ts")) == DAY)


# --- dictionaries and stored tables ------------------------------------------

def dict_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    prefix = F.when(F.col("n_regionkey") == 2, F.lit("OLD")).otherwise(F.lit("CH"))
    return n.select(
        F.concat(prefix, F.col("n_nationkey").cast("string")).alias("channel_name"),
        text("CONF", F.col("n_nationkey")).alias("conf_channel_id"),
        F.col("n_name").alias("conf_channel_name"),
    )


def dict_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(media, category, channel) placements; a media has several categories."""
    p = table(spark, sf_dir, "part")
    brand = F.substring_index("p_brand", "#", -1)
    return p.select(
        text("M", F.col("p_partkey") % 100).alias("media_id"),
        F.col("p_name").alias("media_name"),
        F.concat(F.lit("CAT"), brand).alias("category_id"),
        F.concat(F.lit("cat "), F.lower("p_type"), F.lit(" "), brand).alias("category_name"),
        F.concat(F.lit("CHN_"), F.col("p_type")).alias("channel_id"),
    )


def upload_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category ids of uploads; some rows have no id, a blank one, or no category."""
    s = table(spark, sf_dir, "supplier")
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    blank = F.when(nation == 8, F.lit(""))
    return s.select(
        blank.otherwise(F.when(nation != 7, text("UP", key % 15))).alias("identityno"),
        F.when(key % 3 != 0, text("CAT", nation)).alias("c_cid"),
        text("CHN_", key % 6).alias("pc_cid"),
    )


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    prefix = F.when(F.col("p_brand") == "Brand#3", F.lit("X")).otherwise(F.lit("M"))
    return p.select(
        F.concat(prefix, key.cast("string")).alias("thremdeiaid"), text("UUID", key).alias("uuid"),
        F.col("p_name").alias("midianame"), text("YD", key).alias("ydmedia"),
        text("LT", key).alias("ltmedia"), text("AS", key % 60).alias("dxmedia"),
        F.col("p_brand").alias("cp"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(text("AS", F.col("p_size")).alias("asset_id"))


def app_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    brand = F.substring_index("p_brand", "#", -1)
    return p.select(
        F.col("p_type").alias("nns_id"), F.concat(F.lit("name "), F.lower("p_type")).alias("nns_name"),
        F.concat(F.lit("CAT"), brand).alias("nns_category_id"),
        F.concat(F.lit("cat "), F.lower("p_type"), F.lit(" "), brand).alias("nns_category_name"),
    ).distinct()


def app_placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    brand = F.substring_index("p_brand", "#", -1)
    return p.select(
        text("M", F.col("p_partkey") % 100).alias("nns_video_id"),
        F.lower("p_type").alias("nns_assist_id"),
        F.concat(F.lit("CAT"), brand).alias("nns_category_id"),
    ).distinct()


def review_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that mark a category as under review."""
    r = table(spark, sf_dir, "region")
    word = F.when(F.col("r_regionkey") == 1, F.lit("small")).when(
        F.col("r_regionkey") == 2, F.lit("cat economy 1")
    ).otherwise(F.lower("r_name"))
    return r.select(word.alias("category_name"))


def test_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    word = F.when(F.col("r_regionkey") == 0, F.lit("test")).when(
        F.col("r_regionkey") == 1, F.lit("YX1")
    ).otherwise(F.lower("r_name"))
    return r.select(word.alias("key_word"))


def previous_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's pool; customers of one segment carry ids that no log has."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    blank = F.lit("")
    user = F.when(F.col("c_mktsegment") == "BUILDING", text("gone", key)).otherwise(user_name(key))
    return c.select(
        user.alias("user_id"), telecom_region(user).alias("regionid"),
        blank.alias("status"), F.lit("20231201").alias("start_date"), blank.alias("end_date"),
        F.lit("20231201").alias("create_date"),
        F.concat(F.lit("B."), (key % 5).cast("string"), F.lit(".0.2")).alias("apk_version"),
        text("OLDMAC", key).alias("mac"), text("OLDMK", key % 4).alias("manufacturers"),
        text("OLDMD", key % 7).alias("model"), F.lit("4.4").alias("system_version"),
        text("10.1.0.", key % 200).alias("ip"), text("OLDACC", key).alias("user_account"),
        user.alias("uuid"), F.lit("android").alias("os"),
        F.lit("20240101").alias("dt"), F.lit("HNYD").alias("platform"),
        F.lit("sdk").alias("source_type"),
    )


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pool of the day with one row per customer, for fact joins."""
    return previous_pool(spark, sf_dir).withColumn("dt", F.lit(DAY))


def online(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mid_online_day over the 30 real days of ``events``."""
    e = events(spark, sf_dir)
    k = F.col("k")
    return e.select(
        F.col("user_id").alias("uuid"), pick(("14301", "14302", "14303", "14304"), k).alias("regionid"),
        day_of(F.col("real_s")).alias("dt"),
        pick(PLATFORM_OF, F.col("uid")).alias("platform"),
        F.when(F.floor(F.col("uid") / 3) % 2 == 1, F.lit("apk"))
        .when(F.col("uid") % 3 == 2, F.lit("c3")).otherwise(F.lit("sdk")).alias("source_type"),
    ).distinct()


def channel_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel views: every event is a view that lasts up to its day's end."""
    codes = ("303", "104", "2104", "4104", "4004", "4104", "4904", "4804", "4602", "4104", "1", "2")
    e = events(spark, sf_dir)
    k, s = F.col("k"), F.col("s")
    day_end = s - (s - EPOCH) % 86400 + 86399
    return e.select(
        F.col("user_id").alias("stbid"), from_epoch(s).alias("starttime"),
        from_epoch(F.least(s + k * 60, day_end)).alias("endtime"), day_of(s).alias("day"),
        pick(codes, k).alias("content"), F.col("event_id").alias("rid"),
    )


def log_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(day_of(F.col("s")).alias("day")).distinct()


def minute_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of the day for the minute report, cut at its end."""
    e = events(spark, sf_dir).where(F.col("type") == "view").where(day_of(F.col("s")) == DAY)
    k, s = F.col("k"), F.col("s")
    day_end = s - (s - EPOCH) % 86400 + 86399
    return e.select(
        F.when(k % 19 != 0, text("CH", k % 10)).alias("conf_channel_id"),
        F.when(k % 17 != 0, telecom_region(F.col("user_id"))).alias("area_code"),
        s.alias("start_ts"), F.least(s + k * 37, day_end).alias("end_ts"),
        F.lit("HNYD").alias("platform"), F.lit("sdk").alias("source_type"),
    )
