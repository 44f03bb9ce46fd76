"""Scalar functions over the log."""

from __future__ import annotations

from pyspark.sql import functions as F

from tvtrail.functions import labels, regions, text, times
from tvtrail.operators import flow
from tvtrail.sources import app_lines
from workbench import frames
from workbench.registry import query
from workbench.sql import AREA_CODES, EV, day, log_time, mobile_region, pick, telecom_region, with_

_STAMP = "strftime(make_timestamp(s*1000000),'%Y-%m-%dT%H:%M:%S')"


@query(with_(EV) + f"""SELECT event_id,
  CASE WHEN k%9=0 THEN NULL ELSE {log_time("s-8*3600")} END AS compact,
  CASE WHEN k%9=0 THEN NULL ELSE {log_time("s-8*3600")}||'250' END AS compact_ms,
  CASE WHEN k%9=0 THEN NULL ELSE {log_time("s-8*3600+90*60")} END AS later,
  {day('s+3*86400')} AS plus_three_days, {log_time('s+45')} AS plus_45_seconds,
  {log_time('s+300')} AS plus_five_minutes, CAST(real_s-s AS BIGINT) AS seconds,
  CAST(s%86400 AS BIGINT) AS clock, CAST(86399-s%86400 AS BIGINT) AS clock_left FROM ev""")
def device_time(spark, sf_dir):
    e = frames.events(spark, sf_dir)
    k, s = F.col("k"), F.col("s")
    stamp = F.timestamp_seconds(s)
    seconds = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
    bad = F.when(k % 9 == 0, F.lit("2024-13-01T00:00:00+0800"))
    raw = bad.otherwise(F.concat(seconds, F.lit("+0800")))
    raw_ms = bad.otherwise(F.concat(seconds, F.lit(".250+0800")))
    log_time_s = times.from_epoch(s)
    return e.select(
        "event_id", times.device_time(raw).alias("compact"), times.device_time_ms(raw_ms).alias("compact_ms"),
        times.device_time(raw, 90).alias("later"),
        times.plus_days(times.day_of(s), 3).alias("plus_three_days"),
        times.plus_seconds(log_time_s, 45).alias("plus_45_seconds"),
        times.plus_minutes(log_time_s, 5).alias("plus_five_minutes"),
        times.seconds_between(log_time_s, times.from_epoch(F.col("real_s"))).alias("seconds"),
        times.clock_seconds(F.date_format(stamp, "HH:mm:ss")).alias("clock"),
        times.clock_duration(F.date_format(stamp, "HHmmss"), F.lit("235959")).alias("clock_left"),
    )


@query(with_(EV) + f"""SELECT event_id, CASE WHEN k%3=0 THEN '' WHEN k%3=1 THEN 'A.'||k||'.2' ELSE '' END AS major
  FROM ev""")
def major_version(spark, sf_dir):
    e = frames.events(spark, sf_dir)
    k = F.col("k")
    version = F.when(k % 3 == 1, F.concat(F.lit("A."), k.cast("string"), F.lit(".2.7_x.1"))).when(
        k % 3 == 2, F.lit("1.2"))
    return e.select("event_id", text.major_version(version).alias("major"))


@query(with_(EV) + f"SELECT event_id, user_id, {telecom_region('user_id')} AS regionid FROM ev")
def region_prefix(spark, sf_dir):
    e = frames.events(spark, sf_dir)
    return e.select("event_id", "user_id", regions.telecom_region(F.col("user_id")).alias("regionid"))


@query(with_(EV) + f"SELECT event_id, {mobile_region(pick(AREA_CODES, 'k'))} AS regionid FROM ev")
def region_area_code(spark, sf_dir):
    e = frames.events(spark, sf_dir)
    return e.select("event_id", regions.mobile_region(frames.pick(frames.AREA_CODES, F.col("k"))).alias("regionid"))


_UNICOM_USER = "(['073108','073102','073105','0734','0730','0746','U'])[k%7+1]||uid"


def _unicom_areas(spark, sf_dir):
    c = frames.table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    users = F.concat(F.lit("U"), key.cast("string"))
    area = F.when(F.col("c_nationkey") == 0, F.lit("")).when(F.col("c_nationkey") == 1, F.lit("9999")).otherwise(
        F.concat(F.lit(" "), F.lpad((F.col("c_nationkey") + 1).cast("string"), 4, "0")))
    return c.select(users.alias("userid"), area.alias("areacode"))


@query(with_(EV, """areas AS (SELECT 'U'||c_custkey AS userid, CASE c_nationkey WHEN 0 THEN '' WHEN 1 THEN '9999'
    ELSE lpad(CAST(c_nationkey+1 AS VARCHAR),4,'0') END AS area FROM customer)""",
    f"""u AS (SELECT event_id, {_UNICOM_USER} AS uuid FROM ev)""",
    """coded AS (SELECT event_id, uuid, CASE WHEN coalesce(area,'')<>'' THEN area
      WHEN left(uuid,6)='073108' THEN '0001' WHEN left(uuid,6)='073102' THEN '0002'
      WHEN left(uuid,6)='073105' THEN '0003' WHEN left(uuid,4)='0734' THEN '0004'
      WHEN left(uuid,4)='0730' THEN '0005' WHEN left(uuid,4)='0736' THEN '0006'
      WHEN left(uuid,4)='0746' THEN '0007' ELSE '' END AS code FROM u LEFT JOIN areas ON uuid=userid)""")
    + """SELECT event_id, uuid, CASE code WHEN '0002' THEN '14302' WHEN '0003' THEN '14303'
      WHEN '0004' THEN '14304' WHEN '0005' THEN '14306' WHEN '0006' THEN '14307' WHEN '0007' THEN '14311'
      WHEN '0008' THEN '14305' WHEN '0009' THEN '14331' WHEN '0010' THEN '14312' WHEN '0011' THEN '14309'
      WHEN '0012' THEN '14308' WHEN '0013' THEN '14310' WHEN '0014' THEN '14313' ELSE '14301' END AS regionid
      FROM coded""")
def region_dictionary(spark, sf_dir):
    e = frames.events(spark, sf_dir)
    user = F.concat(
        frames.pick(("073108", "073102", "073105", "0734", "0730", "0746", "U"), F.col("k")),
        F.col("uid").cast("string"))
    return app_lines.online_regions(
        e.select("event_id", user.alias("uuid")), "HNLT", areas=_unicom_areas(spark, sf_dir))


@query(with_(EV) + f"""SELECT event_id,
  CASE WHEN uid%3=0 AND k%7=0 THEN 'N'||k ELSE user_id END AS uuid,
  CASE WHEN uid%3=2 THEN {telecom_region('user_id')} WHEN uid%3=1 AND starts_with(user_id,'0736') THEN '14307'
    ELSE '14301' END AS regionid FROM ev""")
def region_by_platform(spark, sf_dir):
    """Every platform's rule on its own boxes (unicom boxes here are in no dictionary).

    Mobile boxes get the default region, and their ids the new name a relation gives.
    """
    e = frames.events(spark, sf_dir).withColumn("platform", frames.pick(frames.PLATFORM_OF, F.col("uid")))
    named = F.when((F.col("platform") == "HNYD") & (F.col("k") % 7 == 0), frames.text("old", F.col("k")))
    rows = e.select("event_id", "platform", F.coalesce(named, F.col("user_id")).alias("uuid"))
    areas = _unicom_areas(spark, sf_dir).withColumn("userid", F.concat(F.lit("none"), F.col("userid")))
    renames = e.select(frames.text("old", F.col("k")).alias("userid"), frames.text("N", F.col("k")).alias("stbid"))
    parts = [
        app_lines.online_regions(rows.where(F.col("platform") == platform).drop("platform"), platform, areas, renames)
        for platform in frames.PLATFORM_OF
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("event_id", "uuid", "regionid")


@query(with_(EV) + """SELECT event_id, platform||'_'||upper(coalesce(source,'all')) AS label FROM (
  SELECT event_id, (['HNYD','HNLT','HNDX'])[uid%3+1] AS platform,
    CASE WHEN k%4=0 THEN NULL WHEN k%4=1 THEN 'apk' WHEN k%4=2 THEN 'all'
      WHEN uid%3=2 THEN 'c3' ELSE 'sdk' END AS source FROM ev)""")
def source_label(spark, sf_dir):
    e = frames.events(spark, sf_dir)
    k, uid = F.col("k"), F.col("uid")
    source = F.when(k % 4 == 1, F.lit("apk")).when(k % 4 == 2, F.lit("all")).when(
        (k % 4 == 3) & (uid % 3 == 2), F.lit("c3")).when(k % 4 == 3, F.lit("sdk"))
    return e.select("event_id", labels.report_source(frames.pick(frames.PLATFORM_OF, uid), source).alias("label"))


@query(with_(EV) + """SELECT event_id,
  CASE WHEN k%4=2 THEN 'new'||k ELSE 'old'||uid END AS chosen,
  CASE WHEN k%5=4 THEN 'v'||k ELSE '' END AS cleaned FROM ev""")
def choose_new(spark, sf_dir):
    e = frames.events(spark, sf_dir)
    k = F.col("k")
    new = F.when(k % 4 == 2, frames.text("new", k)).when(k % 4 == 1, F.lit(""))
    new = F.when(k % 4 == 3, F.lit("")).otherwise(new)
    dirty = F.when(k % 5 == 4, frames.text("v", k)).when(k % 5 == 3, F.lit("null")).when(
        k % 5 == 2, F.lit("NULL")).when(k % 5 == 1, F.lit("  "))
    return e.select(
        "event_id", text.choose_new(frames.text("old", F.col("uid")), new).alias("chosen"),
        text.blank_to_empty(dirty).alias("cleaned"))


@query(with_(EV, """m AS (SELECT event_id, k, p_name AS media, CASE WHEN k%4=0 THEN ''
    ELSE substr('abcdefghijkl',1,k%12) END AS kw FROM ev JOIN part ON p_partkey=k)""")
    + """SELECT event_id, CASE WHEN kw='' THEN '' WHEN length(media)<length(kw) THEN media
      ELSE substr(media,1,length(kw)) END AS keyname,
      CASE WHEN k%4=1 THEN 'search' ELSE 'home_page' END AS kind FROM m""")
def search_key_name(spark, sf_dir):
    e = frames.events(spark, sf_dir)
    k = F.col("k")
    part = frames.table(spark, sf_dir, "part").select(F.col("p_partkey"), F.col("p_name"))
    rows = e.join(part, F.col("k") == F.col("p_partkey"))
    typed = F.when(k % 4 == 0, F.lit("")).otherwise(F.substring(F.lit("abcdefghijkl"), F.lit(1), k % 12))
    kind = F.when(k % 4 == 1, F.lit("my_search_box")).otherwise(F.lit("home_page"))
    return rows.select(
        "event_id", text.search_key_name(F.col("p_name"), typed).alias("keyname"),
        text.page_event_kind(kind).alias("kind"))


@query(with_(EV, f"days AS (SELECT DISTINCT {day('s')} AS day FROM ev)",
             "slots AS (SELECT day, unnest(range(0,86400,7200)) AS b FROM days)")
       + """SELECT day, day||strftime(make_timestamp(b*1000000),'%H%M%S') AS starttime,
  strftime(strptime(day,'%Y%m%d')+to_seconds(b+7200),'%Y%m%d%H%M%S') AS endtime FROM slots""")
def epg_fix(spark, sf_dir):
    """The last programme of a day ends at 000000, that is on the next day."""
    return flow.programme_times(flow.guide_spine(frames.log_days(spark, sf_dir)))


@query(with_(EV, """pairs AS (SELECT CASE WHEN p_type='SMALL' THEN 'M' ELSE 'Z' END||p_partkey AS old, 'N'||min(p_size) AS new
    FROM part GROUP BY 1)""")
       + "SELECT event_id, coalesce(new,'M'||k) AS uuid, '14301' AS regionid FROM ev LEFT JOIN pairs ON old='M'||k")
def id_remap(spark, sf_dir):
    """Mobile apps: ids renamed through the relation table, others kept."""
    e = frames.events(spark, sf_dir)
    p = frames.table(spark, sf_dir, "part")
    prefix = F.when(F.col("p_type") == "SMALL", F.lit(" M")).otherwise(F.lit(" Z"))
    relations = p.select(
        F.concat(prefix, F.col("p_partkey").cast("string")).alias("userid"),
        F.concat(F.lit("N"), F.col("p_size").cast("string"), F.lit(" ")).alias("stbid"))
    rows = e.select("event_id", frames.text("M", F.col("k")).alias("uuid"))
    return app_lines.online_regions(rows, "HNYD", renames=relations)
