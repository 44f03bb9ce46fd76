"""Scans and parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tvtrail.operators import facts
from tvtrail.session import scratch_path
from tvtrail.sources import app_lines, files, records, rejects
from tvtrail.functions.times import day_of, day_start
from workbench import frames, wire
from workbench.registry import query
from workbench.sql import EV, GOOD, VERSION, day, log_time, mobile_region, pick, telecom_region, with_
from workbench.sql import AREA_CODES

_T = log_time("s")


def _parsed(spark, sf_dir, state, *columns):
    events = records.parse_mobile(wire.mobile_lines(spark, sf_dir))
    return events.where(F.col("state") == state).select("state", "user_id", "create_time", "play", *columns)


def _rows(state: str, play: str, where: str, *columns: str) -> str:
    extra = "".join(f", {c}" for c in columns)
    return with_(EV) + f"SELECT '{state}' AS state, user_id, {_T} AS create_time, {play} AS play{extra} " \
        f"FROM ev WHERE {GOOD} AND {where}"


_VIEW = "type IN ('view','click')"
_PLAY = "type='view'"


@query(_rows("0x03", _PLAY, f"{_VIEW} AND k%4=0", "'CH'||(k%10) AS channel_id"))
def log_parse_live(spark, sf_dir):
    return _parsed(spark, sf_dir, "0x03", "channel_id")


@query(_rows("0x04", _PLAY, f"{_VIEW} AND k%4=1 AND k NOT IN (21,41,61)", "'M'||k AS media_id",
             "'media '||k AS media_name", "'9' AS episodes", "'UP'||(k%20) AS category_id",
             "'CH'||(k%10) AS channel_id"))
def log_parse_vod(spark, sf_dir):
    return _parsed(spark, sf_dir, "0x04", "media_id", "media_name", "episodes", "category_id", "channel_id")


@query(_rows("0x05", _PLAY, f"{_VIEW} AND k%4=2", "'M'||k AS media_id", "'media '||k AS media_name",
             "'CH'||(k%10) AS channel_id"))
def log_parse_lookback(spark, sf_dir):
    return _parsed(spark, sf_dir, "0x05", "media_id", "media_name", "channel_id")


@query(_rows("0x06", _PLAY, f"{_VIEW} AND k%4=3", "'CH'||(k%10) AS channel_id", "'1' AS is_timeshift"))
def log_parse_timeshift(spark, sf_dir):
    return _parsed(spark, sf_dir, "0x06", "channel_id", "is_timeshift")


@query(_rows("0x01", "false", "type='signup'", "'MK'||(k%3) AS manufacturers", "'MAC'||uid AS mac",
             "'MD'||(k%6) AS model", f"{VERSION} AS apk_version", "'4.'||(k%4) AS system_version",
             "'10.0.0.'||k AS ip", "'ACC'||uid AS user_account", "'android' AS os",
             f"{mobile_region(pick(AREA_CODES, 'k'))} AS regionid", "'v1' AS sdk_version"))
def log_parse_init(spark, sf_dir):
    return _parsed(spark, sf_dir, "0x01", "manufacturers", "mac", "model", "apk_version",
                   "system_version", "ip", "user_account", "os", "regionid", "sdk_version")


_PAGE_COLUMNS = (
    "'sp'||(k%3) AS sp_code", "'P'||(k%40) AS page_id", "'act'||(k%6) AS pagepath",
    "'' AS nextpagepath", "CASE WHEN k%13=0 THEN '' ELSE 'page_'||(k%40) END AS pagename",
    "CASE WHEN k%11<>0 THEN '' ELSE 'SP'||(k%5) END AS special_id", "CAST(k%2 AS VARCHAR) AS way",
    "'ON'||(k%4) AS offset_name", "'OI'||(k%4) AS offset_id", "'CAT'||(k%15) AS category_id",
    "CASE WHEN k%4=0 THEN '' ELSE 'key'||k END AS key", "'OG'||(k%2) AS offset_group",
    "'MG'||(k%2) AS media_group", "'CH'||(k%10) AS channel_id",
)
_PAGE_NAMES = tuple(c.rsplit(" ", 1)[1] for c in _PAGE_COLUMNS)


@query(_rows("0x07", "false", _VIEW, *_PAGE_COLUMNS, "'M'||k AS media_id",
             "CASE WHEN k%4=1 THEN 'search' ELSE 'home_page' END AS event_type"))
def log_parse_pageview(spark, sf_dir):
    return _parsed(spark, sf_dir, "0x07", *_PAGE_NAMES, "media_id", "event_type")


@query(with_(EV) + f"""SELECT '0x07' AS state, user_id, {_T}||'000' AS create_time,
  {', '.join(_PAGE_COLUMNS)}, CASE WHEN k%4=1 THEN 'key_search' ELSE 'home_page' END AS event_type,
  'SN'||k AS serial_number, 'IP'||(k%2) AS interface_properties,
  'II'||(k%3) AS interface_identification, 'RC'||(k%4) AS request_classification
  FROM ev WHERE {GOOD} AND {_VIEW}""")
def log_parse_pageview_telecom(spark, sf_dir):
    events = records.parse_telecom(wire.telecom_lines(spark, sf_dir))
    return events.where(F.col("state") == "0x07").select(
        "state", "user_id", "create_time", *_PAGE_NAMES, "event_type", "serial_number",
        "interface_properties", "interface_identification", "request_classification",
    )


@query(with_(EV) + f"""SELECT CASE type WHEN 'signup' THEN '0x01' ELSE '0x09' END AS state, user_id,
  {_T}||'000' AS create_time, CASE WHEN type='signup' THEN {VERSION} ELSE '' END AS apk_version,
  CASE WHEN type='signup' THEN {telecom_region('user_id')} ELSE '14301' END AS regionid,
  CASE WHEN type='purchase' THEN 'prod'||(k%8) ELSE '' END AS product_name,
  CASE WHEN type='purchase' THEN 'media '||k ELSE '' END AS media_name,
  CASE WHEN type='purchase' THEN CAST(k%2 AS VARCHAR) ELSE '' END AS status
  FROM ev WHERE {GOOD} AND type IN ('signup','purchase')""")
def log_parse_telecom_users(spark, sf_dir):
    events = records.parse_telecom(wire.telecom_lines(spark, sf_dir))
    return events.where(F.col("state").isin("0x01", "0x09")).select(
        "state", "user_id", "create_time", "apk_version", "regionid", "product_name", "media_name", "status"
    )


@query(_rows("0x09", "false", "type='purchase'", "'act'||(k%6) AS pagepath", "'' AS nextpagepath",
             "'prod'||(k%8) AS product_name", "'B'||k AS boss_id", "CAST(k AS VARCHAR) AS product_price",
             "'M'||k AS media_id", "'media '||k AS media_name", "'UP'||(k%20) AS category_id",
             "'buy_ok' AS confirmation", "CAST(k%2 AS VARCHAR) AS status", "'CH'||(k%10) AS channel_id"))
def log_parse_order(spark, sf_dir):
    return _parsed(spark, sf_dir, "0x09", "pagepath", "nextpagepath", "product_name", "boss_id",
                   "product_price", "media_id", "media_name", "category_id", "confirmation", "status",
                   "channel_id")


@query(_rows("0x11", "false", "type='error' AND k%3=0", "'E'||k AS error_code"))
def log_parse_error(spark, sf_dir):
    return _parsed(spark, sf_dir, "0x11", "error_code")


@query(with_(EV) + f"""SELECT '0x100' AS state, user_id, {_T} AS create_time, false AS play FROM ev
  WHERE {GOOD} AND ((type='error' AND k%3<>0) OR type='purchase' OR ({_VIEW} AND k%4=1 AND k IN (21,41,61)))""")
def log_heart_fallback(spark, sf_dir):
    """Unknown types, short records and favourites count as heartbeats."""
    return _parsed(spark, sf_dir, "0x100")


@query(with_(EV) + f"""SELECT '0x04' AS state, user_id, {_T} AS create_time, 'M'||k AS media_id,
  'media '||k AS media_name, CAST(k%2 AS VARCHAR) AS status, 'fs'||(k%3) AS vodstate
  FROM ev WHERE {GOOD} AND type='purchase'""")
def log_parse_favourite(spark, sf_dir):
    events = records.parse_favourites(wire.mobile_lines(spark, sf_dir))
    return events.where(F.col("state") == "0x04").select(
        "state", "user_id", "create_time", "media_id", "media_name", "status", "vodstate")


_RECORDS = """recs AS (
  SELECT event_id, k, type, CASE WHEN type='signup' THEN '0x01' WHEN type='purchase' THEN '0x09'
    WHEN type='error' THEN CASE WHEN k%3=0 THEN '0x11' ELSE '0x10' END
    ELSE (['0x03','0x04','0x05','0x06'])[k%4+1] END AS code,
    CASE WHEN type='signup' THEN 24 WHEN type='purchase' THEN 21
      WHEN type='error' THEN CASE WHEN k%3=0 THEN 11 ELSE 7 END
      WHEN k%4=1 THEN CASE WHEN k IN (21,41,61) THEN 22 ELSE 23 END
      ELSE ([15,0,17,13])[k%4+1] END AS width FROM ev
  UNION ALL
  SELECT event_id, k, type, CASE WHEN type='purchase' THEN '0x04' ELSE '0x07' END,
    CASE WHEN type='purchase' THEN CASE WHEN k IN (21,41,61) THEN 22 ELSE 23 END ELSE 26 END
  FROM ev WHERE type IN ('view','click','purchase'))"""


@query(with_(EV, _RECORDS) + """SELECT code AS first_code, CAST(width AS BIGINT) AS width,
  count(*) AS records FROM recs GROUP BY 1, 2""")
def log_split_packed(spark, sf_dir):
    """Records per type and width after packed lines are split, trailing blanks counted."""
    rows = records.split_packed(wire.mobile_lines(spark, sf_dir)).withColumn("f", records.fields_of(F.col("value")))
    return rows.groupBy(
        records.type_code(records.field(F.col("f"), 0)).alias("first_code"),
        F.size("f").cast("bigint").alias("width"),
    ).agg(F.count(F.lit(1)).alias("records"))


@query(with_(EV, _RECORDS) + f"""SELECT CASE WHEN k BETWEEN 40 AND 49 THEN 'prefixed' ELSE 'plain' END AS form,
  code, count(*) AS records FROM recs GROUP BY 1, 2""")
def log_type_normalised(spark, sf_dir):
    rows = records.split_packed(wire.mobile_lines(spark, sf_dir)).withColumn("f", records.fields_of(F.col("value")))
    first = records.field(F.col("f"), 0)
    return rows.groupBy(
        F.when(records.type_code(first) == first, F.lit("plain")).otherwise(F.lit("prefixed")).alias("form"),
        records.type_code(first).alias("code"),
    ).agg(F.count(F.lit(1)).alias("records"))


@query(with_(EV, _RECORDS) + f"""SELECT code, count(*) AS records, count(DISTINCT event_id) AS lines
  FROM recs WHERE {GOOD} GROUP BY 1""")
def log_bad_time_dropped(spark, sf_dir):
    kept = records.split_records(wire.mobile_lines(spark, sf_dir))
    return kept.groupBy("code").agg(
        F.count(F.lit(1)).alias("records"), F.countDistinct("event_id").alias("lines"))


@query(with_(EV) + """SELECT DISTINCT CAST(CASE WHEN k IN (21,41,61) THEN 22 ELSE 23 END AS BIGINT) AS width
  FROM ev WHERE k NOT BETWEEN 40 AND 49 AND (type='purchase' OR (type IN ('view','click') AND k%4=1))""")
def record_widths(spark, sf_dir):
    return records.record_widths(wire.mobile_lines(spark, sf_dir), "0x04")


@query(with_(EV) + f"""SELECT {day('real_s')} AS dt, type, count(*) AS n,
  CAST(sum(CASE WHEN {day('real_s')}='20240115' THEN 1 ELSE 0 END) AS BIGINT) AS of_day
  FROM ev WHERE {day('real_s')} IN ('20240114','20240115','20240116') GROUP BY 1, 2""")
def log_three_day_halo(spark, sf_dir):
    """Lines stored by day; a job for one day reads the neighbours too."""
    root = scratch_path(spark, "halo")
    e = frames.events(spark, sf_dir)
    line = F.concat_ws("|", "type", F.col("real_s").cast("string"))
    e.select(line.alias("value"), day_of(F.col("real_s")).alias("dt")).write.partitionBy("dt").text(f"{root}/sdk_log")
    lines = files.read_log_days(spark, root, "20240115", ["log"])
    f = records.fields_of(F.col("value"))
    rows = lines.select(records.field(f, 0).alias("type"), records.field(f, 1).cast("bigint").alias("s"))
    first = day_start("20240115")
    inside = (F.col("s") >= first) & (F.col("s") < first + 86400)
    return rows.groupBy(day_of(F.col("s")).alias("dt"), "type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(inside.cast("bigint")).alias("of_day"))


@query(with_(EV) + "SELECT type, count(*) AS n FROM ev GROUP BY 1")
def log_optional_input(spark, sf_dir):
    """A folder of one more type does not exist; the scan takes what is there."""
    root = scratch_path(spark, "optional")
    e = frames.events(spark, sf_dir)
    kinds = ("signup", "view", "click", "purchase", "error")
    for kind in kinds:
        e.where(F.col("type") == kind).select("type").write.text(f"{root}/sdk_{kind}/dt=20240102")
    patterns = files.day_patterns(root, [*kinds, "order"], ["20240102"])
    lines = files.read_lines(spark, patterns, optional=True)
    return lines.groupBy(F.col("value").alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query(with_(EV) + f"""SELECT DISTINCT user_id AS uuid, {telecom_region('user_id')} AS regionid,
  {VERSION} AS apk_version, '20240102' AS dt, 'HNDX' AS platform, 'apk' AS source_type
  FROM ev WHERE k%10>2 AND NOT starts_with(user_id,'test') AND NOT starts_with(user_id,'YX1')""")
def json_online_users(spark, sf_dir):
    online = app_lines.parse_online(wire.online_lines(spark, sf_dir))
    rows = app_lines.online_regions(online, "HNDX").select(
        "uuid", "regionid", "apk_version", F.lit("20240102").alias("dt"),
        F.lit("HNDX").alias("platform"), F.lit("apk").alias("source_type")).distinct()
    return facts.drop_test_users(rows, frames.test_prefixes(spark, sf_dir), "uuid")


@query(with_(EV, "copies AS (SELECT *, unnest(CASE k%10 WHEN 0 THEN [0,1] WHEN 1 THEN [0,2] WHEN 2 THEN [0,3] ELSE [0] END) AS c FROM ev WHERE type='view')")
       + f"""SELECT user_id AS uuid, {log_time('s+CASE WHEN c=3 THEN 60 ELSE 0 END')} AS play_start_time,
  {log_time('s+k*200+CASE WHEN c=2 THEN 60 ELSE 0 END')} AS play_end_time,
  CASE WHEN k%29=0 THEN '' ELSE 'M'||k END AS media_id, 'media '||k AS media_name,
  CASE WHEN k%3=0 THEN '' ELSE 'CAT'||(k%25) END AS category_id, {VERSION} AS apk_version,
  'PR'||(k%3) AS pro_id,
  CASE WHEN k%4=0 THEN '' ELSE {pick(('economy', 'small', 'large', 'standard', 'promo', 'medium'), 'k')} END AS clum_id,
  CASE WHEN k%31=0 THEN 'live' ELSE 'vod' END AS data_type FROM copies""")
def kv_vod_parse(spark, sf_dir):
    return app_lines.parse_app_vod(wire.app_vod_lines(spark, sf_dir)).drop("start_ts", "end_ts")


_REASONS = "(VALUES " + ", ".join(f"('{t}','{r}')" for t, r in (
    ("0x01", "short"), *((c, "no time") for c in (
        "0x01", "0x03", "0x04", "0x05", "0x06", "0x07", "0x09", "0x11", "0x10", "other")))) + ") AS g(type, reason)"
_BAD = f"""bad AS (SELECT CASE WHEN type='error' AND event_id%7=0 THEN 'other' ELSE code END AS type,
  CASE WHEN type='signup' AND event_id%5=0 THEN 'short' WHEN NOT ({GOOD}) OR (type='error' AND event_id%7=0) THEN 'no time' END AS reason
  FROM recs)"""


def _damaged(lines):
    """Some power-ons cut short, some other records replaced by noise."""
    return lines.withColumn("value", F.when(
        (F.col("type") == "signup") & (F.col("event_id") % 5 == 0), F.substring_index("value", "|", 13)).when(
        (F.col("type") == "error") & (F.col("event_id") % 7 == 0), F.lit("?|no record|")).otherwise(F.col("value")))


@query(with_(EV, _RECORDS, _BAD) + f"""SELECT g.type, g.reason, count(bad.type) AS n FROM {_REASONS}
  LEFT JOIN bad ON bad.type=g.type AND bad.reason=g.reason GROUP BY 1, 2""")
def bad_records(spark, sf_dir):
    """Records no step can use, by type and reason, counted from the parsed table."""
    parsed = records.parse_mobile(_damaged(wire.mobile_lines(spark, sf_dir)), rejects=True)
    return rejects.report(rejects.record_rejects(parsed), rejects.RECORD_REASONS)


@query(with_(EV) + """SELECT 'online' AS type, g.reason, count(ev.k) AS n FROM (VALUES ('no json'),('no box')) AS g(reason)
  LEFT JOIN ev ON g.reason = CASE WHEN k%10=0 THEN 'no json' WHEN k%10<=2 THEN 'no box' END GROUP BY 1, 2""")
def bad_online_lines(spark, sf_dir):
    parsed = app_lines.parse_online(wire.online_lines(spark, sf_dir), rejects=True)
    return rejects.report(rejects.line_rejects(parsed, "online"), rejects.ONLINE_REASONS)


@query(with_(EV, "copies AS (SELECT *, unnest(CASE k%10 WHEN 0 THEN [0,1] WHEN 1 THEN [0,2] WHEN 2 THEN [0,3] ELSE [0] END) AS c FROM ev WHERE type='view')")
       + """SELECT 'vod' AS type, g.reason, count(copies.k) AS n FROM (VALUES ('no pairs'),('no time')) AS g(reason)
  LEFT JOIN copies ON g.reason = CASE WHEN k%23=0 THEN 'no pairs' WHEN k%31<>0 AND k%13=0 THEN 'no time' END GROUP BY 1, 2""")
def bad_vod_lines(spark, sf_dir):
    """Some lines lose what they hold, some the month of their start."""
    lines = wire.app_vod_lines(spark, sf_dir)
    k = F.regexp_extract("value", r'sndlvl_name":"media (\d+)"', 1).cast("int")
    broken = F.when(k % 23 == 0, F.lit("{}")).when(
        k % 13 == 0, F.regexp_replace("value", r'(start_time":"\d{4})-\d\d', "$1-13")).otherwise(F.col("value"))
    parsed = app_lines.parse_app_vod(lines.withColumn("value", broken), rejects=True)
    return rejects.report(rejects.line_rejects(parsed, "vod"), rejects.APP_VOD_REASONS)
