"""Sessions and the facts built on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tvtrail.operators import facts, sessions
from tvtrail.sources import records
from workbench import frames, wire
from workbench.registry import hot_users, query
from workbench.sql import CHANNELS, DAY_SESSIONS, EV, GOOD, LOG, PAGES, POOL, SESSIONS, VIEW_STATES, with_

_PART = "p.dt, p.platform, p.source_type"


@query(with_(EV, LOG) + f"""SELECT user_id, state, start_ts, stop_ts, rid FROM (
  SELECT user_id, state, ts AS start_ts, play, rid,
    CASE WHEN NOT lead(play) OVER w THEN lead(ts) OVER w END AS stop_ts
  FROM log WHERE state IN ({VIEW_STATES})
  WINDOW w AS (PARTITION BY user_id, state ORDER BY ts, play, rid)) WHERE play""")
def session_pairing(spark, sf_dir):
    log = frames.log(spark, sf_dir)
    found = sessions.paired_sessions(log, hot_users(log))
    return found.select("user_id", "state", "start_ts", "stop_ts", "rid")


@query(with_(EV, LOG, SESSIONS) + "SELECT user_id, state, start_ts, end_ts, inferred, rid FROM sess")
def session_inferred_end(spark, sf_dir):
    log = frames.log(spark, sf_dir)
    found = sessions.sessions(log, hot_users(log))
    return found.select("user_id", "state", "start_ts", "end_ts", "inferred", "rid")


@query(with_(EV, LOG, SESSIONS, DAY_SESSIONS)
       + "SELECT user_id, state, start_ts, end_ts, CAST(end_ts-start_ts AS BIGINT) AS seconds, rid FROM day_kept")
def session_day_filter(spark, sf_dir):
    log = frames.log(spark, sf_dir)
    found = sessions.of_day(sessions.sessions(log, hot_users(log)), frames.DAY)
    return found.select(
        "user_id", "state", "start_ts", "end_ts", (F.col("end_ts") - F.col("start_ts")).alias("seconds"), "rid")


@query(with_(EV, LOG, SESSIONS, DAY_SESSIONS)
       + "SELECT user_id, state, play_start_time, play_end_time, rid FROM day_sess")
def session_day_clamp(spark, sf_dir):
    log = frames.log(spark, sf_dir)
    found = sessions.day_sessions(log, frames.DAY, hot_users(log))
    return found.select("user_id", "state", "play_start_time", "play_end_time", "rid")


def _named(spark, sf_dir):
    """Sessions of the day with channel names, and the hot users of the log."""
    log = frames.log(spark, sf_dir)
    hot = hot_users(log)
    found = facts.with_channel_names(
        sessions.day_sessions(log, frames.DAY, hot), frames.dict_channel(spark, sf_dir))
    return found, hot


_NAMED = """named AS (SELECT d.*, coalesce(c.conf_channel_id,'') AS conf_channel_code,
  coalesce(c.conf_channel_name,'') AS channel_name,
  CASE WHEN c.conf_channel_id IS NULL THEN '-1' ELSE '0' END AS live_flag
  FROM day_sess d LEFT JOIN channels c USING (channel_id))"""

_NEIGHBOURS = """lag(conf_channel_code) OVER w AS pc, lag(play_start_time) OVER w AS ps, lag(play_end_time) OVER w AS pe,
  lead(conf_channel_code) OVER w AS nc, lead(play_start_time) OVER w AS ns, lead(play_end_time) OVER w AS ne"""
_LIVE_SQL = f"""live_rows AS (SELECT user_id, play_start_time, play_end_time, channel_id, channel_name,
    conf_channel_code, live_flag, '0' AS is_timeshift, {_NEIGHBOURS} FROM named WHERE state='0x03'
  WINDOW w AS (PARTITION BY user_id ORDER BY play_start_time, play_end_time, rid)
  UNION ALL
  SELECT user_id, play_start_time, play_end_time, channel_id, channel_name,
    conf_channel_code, live_flag, '1' AS is_timeshift, {_NEIGHBOURS} FROM (
      SELECT user_id, play_start_time, play_end_time, channel_id, channel_name, conf_channel_code, live_flag,
        min(rid) AS rid FROM named WHERE state='0x06' GROUP BY ALL)
  WINDOW w AS (PARTITION BY user_id ORDER BY play_start_time, play_end_time, rid)),
live_out AS (SELECT user_id, play_start_time, play_end_time, channel_id, channel_name, conf_channel_code,
  live_flag, is_timeshift, CASE WHEN coalesce(pc,'')='' THEN '开始直播' ELSE pc END AS last_code,
  ps AS last_end_time, CASE WHEN coalesce(nc,'')='' THEN '结束直播' ELSE nc END AS next_code,
  ne AS next_start_time, pe AS previous_end_time, ns AS following_start_time FROM live_rows)"""
_SESSION_CTES = (EV, LOG, SESSIONS, DAY_SESSIONS, CHANNELS, _NAMED)


@query(with_(EV, LOG, CHANNELS, """named AS (SELECT l.*, create_time AS play_start_time,
    create_time AS play_end_time, coalesce(c.conf_channel_id,'') AS conf_channel_code FROM log l
    LEFT JOIN channels c USING (channel_id) WHERE state='0x03')""")
       + f"""SELECT user_id, rid, conf_channel_code,
  CASE WHEN coalesce(pc,'')='' THEN '开始直播' ELSE pc END AS last_code, ps AS last_end_time,
  CASE WHEN coalesce(nc,'')='' THEN '结束直播' ELSE nc END AS next_code, ne AS next_start_time,
  pe AS previous_end_time, ns AS following_start_time
  FROM (SELECT *, {_NEIGHBOURS} FROM named WINDOW w AS (PARTITION BY user_id ORDER BY ts, rid))""")
def live_neighbours(spark, sf_dir):
    """Neighbours of every live record of the log, whatever its length."""
    log = frames.log(spark, sf_dir).where(F.col("state") == "0x03")
    hot = hot_users(log)
    rows = facts.with_channel_names(log, frames.dict_channel(spark, sf_dir)).withColumns({
        "start_ts": F.col("ts"), "end_ts": F.col("ts"),
        "play_start_time": F.col("create_time"), "play_end_time": F.col("create_time")})
    return facts.live_neighbours(hot.split(rows, "start_ts"), hot).select(
        "user_id", "rid", "conf_channel_code", "last_code", "last_end_time", "next_code", "next_start_time",
        "previous_end_time", "following_start_time")


@query(with_(*_SESSION_CTES, _LIVE_SQL, POOL)
       + f"SELECT l.*, p.regionid, p.apk_version, {_PART} FROM live_out l JOIN pool p USING (user_id)")
def live_facts(spark, sf_dir):
    found, hot = _named(spark, sf_dir)
    return facts.live_facts(found, frames.pool(spark, sf_dir), hot)


# What the parser makes of all lines: short on-demand records and the favourites packed with orders
# are heartbeats; live lines of some keys come twice.
_SHORT = "type IN ('view','click') AND k IN (21,41,61)"
_SENT = (
    EV.replace("ev AS", "all_ev AS", 1),
    f"""sent AS (SELECT * REPLACE (CASE WHEN {_SHORT} THEN 'error' ELSE type END AS type, CASE WHEN {_SHORT} THEN 1 ELSE k END AS k)
  FROM all_ev WHERE {GOOD})""",
    """ev AS (SELECT * FROM sent UNION ALL SELECT * FROM sent WHERE type IN ('view','click') AND k%12=0
  UNION ALL SELECT * REPLACE ('error' AS type, 1 AS k) FROM sent WHERE type='purchase')""")


@query(with_(*_SENT, LOG, SESSIONS, DAY_SESSIONS, POOL) + """SELECT user_id, play_start_time, play_end_time, count(*) AS n
  FROM day_sess JOIN pool p USING (user_id) WHERE state='0x03' GROUP BY ALL""")
def live_resends(spark, sf_dir):
    """All lines through the parser, a third of the live ones sent twice: every live session stays a fact."""
    lines = wire.mobile_lines(spark, sf_dir)
    again = lines.where("type IN ('view', 'click') AND k % 12 = 0")
    parsed = records.parse_mobile(lines.unionByName(again).select("value"), "HNYD")
    hot = hot_users(parsed)
    found = facts.with_channel_names(
        sessions.day_sessions(parsed, frames.DAY, hot), frames.dict_channel(spark, sf_dir))
    rows = facts.live_facts(found, frames.pool(spark, sf_dir), hot).where("is_timeshift = '0'")
    return rows.groupBy("user_id", "play_start_time", "play_end_time").agg(F.count(F.lit(1)).alias("n"))


@query(with_(*_SESSION_CTES, POOL) + f"""SELECT DISTINCT user_id, p.regionid, play_start_time, play_end_time,
  channel_id, p.apk_version, channel_name, {_PART} FROM named JOIN pool p USING (user_id) WHERE state='0x06'""")
def timeshift_facts(spark, sf_dir):
    found, hot = _named(spark, sf_dir)
    return facts.timeshift_facts(found, frames.pool(spark, sf_dir), hot)


@query(with_(*_SESSION_CTES, POOL) + f"""SELECT user_id, p.regionid, play_start_time, play_end_time, media_id,
  media_name, conf_channel_code, channel_id, channel_name, p.apk_version, {_PART}
  FROM named JOIN pool p USING (user_id) WHERE state='0x05'""")
def lookback_facts(spark, sf_dir):
    found, hot = _named(spark, sf_dir)
    return facts.lookback_facts(found, frames.pool(spark, sf_dir), hot)


@query(with_(*_SESSION_CTES, POOL) + f"""SELECT user_id AS uuid, p.regionid, play_start_time, play_end_time,
  media_id, media_name, category_id, p.apk_version, channel_id, rid, {_PART}
  FROM day_sess JOIN pool p USING (user_id) WHERE state='0x04'""")
def vod_facts(spark, sf_dir):
    log = frames.log(spark, sf_dir)
    hot = hot_users(log)
    return facts.vod_facts(sessions.day_sessions(log, frames.DAY, hot), frames.pool(spark, sf_dir), hot)


_PAGE = """user_id, p.regionid, 'sp'||(k%3) AS sp_code, 'act'||(k%6) AS pagepath, '' AS nextpagepath, pagename,
  CASE WHEN k%4=1 THEN 'key_search' ELSE 'home_page' END AS event_type, special_id, 'P'||(k%40) AS page_id,
  CAST(k%2 AS VARCHAR) AS way, 'ON'||(k%4) AS offset_name, 'OI'||(k%4) AS offset_id,
  kw AS key, CASE WHEN kw='' OR name IS NULL THEN '' WHEN length(name)<length(kw) THEN name
    ELSE substr(name,1,length(kw)) END AS keyname,
  'M'||k AS media_id, coalesce(name,'') AS media_name, 'CAT'||(k%15) AS category_id,
  'CH'||(k%10) AS channel_id, p.apk_version, 'OG'||(k%2) AS offset_group, 'MG'||(k%2) AS media_group,
  create_time, '' AS interface_properties, '' AS interface_identification, '' AS request_classification,
  '' AS serial_number"""


@query(with_(EV, PAGES, POOL, """named AS (SELECT s.*, n.name, CASE WHEN k%4=0 THEN ''
    ELSE substr('abcdefghijkl',1,k%12) END AS kw FROM pages_seen s LEFT JOIN
    (SELECT 'M'||(p_partkey%100) AS media_id, min(p_name) AS name FROM part GROUP BY 1) n ON n.media_id='M'||k)""")
       + f"SELECT {_PAGE}, {_PART} FROM named JOIN pool p USING (user_id)")
def pageview_facts(spark, sf_dir):
    pages = facts.with_search_names(frames.page_views(spark, sf_dir), frames.dict_media(spark, sf_dir))
    return facts.pageview_facts(pages, frames.pool(spark, sf_dir), hot_users(pages))


@query(with_(EV, PAGES, POOL) + f"""SELECT user_id AS userid, p.regionid, special_id AS subject_id,
  create_time AS time, {_PART} FROM pages_seen JOIN pool p USING (user_id) WHERE special_id<>''""")
def topic_visits(spark, sf_dir):
    pages = frames.page_views(spark, sf_dir)
    return facts.topic_visits(pages, frames.pool(spark, sf_dir), hot_users(pages))


@query(with_(EV, LOG, POOL) + f"""SELECT p.apk_version, user_id AS uuid, 'E'||k AS error_code, '' AS error_detail,
  create_time AS oper_time, {_PART} FROM log JOIN pool p USING (user_id) WHERE state='0x11'""")
def error_facts(spark, sf_dir):
    log = frames.log(spark, sf_dir)
    return facts.error_facts(log, frames.pool(spark, sf_dir), hot_users(log))


@query(with_(EV, LOG, POOL) + f"""SELECT user_id, 'B'||k AS boss_id, '' AS order_type, CAST(k%2 AS VARCHAR) AS status,
  p.apk_version, regexp_extract(p.apk_version,'^([^.]*[.][^.]*[.][^.]*)[.]',1) AS parent_apk_version, create_time,
  'prod'||(k%8) AS product_name, CAST(k AS VARCHAR) AS product_price, media_id, media_name, category_id,
  channel_id, 'act'||(k%6) AS pagepath, '' AS nextpagepath, {_PART}
  FROM log JOIN pool p USING (user_id) WHERE state='0x09'""")
def order_facts(spark, sf_dir):
    log = frames.log(spark, sf_dir)
    return facts.order_facts(log, frames.pool(spark, sf_dir), hot_users(log))
