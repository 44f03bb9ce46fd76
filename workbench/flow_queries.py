"""Minute report and channel flow."""

from __future__ import annotations

from tvtrail.operators import flow, minutes
from tvtrail.session import stored
from workbench import frames
from workbench.registry import hot_users, query
from workbench.sql import EV, day, log_time, pick, telecom_region, with_

_FIRST = 1704067200 + 86400
_SECONDS = f"""v AS (SELECT CASE WHEN k%19<>0 THEN 'CH'||(k%10) END AS ch,
  CASE WHEN k%17<>0 THEN {telecom_region('user_id')} END AS area, s-{_FIRST} AS b,
  least(s+k*37, s-(s-1704067200)%86400+86399)-{_FIRST} AS e FROM ev WHERE type='view' AND {day('s')}='20240102'),
m AS (SELECT ch, area, minute, CAST(sum(least(e,(minute+1)*60)-greatest(b,minute*60)) AS BIGINT) AS sec
  FROM v, unnest(range(b//60, e//60+1)) AS t(minute) GROUP BY 1,2,3),
spine AS (SELECT ch, area, minute FROM (SELECT DISTINCT ch, area FROM v), range(0,1440) AS r(minute)),
base AS (SELECT s.ch, s.area, s.minute, coalesce(sec,0) AS sec FROM spine s LEFT JOIN m
  ON m.ch IS NOT DISTINCT FROM s.ch AND m.area IS NOT DISTINCT FROM s.area AND m.minute=s.minute)"""
_KEYS = ["conf_channel_id", "area_code", "platform", "source_type"]


@query(with_(EV, _SECONDS) + """SELECT ch AS conf_channel_id, area AS area_code, 'HNYD' AS platform, 'sdk' AS source_type,
  minute, sec AS duration FROM base""")
def minute_seconds(spark, sf_dir):
    return minutes.minute_seconds(frames.minute_views(spark, sf_dir), frames.DAY, _KEYS)


@query(with_(EV, _SECONDS, """chans AS (SELECT * FROM base UNION ALL
  SELECT '-1', area, minute, CAST(sum(sec) AS BIGINT) FROM base GROUP BY 2,3),
allrows AS (SELECT * FROM chans UNION ALL SELECT ch, '14300', minute, CAST(sum(sec) AS BIGINT) FROM chans GROUP BY 1,3)""")
       + """SELECT ch AS conf_channel_id, area AS area_code,
  lpad(CAST(minute//60 AS VARCHAR),2,'0')||lpad(CAST(minute%60 AS VARCHAR),2,'0')||'00' AS view_time,
  '20240102HNYDsdk' AS combination, sec AS duration, '20240102' AS dt, 'sdk' AS source_type, 'HNYD' AS platform
  FROM allrows""")
def minute_totals_cube(spark, sf_dir):
    return minutes.minute_report(frames.minute_views(spark, sf_dir), frames.DAY)


_CODES = ("303", "104", "2104", "4104", "4004", "4104", "4904", "4804", "4602", "4104", "1", "2")
_NAMES = ("东方购物", "东方购物二", "家有购物", "央广购物", "环球购物", "央广购物", "优购物", "快乐购物", "东方购物高清",
          "央广购物", "其他", "其他")
_VIEWS = f"""v AS (SELECT user_id AS box, event_id AS rid, s AS b, {day('s')} AS day,
    least(s+k*60, s-(s-1704067200)%86400+86399) AS e, {pick(_NAMES, 'k')} AS content FROM ev),
views AS (SELECT *, lag(content) OVER (PARTITION BY box, day ORDER BY b, e, rid) AS prev FROM v WHERE e-b>30),
days AS (SELECT DISTINCT {day('s')} AS day, (s-1704067200)//86400*86400+1704067200 AS d0 FROM ev),
epg AS (SELECT day, d0+h*7200 AS ps, d0+(h+1)*7200 AS pe, h FROM days, range(0,12) AS r(h)),
pairs AS (SELECT v.*, p.ps, p.pe, p.h, CASE WHEN h>0 THEN ps-7200 END AS lps, CASE WHEN h>0 THEN ps END AS lpe
  FROM views v JOIN epg p ON p.day=v.day AND v.b<=p.pe AND v.e>p.ps)"""
_FLOWS = """flows AS (SELECT box, day, '流入' AS type, ps AS fs, pe AS fe, b, e, rid, h,
    CASE WHEN prev IS NULL THEN '开机' WHEN prev='央广购物' THEN '保留流入' ELSE prev END AS label
  FROM pairs WHERE content='央广购物'
  UNION ALL SELECT box, day, '流出', lps, lpe, b, e, rid, h,
    CASE WHEN content='央广购物' THEN '保留流出' ELSE content END
  FROM pairs WHERE prev='央广购物' AND lps IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY box, day, type, fs ORDER BY b, e, rid, h) AS r1,
    row_number() OVER (PARTITION BY box, day, type, fs ORDER BY b DESC, e DESC, rid DESC, h DESC) AS r2 FROM flows),
chosen AS (SELECT box, day, type, right(strftime(make_timestamp(fs*1000000),'%Y%m%d%H%M%S'),6) AS starttime,
    right(strftime(make_timestamp(fe*1000000),'%Y%m%d%H%M%S'),6) AS endtime, label FROM ranked
  WHERE (type='流入' AND r1=1) OR (type='流出' AND r2=1)),
counts AS (SELECT type, day, starttime, endtime, label AS content, count(*) AS count FROM chosen GROUP BY ALL)"""


def _views(spark, sf_dir):
    return flow.named_views(frames.channel_views(spark, sf_dir))


def _guide(spark, sf_dir):
    return flow.programme_times(flow.guide_spine(frames.log_days(spark, sf_dir)))


@query(with_(EV, _VIEWS) + f"""SELECT box AS stbid, rid, day, content, {log_time('ps')} AS epg_start,
  {log_time('pe')} AS epg_end FROM pairs""")
def flow_overlap(spark, sf_dir):
    return flow.overlapping(_views(spark, sf_dir), _guide(spark, sf_dir)).select(
        "stbid", "rid", "day", "content", "epg_start", "epg_end")


def _counts(spark, sf_dir):
    views = _views(spark, sf_dir)
    hot = hot_users(views, "stbid", "start_ts")
    return flow.flow_counts(flow.flow_events(views, _guide(spark, sf_dir), hot, stored))


@query(with_(EV, _VIEWS, _FLOWS) + "SELECT * FROM counts")
def flow_in_out(spark, sf_dir):
    return _counts(spark, sf_dir)


_LABELS = """labels AS (SELECT '流入' AS type, unnest(['东方购物','东方购物二','家有购物','环球购物','央广购物','优购物','快乐购物',
    '东方购物高清','东方购物二高清','环球购物高清','保留流入','开机','其他']) AS content UNION ALL
  SELECT '流出', unnest(['东方购物','东方购物二','家有购物','环球购物','央广购物','优购物','快乐购物',
    '东方购物高清','东方购物二高清','环球购物高清','保留流出','其他'])),
programmes AS (SELECT day, starttime, endtime, CAST(sum(CASE WHEN type='流入' THEN count ELSE -count END) AS BIGINT)
  AS imbalance FROM counts GROUP BY 1,2,3),
report AS (SELECT l.type, p.day, p.starttime, p.endtime, l.content, coalesce(c.count,0) AS count, p.imbalance
  FROM programmes p CROSS JOIN labels l LEFT JOIN counts c ON c.type=l.type AND c.day=p.day
  AND c.starttime=p.starttime AND c.endtime=p.endtime AND c.content=l.content)"""


@query(with_(EV, _VIEWS, _FLOWS, _LABELS) + "SELECT * FROM report")
def flow_zero_fill(spark, sf_dir):
    return flow.flow_report(_counts(spark, sf_dir))
