"""Active users, the pool, power-ons, favourites and box numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tvtrail.operators import facts, last_seen, pool, reports
from tvtrail.session import scratch_path
from tvtrail.sources import buckets, files, records
from workbench import frames, wire
from workbench.registry import ORACLES, hot_users, query
from workbench.sql import AREA_CODES, EV, GOOD, LOG, ONLINE, POOL, VERSION, log_time, mobile_region, pick, with_

_ON_COLUMNS = f"""{mobile_region(pick(AREA_CODES, 'k'))} AS regionid,
  CASE WHEN k%9<>0 THEN {VERSION} ELSE '' END AS apk_version, 'MAC'||uid AS mac, 'MK'||(k%3) AS manufacturers,
  'MD'||(k%6) AS model, '4.'||(k%4) AS system_version, '10.0.0.'||k AS ip,
  CASE WHEN k%4<>0 THEN 'ACC'||uid ELSE '' END AS user_account, 'android' AS os"""
_ATTRIBUTES = ("apk_version", "mac", "manufacturers", "model", "system_version", "ip", "user_account", "os")
_ACTIVE = f"""day_log AS (SELECT * FROM log WHERE left(create_time,8)='20240102'),
ons AS (SELECT user_id, rid, ts, create_time, {_ON_COLUMNS} FROM day_log WHERE state='0x01'),
last_on AS (SELECT * FROM ons QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, rid DESC)=1),
active AS (SELECT d.user_id, o.regionid, {', '.join(f"coalesce(o.{a},'') AS {a}" for a in _ATTRIBUTES)}
  FROM (SELECT DISTINCT user_id FROM day_log) d LEFT JOIN last_on o USING (user_id))"""
_LABELS = "'20240102' AS dt, 'HNYD' AS platform, 'sdk' AS source_type"


def _active(spark, sf_dir):
    return pool.active_users(frames.day_events(spark, sf_dir), frames.DAY, "HNYD")


@query(with_(EV, LOG, _ACTIVE) + f"SELECT active.*, {_LABELS} FROM active")
def active_users(spark, sf_dir):
    return _active(spark, sf_dir)


@query(with_(EV, LOG, _ACTIVE)
       + f"SELECT user_id AS uuid, coalesce(regionid,'14301') AS regionid, apk_version, {_LABELS} FROM active")
def online_day(spark, sf_dir):
    return pool.online_day(_active(spark, sf_dir))


@query(with_(EV, LOG, _ACTIVE) + f"""SELECT user_id, rid, create_time, regionid, apk_version, ip FROM ons
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, rid DESC)=1""")
def last_power_on(spark, sf_dir):
    return pool.last_power_on(frames.log(spark, sf_dir), frames.DAY).select(
        "user_id", "rid", "create_time", "regionid", "apk_version", "ip")


_NEW = """new_rows AS (SELECT a.user_id, coalesce(a.regionid,'14301') AS regionid, '' AS status, '20240102' AS start_date,
  '' AS end_date, '20240102' AS create_date, a.apk_version, a.mac, a.manufacturers, a.model, a.system_version, a.ip,
  a.user_account, a.user_id AS uuid, a.os, '20240102' AS dt, 'HNYD' AS platform, 'sdk' AS source_type
  FROM active a LEFT JOIN prev_pool p USING (user_id) WHERE p.user_id IS NULL)"""


def _merged(name: str) -> str:
    return f"CASE WHEN coalesce(a.{name},'')<>'' THEN a.{name} ELSE p.{name} END AS {name}"


@query(with_(EV, LOG, _ACTIVE, POOL, _NEW) + "SELECT * FROM new_rows")
def pool_new_users(spark, sf_dir):
    return pool.new_users(_active(spark, sf_dir), frames.previous_pool(spark, sf_dir))


@query(with_(EV, LOG, _ACTIVE, POOL, _NEW) + f"""SELECT * FROM new_rows UNION ALL
  SELECT p.user_id, {_merged('regionid')}, '' AS status, p.start_date, '' AS end_date, p.create_date,
  {', '.join(_merged(a) for a in ('apk_version', 'mac', 'manufacturers', 'model', 'system_version', 'ip', 'user_account'))},
  p.user_id AS uuid, {_merged('os')}, '20240102' AS dt, p.platform, p.source_type
  FROM prev_pool p LEFT JOIN active a USING (user_id)""")
def pool_merge(spark, sf_dir):
    return pool.merge_pool(_active(spark, sf_dir), frames.previous_pool(spark, sf_dir), frames.DAY)


@query(ORACLES["pool_merge"])
def pool_merge_bucketed(spark, sf_dir):
    """Yesterday's pool is a table bucketed by user, and is not shuffled."""
    folder = scratch_path(spark, "pool")
    buckets.write(frames.previous_pool(spark, sf_dir), folder, "user_id", 8)
    return pool.merge_pool(_active(spark, sf_dir), buckets.read(spark, folder, "user_id"), frames.DAY)


@query(with_(EV) + f"""SELECT user_id AS uuid, {log_time('s')} AS powertime, {mobile_region(pick(AREA_CODES, 'k'))} AS regionid,
  {VERSION} AS apk_version, {_LABELS} FROM ev WHERE {GOOD} AND type='signup'""")
def power_on_facts(spark, sf_dir):
    return records.power_on_records(wire.mobile_lines(spark, sf_dir), frames.DAY, "HNYD")


@query(with_(EV, POOL) + f"""SELECT coalesce(p.apk_version,'') AS apk_version, user_id AS uuid,
  coalesce(p.regionid,'14301') AS regionid, 'M'||k AS media_id, 'media '||k AS media_name,
  CAST(k%2 AS VARCHAR) AS status, {log_time('s')} AS create_time, 'fs'||(k%3) AS vodstate, {_LABELS}
  FROM ev LEFT JOIN pool p USING (user_id) WHERE {GOOD} AND type='purchase'""")
def favourite_facts(spark, sf_dir):
    rows = records.parse_favourites(wire.mobile_lines(spark, sf_dir))
    return facts.favourite_facts(rows, frames.pool(spark, sf_dir), frames.DAY, hot_users(rows))


_RANGE = "dt BETWEEN '20231027' AND '20240125'"


@query(with_(EV, ONLINE) + f"""SELECT regionid, platform, source_type, count(DISTINCT uuid) AS stbnum
  FROM online WHERE {_RANGE} GROUP BY 1,2,3""")
def distinct_90d(spark, sf_dir):
    """The 90 days before the day (both ends count)."""
    return reports.distinct_users(frames.online(spark, sf_dir), "20240125")


_RESIDUAL = f"""(SELECT count(DISTINCT uuid) FROM online WHERE {_RANGE} AND platform='HNYD' AND source_type='sdk')
  - (SELECT count(DISTINCT uuid) FROM online WHERE {_RANGE} AND platform='HNYD' AND source_type='sdk'
     AND regionid<>'14301')"""


@query(with_(EV, ONLINE) + f"""SELECT {_RESIDUAL} AS stbnum, '14301' AS regionid, 'HNYD' AS platform,
  'sdk' AS source_type""")
def area_residual(spark, sf_dir):
    return reports.residual_region(frames.online(spark, sf_dir), "20240125")


@query(with_(EV, ONLINE, f"""base AS (SELECT regionid, platform, source_type, count(DISTINCT uuid) AS n FROM online
    WHERE {_RANGE} GROUP BY 1,2,3),
fixed AS (SELECT regionid, platform, platform||'_'||upper(source_type) AS label,
    CASE WHEN regionid='14301' AND platform='HNYD' AND source_type='sdk' THEN {_RESIDUAL} ELSE n END AS n FROM base),
nonzero AS (SELECT * FROM fixed WHERE n>0),
sources AS (SELECT * FROM nonzero UNION ALL
  SELECT regionid, platform, platform||'_ALL', CAST(sum(n) AS BIGINT) FROM nonzero GROUP BY 1,2)""")
       + """SELECT '20240125' AS create_date, regionid AS area_code, platform, label AS source_type, n AS stb_num
  FROM sources UNION ALL SELECT '20240125', '14300', platform, label, CAST(sum(n) AS BIGINT) FROM sources GROUP BY 3,4""")
def stb_report_rollup(spark, sf_dir):
    return reports.stb_report(frames.online(spark, sf_dir), "20240125")


def _last_seen(spark, sf_dir):
    """The state of 22 January, then three days, each merged with what was stored the day before."""
    online, path = frames.online(spark, sf_dir), scratch_path(spark, "last-seen")
    buckets.write(last_seen.state_of(online, "20240122"), f"{path}/dt=20240122", "uuid", 8)
    for before, dt in (("20240122", "20240123"), ("20240123", "20240124"), ("20240124", "20240125")):
        state = buckets.read(spark, f"{path}/dt={before}", "uuid")
        buckets.write(last_seen.advance(state, online.where(F.col("dt") == dt), dt), f"{path}/dt={dt}", "uuid", 8, aligned=True)
    return buckets.read(spark, f"{path}/dt=20240125", "uuid")


@query(ORACLES["distinct_90d"])
def distinct_90d_state(spark, sf_dir):
    return last_seen.distinct_users(_last_seen(spark, sf_dir), "20240125")


@query(ORACLES["stb_report_rollup"])
def stb_report_state(spark, sf_dir):
    state = _last_seen(spark, sf_dir)
    return reports.rollup(
        last_seen.distinct_users(state, "20240125"), last_seen.residual_region(state, "20240125"), "20240125")


@query(with_(EV, """found AS (SELECT user_id AS userid, max('N'||k) AS stbid FROM ev GROUP BY 1)""", POOL)
       + "SELECT userid, stbid FROM found WHERE userid NOT IN (SELECT user_id FROM prev_pool)")
def new_relations_anti(spark, sf_dir):
    e = frames.events(spark, sf_dir)
    found = e.select(F.col("user_id").alias("userid"), frames.text("N", F.col("k")).alias("stbid"))
    known = frames.previous_pool(spark, sf_dir).select(F.col("user_id").alias("userid"))
    return reports.new_relations(found, known)


@query(with_(EV) + """SELECT 'P'||(k%40) AS page_id, min('page_'||(k%40)||' '||(k%4)) AS page_name FROM ev
  WHERE type IN ('view','click') AND k%13<>0
  AND 'P'||(k%40) NOT IN (SELECT 'P'||n_nationkey FROM nation) GROUP BY 1""")
def insert_if_absent(spark, sf_dir):
    """A page id may come with several names; one goes in."""
    pages = frames.page_views(spark, sf_dir)
    several = F.concat(F.col("pagename"), F.lit(" "), F.substring("offset_id", 3, 1))
    names = reports.page_names(pages.withColumn("pagename", F.when(F.col("pagename") != "", several)))
    stored = frames.table(spark, sf_dir, "nation").select(frames.text("P", F.col("n_nationkey")).alias("page_id"))
    return reports.rows_to_insert(names, stored, ["page_id"]).select("page_id", "page_name")


@query(with_(EV, LOG) + """SELECT media_id, min(media_name) AS media_name FROM log WHERE media_id<>'' AND media_name<>''
  AND media_id NOT IN (SELECT 'M'||n_nationkey FROM nation) GROUP BY 1""")
def insert_media_names(spark, sf_dir):
    names = reports.media_names(frames.log(spark, sf_dir))
    known = frames.table(spark, sf_dir, "nation").select(frames.text("M", F.col("n_nationkey")).alias("media_id"))
    return reports.rows_to_insert(names, known, ["media_id"])


@query(with_(EV, """a AS (SELECT strftime(make_timestamp(real_s*1000000),'%Y%m%d') AS dt, count(*)*1000 AS n FROM ev GROUP BY 1)""",
             """b AS (SELECT strftime(make_timestamp(real_s*1000000),'%Y%m%d') AS dt, count(*)*1000 AS n FROM ev
    WHERE type<>'error' AND strftime(make_timestamp(real_s*1000000),'%Y%m%d')>='20240112' GROUP BY 1)""")
       + """SELECT a.dt, a.n AS count, b.n AS other_count, a.n-b.n AS diff FROM a LEFT JOIN b ON a.dt=b.dt
  WHERE coalesce(a.n-b.n,134000)>67000""")
def count_reconcile(spark, sf_dir):
    """Daily counts of two systems as whitespace-separated text, columns swapped.  The
    second system started later."""
    e = frames.events(spark, sf_dir).withColumn("dt", frames.day_of(F.col("real_s")))
    n = F.count(F.lit(1))
    left = e.groupBy("dt").agg(n.alias("n"))
    right = e.where((F.col("type") != "error") & (F.col("dt") >= "20240112")).groupBy("dt").agg(n.alias("n"))
    thousand = (F.col("n") * 1000).cast("string")
    left = left.select(F.concat(F.col("dt"), F.lit("\t "), thousand).alias("value"))
    right = right.select(F.concat(F.lit(" "), thousand, F.lit("  "), F.col("dt")).alias("value"))

    def counts(lines, *names):
        return files.read_two_columns(lines, *names).withColumn("count", F.col("count").try_cast("bigint"))

    return reports.count_differences(counts(left, "dt", "count"), counts(right, "count", "dt"), 67000)


@query(with_(EV) + "SELECT count(*) AS pv FROM ev WHERE type IN ('view','click') AND k%4<>0")
def nonnull_count(spark, sf_dir):
    pages = frames.page_views(spark, sf_dir)
    sparse = pages.withColumn("offset_id", F.when(F.col("offset_id") != "OI0", F.col("offset_id")))
    return reports.non_null_count(sparse, "offset_id")
