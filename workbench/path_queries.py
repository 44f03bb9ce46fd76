"""Page paths and order attribution."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tvtrail.functions.times import day_of
from tvtrail.operators import orders, paths, reports
from tvtrail.session import stored
from workbench import frames
from workbench.registry import hot_users, query
from workbench.sql import EV, LOG, PAGES, POOL, day, with_

# Pages in order per user, with a boot page first where a power-on precedes them.
_SEQ = """named AS (SELECT user_id, ts, rid, pagename FROM pages_seen WHERE pagename<>''),
boot AS (SELECT n.user_id FROM (SELECT user_id, min(ts) AS p FROM named GROUP BY 1) n
  JOIN (SELECT user_id, min(ts) AS i FROM log WHERE state='0x01' GROUP BY 1) o USING (user_id) WHERE i<p),
seq AS (SELECT user_id, list(pagename ORDER BY ts, rid, pagename) AS pages FROM named GROUP BY 1),
full_seq AS (SELECT user_id, CASE WHEN user_id IN (SELECT user_id FROM boot) THEN list_prepend('开机精选', pages)
  ELSE pages END AS pages, user_id IN (SELECT user_id FROM boot) AS booted FROM seq),
padded AS (SELECT user_id, booted, len(pages) AS n, list_concat(['',''], pages, ['','']) AS p FROM full_seq),
tri AS (SELECT user_id, booted, n, i, p[i] AS page_name, p[i+1] AS page_name2, p[i+2] AS page_name3
  FROM padded, unnest(range(1, n+3)) AS t(i)),
paths AS (SELECT user_id, page_name, page_name2, page_name3 FROM tri
  WHERE NOT (booted AND i=1) AND NOT (n=1 AND i=2))"""
_COUNTS = """counts AS (SELECT page_name, page_name2, page_name3, count(*) AS ct,
  max(regexp_extract(apk_version,'^([^.]*[.][^.]*[.][^.]*)[.]',1)) AS apk_version, max(dt) AS dt,
  max(platform) AS platform FROM paths JOIN pool USING (user_id) GROUP BY 1,2,3)"""
_BASE = (EV, LOG, PAGES, _SEQ)


@query(with_(*_BASE) + "SELECT * FROM paths")
def path_trigrams(spark, sf_dir):
    events = frames.path_events(spark, sf_dir)
    return paths.path_trigrams(events, hot_users(events)).select("user_id", *paths.NAMES)


def _counts(spark, sf_dir):
    events = frames.path_events(spark, sf_dir)
    return paths.path_counts(events, frames.pool(spark, sf_dir), hot_users(events))


@query(with_(*_BASE, POOL, _COUNTS) + "SELECT * FROM counts")
def path_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


@query(with_(*_BASE, POOL, _COUNTS) + """SELECT DISTINCT '' AS page_id, name AS page_name FROM (
    SELECT unnest([page_name, page_name2, page_name3]) AS name FROM counts)
  WHERE name<>'' AND name NOT IN (SELECT 'page_'||n_nationkey FROM nation)""")
def insert_path_names(spark, sf_dir):
    """Names of path pages; their id is blank, so id and name are the key."""
    names = reports.path_page_names(_counts(spark, sf_dir))
    known = frames.table(spark, sf_dir, "nation").select(
        F.lit("").alias("page_id"), frames.text("page_", F.col("n_nationkey")).alias("page_name"))
    return reports.rows_to_insert(names, known, ["page_id", "page_name"])


def _top(near: str, middle: str, far: str, kind: str, base=(*_BASE, POOL, _COUNTS)) -> str:
    meta = "max(apk_version) AS apk_version, max(dt) AS dt, max(platform) AS platform"
    return with_(*base, f"""ranked AS (SELECT *, row_number() OVER (PARTITION BY {near},{middle}
    ORDER BY ct DESC, {far}) AS rn FROM counts),
second AS (SELECT * EXCLUDE (rn) FROM ranked WHERE rn<=19 UNION ALL BY NAME
  SELECT {near}, {middle}, 'other' AS {far}, CAST(sum(ct) AS BIGINT) AS ct, {meta} FROM ranked WHERE rn>19 GROUP BY 1,2),
third AS (SELECT {near}, {middle} FROM (SELECT {near}, {middle}, row_number() OVER (PARTITION BY {near}
    ORDER BY sum(ct) DESC, {middle}) AS rn FROM second GROUP BY 1,2) WHERE rn<=19)""") + f"""
SELECT s.*, '{kind}' AS type FROM second s JOIN third USING ({near},{middle}) UNION ALL BY NAME
SELECT {near}, 'other' AS {middle}, 'other' AS {far}, CAST(sum(ct) AS BIGINT) AS ct, {meta}, '{kind}' AS type
FROM second s WHERE NOT EXISTS (SELECT 1 FROM third t WHERE t.{near}=s.{near} AND t.{middle}=s.{middle}) GROUP BY 1"""


@query(_top("page_name", "page_name2", "page_name3", "0"))
def path_top20_start(spark, sf_dir):
    return paths.top_paths(stored(_counts(spark, sf_dir), "path-counts"))


@query(_top("page_name3", "page_name2", "page_name", "1"))
def path_top20_end(spark, sf_dir):
    return paths.top_paths(stored(_counts(spark, sf_dir), "path-counts"), end=True)


# The paths of each day by itself: a user is another one on another day.
_DAILY = (
    f"pages_day AS (SELECT *, user_id||'@'||{day('ts')} AS who FROM pages_seen)",
    f"log_day AS (SELECT *, user_id||'@'||{day('ts')} AS who FROM log)",
    _SEQ.replace("user_id", "who").replace("FROM pages_seen", "FROM pages_day").replace("FROM log", "FROM log_day"))
_DAILY_COUNTS = _COUNTS.replace("paths JOIN pool USING (user_id)", "paths JOIN pool ON pool.user_id=split_part(who,'@',1)")


@query(_top("page_name", "page_name2", "page_name3", "0", (EV, LOG, PAGES, *_DAILY, POOL, _DAILY_COUNTS)))
def path_period_start(spark, sf_dir):
    """Top paths of three days, from the stored counts of each."""
    events, pool = frames.path_events(spark, sf_dir), frames.pool(spark, sf_dir)
    days = [events.where(day_of(F.col("ts")) == dt) for dt in ("20240101", "20240102", "20240103")]
    daily = [stored(paths.path_counts(rows, pool, hot_users(rows)), "day-counts") for rows in days]
    return paths.top_paths(stored(paths.add_counts(reduce(DataFrame.unionByName, daily)), "period-counts"))


@query(with_(*_BASE, """p2 AS (SELECT user_id, len(pages) AS n, list_concat(['',''], pages, ['','']) AS p FROM seq),
inout AS (SELECT p[i] AS page_name, p[i+1] AS page_name2, p[i+2] AS page_name3, 0 AS lr FROM p2, unnest(range(3,n+3)) AS t(i)
  UNION ALL SELECT p[i], p[i-1], p[i-2], 1 FROM p2, unnest(range(3,n+3)) AS t(i))""")
       + "SELECT page_name, page_name2, page_name3, lr, count(*) AS ct FROM inout GROUP BY 1,2,3,4")
def path_in_out(spark, sf_dir):
    pages = frames.page_views(spark, sf_dir)
    return paths.in_out_counts(pages, hot_users(pages))


_LAST = """buys AS (SELECT l.*, coalesce((SELECT max_by(p.pagename, (p.ts, p.rid)) FROM pages_seen p
    WHERE p.user_id=l.user_id AND p.ts<=l.ts),'') AS pagename FROM log l WHERE state='0x09' AND k%2=1)"""


@query(with_(EV, LOG, PAGES, POOL, _LAST) + """SELECT user_id, p.regionid, media_name,
  regexp_extract(p.apk_version,'^([^.]*[.][^.]*[.][^.]*)[.]',1) AS apk_version, 'prod'||(k%8) AS product_name,
  pagename, substr(create_time,9,14) AS create_time, p.dt, p.platform FROM buys JOIN pool p USING (user_id)""")
def order_last_page(spark, sf_dir):
    events = frames.path_events(spark, sf_dir)
    for column in ("regionid", "apk_version", "dt", "platform"):
        events = events.withColumn(column, F.lit(""))
    return orders.order_relations(events, frames.pool(spark, sf_dir), hot_users(events))
