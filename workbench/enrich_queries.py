"""Dictionaries applied to on-demand views."""

from __future__ import annotations

from pyspark.sql import functions as F

from tvtrail.operators import app_vod, facts, vod
from tvtrail.session import stored
from tvtrail.sources import app_lines
from workbench import frames, wire
from workbench.registry import query
from workbench.sql import ASSETS, EV, LOG, MEDIA, REVIEW, VERSION, log_time, pick, telecom_region, with_


def _vod_records(spark, sf_dir):
    """On-demand records in the layout of the VOD fact."""
    log = frames.log(spark, sf_dir).where(F.col("state") == "0x04")
    return log.select(
        F.col("user_id").alias("uuid"), "regionid", F.col("create_time").alias("play_start_time"),
        F.col("create_time").alias("play_end_time"), "media_id", "media_name", "category_id",
        "apk_version", "channel_id", "rid", F.lit(frames.DAY).alias("dt"), "platform", "source_type")


@query(with_(EV, LOG, ASSETS) + """SELECT rid, user_id AS uuid, l.media_id, coalesce(uuid,'') AS media_uuid,
  coalesce(midianame,'') AS media_second_name, coalesce(ydmedia,'') AS asset_id,
  coalesce(ltmedia,'') AS orgin_id FROM log l LEFT JOIN assets a ON a.media_id=l.media_id WHERE state='0x04'""")
def vod_asset_left_join(spark, sf_dir):
    rows = facts.with_assets(_vod_records(spark, sf_dir), frames.assets(spark, sf_dir))
    return rows.select("rid", "uuid", "media_id", "media_uuid", "media_second_name", "asset_id", "orgin_id")


_RESOLVE = """up AS (SELECT k AS identityno, min(v) FILTER (s_suppkey%3<>0) AS v FROM (SELECT s_suppkey,
    CASE WHEN s_nationkey=8 THEN '' WHEN s_nationkey<>7 THEN 'UP'||(s_suppkey%15) END AS k,
    ('CAT'||s_nationkey, 'CHN_'||(s_suppkey%6)) AS v FROM supplier) WHERE k<>'' GROUP BY 1),
options AS (SELECT media_id, category_id, min(channel_id) AS channel_id FROM media GROUP BY 1,2),
cat_names AS (SELECT category_id, min(category_name) AS category_name FROM media GROUP BY 1),
banned AS (SELECT DISTINCT category_id FROM cat_names, review WHERE starts_with(category_name, word)),
views AS (SELECT l.rid, l.user_id AS uuid, l.media_id, CASE WHEN l.media_name='' THEN coalesce(n.name,'')
    ELSE l.media_name END AS media_name, up.v AS v, up.identityno AS hit
  FROM log l LEFT JOIN media_names n ON n.media_id=l.media_id
  LEFT JOIN up ON up.identityno=l.category_id WHERE l.state='0x04'),
rows_ AS (SELECT rid, uuid, views.media_id, media_name,
    CASE WHEN hit IS NOT NULL THEN coalesce(v[1],'') ELSE coalesce(o.category_id,'') END AS category_id,
    CASE WHEN hit IS NOT NULL THEN coalesce(v[2],'') ELSE coalesce(o.channel_id,'') END AS channel_id
  FROM views LEFT JOIN options o ON o.media_id=views.media_id AND hit IS NULL),
resolved AS (SELECT r.*, coalesce(c.category_name,'') AS category_name FROM rows_ r
  LEFT JOIN cat_names c USING (category_id) WHERE r.category_id NOT IN (SELECT category_id FROM banned))"""


def _resolved(spark, sf_dir):
    rows = _vod_records(spark, sf_dir).withColumn("media_uuid", F.lit(""))
    return vod.resolve_categories(
        rows, frames.dict_media(spark, sf_dir), frames.upload_map(spark, sf_dir),
        frames.review_words(spark, sf_dir))


@query(with_(EV, LOG, MEDIA, REVIEW, _RESOLVE)
       + "SELECT rid, uuid, media_id, media_name, category_id, category_name, channel_id FROM resolved")
def vod_category_resolve(spark, sf_dir):
    return _resolved(spark, sf_dir).select(
        "rid", "uuid", "media_id", "media_name", "category_id", "category_name", "channel_id")


@query(with_(EV, LOG, MEDIA, REVIEW, _RESOLVE) + """SELECT rid, category_id, channel_id,
  CASE WHEN row_number() OVER (PARTITION BY rid, channel_id ORDER BY category_id)=1 THEN '0' ELSE '1' END AS flag
  FROM resolved""")
def vod_primary_flag(spark, sf_dir):
    return _resolved(spark, sf_dir).select("rid", "category_id", "channel_id", "flag")


@query(with_(EV) + """SELECT event_id, user_id FROM ev
  WHERE NOT starts_with(user_id,'test') AND NOT starts_with(user_id,'YX1')""")
def test_user_filter(spark, sf_dir):
    e = frames.events(spark, sf_dir).select("event_id", "user_id")
    return facts.drop_test_users(e, frames.test_prefixes(spark, sf_dir), "user_id")


_COPIES = """copies AS (SELECT *, unnest(CASE k%10 WHEN 0 THEN [0,1] WHEN 1 THEN [0,2] WHEN 2 THEN [0,3] ELSE [0] END)
  AS c FROM ev WHERE type='view')"""
_KEPT = f"""sent AS (SELECT user_id AS uuid, {telecom_region('user_id')} AS regionid,
  {log_time('s+CASE WHEN c=3 THEN 60 ELSE 0 END')} AS play_start_time,
  {log_time('s+k*200+CASE WHEN c=2 THEN 60 ELSE 0 END')} AS play_end_time,
  s+CASE WHEN c=3 THEN 60 ELSE 0 END AS b, s+k*200+CASE WHEN c=2 THEN 60 ELSE 0 END AS e,
  CASE WHEN k%29=0 THEN '' ELSE 'M'||k END AS media_id, 'media '||k AS media_name,
  CASE WHEN k%3=0 THEN '' ELSE 'CAT'||(k%25) END AS category_id, {VERSION} AS apk_version,
  'PR'||(k%3) AS pro_id,
  CASE WHEN k%4=0 THEN '' ELSE {pick(('economy', 'small', 'large', 'standard', 'promo', 'medium'), 'k')} END AS clum_id
  FROM copies WHERE k%31<>0),
kept AS (SELECT * EXCLUDE (b, e) FROM sent WHERE e-b BETWEEN 3 AND 14400 AND (
  (left(play_end_time,8)='20240102' AND left(play_start_time,8)<='20240102')
  OR (left(play_start_time,8)='20240102' AND left(play_end_time,8)>'20240102')))"""
_ONCE = """once AS (SELECT * EXCLUDE (n) FROM (SELECT *, count(*) OVER (PARTITION BY uuid, regionid, play_start_time,
  play_end_time, media_id, media_name, category_id, apk_version, pro_id, clum_id) AS n FROM kept) WHERE n=1)"""
_DEDUP = """same_end AS (SELECT * FROM once QUALIFY row_number() OVER (PARTITION BY uuid, regionid, play_end_time,
  media_id, media_name, category_id, apk_version, pro_id, clum_id ORDER BY play_start_time)=1),
same_start AS (SELECT * FROM same_end QUALIFY row_number() OVER (PARTITION BY uuid, play_start_time, media_id,
  category_id, apk_version, pro_id, clum_id ORDER BY play_end_time DESC, media_name, regionid)=1),
cleaned AS (SELECT * REPLACE (greatest(play_start_time,'20240102000000') AS play_start_time,
  least(play_end_time,'20240102235959') AS play_end_time) FROM same_start)"""
_APP = (EV, _COPIES, _KEPT, _ONCE, _DEDUP)


def _sent(spark, sf_dir):
    parsed = app_lines.parse_app_vod(wire.app_vod_lines(spark, sf_dir))
    return app_vod.views_of_day(parsed, frames.DAY)


@query(with_(EV, _COPIES, _KEPT, _ONCE) + "SELECT * FROM once")
def appvod_unique_only(spark, sf_dir):
    return app_vod.occurring_once(_sent(spark, sf_dir))


@query(with_(*_APP) + "SELECT * FROM cleaned")
def appvod_dedup(spark, sf_dir):
    return app_vod.cut_to_day(app_vod.deduplicate(_sent(spark, sf_dir)), frames.DAY)


_DIMS = ASSETS + """,
cats AS (SELECT DISTINCT p_type AS nns_id, 'name '||lower(p_type) AS nns_name,
  'CAT'||split_part(p_brand,'#',2) AS nns_category_id,
  'cat '||lower(p_type)||' '||split_part(p_brand,'#',2) AS nns_category_name FROM part),
chans AS (SELECT DISTINCT upper(nns_id) AS nns_id, nns_name FROM cats),
assists AS (SELECT DISTINCT 'M'||(p_partkey%100) AS nns_video_id, upper(p_type) AS assist,
  'CAT'||split_part(p_brand,'#',2) AS nns_category_id FROM part),
prods AS (SELECT DISTINCT 'AS'||p_size AS asset_id FROM part)"""
# What a row shows of its media, and how category and channel ids read.
_LOOKUPS = """media_info AS (SELECT media_id, midianame, uuid AS media_uuid, cp,
  CASE WHEN dxmedia IN (SELECT asset_id FROM prods) THEN '1' ELSE '0' END AS isfree FROM assets),
places AS (SELECT upper(nns_id) AS place_channel, nns_category_id AS place_category, nns_category_name AS label FROM cats),
channel_names AS (SELECT nns_id AS named_channel, nns_name AS channel_name FROM chans)"""


def _published(name: str, rows: str) -> str:
    """Rows with ``category_id`` and ``channel_id`` settled, as they are published."""
    return f"""{name} AS (SELECT DISTINCT uuid, regionid, play_start_time, play_end_time, media_id,
  coalesce(midianame, media_name, '') AS media_name, category_id, coalesce(label, '') AS category_name, apk_version,
  coalesce(media_uuid, '') AS media_uuid, coalesce(cp, '') AS cp, pro_id, channel_id,
  coalesce(channel_name, '') AS channel_name, coalesce(isfree, '0') AS isfree FROM ({rows}) AS settled
  LEFT JOIN media_info USING (media_id)
  LEFT JOIN places ON place_channel=channel_id AND place_category=category_id
  LEFT JOIN channel_names ON named_channel=channel_id)"""


_SENT_ROWS = _LOOKUPS + ",\n" + _published(
    "sent_rows", "SELECT *, upper(clum_id) AS channel_id FROM cleaned WHERE category_id<>''")
# Without a category, one row for each place of the media, on the channel that was sent if any.
_FOUND_ROWS = _published("found_rows", """SELECT seen.* REPLACE (nns_category_id AS category_id), assist AS channel_id
  FROM (SELECT * FROM cleaned WHERE category_id='') AS seen
  LEFT JOIN assists ON nns_video_id=media_id AND (coalesce(clum_id, '')='' OR assist=upper(clum_id))""")


def _views(spark, sf_dir):
    return app_vod.app_views(app_lines.parse_app_vod(wire.app_vod_lines(spark, sf_dir)), frames.DAY)


def _sent_rows(spark, sf_dir):
    return app_vod.with_sent_category(
        _views(spark, sf_dir), frames.assets(spark, sf_dir), frames.app_categories(spark, sf_dir),
        frames.products(spark, sf_dir))


def _found_rows(spark, sf_dir):
    return app_vod.with_found_category(
        _views(spark, sf_dir), frames.assets(spark, sf_dir), frames.app_placements(spark, sf_dir),
        frames.app_categories(spark, sf_dir), frames.products(spark, sf_dir))


@query(with_(*_APP, _DIMS, _SENT_ROWS) + "SELECT * FROM sent_rows")
def appvod_multi_left(spark, sf_dir):
    return _sent_rows(spark, sf_dir)


@query(with_(*_APP, _DIMS, _LOOKUPS, _FOUND_ROWS) + "SELECT * FROM found_rows")
def appvod_conditional_join(spark, sf_dir):
    return _found_rows(spark, sf_dir)


_FLAGGED = """flagged AS (SELECT *, CASE WHEN EXISTS (SELECT 1 FROM review WHERE contains(category_name, word))
    THEN '2' ELSE '0' END AS flag FROM sent_rows
  UNION ALL
  SELECT * EXCLUDE (bad), CASE WHEN bad THEN '2' WHEN row_number() OVER (PARTITION BY uuid, play_start_time,
      play_end_time, media_id, channel_id, bad ORDER BY category_id NULLS LAST, category_name, regionid, media_name,
      apk_version, pro_id, media_uuid, cp, channel_name, isfree)=1 THEN '0' ELSE '1' END AS flag
  FROM (SELECT *, EXISTS (SELECT 1 FROM review WHERE contains(category_name, word)) AS bad FROM found_rows))"""


@query(with_(*_APP, _DIMS, REVIEW, _SENT_ROWS, _FOUND_ROWS, _FLAGGED) + "SELECT * FROM flagged")
def appvod_results(spark, sf_dir):
    """The published rows: both category branches with their flags."""
    return app_vod.app_results(
        stored(_views(spark, sf_dir), "app-views"), frames.assets(spark, sf_dir), frames.app_placements(spark, sf_dir),
        frames.app_categories(spark, sf_dir), frames.products(spark, sf_dir),
        frames.review_words(spark, sf_dir))


@query(with_(EV, REVIEW, """named AS (SELECT event_id, 'cat '||lower(p_type)||' '||split_part(p_brand,'#',2) AS category_name
    FROM ev JOIN part ON p_partkey=k)""")
       + """SELECT event_id, category_name, EXISTS (SELECT 1 FROM review WHERE contains(category_name, word)) AS review
  FROM named""")
def review_category_flag(spark, sf_dir):
    part = frames.table(spark, sf_dir, "part")
    brand = F.substring_index("p_brand", "#", -1)
    named = part.select("p_partkey", F.concat(F.lit("cat "), F.lower("p_type"), F.lit(" "), brand).alias("category_name"))
    rows = frames.events(spark, sf_dir).join(named, F.col("k") == F.col("p_partkey")).select("event_id", "category_name")
    return app_vod.with_review_flag(
        rows, frames.app_categories(spark, sf_dir), frames.review_words(spark, sf_dir))


@query(with_(EV) + """SELECT event_id, CASE WHEN k%5<3 THEN '0' ELSE '1' END AS isfree FROM ev""")
def free_flag(spark, sf_dir):
    k = F.col("k")
    asset = F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit("null")).when(k % 5 > 2, frames.text("AS", k))
    return frames.events(spark, sf_dir).select("event_id", app_vod.is_free(asset).alias("isfree"))
