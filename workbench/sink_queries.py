"""Writers, checked by reading back what they wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tvtrail import sinks
from tvtrail.operators import flow
from tvtrail.session import scratch_path
from tvtrail.sources import files
from workbench import frames
from workbench.registry import query
from workbench.sql import EV, ONLINE, with_

_PART = ["dt", "platform", "source_type"]


@query(with_(EV, ONLINE) + """SELECT uuid, regionid, dt, platform, source_type FROM online
  WHERE NOT (dt='20240110' AND platform='HNYD')
  UNION ALL SELECT uuid, '14309', dt, platform, source_type FROM online WHERE dt='20240110' AND platform='HNYD'""")
def sink_partition_overwrite(spark, sf_dir):
    """A rerun replaces the partitions it writes and leaves the others."""
    path = scratch_path(spark, "online")
    online = frames.online(spark, sf_dir)
    sinks.overwrite_partitions(online, path)
    rerun = online.where((F.col("dt") == "20240110") & (F.col("platform") == "HNYD"))
    sinks.overwrite_partitions(rerun.withColumn("regionid", F.lit("14309")), path)
    return files.read_partition(spark, path).select("uuid", "regionid", *_PART)


@query(with_(EV, ONLINE) + """SELECT uuid, regionid, '20240111' AS dt, 'HNDX' AS platform, 'apk' AS source_type
  FROM online""")
def sink_static_partition(spark, sf_dir):
    path = scratch_path(spark, "static")
    online = frames.online(spark, sf_dir)
    for day in ("20240110", "20240111"):
        rows = online.select("uuid", "regionid")
        sinks.overwrite_static(rows, path, dt=day, platform="HNDX", source_type="apk")
    return files.read_partition(spark, path, dt="20240111").select("uuid", "regionid", *_PART)


@query(with_(EV, ONLINE) + """SELECT uuid, '0' AS type, dt FROM online WHERE platform='HNYD'
  UNION ALL SELECT uuid, '1', dt FROM online WHERE platform<>'HNYD'""")
def sink_append_union(spark, sf_dir):
    """Both halves of a report are written together, so a rerun cannot append twice."""
    path = scratch_path(spark, "halves")
    online = frames.online(spark, sf_dir)

    own = F.col("platform") == "HNYD"

    def half(rows, kind):
        return online.where(rows).select("uuid", F.lit(kind).alias("type"), "dt")

    for _ in range(2):
        sinks.overwrite_partitions(half(own, "0").unionByName(half(~own, "1")), path, ("dt",), files=2)
    return files.read_partition(spark, path).select("uuid", "type", "dt")


@query(with_(EV, """c AS (SELECT type, strftime(make_timestamp(real_s*1000000),'%Y%m%d') AS day, count(*) AS n
    FROM ev GROUP BY 1,2)""") + "SELECT type||'|'||day||'|label|000000|020000|'||n AS value FROM c")
def sink_text(spark, sf_dir):
    path = scratch_path(spark, "text")
    e = frames.events(spark, sf_dir)
    counts = e.groupBy("type", frames.day_of(F.col("real_s")).alias("day")).agg(F.count(F.lit(1)).alias("count"))
    report = counts.withColumns({
        "content": F.lit("label"), "starttime": F.lit("000000"), "endtime": F.lit("020000")})
    sinks.write_text(flow.flow_lines(report), path)
    return files.read_lines(spark, [path])


@query(with_(EV) + """SELECT event_id, user_id, k FROM ev""")
def sink_table(spark, sf_dir):
    """A managed table; its files go to the shared folder."""
    name = f"tvtrail_events_{uuid.uuid4().hex[:12]}"
    path = scratch_path(spark, "table")
    sinks.save_table(frames.events(spark, sf_dir).select("event_id", "user_id", "k"), name, path)
    return spark.table(name)


@query(with_(EV) + """SELECT DISTINCT 'P'||(k%40) AS page_id FROM ev""")
def sink_insert_missing(spark, sf_dir):
    """Inserting twice leaves every key once."""
    path = scratch_path(spark, "names")
    e = frames.events(spark, sf_dir)
    names = e.select(frames.text("P", F.col("k") % 40).alias("page_id"))
    e.where(F.col("type") == "view").select(frames.text("P", F.col("k") % 40).alias("page_id")).distinct().write.parquet(path)
    sinks.insert_missing(names, spark.read.parquet(path), path, ["page_id"])
    return spark.read.parquet(path)
