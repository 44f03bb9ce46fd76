"""Tables bucketed by a key: a join or grouping on that key reads them without a shuffle.

A table is a folder of Parquet files, written and read through a catalog entry that lives only
as long as the call, so any session, and any reader of plain Parquet, can use it.  A marker
file tells the number of buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MARKER = "_buckets-"
# Of new tables.  A bucket should fit a task: 200 for 30 GB is 150 MB each.
SETTING, DEFAULT = "spark.tvtrail.buckets", "200"


def setting(spark: SparkSession) -> int:
    return int(spark.conf.get(SETTING, DEFAULT))


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def bucket_count(spark: SparkSession, path: str) -> int | None:
    """Buckets of the table in a folder; null where there is none, or no bucketed one."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return None
    found = [f.getPath().getName() for f in fs.listStatus(folder)]
    counts = [int(name.removeprefix(MARKER)) for name in found if name.startswith(MARKER)]
    return counts[0] if len(counts) == 1 else None


def write(df: DataFrame, path: str, key: str, buckets: int, aligned: bool = False) -> None:
    """Replace the table in a folder.

    ``aligned``: the rows come from a join with a table of as many buckets, so each task already
    holds the rows of one bucket; others are shuffled first, or every task would write a file
    for every bucket.
    """
    spark, name = df.sparkSession, f"tvtrail_{uuid.uuid4().hex}"
    rows = df if aligned else df.repartition(buckets, key)
    writer = rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # of a table with a path, only the entry
    _, fs = _folder(spark, path)
    fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MARKER}{buckets}"), True).close()


def read(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The table in a folder, known to be bucketed by its key if it is."""
    plain = spark.read.parquet(path)
    buckets = bucket_count(spark, path)
    if buckets is None:
        return plain
    name = f"tvtrail_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
        f"INTO {buckets} BUCKETS LOCATION '{path}'")
    table = spark.table(name)
    table.schema  # resolved while the entry is there
    spark.sql(f"DROP TABLE {name}")
    return table
