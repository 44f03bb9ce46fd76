"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on.  All can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Of a key repeated in a key/value line the last one counts.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # The record layouts make long expressions.  The JVM never compiles methods
    # above 8,000 bytes of bytecode; past that Spark is to generate smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def prepare(spark: SparkSession, time_zone: str | None = None) -> SparkSession:
    """Apply the runtime settings to a session somebody else created.

    The time zone decides where a reporting day begins; it stays as it is unless
    one is named.
    """
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    if time_zone:
        spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


# Settings that only a new session can take.  Recording the Python line of every
# column expression costs more than analysing the plans of these jobs.
START_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(
    app: str, master: str | None = None, time_zone: str = "UTC", **conf: str
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for name, value in START_CONF.items():
        builder = builder.config(name, value)
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate(), time_zone)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets a temporary folder; on a
    cluster a missing setting is an error, since a machine-local folder would
    be lost with its executor.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="tvtrail-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path whose table goes when the enclosing ``working_tables`` blocks end."""
    path = scratch_path(spark, name)
    for tables in _open:
        tables.append(path)
    return path


def stored(df: DataFrame, name: str, partitions: tuple[str, ...] = ()) -> DataFrame:
    """Write a frame several steps read, and read it back.

    The table in the shared folder outlives lost executors, and its readers
    neither repeat the work nor drag its lineage along.  Filters on columns of
    ``partitions`` read only their folders.
    """
    path = working_path(df.sparkSession, name)
    if not partitions:
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)
    df.hint("rebalance", *partitions).write.partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Where an operator puts a small table that large ones are joined with.  Adaptive execution splits
# the hot keys of a join only if both sides come straight from a shuffle: a side that is still to be
# aggregated keeps the rows of a key in one task, one that was stored before does not.
Keep = Callable[[DataFrame, str], DataFrame]


def as_it_is(df: DataFrame, name: str) -> DataFrame:
    """Leave the table a part of the plan."""
    return df


def stored_once() -> Keep:
    """Store each table the first time its name comes up; its later users read the same one."""
    tables: dict[str, DataFrame] = {}

    def keep(df: DataFrame, name: str) -> DataFrame:
        if name not in tables:
            tables[name] = stored(df, name)
        return tables[name]

    return keep


_open: list[list[str]] = []


@contextmanager
def working_tables(spark: SparkSession):
    """Remove the tables written inside the block when it ends, however it ends.

    Yields the list of their paths; one taken from the list stays.
    """
    tables: list[str] = []
    _open.append(tables)
    try:
        yield tables
    finally:
        _open.remove(tables)
        for name in tables:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
