"""Helpers the training-text operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tvtrail.session import working_path

# Separators of words, as in the character class [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for the jobs of a block, restored after it."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder, free its shuffle files, read it back.

    Later steps start from the written table, so a lost executor never costs
    more than the tasks of the step at hand.  The table goes when an enclosing
    ``working_tables`` block ends, or by ``discard``.
    """
    spark, path = df.sparkSession, working_path(df.sparkSession, name)
    with setting(spark, _CLEANUP, "true"):
        df.write.parquet(path)
    table = spark.read.parquet(path)
    table.settled_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.settled_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def text_bytes(text: str | Column) -> Column:
    """UTF-8 length of a text; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint")


def text_crc32(text: str | Column) -> Column:
    """Unsigned crc32 of the UTF-8 bytes of a text; that of no bytes for null."""
    return F.crc32(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def packed(df: DataFrame, **own: Column) -> DataFrame:
    """The input row as one struct ``_row`` beside columns of the operator's own.

    No column of the input can clash with the operator's names that way.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[c.alias(n) for n, c in own.items()])


def unpacked(df: DataFrame, **new: Column) -> DataFrame:
    """The input columns again, with the new ones replacing any of the same name."""
    old = [c for c in df.schema["_row"].dataType.names if c.lower() not in {n.lower() for n in new}]
    return df.select(*[F.col("_row")[c].alias(c) for c in old], *[c.alias(n) for n, c in new.items()])


def row_hash(df: DataFrame) -> Column:
    """A hash over all columns that can be hashed; orders rows that tie otherwise."""
    usable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(*[F.col(f"`{c}`") for c in usable]) if usable else F.lit(0).cast("bigint")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def number_rows(df: DataFrame, order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """Settle ``df`` with ``_number``: the row's place, from 0, in ascending ``order``.

    Rows are range partitioned and sorted; a row's place is the number of rows of
    all earlier partitions, a prefix sum over one row per partition, plus its
    place in its own partition.
    """
    spark = df.sparkSession
    ranged = (
        df.repartitionByRange(parts or shuffle_partitions(spark), *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    table = settle(ranged, name)
    base = bases(table.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")), "_part", "_rows")
    return (
        table.join(F.broadcast(base), "_part")  # one row per partition
        .withColumn("_number", F.col("_base") + F.col("_at"))
        .drop("_part", "_at", "_base")
    )


def bases(totals: DataFrame, part: str, total: str) -> DataFrame:
    """(part, ``_base``): what the parts before it add up to; one row per partition comes in."""
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(total).over(earlier), F.lit(0)).cast("bigint").alias("_base"))
