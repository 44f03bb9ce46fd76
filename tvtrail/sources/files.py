"""File scans: day folders of raw text, partitioned tables, external tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tvtrail.functions.times import halo_days
from tvtrail.schemas import ORDER


def existing_paths(spark: SparkSession, patterns: list[str]) -> list[str]:
    """The patterns that match at least one file or folder."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        matches = path.getFileSystem(conf).globStatus(path)
        if matches is not None and len(matches) > 0:
            found.append(pattern)
    return found


def read_lines(
    spark: SparkSession, patterns: list[str], optional: list[str] | bool = False
) -> DataFrame:
    """Raw lines in a column ``value``; a pattern without a file is an error.

    ``optional`` lists further patterns that are skipped where nothing matches; True
    makes all of them optional.
    """
    required, extra = ([], patterns) if optional is True else (patterns, optional or [])
    there = set(existing_paths(spark, [*required, *extra]))
    missing = [p for p in required if p not in there]
    if missing:
        raise FileNotFoundError(f"no input at {', '.join(missing)}")
    found = [p for p in (*required, *extra) if p in there]
    return spark.read.text(found) if found else spark.createDataFrame([], "value string")


def day_patterns(root: str, codes: list[str], days: list[str]) -> list[str]:
    return [f"{root}/sdk_{code}/dt={day}/*" for code in codes for day in days]


def read_days(
    spark: SparkSession, root: str, codes: list[str], days: list[str], allow_missing: bool = False
) -> DataFrame:
    """The record types ``codes`` of some days.

    Only order logs may be absent, unless the caller allows gaps.
    """
    needed = [code for code in codes if code != ORDER]
    orders = [code for code in codes if code == ORDER]
    if allow_missing:
        return read_lines(spark, day_patterns(root, codes, days), optional=True)
    return read_lines(spark, day_patterns(root, needed, days), day_patterns(root, orders, days))


def read_log_days(
    spark: SparkSession, root: str, day: str, codes: list[str], halo: int = 1, allow_missing: bool = False
) -> DataFrame:
    """The day and its neighbours, so sessions that cross midnight are whole."""
    return read_days(spark, root, codes, halo_days(day, halo, halo), allow_missing)


def stored_days(spark: SparkSession, path: str, platform: str, source_type: str) -> list[str]:
    """The days of a table that hold a platform and source, from the folder names."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{path}/dt=*/platform={platform}/source_type={source_type}")
    matches = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    days = [m.getPath().getParent().getParent().getName() for m in matches or []]
    return sorted(day.split("=", 1)[1] for day in days)


def read_partition(
    spark: SparkSession,
    path: str,
    dt: str | None = None,
    platform: str | None = None,
    source_type: str | None = None,
) -> DataFrame:
    """A table partitioned by dt, platform, source_type; the filters prune folders."""
    table = spark.read.parquet(path)
    wanted = {"dt": dt, "platform": platform, "source_type": source_type}
    for name, value in wanted.items():
        if value is not None:
            table = table.where(F.col(name).cast("string") == value)
    return table.withColumns(
        {c: F.col(c).cast("string") for c in wanted if c in table.columns}
    )


def read_external(spark: SparkSession, fmt: str, **options: str) -> DataFrame:
    """A table of another store; the caller names the format and its options."""
    return spark.read.format(fmt).options(**options).load()


def jdbc_options(
    connection: dict[str, str],
    query: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 1000,
) -> dict[str, str]:
    """Options of a JDBC scan of a subquery, split on a plain numeric column."""
    options = dict(connection)
    options["dbtable"] = f"({query}) t"
    options["fetchsize"] = str(fetch_size)
    if partition_column:
        if bounds is None:
            raise ValueError("a partitioned scan needs the column's real bounds")
        options["partitionColumn"] = partition_column
        options["lowerBound"], options["upperBound"] = (str(b) for b in bounds)
        options["numPartitions"] = str(partitions)
    return options


def read_jdbc(spark: SparkSession, connection: dict[str, str], query: str, **scan) -> DataFrame:
    return read_external(spark, "jdbc", **jdbc_options(connection, query, **scan))


def read_two_columns(lines: DataFrame, first: str, second: str, value: str = "value") -> DataFrame:
    """Whitespace-separated two-column text."""
    parts = F.split(F.trim(F.col(value)), r"\s+")

    def part(i: int) -> Column:
        return F.get(parts, F.lit(i))

    return lines.select(part(0).alias(first), part(1).alias(second))
