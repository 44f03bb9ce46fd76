"""Writers.  Columns are matched by name and partitions are replaced, so a rerun
of a day, or of a lost task, leaves the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tvtrail.operators.reports import rows_to_insert
from tvtrail.schemas import PARTITION_COLUMNS


def overwrite_partitions(
    df: DataFrame, path: str, partitions: tuple[str, ...] = PARTITION_COLUMNS, files: int | None = None
) -> None:
    """Replace the partitions present in ``df``; others stay.

    The mode is set on the writer, so it does not depend on session settings.
    Rows are rebalanced by partition first: adaptive execution splits a large
    partition and merges small ones, so files get an even size instead of one
    small file per task and partition.  ``files`` limits them for small tables.
    """
    out = df.hint("rebalance", *partitions) if files is None else df.coalesce(files)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def overwrite_static(df: DataFrame, path: str, **partition: str) -> None:
    """Replace one partition whose values the caller names."""
    fixed = df.drop(*partition).withColumns({c: F.lit(v) for c, v in partition.items()})
    overwrite_partitions(fixed, path, tuple(partition))


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_text(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def append_external(df: DataFrame, fmt: str, **options: str) -> None:
    """Append to a table of another store, e.g. ``jdbc``."""
    df.write.format(fmt).options(**options).mode("append").save()


def insert_missing(candidates: DataFrame, target: DataFrame, path: str, keys: list[str]) -> None:
    """Append the candidate rows whose key the stored table lacks."""
    rows_to_insert(candidates, target, keys).write.mode("append").parquet(path)
