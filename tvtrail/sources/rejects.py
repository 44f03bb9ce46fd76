"""Bad records: dropped from the data, counted by type and reason.

Parsers asked for rejects keep a bad record as a row that names its reason.  A job writes
these rows with the good ones, in the table its steps read anyway, and counts them from
there: the logs are parsed once, and a task that runs again counts nothing twice.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tvtrail.schemas import ERROR, HEARTBEAT, INIT, LIVE, LOOK_BACK, ORDER, PAGE_VIEW, TIME_SHIFT, VOD

REJECT = "reject"  # state of a bad record

# Reasons, by what a line or record lacks.
SHORT, NO_TIME = "short", "no time"
NO_JSON, NO_BOX = "no json", "no box"
NO_PAIRS = "no pairs"

OTHER = "other"
RECORD_TYPES = (INIT, LIVE, VOD, LOOK_BACK, TIME_SHIFT, PAGE_VIEW, ORDER, ERROR, HEARTBEAT, OTHER)
# What can be wrong with which type.
RECORD_REASONS = ((INIT, SHORT), *((code, NO_TIME) for code in RECORD_TYPES))
ONLINE_REASONS = (("online", NO_JSON), ("online", NO_BOX))
APP_VOD_REASONS = (("vod", NO_PAIRS), ("vod", NO_TIME))

COLUMNS = ("type", "reason", "n")


def known_type(code: Column) -> Column:
    """Type codes the logs have; whatever else stands there is one type."""
    return F.when(code.isin(*RECORD_TYPES), code).otherwise(F.lit(OTHER))


def record_rejects(rows: DataFrame) -> DataFrame:
    """(type, reason) of the bad rows of a parser of records."""
    bad = rows.where(F.col("reject").isNotNull())
    return bad.select(known_type(F.col("code")).alias("type"), F.col("reject").alias("reason"))


def line_rejects(rows: DataFrame, kind: str, *more: str) -> DataFrame:
    """(type, reason) and columns of the caller's, of the bad rows of a parser of lines of one kind."""
    bad = rows.where(F.col("reject").isNotNull())
    return bad.select(F.lit(kind).alias("type"), F.col("reject").alias("reason"), *more)


def report(rejects: DataFrame, reasons: Iterable[tuple[str, str]], n: Column | None = None) -> DataFrame:
    """(type, reason, n): one row for each that can occur, 0 where none did.

    So a day without bad records replaces the counts of an earlier run.  ``n``: rows that
    a row of ``rejects`` stands for, one by default.
    """
    expected = F.array(*[F.struct(F.lit(t).alias("type"), F.lit(r).alias("reason")) for t, r in reasons])
    grid = rejects.sparkSession.range(1).select(F.inline(expected))
    counts = rejects.groupBy("type", "reason").agg(F.sum(F.lit(1) if n is None else n).alias("n"))
    return grid.join(counts, ["type", "reason"], "left").select(
        "type", "reason", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
