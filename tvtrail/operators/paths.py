"""Page paths: three consecutive pages of a user, counted and ranked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tvtrail.functions.text import major_version
from tvtrail.operators.hotkeys import HotKeys, join_per_key, neighbours
from tvtrail.schemas import BOOT_PAGE, INIT, OTHER_PAGE, PAGE_VIEW

_META = ("apk_version", "dt", "platform")
KEPT = 19       # ranks kept; everything beyond becomes one "other"
NAMES = ("page_name", "page_name2", "page_name3")


def _named_pages(events: DataFrame) -> DataFrame:
    named = (F.col("state") == PAGE_VIEW) & (F.coalesce("pagename", F.lit("")) != "")
    return events.where(named).select("user_id", "ts", "rid", "pagename")


def _boot_pages(events: DataFrame) -> DataFrame:
    """A leading page for users switched on before their first page.

    Only the first page and the first power-on matter, so two map-side minima
    per user decide it.  It sorts before the first page by its smaller time.
    """
    on = F.col("state") == INIT
    page = (F.col("state") == PAGE_VIEW) & (F.coalesce("pagename", F.lit("")) != "")
    firsts = events.groupBy("user_id").agg(
        F.min(F.when(on, F.col("ts"))).alias("_on"), F.min(F.when(page, F.col("ts"))).alias("_page")
    )
    return firsts.where(F.col("_on") < F.col("_page")).select(
        "user_id", F.col("_on").alias("ts"), F.lit(0).cast("bigint").alias("rid"),
        F.lit(BOOT_PAGE).alias("pagename"),
    )


def path_trigrams(events: DataFrame, hot: HotKeys) -> DataFrame:
    """Every run of three pages, padded with blanks at both ends.

    The page before the one before is the previous page's own previous page, so
    two one-step passes over the same partitioning are enough.
    """
    boots = _boot_pages(events).withColumn("_boot", F.lit(True))
    pages = _named_pages(events).withColumn("_boot", F.lit(False)).unionByName(boots)
    pages = hot.split(pages, "ts")
    order = ["ts", "rid", "pagename"]
    key = ["user_id"]
    pages = neighbours(pages, key, order, {"_one": F.col("pagename")}, {"_more": F.lit(True)}, hot)
    pages = neighbours(pages, key, order, {"_two": F.col("_one")}, {}, hot)
    one, two = F.coalesce("_one", F.lit("")), F.coalesce("_two", F.lit(""))
    page, blank = F.col("pagename"), F.lit("")
    last = F.col("_more").isNull()

    def path(a: Column, b: Column, c: Column) -> Column:
        return F.struct(*[x.alias(n) for x, n in zip((a, b, c), NAMES)])

    paths = F.filter(
        F.array(
            F.when(~F.col("_boot"), path(two, one, page)),
            F.when(last & F.col("_one").isNotNull(), path(one, page, blank)),
            F.when(last, path(page, blank, blank)),
        ),
        lambda p: p.isNotNull(),
    )
    return pages.select("user_id", *hot.parts(), F.explode(paths).alias("_p")).select(
        "user_id", *hot.parts(), "_p.*"
    )


def path_counts(events: DataFrame, pool: DataFrame, hot: HotKeys) -> DataFrame:
    """How often each path occurs among pool users."""
    users = pool.select("user_id", "apk_version", "dt", "platform")
    joined = join_per_key(path_trigrams(events, hot), users, hot, "inner")
    # Rows are counted by hash; only these few counts are sorted for the largest texts.
    counted = joined.groupBy(*NAMES, *_META).agg(F.count(F.lit(1)).alias("ct"))
    return counted.groupBy(*NAMES).agg(
        F.sum("ct").alias("ct"),
        F.max(major_version(F.col("apk_version"))).alias("apk_version"),
        F.max("dt").alias("dt"),
        F.max("platform").alias("platform"),
    )


def add_counts(counts: DataFrame) -> DataFrame:
    """Counts of several days, in any number of rows per path, to one row per path.

    The counts of a day hold every path, so they add up exactly: the top of any period comes from
    the stored days, without the events.
    """
    return counts.groupBy(*NAMES).agg(F.sum("ct").alias("ct"), *[F.max(c).alias(c) for c in _META])


def top_paths(counts: DataFrame, end: bool = False, keep: int = KEPT) -> DataFrame:
    """Top paths from their first page (type 0) or towards their last (type 1).

    Within the two nearest pages the ``keep`` most frequent far pages stay and
    the rest becomes "other"; within the nearest page the ``keep`` most frequent
    middle pages stay and the rest becomes ("other", "other").  Ties go to the
    smaller name.

    Both rankings are plain rank filters, which Spark also applies before the
    shuffle, so no group is sorted whole in one task.  What they leave is one
    cut-off per pair and the kept pairs; one join and one aggregation then
    relabel and add up all rows.
    """
    near, middle, far = reversed(NAMES) if end else NAMES
    rows = counts.select(*NAMES, "ct", *_META)

    by_far = Window.partitionBy(near, middle).orderBy(F.col("ct").desc(), F.col(far).asc())
    cut = (
        rows.select(near, middle, far, "ct")
        .withColumn("_rank", F.row_number().over(by_far))
        .where(F.col("_rank") == keep)
        .select(near, middle, F.col("ct").alias("_ct"), F.col(far).alias("_far"))
    )
    by_middle = Window.partitionBy(near).orderBy(F.col("_sum").desc(), F.col(middle).asc())
    kept = (
        rows.groupBy(near, middle).agg(F.sum("ct").alias("_sum"))
        .withColumn("_rank", F.row_number().over(by_middle))
        .where(F.col("_rank") <= keep)
        .select(near, middle, F.lit(True).alias("_kept"))
    )
    tail = (F.col("ct") < F.col("_ct")) | ((F.col("ct") == F.col("_ct")) & (F.col(far) > F.col("_far")))
    other = F.lit(OTHER_PAGE)
    rank = F.when(F.col("_kept").isNull(), 2).when(tail, 1).otherwise(0)
    relabelled = (
        rows.join(kept, [near, middle], "left")
        .join(cut, [near, middle], "left")
        .withColumn("_level", rank)
        .withColumns({
            far: F.when(F.col("_level") > 0, other).otherwise(F.col(far)),
            middle: F.when(F.col("_level") > 1, other).otherwise(F.col(middle)),
        })
    )
    # The level keeps a page that is really named "other" apart from the rest.
    totals = relabelled.groupBy(*NAMES, "_level").agg(
        F.sum("ct").alias("ct"), *[F.max(c).alias(c) for c in _META]
    )
    return totals.select(*NAMES, F.lit("1" if end else "0").alias("type"), "ct", *_META)


def in_out_paths(pages: DataFrame, hot: HotKeys) -> DataFrame:
    """Paths read forwards (out, label 0) and backwards (in, label 1) from each page."""
    rows = hot.split(_named_pages(pages), "ts")
    order = ["ts", "rid", "pagename"]
    key = ["user_id"]
    page = F.col("pagename")
    rows = neighbours(rows, key, order, {"_b1": page}, {"_f1": page}, hot)
    rows = neighbours(rows, key, order, {"_b2": F.col("_b1")}, {"_f2": F.col("_f1")}, hot)

    def path(second: str, third: str, label: int) -> Column:
        return F.struct(
            F.coalesce(second, F.lit("")).alias("page_name2"),
            F.coalesce(third, F.lit("")).alias("page_name3"),
            F.lit(label).alias("lr"),
        )

    both = F.array(path("_f1", "_f2", 0), path("_b1", "_b2", 1))
    return rows.select("user_id", F.col("pagename").alias("page_name"), F.explode(both).alias("_p")).select(
        "user_id", "page_name", "_p.*"
    )


def in_out_counts(pages: DataFrame, hot: HotKeys) -> DataFrame:
    return in_out_paths(pages, hot).groupBy(*NAMES, "lr").agg(F.count(F.lit(1)).alias("ct"))
