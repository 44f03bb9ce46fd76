"""Viewers flowing into and out of the programmes of one channel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tvtrail.functions.times import DAY_SECONDS, day_start, plus_days, to_epoch
from tvtrail.operators.extremes import extreme
from tvtrail.operators.hotkeys import HotKeys, neighbours
from tvtrail.session import Keep, as_it_is

# --- fixed values: reported channel code -> channel name ----------------------
MAIN_CHANNEL = "央广购物"
CHANNELS = {
    "303": "东方购物",
    "104": "东方购物二",
    "2104": "家有购物",
    "4004": "环球购物",
    "4104": MAIN_CHANNEL,
    "4904": "优购物",
    "4804": "快乐购物",
    "4602": "东方购物高清",
    "4801": "东方购物二高清",
    "4503": "环球购物高清",
}
OTHER = "其他"
INFLOW, OUTFLOW = "流入", "流出"
STAYED_IN, STAYED_OUT, SWITCHED_ON = "保留流入", "保留流出", "开机"
IN_LABELS = (*CHANNELS.values(), STAYED_IN, SWITCHED_ON, OTHER)
OUT_LABELS = (*CHANNELS.values(), STAYED_OUT, OTHER)

MIN_SECONDS = 30
SLOT_SECONDS = 3600
LAST_SLOT = 2 * DAY_SECONDS // SLOT_SECONDS
# Views of one hour that one task joins; more are dealt over salts.
VIEWS_PER_SALT = 500_000


def programme_times(guide: DataFrame) -> DataFrame:
    """Full times of a programme; one that ends before it starts ends tomorrow."""
    overnight = F.col("starttime") > F.col("endtime")
    end_day = F.when(overnight, plus_days(F.col("day"), 1)).otherwise(F.col("day"))
    return guide.withColumns({
        "starttime": F.concat("day", "starttime"),
        "endtime": F.concat(end_day, F.col("endtime")),
    })


def named_views(views: DataFrame) -> DataFrame:
    """Views longer than 30 s, channel codes replaced by names."""
    pairs = ", ".join(f"'{code}', '{name}'" for code, name in CHANNELS.items())
    start, end = to_epoch(F.col("starttime")), to_epoch(F.col("endtime"))
    return views.withColumns({"start_ts": start, "end_ts": end}).where(
        F.col("end_ts") - F.col("start_ts") > MIN_SECONDS
    ).withColumn(
        "content", F.coalesce(F.try_element_at(F.expr(f"map({pairs})"), F.col("content")), F.lit(OTHER))
    )


def _slots(start: Column, end: Column, day: Column) -> Column:
    """Hour slots an interval touches, of those a programme of the day can lie in.

    A programme ends on the next day at the latest, so a view of any length has 48
    slots at most.  An interval outside of them has none.
    """
    first = day_start(day)

    def slot(time: Column) -> Column:
        return F.floor((time - first) / SLOT_SECONDS).cast("bigint")

    low = F.greatest(slot(start), F.lit(0).cast("bigint"))
    high = F.least(F.greatest(slot(start), slot(end)), F.lit(LAST_SLOT).cast("bigint"))
    return F.when(low <= high, F.sequence(low, F.greatest(low, high))).otherwise(F.array().cast("array<bigint>"))


def _salts(views: DataFrame, per_salt: int) -> int:
    """Into how many parts the views of the fullest hour fall; one count comes to the driver."""
    slots = views.select("day", F.explode(_slots(F.col("start_ts"), F.col("end_ts"), F.col("day"))).alias("_slot"))
    fullest = slots.groupBy("day", "_slot").count().agg(F.max("count")).first()[0] or 0
    return max(1, -(-fullest // per_salt))


def overlapping(
    views: DataFrame, guide: DataFrame, per_salt: int | None = None, counted: DataFrame | None = None
) -> DataFrame:
    """Views with the programmes of their day they overlap.

    Both sides are spread over the hours they touch and joined on (day, hour, salt),
    so the join stays an equi-join at any size; a pair that shares several hours
    is taken in the first shared one only.  Hours are few, and an evening hour may hold most
    views: as many salts as the fullest hour needs divide its views, and the far fewer
    programmes are copied to each.  ``counted``: views among which these are, if counting
    them takes less.
    """
    programmes = guide.withColumns({
        "_from": to_epoch(F.col("starttime")), "_to": to_epoch(F.col("endtime")),
    }).select(
        "day", "_from", "_to", F.col("starttime").alias("epg_start"), F.col("endtime").alias("epg_end"),
    )
    before = Window.partitionBy("day").orderBy("_from", "_to")
    programmes = programmes.withColumns({
        "last_start": F.lag("epg_start").over(before),
        "last_end": F.lag("epg_end").over(before),
    })
    programmes = programmes.withColumn("_slots", _slots(F.col("_from"), F.col("_to"), F.col("day")))
    programmes = programmes.withColumns({"_p0": F.get("_slots", F.lit(0)), "_slot": F.explode("_slots")})
    spread = views.withColumn("_vslots", _slots(F.col("start_ts"), F.col("end_ts"), F.col("day")))
    spread = spread.withColumns({"_v0": F.get("_vslots", F.lit(0)), "_slot": F.explode("_vslots")})
    salts = _salts(views if counted is None else counted, per_salt or VIEWS_PER_SALT)
    spread = spread.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in views.columns]), F.lit(salts)))
    copies = programmes.drop("_slots").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    pairs = spread.join(copies, ["day", "_slot", "_salt"])
    return pairs.where(
        (F.col("start_ts") <= F.col("_to"))
        & (F.col("end_ts") > F.col("_from"))
        & (F.col("_slot") == F.greatest("_p0", "_v0"))
    ).drop("_slot", "_salt", "_vslots", "_v0", "_p0")


def flow_events(views: DataFrame, guide: DataFrame, hot: HotKeys, keep: Keep = as_it_is) -> DataFrame:
    """In- and outflows of each box and day, one per type and programme.

    ``views``: stbid, day, start_ts, end_ts, content (a name), rid.  Of several
    flows of a box at a programme the first inflow and the last outflow count.  ``keep``: where the
    flows go, which are read twice.
    """
    rows = hot.split(views, "start_ts")
    rows = neighbours(
        rows, ["stbid", "day"], ["start_ts", "end_ts", "rid"], {"_prev": F.col("content")}, {}, hot
    )
    on_main = F.col("content") == MAIN_CHANNEL
    was_main = F.coalesce(F.col("_prev") == MAIN_CHANNEL, F.lit(False))
    # Views that are not on the main channel and do not leave it cause no flow.
    pairs = overlapping(rows.where(on_main | was_main), guide, counted=views)

    def flow(kind: str, start: str, end: str, label: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("type"), F.col(start).alias("epg_start"),
            F.col(end).alias("epg_end"), label.alias("label"),
        )

    came_from = (
        F.when(F.col("_prev").isNull(), F.lit(SWITCHED_ON))
        .when(was_main, F.lit(STAYED_IN))
        .otherwise(F.col("_prev"))
    )
    went_to = F.when(on_main, F.lit(STAYED_OUT)).otherwise(F.col("content"))
    flows = F.filter(
        F.array(
            F.when(on_main, flow(INFLOW, "epg_start", "epg_end", came_from)),
            F.when(
                was_main & F.col("last_start").isNotNull(),
                flow(OUTFLOW, "last_start", "last_end", went_to),
            ),
        ),
        lambda f: f.isNotNull(),
    )
    moment = ["start_ts", "end_ts", "rid", "_from"]
    events = keep(pairs.select("stbid", "day", *moment, F.explode(flows).alias("_f")).select(
        "stbid", "day", *moment, "_f.*"), "flow-events")
    keys, shown = ["stbid", "day", "type", "epg_start"], ["label", "epg_end"]
    chosen = extreme(events.where(F.col("type") == INFLOW), keys, moment, shown, last=False).unionByName(
        extreme(events.where(F.col("type") == OUTFLOW), keys, moment, shown))
    return chosen.select(
        "stbid", "day", "type", F.substring("epg_start", -6, 6).alias("starttime"),
        F.substring("epg_end", -6, 6).alias("endtime"), F.col("label").alias("content"),
    )


_PROGRAMME = ("day", "starttime", "endtime")


def flow_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("type", *_PROGRAMME, "content").agg(F.count(F.lit(1)).alias("count"))


def flow_report(counts: DataFrame) -> DataFrame:
    """Counts for every label of every programme, zero where nothing flowed.

    A programme has at most as many counts as there are labels, so they fit in
    one map per programme and filling needs no join.  ``imbalance`` is inflow
    minus outflow of the programme, as measured.
    """
    labels = F.array(
        *[F.struct(F.lit(INFLOW).alias("type"), F.lit(x).alias("content")) for x in IN_LABELS],
        *[F.struct(F.lit(OUTFLOW).alias("type"), F.lit(x).alias("content")) for x in OUT_LABELS],
    )
    signed = F.when(F.col("type") == INFLOW, F.col("count")).otherwise(-F.col("count"))
    entry = F.struct(F.struct("type", "content").alias("label"), F.col("count").alias("n"))
    # A channel that is not reported flows under "other".
    known = F.when(F.col("type") == INFLOW, F.col("content").isin(*IN_LABELS)).otherwise(F.col("content").isin(*OUT_LABELS))
    counts = counts.withColumn("content", F.when(known, F.col("content")).otherwise(F.lit(OTHER)))
    counts = counts.groupBy("type", *_PROGRAMME, "content").agg(F.sum("count").alias("count"))
    programmes = counts.groupBy(*_PROGRAMME).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_m"),
        F.sum(signed).cast("bigint").alias("imbalance"),
    )
    found = F.try_element_at(F.col("_m"), F.col("_l"))
    return programmes.withColumn("_l", F.explode(labels)).select(
        "_l.type", *_PROGRAMME, "_l.content",
        F.coalesce(found, F.lit(0).cast("bigint")).alias("count"), "imbalance",
    )


def flow_lines(report: DataFrame) -> DataFrame:
    """Text form: type|day|label|start|end|count."""
    return report.select(
        F.concat_ws("|", "type", "day", "content", "starttime", "endtime", F.col("count").cast("string"))
        .alias("value")
    )


def guide_spine(days: DataFrame, slot_seconds: int = 7200) -> DataFrame:
    """An even programme guide for days (column ``day``) that have none."""
    starts = F.sequence(F.lit(0), F.lit(DAY_SECONDS - slot_seconds), F.lit(slot_seconds))

    def clock(seconds: Column) -> Column:
        return F.date_format(F.timestamp_seconds(seconds % DAY_SECONDS), "HHmmss")

    slots = days.select("day", F.explode(starts).alias("_s"))
    return slots.select(
        "day", clock(F.col("_s")).alias("starttime"), clock(F.col("_s") + slot_seconds).alias("endtime")
    )
