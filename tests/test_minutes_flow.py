import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tvtrail.operators import flow, hotkeys, minutes

DAY, D = "20240102", 1704153600


def test_minute_hand_cases(spark):
    def at(h, m, s):
        return D + h * 3600 + m * 60 + s

    rows = [("a", at(10, 0, 30), at(10, 2, 10)), ("b", at(10, 0, 10), at(10, 0, 40)), ("c", D, D + 86399)]
    df = spark.createDataFrame(rows, "ch string, start_ts bigint, end_ts bigint")
    got = defaultdict(dict)
    for r in minutes.minute_seconds(df, DAY, ["ch"]).collect():
        got[r.ch][r.minute] = r.duration
    assert all(len(m) == 1440 for m in got.values())
    assert {k: v for k, v in got["a"].items() if v} == {600: 30, 601: 60, 602: 10}
    assert {k: v for k, v in got["b"].items() if v} == {600: 30}
    assert set(got["c"].values()) == {60, 59} and sum(got["c"].values()) == 86399


def test_minutes_and_totals_match_a_loop(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        start = rng.randrange(86000)
        rows.append((rng.choice(["c1", "c2"]), rng.choice(["14301", "14302"]), D + start,
                     D + min(86399, start + rng.randrange(3, 20000)), "HNYD", "sdk"))
    want = Counter()
    for ch, area, b, e, *_ in rows:
        for m in range((b - D) // 60, (e - D) // 60 + 1):
            sec = min(e - D, (m + 1) * 60) - max(b - D, m * 60)
            for key in ((ch, area), ("-1", area), (ch, "14300"), ("-1", "14300")):
                want[(*key, f"{m // 60:02d}{m % 60:02d}00")] += sec
    df = spark.createDataFrame(rows, "conf_channel_id string, area_code string, start_ts bigint, end_ts bigint, "
                                     "platform string, source_type string")
    report = minutes.minute_report(df, DAY)
    got = {(r.conf_channel_id, r.area_code, r.view_time): r.duration for r in report.collect()}
    assert len(got) == 9 * 1440
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def flows(views, guide):
    """views: (box, day, start, end, content, rid); guide: day -> [(start, end)]."""
    main, out = flow.MAIN_CHANNEL, Counter()
    groups = defaultdict(list)
    for view in views:
        groups[view[:2]].append(view)
    for (_, day), mine in groups.items():
        prev, hits = None, defaultdict(list)
        for _, _, b, e, content, _ in sorted(mine, key=lambda v: (v[2], v[3], v[5])):
            before = None
            for programme in guide.get(day, []):
                if b <= programme[1] and e > programme[0]:
                    if content == main:
                        label = "开机" if prev is None else "保留流入" if prev == main else prev
                        hits[("流入", programme[0])].append((label, programme))
                    if prev == main and before:
                        label = "保留流出" if content == main else content
                        hits[("流出", before[0])].append((label, before))
                before = programme
            prev = content
        for (kind, _), found in hits.items():
            label, programme = found[0] if kind == "流入" else found[-1]
            out[(kind, day, programme[0] % 86400, programme[1] % 86400, label)] += 1
    return dict(out)


def test_flow_matches_the_loop(spark):
    rng = random.Random(11)
    names = [flow.MAIN_CHANNEL, flow.MAIN_CHANNEL, "东方购物", "其他"]
    views = []
    for box in range(30):
        for _ in range(300 if box == 0 else 12):
            day = rng.randrange(2)
            start = D + day * 86400 + rng.randrange(80000)
            end = min(start + rng.randrange(31, 9000), D + day * 86400 + 86399)
            views.append((f"b{box}", f"2024010{2 + day}", start, end, rng.choice(names), len(views)))
    guide, rows = {}, []
    for day in range(2):
        text, first = f"2024010{2 + day}", D + day * 86400
        edges = sorted(rng.sample(range(0, 86400, 300), 14))
        programmes = [(first + a, first + b) for a, b in zip(edges, edges[1:])] + [(first + edges[-1], first + 86400 + 1800)]
        guide[text] = programmes
        for a, b in programmes:
            rows.append((text, *(f"{t % 86400 // 3600:02d}{t % 3600 // 60:02d}{t % 60:02d}" for t in (a, b))))
    df = spark.createDataFrame(views, "stbid string, day string, start_ts bigint, end_ts bigint, content string, rid bigint")
    epg = flow.programme_times(spark.createDataFrame(rows, "day string, starttime string, endtime string"))
    want = flows(views, guide)
    hot = hotkeys.find_hot_keys(df, "stbid", "start_ts", slice_rows=40)
    assert hot
    for keys in (hotkeys.HotKeys("stbid"), hot):
        counts = flow.flow_counts(flow.flow_events(df, epg, keys))
        got = {}
        for r in counts.collect():
            a, b = (int(t[:2]) * 3600 + int(t[2:4]) * 60 + int(t[4:]) for t in (r.starttime, r.endtime))
            got[(r.type, r.day, a, b, r.content)] = r["count"]
        assert got == want
    report = flow.flow_report(counts)
    programmes = counts.select("day", "starttime", "endtime").distinct().count()
    assert report.count() == programmes * (len(flow.IN_LABELS) + len(flow.OUT_LABELS))
    assert report.agg(F.sum("count")).first()[0] == sum(want.values())


def test_programme_over_midnight(spark):
    df = spark.createDataFrame([("20240131", "230000", "003000"), ("20240131", "010000", "020000")],
                               "day string, starttime string, endtime string")
    assert sorted((r.starttime, r.endtime) for r in flow.programme_times(df).collect()) == [
        ("20240131010000", "20240131020000"), ("20240131230000", "20240201003000")]


def test_null_area_or_channel_keeps_its_seconds(spark):
    rows = [("a", None, D + 10, D + 110), (None, None, D + 10, D + 30), (None, "x", D + 65, D + 70)]
    df = spark.createDataFrame(rows, "ch string, area string, start_ts bigint, end_ts bigint")
    got = minutes.minute_seconds(df, DAY, ["ch", "area"]).groupBy("ch", "area").agg(F.sum("duration"), F.count("*"))
    assert {(r[0], r[1]): (r[2], r[3]) for r in got.collect()} == {
        ("a", None): (100, 1440), (None, None): (20, 1440), (None, "x"): (5, 1440)}


def test_a_view_without_end_touches_its_days_programmes_only(spark):
    guide = flow.programme_times(spark.createDataFrame(
        [("20240102", "000000", "120000"), ("20240102", "230000", "010000")], "day string, starttime string, endtime string"))
    views = spark.createDataFrame(
        [("b", "20240102", D + 3600, D + 75 * 365 * 86400, "x", 1), ("c", "20240102", D + 3 * 86400, D + 4 * 86400, "x", 2),
         ("d", "20240102", D - 7200, D + 60, "x", 3)],
        "stbid string, day string, start_ts bigint, end_ts bigint, content string, rid bigint")
    spread = views.select(F.size(flow._slots(F.col("start_ts"), F.col("end_ts"), F.col("day"))))
    assert max(r[0] for r in spread.collect()) <= 49
    got = flow.overlapping(views, guide).select("stbid", F.substring("epg_start", 9, 6))
    assert sorted(map(tuple, got.collect())) == [("b", "000000"), ("b", "230000"), ("d", "000000")]


def test_unlisted_channels_flow_under_other(spark):
    counts = spark.createDataFrame(
        [(flow.INFLOW, "20240102", "000000", "120000", c, n) for c, n in (("someone", 3), (flow.OTHER, 2), (flow.MAIN_CHANNEL, 1))],
        "type string, day string, starttime string, endtime string, content string, count bigint")
    report = flow.flow_report(counts).where("count > 0")
    assert {(r.content, r["count"]) for r in report.collect()} == {(flow.OTHER, 5), (flow.MAIN_CHANNEL, 1)}
