import random

import pytest
from pyspark.sql import functions as F

from tests import folds
from tvtrail.operators import hotkeys, sessions

DAY = "20240102"
D = 1704153600      # 2024-01-02 00:00:00 UTC
VOD, LIVE, HEART, INIT = "0x04", "0x03", "0x100", "0x01"
SCHEMA = "user_id string, state string, ts bigint, play boolean, rid bigint"


def at(clock: str, day: int = 0) -> int:
    h, m, *s = (int(p) for p in clock.split(":"))
    return D + day * 86400 + h * 3600 + m * 60 + (s[0] if s else 0)


def S(clock, day=0, state=VOD):
    return (state, at(clock, day), True)


def X(clock, day=0, state=VOD):
    return (state, at(clock, day), False)


def H(clock):
    return (HEART, at(clock), False)


def B(clock):
    return (INIT, at(clock), False)


LATER = S("11:00", state=LIVE)
SCENARIOS = {
    "crosses_midnight": ([S("23:50", -1), X("00:20")], [("00:00:00", "00:20:00")]),
    "crosses_midnight_forward": ([S("23:50"), X("00:20", 1)], [("23:50:00", "23:59:59")]),
    "too_short_too_long": ([S("10:00:00"), X("10:00:02"), S("11:00"), X("15:00:01")], []),
    "heartbeat_no_stop": ([S("10:00"), H("10:30")], [("10:00:00", "10:30:00")]),
    "stop_and_heartbeat": ([S("10:00"), H("10:10"), X("10:20")], [("10:00:00", "10:20:00")]),
    "next_type_within_grace": ([S("10:00"), H("10:10"), S("10:25", state=LIVE)], [("10:00:00", "10:25:00")]),
    "next_type_after_grace": ([S("10:00"), H("10:10"), S("10:40", state=LIVE)], [("10:00:00", "10:10:00")]),
    "nothing_follows": ([S("10:00")], [("10:00:00", "10:05:00")]),
    "power_on_between": ([S("10:00"), B("10:30"), LATER], [("10:00:00", "10:05:00")]),
    "heartbeat_then_power_on": ([S("10:00"), H("10:20"), B("10:30"), LATER], [("10:00:00", "10:20:00")]),
    "two_power_ons": (
        [S("10:00"), H("10:10"), B("10:20"), H("10:25"), B("10:30"), LATER], [("10:00:00", "10:10:00")]),
    "heartbeat_after_power_on": ([S("10:00"), B("10:30"), H("10:40"), LATER], [("10:00:00", "10:05:00")]),
    "stop_without_start": ([X("10:00")], []),
    "restart_in_the_same_second": (
        [S("10:00"), X("10:10"), S("10:10"), X("10:20")], [("10:00:00", "10:10:00"), ("10:10:00", "10:20:00")]),
}


def test_named_scenarios(spark):
    rows = [
        (name, state, ts, play, i)
        for name, (records, _) in SCENARIOS.items()
        for i, (state, ts, play) in enumerate(records)
    ]
    log = spark.createDataFrame(rows, SCHEMA)
    found = sessions.day_sessions(log, DAY, hotkeys.NO_HOT_KEYS).where(F.col("state") == VOD)
    got = {name: [] for name in SCENARIOS}
    for r in found.orderBy("play_start_time").collect():
        start, end = (f"{t[8:10]}:{t[10:12]}:{t[12:]}" for t in (r.play_start_time, r.play_end_time))
        got[r.user_id].append((start, end))
    assert got == {name: want for name, (_, want) in SCENARIOS.items()}


def random_log(seed: int, users: int, per_user: int, hot_rows: int, span: int, starts: float = 0.6):
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        for _ in range(hot_rows if u == 0 else per_user):
            state = rng.choice([VOD, LIVE, "0x05", "0x06", HEART, HEART, INIT])
            play = state in folds.VIEWING and rng.random() < starts
            rows.append((f"u{u}", state, D + rng.randrange(span), play, len(rows)))
    return rows


@pytest.mark.parametrize("seed,span,starts", [
    (1, 300, 0.6), (2, 4000, 0.6), (3, 80000, 0.6), (4, 4000, 0.02), (5, 80000, 0.01), (6, 20000, 0.05),
])
def test_random_logs_match_the_fold(spark, seed, span, starts):
    """Few starts make gaps that span several slices of the hot user."""
    rows = random_log(seed, users=40, per_user=25, hot_rows=400, span=span, starts=starts)
    log = spark.createDataFrame(rows, SCHEMA)
    want = folds.sessions(rows)
    hot = hotkeys.find_hot_keys(log, "user_id", "ts", slice_rows=50)
    assert [r.user_id for r in hot.slices.collect()] == ["u0"]
    for keys in (hotkeys.NO_HOT_KEYS, hot):
        found = sessions.sessions(log, keys).select("user_id", "state", "start_ts", "end_ts", "rid")
        assert sorted(tuple(r) for r in found.collect()) == want


def test_day_filter_judges_the_whole_session(spark):
    rows = [("a", VOD, at("20:30", -1), at("00:20")), ("b", VOD, at("19:00", -1), at("00:20")),
            ("c", LIVE, at("19:00", -1), at("00:20")), ("d", VOD, at("10:00", 1), at("10:20", 1)),
            ("e", VOD, at("10:00"), at("10:00:03"))]
    df = spark.createDataFrame(rows, "user_id string, state string, start_ts bigint, end_ts bigint")
    kept = sessions.clamp_to_day(sessions.of_day(df, DAY), DAY)
    assert {(r.user_id, r.start_ts, r.end_ts) for r in kept.collect()} == {
        ("a", D, at("00:20")), ("c", D, at("00:20")), ("e", at("10:00"), at("10:00:03"))}


def test_one_shuffle_for_ordinary_data(spark):
    """All windows of the sessioniser share one partitioning by user."""
    log = spark.createDataFrame(random_log(4, 5, 5, 5, 1000), SCHEMA)
    plan = sessions.sessions(log, hotkeys.NO_HOT_KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
