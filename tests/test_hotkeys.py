"""Slicing hot keys must not change any result."""

import random

import pytest
from pyspark.sql import functions as F

from tvtrail.operators import hotkeys as hk


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    made = [("hot", rng.randrange(400), i, rng.choice([None, 1, 2])) for i in range(300)]
    made += [(f"u{i % 20}", rng.randrange(400), 1000 + i, rng.choice([None, 1, 2])) for i in range(200)]
    return made


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "user_id string, ts bigint, rid bigint, v int")


@pytest.fixture(scope="module")
def hot(df):
    found = hk.find_hot_keys(df, "user_id", "ts", slice_rows=30)
    (row,) = found.slices.collect()
    assert row.user_id == "hot" and len(row["_starts"]) > 4
    return found


def test_ordinary_data_has_no_hot_keys(df):
    assert not hk.find_hot_keys(df, "user_id", "ts")


def test_slices_are_bounded_and_ordered(df, hot):
    split = hot.split(df, "ts").where("user_id = 'hot'")
    got = split.groupBy(hk.SLICE).agg(F.min("ts").alias("a"), F.max("ts").alias("b"), F.count("*").alias("n"))
    spans = [(r.a, r.b, r.n) for r in got.orderBy(hk.SLICE).collect()]
    assert len(spans) > 4 and max(n for _, _, n in spans) < 100
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    assert hot.split(df, "ts").where("user_id <> 'hot'").select(hk.SLICE).distinct().first()[0] == hk.COLD


def largest_slice(spark, rows, slice_rows):
    df = spark.createDataFrame(rows, "user_id string, ts bigint, rid bigint")
    found = hk.find_hot_keys(df, "user_id", "ts", slice_rows=slice_rows)
    counts = found.split(df, "ts").where(f"{hk.SLICE} >= 0").groupBy("user_id", hk.SLICE).count()
    return df, found, counts.agg(F.max("count"), F.count("*")).first()


@pytest.mark.parametrize("times", [
    [0, *range(1_704_000_000, 1_704_002_000)],                           # one stray clock
    [*range(500), *(10_000 + i // 40 for i in range(1_500))],            # a burst
    [d * 86_400 + i for d in range(365) for i in range(6)],              # many days
], ids=["stray", "burst", "days"])
@pytest.mark.parametrize("user", ["u", None])
def test_slices_hold_at_most_twice_the_limit(spark, times, user):
    rows = [(user, t, i) for i, t in enumerate(times)] + [("cold", 5, -1)]
    df, found, (most, slices) = largest_slice(spark, rows, 64)
    assert most < 2 * 64 and slices >= len(times) / 128
    near = hk.neighbours(found.split(df, "ts"), ["user_id"], ["ts", "rid"], {"b": F.col("rid")}, {"a": F.col("rid")}, found)
    got = {r.rid: (r.b, r.a) for r in near.where("rid >= 0").collect()}
    order = [r[2] for r in sorted((r for r in rows if r[2] >= 0), key=lambda r: (r[1], r[2]))]
    assert got == {x: (b, a) for b, x, a in zip([None, *order[:-1]], order, [*order[1:], None])}


def test_neighbours(df, hot, rows):
    values = {"n": F.col("v"), "r": F.col("rid")}

    def run(keys):
        after = {f"{k}_after": v for k, v in values.items()}
        out = hk.neighbours(keys.split(df, "ts"), ["user_id"], ["ts", "rid"], values, after, keys)
        return {r.rid: (r.n, r.r, r.n_after, r.r_after) for r in out.collect()}

    got = run(hot)
    assert got == run(hk.NO_HOT_KEYS)
    v = {r[2]: r[3] for r in rows}
    for user in {r[0] for r in rows}:
        order = [r[2] for r in sorted(rows, key=lambda r: (r[1], r[2])) if r[0] == user]
        for i, rid in enumerate(order):
            before = order[i - 1] if i else None
            after = order[i + 1] if i + 1 < len(order) else None
            assert got[rid] == (v.get(before), before, v.get(after), after)


def test_as_of(df, hot, rows):
    flagged = F.when(F.col("v") == 1, F.col("ts"))

    def run(keys):
        out = hk.latest_before(keys.split(df, "ts"), ["user_id"], "ts", {"b": flagged}, keys)
        return {r.rid: r.b for r in out.collect()}

    got = run(hot)
    assert got == run(hk.NO_HOT_KEYS)
    for user, ts, rid, _ in rows:
        assert got[rid] == max([t for u, t, _, v in rows if u == user and v == 1 and t < ts], default=None)


def test_join_per_key_spreads_hot_facts(spark, df, hot):
    dim = df.select("user_id").distinct().withColumn("region", F.concat(F.lit("r"), "user_id"))
    plain = df.join(dim, "user_id").select("rid", "region")
    spread = hk.join_per_key(hot.split(df, "ts"), dim, hot).select("rid", "region")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, spread.collect()))
    missing = hk.join_per_key(hot.split(df, "ts"), dim.where("user_id <> 'hot'"), hot, "left")
    assert missing.where("region is null").count() == 300
