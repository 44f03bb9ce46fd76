"""Tables carried from day to day: bucketed by key, merged without shuffling them."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tvtrail.functions.times import shift_day
from tvtrail.operators import last_seen, pool, reports
from tvtrail.plans import mobile_day, reports_day
from tvtrail.schemas import POOL_COLUMNS
from tvtrail.sources import buckets, files

DAY = "20240102"


def same(a, b):
    a, b = (sorted(map(str, df.select(sorted(df.columns)).collect())) for df in (a, b))
    assert a == b and a


def exchanges_below(df, table):
    """Names of the exchanges between the scan of a table and the top of the plan that runs."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(k for k, line in enumerate(plan) if "FileScan" in line and table in line)
    depth, found = len(plan[at]) - len(plan[at].lstrip(" :+-*")), []
    for line in reversed(plan[:at]):
        here = len(line) - len(line.lstrip(" :+-*"))
        if here < depth:
            depth = here
            found += re.findall(r"Exchange", line)
    return found


@pytest.mark.parametrize("partitions", ["2", "4", "64"])
def test_bucketed_tables(spark, tmp_path, partitions):
    path = str(tmp_path / "t")
    rows = spark.range(1000).select((F.col("id") % 313).cast("string").alias("k"), "id", F.array("id").alias("some list"))
    assert buckets.bucket_count(spark, path) is None
    buckets.write(rows, path, "k", 4)
    assert buckets.bucket_count(spark, path) == 4
    same(buckets.read(spark, path, "k"), rows)
    same(spark.read.parquet(path), rows)
    assert not [t for t in spark.catalog.listTables() if re.fullmatch("tvtrail_[0-9a-f]{32}", t.name)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        table = buckets.read(spark, path, "k")
        day = spark.range(40).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("new"))
        joined = table.join(day, "k", "full_outer")
        assert exchanges_below(joined, "some list") == []
        grouped = table.groupBy("k").count()
        assert exchanges_below(grouped, "k#") == [] and grouped.count() == 313
        assert joined.where("new = 1").count() == rows.join(day, "k", "left_semi").count() + day.join(rows, "k", "left_anti").count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # Replaced, with another number of buckets.
    buckets.write(rows.limit(10), path, "k", 2)
    assert buckets.read(spark, path, "k").count() == 10
    assert buckets.bucket_count(spark, path) == 2


def history(seed, days=200, boxes=60):
    rng = random.Random(seed)
    rows = []
    for d in range(days):
        for _ in range(rng.randrange(0, 25)):
            box = rng.choice([None, *(f"b{k}" for k in range(boxes))])
            rows.append((box, rng.choice(("14301", "14302", None, "14300")), rng.choice(("HNYD", "HNDX")),
                         rng.choice(("sdk", "apk")), shift_day("20240101", d)))
    return rows + rows[:50]


def frame(spark, rows):
    return spark.createDataFrame(rows, "uuid string, regionid string, platform string, source_type string, dt string")


def test_last_seen_equals_the_window(spark, tmp_path):
    online = frame(spark, history(1))
    start = shift_day("20240101", 80)
    path = str(tmp_path)
    buckets.write(last_seen.state_of(online, start, 30), f"{path}/{start}", "uuid", 4)
    before = start
    for step in (1, 1, 3, 30, 1, 40):  # a gap of days, and one longer than the window
        dt = shift_day(before, step)
        since = online.where((F.col("dt") > before) & (F.col("dt") <= shift_day(dt, 2)))  # later days do no harm
        state = last_seen.advance(buckets.read(spark, f"{path}/{before}", "uuid"), since, dt, 30)
        if step == 1:
            state = last_seen.advance(state, online.where(F.col("dt") == dt), dt, 30)  # a day merged twice
        buckets.write(state, f"{path}/{dt}", "uuid", 4)
        state = buckets.read(spark, f"{path}/{dt}", "uuid")
        same(last_seen.distinct_users(state, dt, 30), reports.distinct_users(online, dt, 30))
        same(last_seen.residual_region(state, dt, 30), reports.residual_region(online, dt, 30))
        assert state.count() == online.where(F.col("dt").between(shift_day(dt, -30), dt)).select("uuid").distinct().where("uuid is not null").count()
        before = dt
    empty = last_seen.advance(state, frame(spark, []), shift_day(before, 100), 30)
    assert empty.count() == 0 and last_seen.residual_region(empty, "20240901", 30).first()["stbnum"] == 0


def test_box_numbers_read_one_day(spark, tmp_path):
    out = str(tmp_path)
    days = [shift_day("20240101", d) for d in range(95)]
    rows = [r for r in history(2, 95) if r[2] == "HNYD" or r[3] != "sdk"]
    frame(spark, rows).write.partitionBy("dt", "platform", "source_type").parquet(f"{out}/mid_online_day")
    online = files.read_partition(spark, f"{out}/mid_online_day")
    for dt in days[-3:]:
        reports_day.box_numbers(spark, out, dt)
        job = mobile_day.Job(spark, out, dt)
        assert buckets.bucket_count(spark, f"{job.path('box_last_seen')}/dt={dt}") == 4
        got = spark.read.parquet(f"{out}/stb_num_day").where(F.col("create_date").cast("string") == dt).drop("create_date")
        same(got, reports.stb_report(online, dt).drop("create_date"))
    # One day of users is read once the state is there, and the state is not shuffled.
    state = buckets.read(spark, f"{out}/box_last_seen/dt={days[-2]}", "uuid")
    merged = last_seen.advance(state, online.where(F.col("dt") == days[-1]), days[-1])
    assert exchanges_below(merged, "seen#") == []
    assert re.search(rf"PartitionFilters: \[[^\n]*dt#\d+ as string\) = {days[-1]}", merged._jdf.queryExecution().toString())
    # An earlier day is corrected: rebuilding takes it in.
    extra = frame(spark, [("late", "14302", "HNYD", "sdk", days[-10])])
    extra.write.mode("append").partitionBy("dt", "platform", "source_type").parquet(f"{out}/mid_online_day")
    online = files.read_partition(spark, f"{out}/mid_online_day")
    reports_day.box_numbers(spark, out, days[-1], rebuild=True)
    got = spark.read.parquet(f"{out}/stb_num_day").where(F.col("create_date").cast("string") == days[-1]).drop("create_date")
    same(got, reports.stb_report(online, days[-1]).drop("create_date"))


def test_pool_is_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "pool")
    old = spark.range(3000).select(*[
        F.concat(F.lit("u"), F.col("id").cast("string")).alias(c) if c in ("user_id", "uuid") else F.lit(c).alias(c) for c in POOL_COLUMNS])
    columns = [c for c in POOL_COLUMNS if c not in ("status", "start_date", "end_date", "create_date", "uuid")]
    active = spark.range(2990, 3020).select(*[
        F.concat(F.lit("u"), F.col("id").cast("string")).alias(c) if c == "user_id" else
        F.when(F.col("id") % 2 == 0, F.lit("new")).otherwise(F.lit("")).alias(c) for c in columns]).withColumn("dt", F.lit(DAY))
    buckets.write(old, path, "user_id", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        merged = pool.merge_pool(active, buckets.read(spark, path, "user_id"), DAY)
        assert exchanges_below(merged, "start_date#") == []
        same(merged, pool.merge_pool(active, old, DAY))
        buckets.write(merged, str(tmp_path / "next"), "user_id", 4, aligned=True)
        written = buckets.read(spark, str(tmp_path / "next"), "user_id")
        same(written, merged)
        assert len(written.inputFiles()) == 4  # a file for a bucket, without a shuffle before the write
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_pool_job_reads_yesterday_bucketed(spark, tmp_path):
    out = str(tmp_path)
    events = spark.createDataFrame(
        [("u1", "0x01", 1704200000, 1, "own"), ("u2", "0x100", 1704200001, 2, "own")], "user_id string, state string, ts bigint, rid bigint, near string")
    events = events.withColumns({c: F.lit("a") for c in pool.POOL_ATTRIBUTES})
    found = events.where("false").select("user_id", "state")
    for dt in (DAY, shift_day(DAY, 1)):
        job = mobile_day.Job(spark, out, dt, "HNYD", "sdk")
        day = events.withColumn("ts", F.col("ts") + (0 if dt == DAY else 86400)).withColumn(
            "user_id", F.when((F.col("user_id") == "u2") & F.lit(dt != DAY), F.lit("u3")).otherwise(F.col("user_id")))
        got = mobile_day.user_pool(job, day, found, None)
        assert buckets.bucket_count(spark, mobile_day.pool_folder(job, dt)) == 4
    assert sorted((r["user_id"], r["start_date"]) for r in got.collect()) == [("u1", DAY), ("u2", DAY), ("u3", shift_day(DAY, 1))]
    assert set(got.columns) == set(POOL_COLUMNS)
