"""Operators whose groups are few or hot: no task sorts, joins or counts such a group alone."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tvtrail.operators import facts, flow, paths, pool, words
from tvtrail.operators.extremes import extreme
from tvtrail.operators.hotkeys import HotKeys
from tvtrail.plans import reports_day
from tvtrail.session import stored, working_tables

D = 1704153600  # 2024-01-02
DAY = "20240102"


def ran(df):
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString()


def test_extreme_rows(spark):
    rng = random.Random(3)
    rows = [(rng.choice((None, "hot", "hot", "hot", f"u{k % 40}")), rng.choice((None, "a", "b")), rng.randrange(12), rng.randrange(4), f"t{k}")
            for k in range(3000)] + [("one", "a", -5, 0, "x")]
    df = spark.createDataFrame(rows, "k string, j string, n bigint, m bigint, payload string")
    for last in (True, False):
        got = {(r["k"], r["j"]): (r["n"], r["m"], r["payload"]) for r in extreme(df, ["k", "j"], ["n", "m", "payload"], ["n", "m", "payload"], last).collect()}
        want = {}
        for k, j, *row in rows:
            best = (max if last else min)
            want[k, j] = best(want.get((k, j), tuple(row)), tuple(row))
        assert got == want
    assert extreme(df.where("false"), ["k"], ["n"], ["payload"]).count() == 0


def test_no_sort_over_raw_rows(spark):
    """The raw rows are aggregated by hash; what is sorted comes after the join with the extremum."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    with working_tables(spark):
        try:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            rows = stored(spark.range(20_000).select(
                F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("user_id"), F.lit("0x01").alias("state"),
                (F.lit(D) + F.col("id") % 86400).alias("ts"), F.col("id").alias("rid"), F.sha2(F.col("id").cast("string"), 256).alias("ip")), "ons")
            plan = pool.last_power_on(rows, DAY)._jdf.queryExecution().sparkPlan().toString().splitlines()
            depth = {name: min(len(x) - len(x.lstrip(" :+-")) for x in plan if name in x) for name in ("SortAggregate", "Join")}
            deepest = max(len(x) - len(x.lstrip(" :+-")) for x in plan if "SortAggregate" in x)
            assert deepest < depth["Join"] and any("HashAggregate" in x for x in plan)
            # The hot user's rows are spread: the join has the time among its keys.
            assert re.search(r"Join \[[^\]]*ts#\d+", " ".join(plan)) or any("ts#" in x and "Join" in x for x in plan)
            assert pool.last_power_on(rows, DAY).where("user_id = 'hot'").first()["ts"] == D + 19_998
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


@pytest.fixture
def shuffles(spark):
    wanted = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def evening(spark, n=40_000):
    """All views in one hour, most of them in the same minute."""
    rows = spark.range(n)
    start = F.lit(D + 72_000) + F.when(F.col("id") % 4 == 0, F.col("id") % 600).otherwise(0)
    return rows.select(
        F.concat(F.lit("b"), F.col("id").cast("string")).alias("stbid"), F.lit(DAY).alias("day"), start.alias("start_ts"),
        (start + 300).alias("end_ts"), F.lit(flow.MAIN_CHANNEL).alias("content"), F.col("id").alias("rid"))


def guide(spark):
    rows = [(DAY, f"{h:02}{m:02}00", f"{h + (m == 50):02}{(m + 10) % 60:02}00") for h in range(23) for m in range(0, 60, 10)]
    return flow.programme_times(spark.createDataFrame(rows, "day string, starttime string, endtime string"))


def test_one_hour_holds_all_views(shuffles):
    spark = shuffles
    with working_tables(spark):
        views = stored(evening(spark), "views")
        plain = flow.overlapping(views, guide(spark))
        dealt = flow.overlapping(views, guide(spark), per_salt=100)

        def tasks(df):
            return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())

        assert len(tasks(plain)) == 1  # one hour, one task
        loads = tasks(dealt)
        assert len(loads) == 8 and max(loads) <= 2 * loads[len(loads) // 2]
        columns = sorted(plain.columns)
        assert dealt.columns == plain.columns and sorted(map(str, dealt.select(columns).collect())) == sorted(map(str, plain.select(columns).collect()))


def test_flow_does_not_depend_on_salts(spark, monkeypatch):
    views = evening(spark, 900).withColumn("content", F.when(F.col("rid") % 3 == 0, F.lit("x")).otherwise(F.col("content")))
    again = views.withColumn("start_ts", F.col("start_ts") + 400).withColumn("end_ts", F.col("end_ts") + 700).withColumn("rid", F.col("rid") + 5000)
    both = views.unionByName(again)
    with working_tables(spark):
        want = sorted(map(str, flow.flow_counts(flow.flow_events(both, guide(spark), HotKeys("stbid"))).collect()))
        monkeypatch.setattr(flow, "VIEWS_PER_SALT", 7)
        assert sorted(map(str, flow.flow_counts(flow.flow_events(both, guide(spark), HotKeys("stbid"), stored)).collect())) == want
        assert flow.flow_counts(flow.flow_events(both.where("false"), guide(spark), HotKeys("stbid"), stored)).count() == 0
    assert want


def test_prefixes_in_one_join(spark):
    rng = random.Random(8)
    names = ["".join(rng.choice("abc") for _ in range(rng.randrange(0, 9))) for _ in range(500)] + [None, "", "é漢", "é", "a"]
    listed = ["ab", "abca", "cc", "bbbbb", "é漢", "bacbac", "", None, "cacacaca", "ab"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    words_of = spark.createDataFrame([(w,) for w in listed], "w string")
    got = words.without_prefixes(df, "name", words_of, "w")
    want = [n for n in names if n is None or not any(w and n.startswith(w) for w in listed)]
    assert sorted(map(str, (r["name"] for r in got.collect()))) == sorted(map(str, want))
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") == 1
    assert "NestedLoop" not in got._jdf.queryExecution().executedPlan().toString()
    one = words_of.where("w = 'é漢' or w = 'a'").unionByName(spark.createDataFrame([("a",)], "w string"))
    kept = {r["name"] for r in words.without_prefixes(df, "name", one, "w").collect()}
    assert kept == {n for n in names if n is None or not n.startswith(("a", "é漢"))}
    assert facts.drop_test_users(df, words_of.where("w = ''").withColumnRenamed("w", "key_word"), "name").count() == len(names)


def test_days_add_up(spark, tmp_path):
    """Top paths of a period from the stored days are those of all rows counted at once."""
    rng = random.Random(6)
    days = ["20240101", "20240102", "20240103"]
    rows = [(rng.choice("ab"), f"m{rng.randrange(30)}", f"f{rng.randrange(30)}", 1, "1", d, "HNYD") for d in days for _ in range(1500)]
    schema = "page_name string, page_name2 string, page_name3 string, ct bigint, apk_version string, dt string, platform string"
    df = spark.createDataFrame(rows, schema)
    once = paths.add_counts(df)  # every row counted at once
    for d in days:
        paths.add_counts(df.where(F.col("dt") == d)).write.mode("append").partitionBy("dt", "platform").parquet(f"{tmp_path}/mid_path_statis")
    reports_day.path_period(spark, str(tmp_path), days[0], days[-1], "HNYD")
    got = spark.read.parquet(f"{tmp_path}/path_period_result")
    shown = ["page_name", "page_name2", "page_name3", "type", "ct"]
    want = paths.top_paths(once).unionByName(paths.top_paths(once, end=True))
    assert sorted(map(str, got.select([F.col(c).cast("string") for c in shown]).collect())) == sorted(
        map(str, want.select([F.col(c).cast("string") for c in shown]).collect()))
    # Lists cut per day would not do: a page below the cut of every day is above it over all.
    reports_day.path_period(spark, str(tmp_path), days[1], days[1], "HNYD")
    assert spark.read.parquet(f"{tmp_path}/path_period_result").where("since = 20240102").agg(F.sum("ct")).first()[0] == 2 * 1500
