"""Joins of near-duplicate detection whose hot keys adaptive execution splits."""

import re

import pytest
from pyspark.sql import functions as F

from tvtrail.llm import common, components, near_dup
from tvtrail.session import prepare

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "48k",
}


@pytest.fixture
def plans(spark, monkeypatch):
    """The plans that ran when tables were settled, by name."""
    prepare(spark)
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    seen = {}

    def settle(df, name):
        out = common.settle(df, name)
        again = df._jdf.queryExecution()
        again.toRdd().count()
        seen[name] = seen.get(name, 0) + len(re.findall(r"skew=true", again.executedPlan().toString()))
        return out

    for module in (components, near_dup):
        monkeypatch.setattr(module, "settle", settle)
    yield seen
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hub(spark, plans):
    hub = spark.range(1, 60_000).select(F.lit(0).cast("bigint").alias("a"), F.col("id").alias("b"))
    others = spark.range(100_000, 130_000).select("id", (F.col("id") + 1).alias("b")).where("id % 3 > 0").toDF("a", "b")
    got = components.components(hub.unionByName(others))
    assert got.where("node < 100000").select("component").distinct().collect() == [(0,)]
    assert got.where("component = 0").count() == 60_000 and got.count() == got.select("node").distinct().count()
    assert plans["edges"] > 0


def test_a_family_of_near_copies(spark, plans):
    """Distinct texts so alike that all share their buckets."""
    spark.conf.set("spark.sql.shuffle.partitions", "200")  # so that a bucket stands out
    base = " ".join(f"word{k}" for k in range(60))
    family = spark.range(4000).select("id", F.concat(F.lit(base + " end"), F.col("id").cast("string")).alias("text"))
    others = spark.range(10_000, 14_000).select("id", F.concat_ws(" ", *[F.sha2(F.concat("id", F.lit(str(k))), 256) for k in range(9)]).alias("text"))
    docs = family.unionByName(others).withColumnRenamed("id", "doc_id")
    out = near_dup.near_duplicates(docs)
    sizes = out.groupBy("component_id").count().orderBy(F.col("count").desc()).limit(2).collect()
    assert [(r["component_id"], r["count"]) for r in sizes][0] == (0, 4000) and sizes[1]["count"] == 1
    assert out.where("kept").count() == 4001 and plans["shared-buckets"] > 0
