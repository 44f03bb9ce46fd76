"""From raw documents to sharded training text, in five stages.

Each stage takes the documents its predecessor kept, written as Parquet and read again,
and returns documents; the last one adds shard and slot.  All stages but the fourth
keep each row once at most; mixing also repeats rows, as often as it takes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tvtrail.llm import contamination, mixing, near_dup, quality, sharding
from tvtrail.llm.common import discard, packed, settle, unpacked
from tvtrail.session import working_tables

SHARDS = 16

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cascade."""
    judged = quality.judge(packed(docs, text=F.col("text")))
    return unpacked(judged.where("quality.kept"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one of the smallest id."""
    return near_dup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = contamination.mark(packed(docs, text=F.col("text")), items)
    return unpacked(marked.where("contamination.n_hit = 0"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    rows = packed(docs, doc_id=F.col("doc_id"), source=F.col("source"), words=mixing.word_count(F.col("text")))
    mixed = mixing.mix(rows, F.col("words")).where("copies > 0")
    return unpacked(mixed.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return sharding.shard(docs, "doc_id", SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source mixing", source_mixing),
    ("sharding", shards),
]

# Mixing and near-duplicate groups are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn.

    Once a stage's result is written, the tables it worked with and the documents it read are
    removed.  What the last stage returns still reads its own; put ``run`` and the use of its
    result in a ``working_tables`` block to have them removed too.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        with working_tables(spark) as working:
            docs = settle(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
            working.remove(docs.settled_at)
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
