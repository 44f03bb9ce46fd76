"""Names that start with, or contain, a word of a list.

Pieces of a name with the lengths words have are matched by an equi-join, so no
name is compared with every word and neither side has to fit in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def without_prefixes(df: DataFrame, column: str, listed: DataFrame, word: str) -> DataFrame:
    """Rows whose name starts with no word of the list.

    One anti join at any number of word lengths: on as many first characters as the shortest
    word has, and then on the whole word.  Spark broadcasts words that are few.  Only the
    shortest length comes to the driver.
    """
    words = listed.where(F.coalesce(word, F.lit("")) != "").select(F.col(word).alias("_word")).distinct()
    shortest = words.agg(F.min(F.length("_word"))).first()[0]
    if shortest is None:
        return df
    name, entry = F.col(column), words["_word"]
    same = F.substring(name, 1, shortest) == F.substring(entry, 1, shortest)
    return df.join(words, same & F.startswith(name, entry), "left_anti")


def _names_and_words(names: DataFrame, listed: DataFrame, column: str):
    words = listed.where(F.coalesce(column, F.lit("")) != "").select(
        F.col(column).alias("_word")
    ).distinct()
    lengths = words.select(F.collect_set(F.length("_word"))).scalar()
    rows = names.where(F.coalesce("_name", F.lit("")) != "").distinct()
    return rows.withColumn("_n", F.explode(lengths)), words


def starting_with(names: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """The distinct ``_name`` values that start with a word."""
    rows, words = _names_and_words(names, listed, column)
    starts = rows.withColumn("_word", F.substring(F.col("_name"), F.lit(1), F.col("_n")))
    return starts.join(words, "_word", "left_semi").select("_name").distinct()


def containing(names: DataFrame, listed: DataFrame, column: str) -> DataFrame:
    """The distinct ``_name`` values that contain a word."""
    rows, words = _names_and_words(names, listed, column)
    last = F.length("_name") - F.col("_n") + 1
    at = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1))))
    pieces = rows.withColumn("_at", F.explode(at)).withColumn(
        "_word", F.substring(F.col("_name"), F.col("_at"), F.col("_n"))
    )
    return pieces.join(words, "_word", "left_semi").select("_name").distinct()
