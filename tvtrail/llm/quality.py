"""Quality rules as a short-circuit cascade, all in built-in column functions.

Every text gets exact measures.  A text fails at once if it has too few words or
repeats itself; the others run through further rules.  A sample tells what each of
these costs and rejects, and the rules run in the order of rejection per cost, each
only on what the ones before let through.  The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tvtrail.llm.common import discard, let, settle

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
SAMPLE_ROWS = 2_000
# Seconds under which a rule's cost on the sample is not told apart.
LEAST_COST = 0.002
_BLANK = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"
# One match for each line with a word; one for each word that the next word equals.
_LINES = r"[^\x20\x09-\x0D][^\n]*+"
_STUTTER = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]++)(?=[\x20\x09-\x0D]++\1(?![^\x20\x09-\x0D]))"
# Letters of scripts that set no blanks between words.
_UNSPACED = r"[\p{L}&&[" + "".join(rf"\p{{Is{s}}}" for s in (
    "Han", "Hiragana", "Katakana", "Bopomofo", "Yi", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan", "Tai_Le",
    "New_Tai_Lue", "Tai_Tham", "Tai_Viet", "Javanese", "Balinese")) + "]]"


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _BLANK), lambda w: w != "")


def _covered(grams: Column) -> Column:
    """Words inside windows found more than once; ``grams`` holds a hash per window start."""

    def places(ordered: Column) -> Column:
        twice = F.transform(ordered, lambda g, k: F.when(
            ((k > 0) & (F.get(ordered, k - 1)["h"] == g["h"])) | (F.get(ordered, k + 1)["h"] == g["h"]), g["at"]))
        return F.sort_array(F.filter(twice, lambda at: at.isNotNull()))

    def step(done: Column, at: Column) -> Column:
        end = at + WINDOW
        return F.struct(end.alias("end"), (done["n"] + end - F.greatest(at, done["end"])).alias("n"))

    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    ordered = F.array_sort(F.transform(grams, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    return F.aggregate(let(ordered, places), start, step, lambda done: done["n"])


def _repeat_words(words: Column) -> Column:
    def windows(hashes: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))

    repeats = let(
        let(F.transform(words, lambda w: F.xxhash64(w)), windows),
        lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(_covered(g)))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(repeats)


def measures(text: Column) -> Column:
    """Struct of exact measures of a text, all bigint; those of an empty text for null.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word, equal to an
    earlier one), n_repeat_words (in a window of five words found twice or more in the text).
    Windows are compared by 64-bit hashes.  What only a rule needs, the rule computes.
    """
    text = F.coalesce(text, F.lit(""))
    by_words = let(_words(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        _repeat_words(w).cast("bigint").alias("n_repeat_words")))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    repeated = let(lines, lambda n: (F.size(n) - F.size(F.array_distinct(n))).cast("bigint"))
    return let(by_words, lambda w: F.struct(
        w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"),
        F.regexp_count(text, F.lit(_SYMBOLS)).cast("bigint").alias("n_symbols"),
        repeated.alias("n_dup_lines"), w["n_repeat_words"].alias("n_repeat_words")))


@dataclass(frozen=True)
class Rule:
    """``rejects(text, measures)`` is true for texts to drop."""

    name: str
    rejects: Callable[[Column, Column], Column]


RULES = (
    # More than one mark-up or table symbol for ten words.
    Rule("symbols", lambda text, m: m["n_symbols"] * 10 > m["n_words"]),
    # More than half of the lines stand earlier in the text.
    Rule("lines", lambda text, m: (m["n_dup_lines"] > 0) & (
        m["n_dup_lines"] * 2 > F.regexp_count(text, F.lit(_LINES)))),
    # More than a quarter of the words repeat the word before.
    Rule("stutter", lambda text, m: F.regexp_count(text, F.lit(_STUTTER)) * 4 > m["n_words"]),
    # Words of more than 50 characters on average, unless most letters are of scripts without blanks.
    Rule("length", lambda text, m: (m["word_chars"] > m["n_words"] * 50) & (
        F.regexp_count(text, F.lit(_UNSPACED)) * 2 <= F.regexp_count(text, F.lit(r"\p{L}")))),
    # More than half of the letters with case are capitals.
    Rule("capitals", lambda text, m:
         F.regexp_count(text, F.lit(r"\p{Lu}")) > F.regexp_count(text, F.lit(r"\p{Ll}"))),
    # Fewer than a quarter of the characters in words are letters.
    Rule("letters", lambda text, m: F.regexp_count(text, F.lit(r"\p{L}")) * 4 < m["word_chars"]),
)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * REPEAT_PERCENT)


def _seconds(question: DataFrame, runs: int = 3) -> tuple[float, int]:
    """Least time of some runs of a one-row query, and its answer."""
    best, answer = float("inf"), 0
    for _ in range(runs):
        start = time.perf_counter()
        answer = question.first()[0] or 0
        best = min(best, time.perf_counter() - start)
    return best, answer


def order_rules(docs: DataFrame, text: str, rules=RULES, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Rules by falling rejection per second, measured on about ``sample_rows`` rows.

    A rule costs what its query takes longer than one that only reads the same columns, so
    the start of a job does not count.  Rules of equal worth, as on an empty table, keep their order.
    """
    rows = docs.count()
    share = min(1.0, sample_rows / max(1, rows))
    chosen = docs.select(F.col(f"`{text}`").alias("text")).sample(share, seed=7)
    sample = settle(chosen.select("text", measures(F.col("text")).alias("m")), "quality-sample")
    reads, _ = _seconds(sample.agg(F.sum(F.length("text") + F.col("m.word_chars"))))
    scored = []
    for rule in rules:
        rejected = F.coalesce(rule.rejects(F.col("text"), F.col("m")), F.lit(False))
        spent, caught = _seconds(sample.agg(F.count_if(rejected)))
        scored.append((caught / max(spent - reads, LEAST_COST), rule))
    discard(sample)
    return [rule for _, rule in sorted(scored, key=lambda s: -s[0])]


def judge(docs: DataFrame, text: str = "text", rules=None, into: str = "quality") -> DataFrame:
    """``docs`` with a struct: the measures, base_failed and kept.

    A null or empty text has no words and fails.  Nothing is shuffled.
    """
    order = order_rules(docs, text) if rules is None else list(rules)
    value = F.col(f"`{text}`")
    measured = docs.withColumn(into, measures(value))
    m = F.col(into)
    verdict = F.when(base_failed(m), False)
    for rule in order:
        verdict = verdict.when(rule.rejects(value, m), False)
    return measured.withColumn(into, F.struct(
        f"{into}.*", base_failed(m).alias("base_failed"), verdict.otherwise(True).alias("kept")))
