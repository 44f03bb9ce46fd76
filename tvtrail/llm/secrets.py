"""Secrets in texts: fixed patterns, and strings that look random to Markov models.

Two first-order character models are trained, one of random strings and one of
ordinary identifiers, from samples the fixed patterns label: what they match against
the other words of texts.  A string of any length whose log-likelihood ratio between the models
is high enough is reported too, unless a fixed pattern has found it.  Everything is
built-in column functions; the models travel as one literal array of fixed size.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tvtrail.llm.common import discard, let, settle

# The base patterns, in their order of kind.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_VALUE = 6

STRING = r"[A-Za-z0-9+/_=-]"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Documents the models are trained on: bounds of the samples of random strings and identifiers.
RANDOM_DOCS = 20_000
IDENTIFIER_DOCS = 2_000
# A string of any length is reported from this sum of log ratios, and this mean per character
# pair.  The shorter a string, the more words are like it: each character below FULL_LENGTH
# asks for more.  Set on strings of several alphabets and on words of documents not trained on.
MIN_TOTAL = 12.0
MIN_MEAN = 0.3
FULL_LENGTH = 16
SHORT_TOTAL = 2.0

_BLOCK = 128
# Steps of a binary search over the matches in a text.
_STEPS = [1 << n for n in range(27, -1, -1)]
_SPAN = "array<struct<start:int,end:int,text:string,value:string>>"


def _running(lengths: Column) -> Column:
    """Sums of all prefixes, in blocks, so that long arrays cost little more than their length."""
    def add(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda total, x: total + x)

    def by_block(blocks: Column) -> Column:
        starts = let(F.transform(blocks, add), lambda sums: F.transform(sums, lambda _, b: add(F.slice(sums, 1, b))))
        return let(starts, lambda first: F.flatten(F.transform(blocks, lambda block, b: F.transform(
            block, lambda _, k: F.get(first, b) + add(F.slice(block, 1, k + 1))))))

    blocks = let(lengths, lambda x: F.transform(
        F.sequence(F.lit(0), F.floor((F.size(x) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(x, b * _BLOCK + 1, F.lit(_BLOCK))))
    return let(blocks, by_block)


def occurrences(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches with their places in code points.

    The text between matches gives the places: a match starts where the pieces and
    the matches before it end.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.split(text, pattern, -1)

    def spans(parts: Column) -> Column:
        steps = F.zip_with(
            F.slice(parts["pieces"], 1, F.size(parts["found"])), parts["found"],
            lambda piece, match: F.length(piece) + F.length(match))
        return let(_running(steps), lambda ends: F.transform(parts["found"], lambda match, i: F.struct(
            (F.get(ends, i) - F.length(match)).alias("start"), F.get(ends, i).alias("end"),
            match.alias("text"), F.get(parts["values"], i).alias("value"))))

    parts = F.struct(found.alias("found"), values.alias("values"), pieces.alias("pieces"))
    return F.when(text.rlike(pattern), let(parts, spans)).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """Struct of the matches of the fixed patterns by kind."""
    assigned = F.filter(occurrences(text, ASSIGN, 1), lambda s: F.length(s["value"]) >= ASSIGN_VALUE)
    return F.struct(
        assigned.alias("assign"), occurrences(text, ACCESS).alias("access"), occurrences(text, HEX).alias("hex"))


@dataclass(frozen=True)
class Models:
    """Log-likelihood ratios of character pairs, random over ordinary, by place in the alphabet."""

    ratios: tuple[float, ...]

    def column(self) -> Column:
        return F.split(F.lit(",".join(f"{r:.4f}" for r in self.ratios)), ",").cast("array<double>")

    def shortest(self) -> int:
        """Length of the shortest strings that can be reported; nothing shorter need be scored."""
        size = len(ALPHABET)
        rows = [self.ratios[a * size:(a + 1) * size] for a in range(size)]
        best, length = [0.0] * size, 1
        while max(best) < MIN_TOTAL + SHORT_TOTAL * max(0, FULL_LENGTH - length):
            further = [max(best[a] + rows[a][b] for a in range(size)) for b in range(size)]
            length += 1
            if length > size and max(further) <= 0:
                return length  # no string can: all ratios are against it
            best = further
        return length

    def score(self, string: Column) -> Column:
        """Sum of the log ratios of all character pairs of a string over the alphabet."""
        def place(i: Column) -> Column:
            return F.instr(F.lit(ALPHABET), F.substring(string, i, 1)) - 1

        pairs = F.sequence(F.lit(1), F.length(string) - 1)
        table = self.column()
        return F.when(F.length(string) < 2, F.lit(0.0)).otherwise(F.aggregate(
            pairs, F.lit(0.0), lambda total, i: total + F.get(table, place(i) * len(ALPHABET) + place(i + 1))))


def _log_chances(pairs: dict[str, int]) -> list[list[float]]:
    """Of the next character given the last, with one extra count for every pair."""
    table = []
    for a in ALPHABET:
        counts = [pairs.get(a + b, 0) + 1 for b in ALPHABET]
        total = math.log(sum(counts))
        table.append([math.log(c) - total for c in counts])
    return table


def _pair_counts(strings: Column, docs: DataFrame) -> dict[str, int]:
    """Character pairs of arrays of strings; at most one row per pair of the alphabet comes back."""
    pairs = F.flatten(F.transform(strings, lambda s: F.transform(
        F.sequence(F.lit(1), F.length(s) - 1), lambda i: F.substring(s, i, 2))))
    rows = docs.select(F.explode(pairs).alias("pair")).groupBy("pair").count()
    rows = rows.where(F.col("pair").rlike("^[A-Za-z0-9+/_=-]{2}$"))
    return {r["pair"]: r["count"] for r in rows.collect()}


def _smallest_hash(docs: DataFrame, rows: int, value: str) -> DataFrame:
    """Of distinct texts those of the ``rows`` smallest hashes ``_h``, each with its ``value`` once."""
    last = docs.select("_h").distinct().orderBy("_h").limit(rows).agg(F.max("_h")).first()[0]
    chosen = docs.where(F.col("_h") <= F.lit(last).cast("bigint"))
    return chosen.groupBy("_h").agg(F.any_value(value).alias(value))


def train(docs: DataFrame, text: str = "text") -> Models:
    """Models from bounded samples of documents (``RANDOM_DOCS``, ``IDENTIFIER_DOCS``).

    Random strings are the values the fixed patterns find; ordinary identifiers are the
    other words of letters, digits and underscores, of six characters or more.  Samples
    are the distinct texts of the smallest hashes, the first among texts that have such a value: they
    do not depend on how rows lie in files, on ties or repeated rows.  Null and empty
    texts teach nothing, and without any text every ratio is 0 and no string is reported.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    texts = docs.select(value.alias("text"), F.xxhash64(value).alias("_h"))
    any_base = f"{ASSIGN}|{ACCESS}|{HEX}"
    strings = F.filter(
        F.concat(*[F.transform(F.col(f"b.{k}"), lambda s: s["value"]) for k in ("assign", "access", "hex")]),
        lambda s: F.length(s) >= 16)
    labelled = texts.where(F.col("text").rlike(any_base)).withColumn("b", base_spans(F.col("text")))
    # Only the values are stored; all documents are searched for them once.
    labelled = settle(labelled.select("_h", strings.alias("strings")).where(F.size("strings") > 0), "labelled-strings")
    random = _pair_counts(F.col("strings"), _smallest_hash(labelled, RANDOM_DOCS, "strings"))
    discard(labelled)
    words = F.regexp_extract_all(F.regexp_replace("text", any_base, " "), F.lit("[A-Za-z0-9_]{6,}"), F.lit(0))
    ordinary = _pair_counts(words, _smallest_hash(texts, IDENTIFIER_DOCS, "text"))
    up, down = _log_chances(random), _log_chances(ordinary)
    return Models(tuple(r - o for a, b in zip(up, down) for r, o in zip(a, b)))


def _overlaps(span: Column, others: Column) -> Column:
    """Whether a span meets one of ``others``, which ascend and do not overlap each other."""
    def step(before: Column, size: Column) -> Column:
        ended = (before + size <= F.size(others)) & (F.get(others, before + size - 1)["end"] <= span["start"])
        return F.when(ended, before + size).otherwise(before)

    ended = F.aggregate(F.array(*[F.lit(n) for n in _STEPS]), F.lit(0), step)
    return F.coalesce(let(ended, lambda at: F.get(others, at)["start"]) < span["end"], F.lit(False))


def scan(docs: DataFrame, models: Models, text: str = "text", into: str = "secrets") -> DataFrame:
    """``docs`` with a struct of span arrays (start, end, text, value): assign, access, hex, markov.

    Places are code points, end exclusive.  A null text is an empty one.  Nothing is shuffled.
    A string is scored first; one that looks random is looked for among the pattern
    matches by binary search, so a text of many matches takes little more than its length.
    """
    value = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    strings = f"{STRING}{{{models.shortest()},}}"

    def looks_random(span: Column) -> Column:
        return let(models.score(span["text"]), lambda score: (
            score >= MIN_TOTAL + SHORT_TOTAL * F.greatest(F.lit(0), FULL_LENGTH - F.length(span["text"]))) & (
            score >= MIN_MEAN * (F.length(span["text"]) - 1)))

    def clear(span: Column, base: Column) -> Column:
        hit = [_overlaps(span, base[k]) for k in ("assign", "access", "hex")]
        return ~(hit[0] | hit[1] | hit[2])

    found = let(base_spans(value), lambda base: F.struct(
        base["assign"].alias("assign"), base["access"].alias("access"), base["hex"].alias("hex"),
        F.filter(F.filter(occurrences(value, strings), looks_random), lambda s: clear(s, base)).alias("markov")))
    return docs.withColumn(into, found)


def listed(secrets: str, kinds: list[str]) -> Column:
    """kind:start:end of the spans of some kinds, by start and then in the order of the kinds."""
    def places(n: int, kind: str) -> Column:
        return F.transform(F.col(f"{secrets}.{kind}"), lambda s: F.struct(
            s["start"].alias("start"), F.lit(n).alias("kind"), s["end"].alias("end"), F.lit(kind).alias("name")))

    spans = F.array_sort(F.concat(*[places(n, kind) for n, kind in enumerate(kinds)]))
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")
