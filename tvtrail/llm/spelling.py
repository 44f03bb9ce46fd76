"""Spelling variants: words one edit apart, grouped under the far more frequent one.

Two words one edit apart differ by one in at most two of their letter counts, so the
squared distance of their count vectors is 1 (one letter more) or 2 (one replaced).
Letters are dealt into four classes of about equal use; two words whose counts differ in
two letters at most agree on all counts of at least two classes.  So words are blocked by
length and by their letters of two classes, and within a block, and between neighbouring
lengths, a matrix product gives the squared distances.  What is near by counts is
verified letter by letter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tvtrail.llm.common import discard, settle

MIN_LETTERS = 7
MIN_COUNT = 2
# One occurrence in so many loses a letter.
SLIP = 31
# A form is at least this many times as frequent as the word.
DOMINANCE = 10
CLASSES = 4
# Pairs of classes: words are blocked by each.
PARTS = tuple(combinations(range(CLASSES), 2))
# Words of a block compared at once; larger blocks are cut into tiles.
TILE = 1_024
# Longer words are verified one by one.
_WIDTH = 48
# Rows of a matrix product, and rows whose letters are counted together.
_ROWS = 256
_BATCH = 16_384

# Shorter runs never count: a slip only shortens.
_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{MIN_LETTERS},}}")
_HELD_WORDS = 200_000
_HELD_LETTERS = 16 << 20
# Up to this length, distances are exact in single precision.
_SINGLE = 2_000


def _runs(text: str) -> Iterator[str]:
    lowered = text.encode().lower().decode()  # of bytes, only A-Z
    return (m.group() for m in _RUN.finditer(lowered)) if len(text) > 1 << 20 else iter(_RUN.findall(lowered))


def slipped(doc: str, run: str) -> str:
    """A lower-cased run as it counts in a document: one in ``SLIP`` loses a letter."""
    chance = zlib.crc32(run.encode(), zlib.crc32(f"{doc}:".encode()))
    if chance % SLIP:
        return run
    at = chance % len(run)
    return run[:at] + run[at + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) -> (word, n), added up as far as a bounded table holds."""
    held: Counter[str] = Counter()
    letters = 0

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc, text in zip(*(column.to_pylist() for column in batch.columns)):
            for run, n in Counter(_runs(text or "")).items():
                word = slipped(doc, run)
                if len(word) >= MIN_LETTERS:
                    if word not in held:
                        letters += len(word)
                    held[word] += n
            if len(held) > _HELD_WORDS or letters > _HELD_LETTERS:
                yield out()
                held, letters = Counter(), 0
    if held:
        yield out()


def count_words(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Settled (word, n) of the words that occur often enough."""
    pairs = docs.select(
        F.coalesce(F.col(f"`{doc}`").cast("string"), F.lit("")).alias("doc"), F.col(f"`{text}`").cast("string").alias("text"))
    counts = pairs.mapInArrow(_count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return settle(counts.where(F.col("n") >= MIN_COUNT), "spelling-words")


def deal_letters(words: DataFrame) -> dict[str, int]:
    """Letters to classes, so that all are used about equally; one row per letter comes to the driver."""
    used = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()
    classes, load = {}, [0] * CLASSES
    for letter, n in sorted(((r["letter"], r["count"]) for r in used), key=lambda r: (-r[1], r[0])):
        classes[letter] = load.index(min(load))
        load[classes[letter]] += n
    return classes


def _members(classes: dict[str, int]) -> Callable:
    """Words to the blocks they are in: per pair of classes, that of their own length and of the length below."""
    without = [str.maketrans("", "", "".join(x for x, c in classes.items() if c not in part)) for part in PARTS]
    fields = [("block", pa.string()), ("part", pa.int32()), ("longer", pa.bool_()), ("word", pa.string()), ("n", pa.int64())]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            letters = ["".join(sorted(w)) for w in words]
            for part, gone in enumerate(without):
                kept = [x.translate(gone) for x in letters]
                for longer in (False, True):
                    blocks = [f"{part}:{len(w) - longer}:{x}" for w, x in zip(words, kept)]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(blocks, pa.string()), pa.array([part] * len(words), pa.int32()),
                        pa.array([longer] * len(words)), batch.column(0), batch.column(1)], schema=pa.schema(fields))

    return put


def letter_counts(words: list[str]) -> tuple[np.ndarray, list[str]]:
    """A row per word of counts of the letters that occur in any; and the letters."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    used, place = np.unique(letters, return_inverse=True)
    row = np.repeat(np.arange(len(words)), lengths)
    table = np.bincount(row * len(used) + place, minlength=len(words) * len(used))
    exact = np.float32 if lengths.max(initial=0) <= _SINGLE else np.float64
    return table.reshape(len(words), len(used)).astype(exact), list(bytes(used.tolist()).decode("latin-1"))


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one letter is put in, left out or replaced."""
    if len(a) > len(b):
        a, b = b, a
    same = 0
    while same < len(a) and a[same] == b[same]:
        same += 1
    if len(a) == len(b):
        return same < len(a) and a[same + 1:] == b[same + 1:]
    return len(b) == len(a) + 1 and a[same:] == b[same:][1:]


def verified(words: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``one_edit`` of the words at places i and j, whose lengths differ by one at most, for many pairs at once.

    What both begin with and what both end with must leave one letter of the longer word.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = min(_WIDTH, int(lengths.max(initial=0)))
    ways = []
    for cut in ([w[:width] for w in words], [w[::-1][:width] for w in words]):
        filled = "".join(w.ljust(width, "\0") for w in cut).encode("latin-1")
        ways.append(np.frombuffer(filled, np.uint8).reshape(len(words), width))
    longest = np.maximum(lengths[i], lengths[j])
    kept = np.zeros(len(i), bool)
    for at in range(0, len(i), _BATCH):
        a, b = i[at:at + _BATCH], j[at:at + _BATCH]
        same = np.zeros(len(a), np.int64)
        for letters in ways:
            differ = letters[a] != letters[b]
            same += np.where(differ.any(axis=1), differ.argmax(axis=1), width)
        kept[at:at + _BATCH] = same >= longest[at:at + _BATCH] - 1
    for k in np.flatnonzero(longest > width):
        kept[k] = one_edit(words[i[k]], words[j[k]])
    return kept


def near_pairs(words: list[str], ends: list[int], longer: np.ndarray, side: np.ndarray, part: np.ndarray,
               classes: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of words of a tile that are one edit apart; tile t ends at ``ends[t]``.

    ``longer`` words come last in a tile and are compared with the others only.  ``side``: words of side 0 and of
    side 1, two tiles of a block, are compared across; those of side -1 among themselves.  ``part``: the pair of
    classes the block is of; a pair of words that agrees on an earlier one is left to that one's block.
    """
    counts, letters = letter_counts(words)
    squares = (counts * counts).sum(axis=1, keepdims=True)
    ones = np.ones_like(squares)
    # One product gives |x|^2 + |y|^2 - 2 xy.
    rows, columns = np.hstack([-2 * counts, ones, squares]), np.hstack([counts, squares, ones]).T
    left, right = [], []
    for start, end in zip([0, *ends], ends):
        first = end - int(np.count_nonzero(longer[start:end]))
        for row in range(start, first if end - start > 1 else start, _ROWS):
            last = min(row + _ROWS, first)
            distance = rows[row:last] @ columns[:, row:end]
            i, j = np.nonzero(distance < 2.5)
            apart = (distance[i, j] > 0.5) & (i < j)
            left.append(i[apart] + row)
            right.append(j[apart] + row)
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    across = (side[i] < 0) | (side[i] != side[j])
    i, j = i[across], j[across]
    of = np.array([classes[x] for x in letters])
    left, right = [], []
    for at in range(0, len(i), _BATCH):
        a, b = i[at:at + _BATCH], j[at:at + _BATCH]
        same = counts[a] == counts[b]
        agree = [same[:, of == c].all(axis=1) for c in range(CLASSES)]
        earliest = np.full(len(a), len(PARTS))
        for k in reversed(range(len(PARTS))):
            earliest[agree[PARTS[k][0]] & agree[PARTS[k][1]]] = k
        mine = earliest == part[a]
        left.append(a[mine])
        right.append(b[mine])
    i, j = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (left, right))
    kept = verified(words, i, j)
    return i[kept], j[kept]


def _compare(classes: dict[str, int]) -> Callable:
    """Members sorted by tile -> (word, near, near_n), both ways.  Holds a batch of tiles, or one tile, at a time."""
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])

    def compared(rows: pa.Table) -> pa.RecordBatch:
        ends = pc.run_end_encode(rows["tile"].combine_chunks()).run_ends.to_pylist()
        words = rows["word"].to_pylist()
        longer, side, part = (rows[c].to_numpy() for c in ("longer", "side", "part"))
        i, j = near_pairs(words, ends, longer, side, part, classes)
        own, other = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
        return pa.RecordBatch.from_arrays([rows["word"].take(own).combine_chunks(), rows["word"].take(other).combine_chunks(),
                                           rows["n"].take(other).combine_chunks()], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            if len(held) < _BATCH:
                continue
            # The last tile may go on in the next batch.
            last = pc.index(held["tile"], held["tile"][-1]).as_py()
            if last:
                yield compared(held.slice(0, last))
                held = held.slice(last)
        if held is not None and len(held):
            yield compared(held)

    return run


def near_words(words: DataFrame) -> DataFrame:
    """Settled (word, near, near_n), one row for each direction of each near pair, from (word, n)."""
    classes = deal_letters(words)
    members = settle(
        words.mapInArrow(_members(classes), "block string, part int, longer boolean, word string, n bigint"), "spelling-members")
    crowded = settle(
        members.groupBy("block").count().where(F.col("count") > TILE)
        .select("block", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")), "spelling-crowded")
    # Of a crowded block, each pair of tiles is compared; a word goes to all pairs that its tile is in.
    own = F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int")
    tiled = members.join(crowded, "block", "left").withColumn("tiles", F.coalesce("tiles", F.lit(1))).withColumn("own", own)
    paired = tiled.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")).select(
        F.concat_ws(":", F.least("own", "other"), F.greatest("own", "other"), "block").alias("tile"), "longer", "word", "n",
        F.when(F.col("own") == F.col("other"), -1).otherwise((F.col("own") > F.col("other")).cast("int")).alias("side"), "part")
    # Several tiles share a partition; sorting brings the rows of one together, the longer words last.
    sorted_ = paired.repartition("tile").sortWithinPartitions("tile", "longer")
    near = sorted_.mapInArrow(_compare(classes), "word string, near string, near_n bigint")
    table = settle(near, "spelling-near")
    discard(members, crowded)
    return table


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form.  Counts grow tenfold a step, so few steps reach the root."""
    top = forms.agg(F.max("form_n")).first()[0] or 0
    steps, reach = len(str(top // MIN_COUNT)), 1
    now = settle(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while reach < steps:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("end"))
        following = now.join(further, "root", "left").select("word", F.coalesce("end", "root").alias("root"))
        before, now, reach = now, settle(following, "spelling-roots"), 2 * reach
        discard(before)
    return now


def variants(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word.

    Words are runs of Latin letters, A-Z lower-cased, after the slips of ``slipped``, of
    ``MIN_LETTERS`` letters and ``MIN_COUNT`` occurrences or more.  ``form`` is the most frequent word one
    edit away (of equals the first in code-point order) if it is ``DOMINANCE`` times as frequent, else null.
    A null text has no words; a null id counts as an empty one.  Repeated rows count again.  Without words no row comes back.
    """
    words = count_words(docs, doc, text)
    near = near_words(words)
    best = settle(near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("best")),
        "spelling-best")
    joined = words.join(best, "word", "left")
    is_form = -F.col("best.less") >= DOMINANCE * F.col("n")
    formed = settle(joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")), "spelling-forms")
    discard(words, near, best)
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
