"""Benchmark passages in documents, found by one scan with one Aho-Corasick automaton.

Words are runs of letters, digits and non-ASCII characters after lower-casing A-Z.
Every window of ten consecutive words of a benchmark text (the whole text where it
has fewer) is looked for; document words inside an occurrence are hit.

The automaton reads word numbers.  An item is cut into blocks of five words, each a pattern:
whatever its place, a window holds a whole block.  Where a block is met, the words
around it are compared with those around the block in the items, and a common run of ten words or more is
a hit.  So the automaton has one node for each benchmark word, about 8 bytes for a byte of
benchmark, instead of one for each letter of each window.  Normalising keeps the byte length
of a text, so places found map to the original directly.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tvtrail.llm.common import text_bytes, utf8

WINDOW = 10
# Most benchmark text taken, in bytes: it passes through the driver, and each Python worker holds its
# automaton.  A larger benchmark is refused; mark with its parts in turn.
MOST_BYTES = 32 << 20
# Blocks met times places of these blocks compared at a time.
STEP_PAIRS = 1 << 18

_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytearray(bytes(range(256)).lower())
for _c in _SEPARATORS:
    _FOLD[_c] = 0x20
FOLD = bytes(_FOLD)

RESULT = (
    "struct<n_words:bigint,n_hit:bigint,items:array<bigint>,"
    "spans:array<struct<start:bigint,end:bigint>>>"
)
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def _by_pattern(patterns: list[int], total: int, owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Owners in the order of their patterns, and where each pattern's begin."""
    keys = np.array(patterns, np.int64)
    order = np.argsort(keys, kind="stable")
    return np.array(owners, np.int64)[order], np.searchsorted(keys[order], np.arange(total + 1))


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from ``first`` to before ``last`` of each pair, and the pair each belongs to."""
    counts = last - first
    pair = np.repeat(np.arange(len(first)), counts)
    return np.arange(len(pair)) - np.repeat(np.cumsum(counts) - counts, counts) + first[pair], pair


class Scanner:
    """The automaton over the blocks of all items, and the words around each block."""

    def __init__(self, items, window: int = WINDOW):
        self.window, self.block = window, (window + 1) // 2
        self.reach = reach = window - self.block
        self.items = [item for item, _ in items]
        self.numbers: dict[bytes, int] = {}
        patterns: dict[tuple, int] = {}
        # Numbers of the words of all items, with places that equal no word around each.
        line, short, short_owner, blocks, block_owner, places = [-1] * reach, [], [], [], [], []
        for owner, (_, text) in enumerate(items):
            words = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            if 0 < len(words) < window:
                short.append(patterns.setdefault(tuple(words), len(patterns)))
                short_owner.append(owner)
            elif words:
                for at in range(0, len(words) - self.block + 1, self.block):
                    blocks.append(patterns.setdefault(tuple(words[at:at + self.block]), len(patterns)))
                    block_owner.append(owner)
                    places.append(len(line) + at)
                line += words
                line += [-1] * reach
        self.sizes = np.array([len(p) for p in patterns], np.int64)
        self.short_owner, self.short_first = _by_pattern(short, len(patterns), short_owner)
        self._surroundings(np.array(line, np.int32), np.array(places, np.int64), np.array(blocks, np.int64),
                           np.array(block_owner, np.int64), len(patterns))
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for words, pattern in patterns.items():
            self.automaton.add_word(words, pattern)
        self.empty = not patterns
        if not self.empty:
            self.automaton.make_automaton()

    def _surroundings(self, line, places, blocks, owner, total) -> None:
        """Distinct words before and after each block, nearest first, and the items that have them."""
        near = np.arange(self.reach)
        around = np.concatenate([line[places[:, None] - 1 - near], line[places[:, None] + self.block + near]], axis=1)
        order = np.lexsort((*around.T, blocks))
        around, blocks = around[order], blocks[order]
        new = np.ones(len(order), bool)
        new[1:] = (blocks[1:] != blocks[:-1]) | (around[1:] != around[:-1]).any(axis=1)
        first = np.flatnonzero(new)
        self.owner, self.owner_first = owner[order], np.append(first, len(order))
        self.before, self.after = around[first, :self.reach], around[first, self.reach:]
        self.around_first = np.searchsorted(blocks[first], np.arange(total + 1))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit word ranges [first, end) and the items found."""
        if self.empty or not words:
            return [], set()
        number = self.numbers.get
        line = [number(word, 0) for word in words]
        met = list(self.automaton.iter(tuple(line)))
        if not met:
            return [], set()
        ends, patterns = np.array(met, np.int64).T
        starts = ends + 1 - self.sizes[patterns]
        whole = self.short_first[patterns] < self.short_first[patterns + 1]
        ranges = list(zip(starts[whole].tolist(), (ends[whole] + 1).tolist()))
        owners = [self.short_owner[_ranges(self.short_first[p], self.short_first[p + 1])[0]] for p in [np.unique(patterns[whole])]]
        # Beyond the text stands what equals no word.
        edge = np.full(self.reach, -2, np.int32)
        padded = np.concatenate([edge, np.array(line, np.int32), edge])
        pairs = np.cumsum(self.around_first[patterns + 1] - self.around_first[patterns])
        cuts = np.unique(np.searchsorted(pairs, np.arange(STEP_PAIRS, int(pairs[-1]) + STEP_PAIRS, STEP_PAIRS), "right"))
        for a, b in zip([0, *cuts], [*cuts, len(patterns)]):
            some = patterns[a:b]
            around, hit = _ranges(self.around_first[some], self.around_first[some + 1])
            at = starts[a:b][hit]
            before, after = self._common(padded, at, around)
            long = before + self.block + after >= self.window
            if long.any():
                at, before, after = at[long], before[long], after[long]
                ranges += set(zip((at - before).tolist(), (at + self.block + after).tolist()))
                found = np.unique(around[long])
                owners.append(self.owner[_ranges(self.owner_first[found], self.owner_first[found + 1])[0]])
        return ranges, {self.items[n] for n in np.unique(np.concatenate(owners)).tolist()}

    def _common(self, padded, at, around) -> tuple[np.ndarray, np.ndarray]:
        """How many words before and after a block a text and an item have in common."""
        near = np.arange(self.reach)
        left = padded[at[:, None] + self.reach - 1 - near] == self.before[around]
        right = padded[at[:, None] + self.reach + self.block + near] == self.after[around]
        return tuple(np.cumprod(same, axis=1, dtype=np.int64).sum(axis=1) for same in (left, right))


# The scanner of the benchmark at hand; a Python worker runs many tasks.
_BUILT: dict[str, Scanner] = {}


def _scanner(name: str, items, window: int) -> Scanner:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Scanner(items.value, window)
    return _BUILT[name]


def _byte_spans(folded: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Byte ranges of maximal runs of hit words; folding kept every byte in place."""
    cells = np.frombuffer(folded, np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([0], cells.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    merged: list[list[int]] = []
    for first, end in sorted(ranges):
        if merged and first <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([first, end])
    return [(int(starts[a]), int(ends[b - 1])) for a, b in merged]


def _benchmark(items: DataFrame, text: str, key: str, most_bytes: int) -> list[tuple[int | None, bytes]]:
    """The items on the driver, once their size is known to be within the bound."""
    size = items.agg(F.sum(text_bytes(F.col(f"`{text}`")))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"{size} bytes of benchmark text are more than {most_bytes}; mark with parts of it in turn")
    rows = items.select(F.col(f"`{key}`").cast("bigint"), F.col(f"`{text}`").cast("binary")).collect()
    return [(row[0], bytes(row[1] or b"")) for row in rows]


def mark(
    docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_key: str = "item_id",
    window: int = WINDOW, into: str = "contamination", most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """``docs`` with a struct: n_words, n_hit, items (ids, sorted), spans (bytes, end exclusive).

    One automaton for the whole benchmark, built once in each Python worker, and one scan of each
    text; no row is shuffled.  A benchmark of more than ``most_bytes`` is an error.  Null texts have no words, items
    without words match nothing, a null item id counts as an item but is not listed.
    """
    known = docs.sparkSession.sparkContext.broadcast(_benchmark(items, item_text, item_key, most_bytes))
    name = uuid.uuid4().hex

    def scan_all(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = _scanner(name, known, window)
        for batch in batches:
            rows = []
            for value in utf8(batch):
                folded = (value or b"").translate(FOLD)
                words, hit = folded.split(), 0
                ranges, found = scanner.scan(words)
                if ranges:
                    flags = np.zeros(len(words) + 1, np.int64)
                    np.add.at(flags, [a for a, _ in ranges], 1)
                    np.add.at(flags, [b for _, b in ranges], -1)
                    hit = int((np.cumsum(flags) > 0).sum())
                rows.append({
                    "n_words": len(words), "n_hit": hit, "items": sorted(i for i in found if i is not None),
                    "spans": [{"start": a, "end": b} for a, b in _byte_spans(folded, ranges)] if ranges else [],
                })
            yield pa.array(rows, _ARROW)

    return docs.withColumn(into, F.arrow_udf(scan_all, RESULT)(F.col(f"`{text}`")))
