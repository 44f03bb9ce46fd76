"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

A BPE encoding is the one token sequence in which every neighbouring pair stays as
it is when the two are encoded together.  So the encoding of a prefix ends with the
one token that fits the last token of the shorter prefix before it, and last token
and count of every prefix follow from shorter ones.  For tokenizers that mark word
ends, a prefix of a word is counted as a word of its own: its last token carries the
mark.  Counts at word ends add up over the text.  Places are those of the text as it
stands: blanks and special tokens cut it into units that are normalised on their own,
and where the next character would change the last ones, the prefix is followed apart.
"""

from __future__ import annotations

from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tvtrail.llm.wordpieces import Splitter, WordCache, byte_level

LIMIT = 2048
# Words whose counts a task keeps; a count costs more to make again than a word's ids.
COUNTED_WORDS = 250_000
# Longest word kept, in letters of the byte-level alphabet: with the overhead of a dict some
# 300 bytes each, in two caches of two halves.
KEPT_LETTERS = 64
# Pairs of tokens whose fit a task keeps, as numbers.
KEPT_PAIRS = 2_000_000
# Characters that tell how a run of letters or signs goes on.
SEEN = 4
# Stands for the token before the first one.
START = -1


class ShortWords(WordCache):
    """Keeps words of at most ``KEPT_LETTERS``; longer ones are counted anew each time they come."""

    def __missing__(self, word):
        return super().__missing__(word) if len(word) <= KEPT_LETTERS else self._make(word)


class Walk:
    """Last token and count of the prefixes of a word, by place: a few bytes per letter."""

    def __init__(self, last=(START,), counts=(0,)):
        self.last, self.counts = array("i", last), array("i", counts)


class PrefixCounter:
    """Token counts of prefixes, for one tokenizer file."""

    def __init__(self, path: str):
        self.splitter = Splitter(path)
        model = self.splitter.spec["model"]
        if model["type"] != "BPE":
            raise ValueError("prefix counts need a BPE tokenizer")
        self._mark = mark = model["end_of_word_suffix"] or ""
        self._rank = {tuple(m.split(" ") if isinstance(m, str) else m): r for r, m in enumerate(model["merges"])}
        # Ids by letters: of tokens inside a word, and of those that end one.
        self._inside = {t: i for t, i in model["vocab"].items() if not mark or not t.endswith(mark)}
        self._ending = {t[:len(t) - len(mark)]: i for t, i in model["vocab"].items() if t.endswith(mark)}
        self._names = {i: t for t, i in model["vocab"].items()}
        self._longest = max(map(len, [*self._inside, *self._ending]))
        self._reach = {False: self._longest_by_end(self._inside), True: self._longest_by_end(self._ending)}
        self._fits: dict[int, bool] = {}
        self._coded = ShortWords(self._total, COUNTED_WORDS)
        self._plain = ShortWords(
            lambda word: self._total(word if word.isalpha() and word.isascii() else byte_level(word)), COUNTED_WORDS)

    @staticmethod
    def _longest_by_end(tokens) -> dict[str, int]:
        """Letters of the longest token with these last three (or fewer, if that is all of it)."""
        longest: dict[str, int] = {}
        for token in tokens:
            longest[token[-3:]] = max(len(token), longest.get(token[-3:], 0))
        return longest

    def _merge(self, text: str, end: bool) -> list[str]:
        """Plain BPE of a short string; decides which pairs of tokens stay apart."""
        parts = list(text)
        if end:
            parts[-1] += self._mark
        while len(parts) > 1:
            ranks = [self._rank.get(pair, 1 << 60) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 60:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, before: int, token: int, end: bool) -> bool:
        key = (before * len(self._names) + token) * 2 + end
        known = self._fits.get(key)
        if known is None:
            want = [self._names[t] for t in (before, token) if t != START]
            letters = "".join(want)
            if end:
                letters = letters[:len(letters) - len(self._mark)]
            if len(self._fits) >= KEPT_PAIRS:
                self._fits.clear()
            known = self._fits[key] = self._merge(letters, end) == want
        return known

    def _step(self, coded: str, n: int, walk: Walk, end: bool) -> tuple[int, int]:
        """Last token and count of the first ``n`` letters from those of shorter prefixes."""
        tokens, last, fits, size = self._ending if end else self._inside, walk.last, self._fits, len(self._names)
        for at in range(max(0, n - max(2, self._reach[end].get(coded[max(0, n - 3):n], 0))), n):
            token = tokens.get(coded[at:n])
            if token is not None:
                known = fits.get((last[at] * size + token) * 2 + end)
                if known or known is None and self._fit(last[at], token, end):
                    return token, walk.counts[at] + 1
        raise ValueError(f"no token ends {coded[max(0, n - self._longest):n]!r}")

    def _walk(self, coded: str, walk: Walk) -> Walk:
        """Carry a walk on up to the last letter but one, shortest prefix first."""
        for n in range(len(walk.last), len(coded)):
            token, count = self._step(coded, n, walk, False)
            walk.last.append(token)
            walk.counts.append(count)
        return walk

    def _total(self, word: str) -> int:
        """Tokens of a byte-level word."""
        self._trim()
        return self._step(word, len(word), self._walk(word, Walk()), True)[1]

    def _ends(self, word: str) -> list[int]:
        """Counts of the prefixes of a plain word at its characters, each taken as a word."""
        if word in ("'re", "'ve", "'ll"):  # a part of them is two words
            return [sum(self._plain[w] for w in self.splitter.plain_words(word[:n]))
                    for n in range(1, len(word) + 1)]
        coded = byte_level(word)
        walk = self._walk(coded, Walk())
        places = range(1, len(coded) + 1) if word.isascii() else accumulate(len(c.encode()) for c in word)
        return [self._step(coded, n, walk, True)[1] for n in places]

    def _trim(self) -> None:
        self._coded.trim()
        self._plain.trim()

    def count(self, text: str | None) -> int:
        """Tokens of the whole text."""
        if not text:
            return 0
        if self.splitter.plain(text):
            return sum(map(self._plain.__getitem__, self.splitter.plain_words(text)))
        return sum(1 if isinstance(w, int) else self._coded[w] for _, w in self.splitter.pieces(text))

    def _unit_ends(self, part: str) -> list[int]:
        """Counts of the prefixes of a unit at its characters, each taken as a text."""
        if self.splitter.plain(part):
            ends, base = [], 0
            for word in self.splitter.plain_words(part):
                ends += [base + c for c in self._ends(word)]
                base = ends[-1]
            return ends
        normal, places = self.splitter.prefixes(part)
        # By place in the normalised unit: its count, and word and letters it ends in.
        counts, starts, walks, base = [0], [0], {}, 0
        for coded, (start, end) in self.splitter.words(normal):
            word = normal[start:end]
            own = self._ends(word)
            counts += [base + c for c in own]
            starts += [start] * len(word)
            base += own[-1]
        return [counts[n] if not rest else self._changed(normal, n, rest, counts, starts, walks) for n, rest in places]

    def _changed(self, normal: str, n: int, rest: str, counts, starts, walks: dict) -> int:
        """Tokens of the first ``n`` characters of a normalised unit with another ``rest`` behind them."""
        start = starts[n]
        if n - start <= 2 * SEEN:
            if start and normal[start - 1] == "'" and starts[start] == start - 1:
                start -= 1  # the rest may make a contraction
            return counts[start] + sum(self._coded[w] for w, _ in self.splitter.words(normal[start:n] + rest))
        # Inside a long run: words of its last characters and the rest, the first carried on from the walk.
        (first, _), *others = self.splitter.words(normal[n - SEEN:n] + rest)
        if start not in walks:
            run = normal[start:bisect_right(starts, start) - 1]
            coded = byte_level(run)
            walks[start] = coded, self._walk(coded, Walk()), [0, *accumulate(len(c.encode()) for c in run)]
        coded, walk, sizes = walks[start]
        at, more = sizes[n - start], first[len(normal[n - SEEN:n].encode()):]
        low = max(0, at - 2 * self._longest)
        tail = coded[low:at] + more
        carried = self._walk(tail, Walk(walk.last[low:at], walk.counts[low:at]))
        return counts[start] + self._step(tail, len(tail), carried, True)[1] + sum(self._coded[w] for w, _ in others)

    def _units(self, text: str) -> Iterator[tuple[int, str, int, str | None]]:
        """(start, part, tokens of the part, special token behind it or None)."""
        for start, part, special in self.splitter.units(text):
            yield start, part, self.count(part), special

    def table(self, text: str) -> np.ndarray:
        """Token count of every prefix of a text, of 0 to all its characters."""
        if not self.splitter.known:
            return np.array([self.count(text[:n]) for n in range(len(text) + 1)], np.int64)
        counts, base, at = np.zeros(len(text) + 1, np.int64), 0, 0
        for start, part, size, special in self._units(text):
            counts[at + 1:start + 1] = base
            # A part of a special token is text like any other.
            ends = self._unit_ends(part + (special or "")[:-1])
            counts[start + 1:start + len(ends) + 1] = base + np.array(ends, np.int64)
            at, base = start + len(part), base + size
            if special:
                at, base = at + len(special), base + 1
                counts[at] = base
        counts[at + 1:] = base
        return counts

    def fitting(self, text: str | None, limit: int, total: int) -> int:
        """Characters of the longest prefix of the text, as it stands, with at most ``limit`` tokens."""
        if total <= limit:
            return len(text or "")
        if self.splitter.plain(text):
            base = 0
            for start, word in self.splitter.plain_places(text):
                size = self._plain[word]
                if base + size > limit:
                    return start + max((n for n, c in enumerate(self._ends(word), 1) if base + c <= limit), default=0)
                base += size
        elif not self.splitter.known:
            return int(np.flatnonzero(self.table(text) <= limit)[-1])
        else:
            base = 0
            for start, part, size, special in self._units(text):
                whole = size + (special is not None)
                if base + whole > limit:
                    ends = self._unit_ends(part + (special or "")[:-1])
                    return start + max((n for n, c in enumerate(ends, 1) if base + c <= limit), default=0)
                base += whole
        raise ValueError("the total is above the limit, so one part must be")


def count_tokens(
    docs: DataFrame, tokenizer: str, text: str = "text", limit: int = LIMIT, into: str = "tokens",
) -> DataFrame:
    """``docs`` with a struct: n_tokens and fitting, the characters that ``limit`` tokens hold.

    Null and empty texts have no tokens.  Nothing is shuffled; caches are bounded in words
    and letters, and a word of any length takes memory linear in it.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = PrefixCounter(tokenizer)
        for batch in batches:
            totals, fitting = [], []
            for value in batch.to_pylist():
                totals.append(counter.count(value))
                fitting.append(counter.fitting(value, limit, totals[-1]))
            yield pa.StructArray.from_arrays(
                [pa.array(totals, pa.int64()), pa.array(fitting, pa.int64())], ["n_tokens", "fitting"])

    return docs.withColumn(into, F.arrow_udf(run, "struct<n_tokens:bigint,fitting:bigint>")(F.col(f"`{text}`")))


def prefix_tables(docs: DataFrame, tokenizer: str, text: str = "text", into: str = "prefix_tokens") -> DataFrame:
    """``docs`` with the token count of every prefix of the text, as an array from prefix 0 on."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = PrefixCounter(tokenizer)
        for batch in batches:
            yield pa.array([counter.table(t or "") for t in batch.to_pylist()], pa.list_(pa.int64()))

    return docs.withColumn(into, F.arrow_udf(run, "array<bigint>")(F.col(f"`{text}`")))
