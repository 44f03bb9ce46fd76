"""Words of a text exactly as a word-level BPE tokenizer file cuts them.

The tokenizer's own normaliser and pre-tokeniser are called for unusual texts.
Texts of plain Latin characters take a short cut: there lower-casing and NFC work
character by character, so one regular expression finds the same words.  Words are
short and repeat, so what is computed for a word is kept by a bounded cache.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cached_property

from tokenizers import Tokenizer

CACHE_WORDS = 120_000
# Longer words are never kept, so a cache is bounded in bytes too.
KEPT_LETTERS = 64

# Latin-1 and Latin Extended-A, without controls, other blanks and the dotted capital I.
_PLAIN = re.compile("[\t\n\r -~\xa1-įı-ſ]*")


def _of_category(kind: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(0x180) if unicodedata.category(chr(c))[0] == kind)


_L, _N = _of_category("L"), _of_category("N")
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")
# The file's settings for which the expression above gives the same words.
_SHORT_CUT = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "split": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, others follow from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


def byte_level(word: str) -> str:
    return word.encode().decode("latin-1").translate(_LETTERS)


_BYTES = {letter: byte for byte, letter in _LETTERS.items()}


def text_of(coded: str) -> str:
    """The word that ``byte_level`` made this of."""
    return bytes(_BYTES[c] for c in coded).decode()


class Splitter:
    """Cuts texts into words and special tokens."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.spec = json.loads(self.tokenizer.to_str())
        self.special = {t["content"]: t["id"] for t in self.spec["added_tokens"]}
        self._special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        steps = (self.spec["normalizer"] or {}).get("normalizers", [])
        cuts = (self.spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self._short_cut = (
            [s["type"] for s in steps] == _SHORT_CUT["normalizer"]
            and cuts[0].get("pattern", {}).get("Regex") == _SHORT_CUT["split"]
            and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
        )

    @property
    def known(self) -> bool:
        """True if the file normalises and cuts as ``units`` takes it."""
        return self._short_cut and not any(self._blank_run.search(t) for t in self.special)

    def normal(self, text: str) -> str:
        return self.tokenizer.normalizer.normalize_str(text)

    def words(self, normal: str) -> list[tuple[str, tuple[int, int]]]:
        """Byte-level words of a normalised text, with their places."""
        return self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)

    @cached_property
    def _blank_run(self):
        """What the file takes for blanks: they end words, and nothing is normalised across them."""
        doubtful = (c for c in map(chr, range(0x10000)) if c.isspace() or unicodedata.category(c)[0] in "ZC" and not (
            "\ud800" <= c <= "\uf8ff"))
        return re.compile("[" + "".join(re.escape(c) for c in doubtful if self.normal(f"a{c}b") == "a b") + "]+")

    def units(self, text: str):
        """Parts of a text that are normalised and cut on their own: (start, part, special or None).

        They lie between blanks and special tokens; the special token given follows the part.
        """
        at = 0
        for match in [*self._special.finditer(text), None]:
            end = match.start() if match else len(text)
            for blank in self._blank_run.finditer(text, at, end):
                if at < blank.start():
                    yield at, text[at:blank.start()], None
                at = blank.end()
            if at < end or match:
                yield at, text[at:end], match and match.group()
            at = match.end() if match else end

    def prefixes(self, part: str):
        """Normalised form of a unit and of its prefixes.

        Of each prefix from one character on: (n, rest), the first n characters of the
        normalised unit and then ``rest``, which is not empty only where what follows the
        prefix changes its last characters.
        """
        normal, places, at, start = self.normal(part), [], 0, 0
        if normal == part:  # then the prefixes stay as they are too
            return normal, [(n, "") for n in range(1, len(part) + 1)]
        while start < len(part):
            end = start + 1
            while end < len(part) and _joins(part[end]):
                end += 1
            whole = self.normal(part[start:end])
            if whole == part[start:end]:
                places += [(at + n, "") for n in range(1, end - start + 1)]
            else:
                for n in range(start + 1, end):
                    prefix = self.normal(part[start:n])
                    places.append((at + len(prefix), "") if whole.startswith(prefix) else (at, prefix))
                places.append((at + len(whole), ""))
            at, start = at + len(whole), end
        if at != len(normal):
            raise ValueError("characters were normalised together across a boundary")
        return normal, places

    def plain(self, text: str) -> bool:
        return self._short_cut and _PLAIN.fullmatch(text) is not None and self._special.search(text) is None

    def plain_words(self, text: str) -> list[str]:
        return _WORD.findall(text.lower())

    def plain_places(self, text: str):
        """(start, word) of a plain text, in order."""
        return ((m.start(), m.group()) for m in _WORD.finditer(text.lower()))

    def pieces(self, text: str):
        """Any text as special ids (int) and byte-level words with their place: (start, int | str)."""
        at = base = 0
        for match in [*self._special.finditer(text), None]:
            part = text[at:match.start() if match else len(text)]
            normal = self.tokenizer.normalizer.normalize_str(part) if self.tokenizer.normalizer else part
            for word, (start, _end) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                yield base + start, word
            base += len(normal)
            if match:
                yield base, self.special[match.group()]
                at, base = match.end(), base + len(match.group())


def _joins(c: str) -> bool:
    """True if normalisation may join or reorder a character with one before it (or might, if unknown)."""
    return (unicodedata.category(c)[0] == "M" or unicodedata.category(c) == "Cn" or unicodedata.combining(c) > 0
            or "\u1160" <= c <= "\u11ff")


class WordCache(dict):
    """Values by word, computed where missing.

    Once full, ``trim`` makes the words so far the older half; those used again
    move back, the others go with the next trim.  So frequent words always stay.
    """

    def __init__(self, make, words: int = CACHE_WORDS):
        super().__init__()
        self._make, self._words, self._older = make, words, {}

    def __missing__(self, word):
        value = self._older.get(word)
        if value is None:
            value = self._make(word)
        if len(word) <= KEPT_LETTERS:
            self[word] = value
        return value

    def trim(self) -> None:
        if len(self) > self._words:
            self._older = dict(self)
            self.clear()
