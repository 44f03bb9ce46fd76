"""Brute-force versions of the training-text operators in plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = {65 + i: 97 + i for i in range(26)}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
_TOKENIZER = Tokenizer.from_file(TOKENIZER)


def ids(text):
    return _TOKENIZER.encode(text or "", add_special_tokens=False).ids


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def token_files(docs):
    """docs: (doc_id, text) in ascending order; null ids first."""
    out, start = [], 0
    for doc, text in docs:
        own = [*ids(text), 2]
        out.append((doc, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    return out


def measures(text):
    text = text or ""
    words = BLANK.findall(text)
    lines = [line for line in text.split("\n") if BLANK.search(line)]
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if grams[tuple(words[i:i + 5])] > 1:
            covered.update(range(i, i + 5))
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), n < 10 or 100 * len(covered) > 20 * n)


def passes(text):
    """The verdict: base rules, then all further ones."""
    n, chars, symbols, dup, _, failed = measures(text)
    text = text or ""
    lines = sum(bool(BLANK.search(line)) for line in text.split("\n"))
    import unicodedata
    kinds = Counter(unicodedata.category(c) for c in text)
    letters = sum(v for k, v in kinds.items() if k[0] == "L")
    words = BLANK.findall(text)
    stutter = sum(a == b for a, b in zip(words, words[1:]))
    return not (failed or 4 * stutter > n or 10 * symbols > n or 2 * dup > lines or chars > 50 * n
                or kinds["Lu"] > kinds["Ll"] or 4 * letters < chars)


_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_secrets(text):
    text = text or ""
    a = [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    b = [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    c = [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    listed = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(a + b + c))
    return len(a), len(b), len(c), sha(listed), listed


def targets(sizes: dict):
    """Of words by source, reshared until no target is above three times its source."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped: set = set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in capped)
        open_ = sum(weight[s] for s in names if s not in capped)
        goal = {s: 3 * sizes[s] if s in capped else left * weight[s] / open_ for s in names}
        over = {s for s in names if goal[s] > 3 * sizes[s] and s not in capped}
        if not over:
            return goal
        capped |= over


FOLD_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold_words(text):
    return FOLD_WORD.findall((text or "").translate(ASCII_LOWER))


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        words = fold_words(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows[tuple(words[i:i + size])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        words, hit, found = fold_words(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if got := windows.get(tuple(words[i:i + size])):
                    hit.update(range(i, i + size))
                    found |= got
        found.discard(None)
        listed = ",".join(sorted(map(str, found)))
        out.append((doc, len(words), len(hit), len(found), sha(listed), bool(hit)))
    return out


def shingles(text):
    words = BLANK.findall((text or "").translate(ASCII_LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def near_duplicates(docs):
    """Component by doc_id (unique ids)."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ordered = sorted(sets)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d), root(d) == d) for d in sets}


def repeats(docs):
    """docs: (doc_id, text); ids ascending, equal ids do not remove from one another, null last."""
    first, out = {}, []
    for rank, (doc, text) in enumerate(docs):
        data = (text or "").encode()
        key = (doc is None, doc or 0)
        for p in range(len(data) - 49):
            first.setdefault(data[p:p + 50], key)
    for doc, text in docs:
        data = (text or "").encode()
        key = (doc is None, doc or 0)
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p:p + 50]] < key:
                gone[p:p + 50] = b"\x01" * 50
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((doc, len(data), sum(gone), runs, sha(kept)))
    return out


MARKOV_ALPHABET = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/_=-"


def markov_model(texts):
    """Log ratios of character pairs, as rounded in the scan, from distinct texts."""
    counts = [defaultdict(int), defaultdict(int)]
    for text in set(texts):
        access, hexes = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
        found = [m.group(1) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
        found += re.findall(access, text) + re.findall(hexes, text)
        ordinary = re.findall("[A-Za-z0-9_]{6,}", re.sub(f"{_ASSIGN.pattern}|{access}|{hexes}", " ", text))
        # Random strings are learnt from labelled texts only, and from 16 characters on.
        for n, strings in enumerate(([s for s in found if len(s) >= 16], ordinary)):
            for s in strings:
                for a, b in zip(s, s[1:]):
                    if a in MARKOV_ALPHABET and b in MARKOV_ALPHABET:
                        counts[n][a + b] += 1

    def chances(pairs):
        return {a + b: math.log(pairs.get(a + b, 0) + 1) - math.log(sum(pairs.get(a + c, 0) + 1 for c in MARKOV_ALPHABET))
                for a in MARKOV_ALPHABET for b in MARKOV_ALPHABET}

    up, down = (chances(c) for c in counts)
    return {pair: float(f"{up[pair] - down[pair]:.4f}") for pair in up}


def markov_spans(text, ratios, base):
    """Strings that look random and meet no span of ``base``, as (start, end)."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{2,}", text):
        size, score = len(m.group()), 0.0
        for a, b in zip(m.group(), m.group()[1:]):
            score += ratios[a + b]
        if score >= 12 + 2 * max(0, 16 - size) and score >= 0.3 * (size - 1):
            if not any(a < m.end() and m.start() < b for a, b in base):
                out.append(m.span())
    return out
