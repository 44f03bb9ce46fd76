"""Passages of 50 bytes or more that an earlier document has, found by a suffix index family.

A 50-byte string starts at every byte, far too many to move.  So each string is led by
its anchor, the 16 bytes in it that come first in a random order: equal strings have
equal anchors, and neighbouring strings mostly share one.  Three steps, each a shuffle:

1. Anchors that occur in more than one document are looked for.  A task sends each
   distinct anchor of a batch once, with the smallest document that has it.
2. Only these anchors send their surroundings, which hold all 50-byte strings they lead,
   to the bucket of the anchor.  A batch sends equal surroundings once; later documents
   of the batch that have them too are matched where they are.
   An anchor of a line that many documents have meets another text around it in each.  Buckets
   that would hold many places are known from step 1; there every string goes by its own
   hash to one of several parts of the bucket, and strings that a row repeats go once.
3. In a bucket documents come in ascending order, in batches.  A batch gets its suffix
   array (the starts of its strings in the order of their fingerprints), is merge-scanned
   against the arrays of earlier batches for strings of smaller documents, and joins them;
   arrays of about equal size are merged, so there are logarithmically many.

Suffixes are ordered by the fingerprint of their first 50 bytes and not by the bytes
themselves: only equality over 50 bytes matters here, and it is the same order anywhere.
A fingerprint is compared inside the bucket of one anchor hash range only.
"""

from __future__ import annotations

import ctypes
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tvtrail.llm.common import discard, packed, setting, settle, text_bytes, unpacked, utf8
from tvtrail.llm.shingles import mix

LENGTH = 50
ANCHOR = 16
REACH = LENGTH - ANCHOR + 1
NO_ID = (1 << 63) - 1
# Text of one batch in a task, of one numpy step, and of what one bucket stands for.
BATCH_BYTES = 6 << 20
STEP_BYTES = 1 << 19
BUCKET_BYTES = 4 << 20
INDEX_BATCH = 1 << 19
# Places of shared anchors from which on a bucket is divided, and those of one part.
HOT_PLACES = 250_000
PART_PLACES = 30_000
# Text of the documents whose results are gathered by one task.
DEST_BYTES = 32 << 20

_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_LETTERS = np.random.default_rng(50).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_ORDER = np.uint64(0xD6E8FEB86659FD93)


def gram_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of all strings of ``length`` bytes, from those of halves."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    size, part = 1, _LETTERS[data]
    out, done = None, 0
    left = length
    while True:
        if left & 1:
            if out is None:
                out, done = part, size
            else:  # the part goes before what there is
                n = len(data) - size - done + 1
                out = part[:n] * np.uint64(pow(_BASE, done, 1 << 64)) + out[size:size + n]
                done += size
        left >>= 1
        if not left:
            return mix(out)
        part = part[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) + part[size:]
        size *= 2


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _steps(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of texts side by side: (bytes, text number, place in its text, bytes left in the piece).

    A long text is cut into pieces that overlap by 49 bytes, so that each string of 50
    starts in exactly one piece.
    """
    pieces, size = [], 0

    def made():
        data = np.frombuffer(b"".join(p[2] for p in pieces), np.uint8)
        lengths = np.array([len(p[2]) for p in pieces])
        first = np.cumsum(lengths) - lengths
        inside = np.arange(len(data)) - np.repeat(first, lengths)
        return (data, np.repeat([p[0] for p in pieces], lengths), np.repeat([p[1] for p in pieces], lengths) + inside,
                np.repeat(lengths, lengths) - inside)

    for n, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), STEP_BYTES):
            piece = text[at:at + STEP_BYTES + LENGTH - 1]
            if len(piece) >= LENGTH:
                if pieces and size + len(piece) > STEP_BYTES:
                    yield made()
                    pieces, size = [], 0
                pieces.append((n, at, piece))
                size += len(piece)
    if pieces:
        yield made()


def anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per step: anchor hash, text number, anchor place, first and last start of the strings it leads."""
    for data, text, place, left in _steps(texts):
        hashes = gram_hashes(data, ANCHOR)
        here = np.arange(len(hashes), dtype=np.uint64)
        low = np.uint64(20)
        # Smallest in an order of its own, so that anchors spread over all hashes; then leftmost.
        leader = _smallest((hashes * _ORDER >> low << low) | here, REACH)
        starts = np.flatnonzero(left[:len(leader)] >= LENGTH)
        led_by = (leader[starts] & np.uint64((1 << 20) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], led_by[1:] != led_by[:-1])))
        last = np.concatenate((first[1:], [len(starts)])) - 1
        anchor = led_by[first]
        yield hashes[anchor], text[anchor], place[anchor], place[starts[first]], place[starts[last]]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """The rows of a task in lists of bounded text size."""
    rows, size = None, 0
    for batch in batches:
        names = batch.schema.names
        columns = [utf8(batch.column(i)) if n == "text" else batch.column(i).to_pylist() for i, n in enumerate(names)]
        for values in zip(*columns):
            row = dict(zip(names, values))
            rows = rows if rows is not None else {name: [] for name in names}
            for name, value in row.items():
                rows[name].append(value)
            size += len(row["text"])
            if size >= BATCH_BYTES:
                yield rows
                rows, size = None, 0
    if rows:
        yield rows


def _tidy() -> None:
    """Give memory that is free back to the system; two workers share a task's place in this operator."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def _buckets_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a hash: equal ranges of its upper half."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _split(order_key: np.ndarray) -> Iterator[tuple[int, int]]:
    """(from, to) of the runs of a sorted array."""
    at = _runs(order_key)
    yield from zip(at, np.concatenate((at[1:], [len(order_key)])))


_ENTRIES = "dest bigint, ids binary, ties binary, starts binary, lengths binary"
_KINDS = (np.int64, np.int64, np.uint32, np.uint32)


def _dest_of(ids: np.ndarray, dests: int) -> np.ndarray:
    return (mix(ids.view(np.uint64)) % np.uint64(dests)).astype(np.int64)


def _packed(columns: tuple[np.ndarray, ...], dests: int) -> Iterator[tuple]:
    """Entries (id, tie, start, length) as one row per destination, a group of documents."""
    dest = _dest_of(columns[0], dests)
    order = np.argsort(dest, kind="stable")
    dest, columns = dest[order], [c[order] for c in columns]
    if len(dest):
        for a, b in _split(dest):
            yield int(dest[a]), *(c[a:b].astype(k).tobytes() for c, k in zip(columns, _KINDS))


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, ...]:
    return tuple(
        np.frombuffer(b"".join(rows[c]), k) for c, k in zip(("ids", "ties", "starts", "lengths"), _KINDS))


def _by_document(rows: pd.DataFrame) -> pd.DataFrame:
    """One row per document of a destination, with all its entries."""
    ids, ties, starts, lengths = _unpacked(rows)
    if not len(ids):
        return pd.DataFrame({"id": ids, "tie": ties, "starts": [], "lengths": []})
    order = np.lexsort((starts, ties, ids))
    ids, ties, starts, lengths = ids[order], ties[order], starts[order], lengths[order]
    first = np.flatnonzero(np.concatenate(([True], (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1]))))
    last = np.concatenate((first[1:], [len(ids)]))
    return pd.DataFrame({
        "id": ids[first], "tie": ties[first],
        "starts": [starts[a:b].tobytes() for a, b in zip(first, last)],
        "lengths": [lengths[a:b].tobytes() for a, b in zip(first, last)],
    })


_POSTINGS = f"bucket bigint, keys binary, {_ENTRIES}"


def _record_batches(out: list[tuple], names: list[str]) -> Iterator[pa.RecordBatch]:
    kinds = {"bucket": pa.int64(), "dest": pa.int64()}
    for a in range(0, len(out), 1024):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, kinds.get(n, pa.binary())) for c, n in zip(zip(*out[a:a + 1024]), names)], names)


def _send_anchors(buckets: int, dests: int):
    """Distinct anchors of a batch, by bucket, with their smallest document.

    Anchors that several documents of the batch have are known to be shared: all places
    of them go out as found already (rows without keys).  ``lengths`` counts the places that
    an entry stands for.
    """
    names = ["bucket", "keys", "dest", "ids", "ties", "starts", "lengths"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _batches(batches):
            ids = np.array(rows["id"], np.int64)
            parts = [(k, ids[t], p) for k, t, p, _, _ in anchors(rows["text"])]
            if not parts:
                continue
            keys, owner, place = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((owner, keys))
            keys, owner, place = keys[order], owner[order], place[order]
            first = _runs(keys)
            counts = np.diff(np.concatenate((first, [len(keys)])))
            shared = np.repeat(owner[first] != owner[first + counts - 1], counts)
            # A shared anchor goes out once, others at every place they have.
            sent = ~shared
            sent[first] = True
            where = _buckets_of(keys[sent], buckets)
            stands = np.where(shared, np.repeat(counts, counts), 1)[sent].astype(np.uint32)
            out = [(int(where[a]), keys[sent][a:b].tobytes(), 0, owner[sent][a:b].tobytes(), b"",
                    place[sent][a:b].astype(np.uint32).tobytes(), stands[a:b].tobytes()) for a, b in _split(where)]
            none = np.zeros(int(shared.sum()), np.int64)
            for dest, *entries in _packed((owner[shared], none, place[shared], none), dests):
                out.append((dest % buckets, b"", dest, *entries))
            yield from _record_batches(out, names)
            _tidy()

    return run


_SHARED = f"{_ENTRIES}, bucket bigint, places bigint"
_FOUND = "id bigint, tie bigint, starts binary, lengths binary"


def _shared_anchors(dests: int):
    """Places of anchors that more than one document has, by destination; and how many the bucket has."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        known = rows["keys"].map(len) == 0
        none = (None, None)
        out = [(*r, *none) for r in rows.loc[known, ["dest", "ids", "ties", "starts", "lengths"]].itertuples(index=False)]
        sent = rows[~known]
        if len(sent):
            keys, owner, place, stands = (np.frombuffer(b"".join(sent[c]), t) for c, t in (
                ("keys", np.uint64), ("ids", np.int64), ("starts", np.uint32), ("lengths", np.uint32)))
            order = np.lexsort((owner, keys))
            keys, owner, place, stands = keys[order], owner[order], place[order], stands[order]
            first = _runs(keys)
            counts = np.diff(np.concatenate((first, [len(keys)])))
            many = np.repeat(owner[first] != owner[first + counts - 1], counts)
            zeros = np.zeros(int(many.sum()), np.int64)
            out += [(*r, *none) for r in _packed((owner[many], zeros, place[many], zeros), dests)]
            out.append((int(key[0]) % dests, b"", b"", b"", b"", int(key[0]), int(stands[many | (stands > 1)].sum())))
        names = ["dest", "ids", "ties", "starts", "lengths", "bucket", "places"]
        _tidy()
        return pd.DataFrame(out, columns=names).astype({"bucket": "Int64", "places": "Int64"})

    return run


def _places_by_document(rows: pd.DataFrame) -> pd.DataFrame:
    """As ``_by_document``, with the counts of buckets as rows without id."""
    counted = rows["bucket"].notna()
    documents, counts = _by_document(rows[~counted]), rows.loc[counted, ["bucket", "places"]]
    # Nullable integers throughout: ids and hashes need all their 64 bits.
    parts = [documents.astype({"id": "Int64", "tie": "Int64"}), counts.astype("Int64")]
    names = {"id": "Int64", "tie": "Int64", "starts": object, "lengths": object, "bucket": "Int64", "places": "Int64"}
    return pd.DataFrame({
        n: pd.concat([p[n] if n in p else pd.Series([None] * len(p), dtype=kind) for p in parts], ignore_index=True).astype(kind)
        for n, kind in names.items()})


_SURROUNDINGS = f"bucket bigint, texts binary, {_ENTRIES}"


def _send_surroundings(buckets: int, dests: int):
    """Surroundings of shared anchors by bucket; equal ones of a batch once, from the smallest document.

    Rows without texts are spans matched in the batch itself.
    """
    names = ["bucket", "texts", "dest", "ids", "ties", "starts", "lengths"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _batches(batches):
            texts, ids, ties = rows["text"], np.array(rows["id"], np.int64), np.array(rows["tie"], np.int64)
            wanted = [np.unique(np.frombuffer(p, np.uint32)) for p in rows["places"]]
            sizes = np.array([len(w) for w in wanted])
            marks = np.repeat(np.arange(len(wanted)), sizes) << 32 | np.concatenate(wanted).astype(np.int64)
            parts = []
            for k, t, p, low, high in anchors(texts):
                mark = t.astype(np.int64) << 32 | p
                keep = marks[np.minimum(np.searchsorted(marks, mark), len(marks) - 1)] == mark
                parts.append((k[keep], t[keep], low[keep], high[keep] + LENGTH - low[keep]))
            if not parts:
                continue
            keys, text, start, length = (np.concatenate(c) for c in zip(*parts))
            if not len(keys):
                continue
            around = [texts[t][s:s + n] for t, s, n in zip(text.tolist(), start.tolist(), length.tolist())]
            same = pd.factorize(pd.Series(around, dtype=object))[0]
            order = np.lexsort((start, ids[text], same))
            same, keys, text, start, length = same[order], keys[order], text[order], start[order], length[order]
            owner, tie = ids[text], ties[text]
            first = _runs(same)
            matched = owner > np.repeat(owner[first], np.diff(np.concatenate((first, [len(same)]))))
            out = []
            for dest, *entries in _packed((owner[matched], tie[matched], start[matched], length[matched]), dests):
                out.append((dest % buckets, b"", dest, *entries))
            send = np.flatnonzero(~matched)
            where = _buckets_of(keys[send], buckets)
            by = np.lexsort((keys[send], where))  # an anchor's surroundings together
            send, where = send[by], where[by]
            for a, b in _split(where):
                part = send[a:b]
                out.append((int(where[a]), b"".join(around[r] for r in order[part].tolist()), 0, *(
                    c[part].astype(k).tobytes() for c, k in zip((owner, tie, start, length), _KINDS))))
            yield from _record_batches(out, names)
            _tidy()

    return run


class IndexFamily:
    """Suffix arrays of sizes that grow geometrically, each with the smallest document per string."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []

    def scan_and_add(self, strings: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Which of a batch's strings (fingerprints) a smaller document has; the batch joins the family."""
        order = np.argsort(strings, kind="stable")  # documents ascend, so the first is the smallest
        ordered, who = strings[order], owner[order]
        first = _runs(ordered)
        found = who > np.repeat(who[first], np.diff(np.concatenate((first, [len(ordered)]))))
        new, least = ordered[first], who[first]
        for level, ids in self.levels:
            at = np.minimum(np.searchsorted(level, new), len(level) - 1)
            older = np.where(level[at] == new, ids[at], NO_ID)
            found |= np.repeat(older, np.diff(np.concatenate((first, [len(ordered)])))) < who
        while self.levels and len(self.levels[-1][0]) <= 2 * len(new):
            old, ids = self.levels.pop()
            both, least = np.concatenate((old, new)), np.concatenate((ids, least))
            merged = np.argsort(both, kind="stable")  # two sorted runs; the older one first
            both, least = both[merged], least[merged]
            keep = _runs(both)
            new, least = both[keep], least[keep]
        self.levels.append((new, least))
        out = np.empty(len(found), bool)
        out[order] = found
        return out


_DEALT = f"bucket bigint, part bigint, texts binary, strings binary, {_ENTRIES}"


def _strings(data, length) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All strings of surroundings that lie one after another: fingerprint, surrounding, place in it."""
    lengths = length.astype(np.int64)
    ends = np.cumsum(lengths)
    inside = np.arange(len(data)) - np.repeat(ends - lengths, lengths)
    entry = np.repeat(np.arange(len(lengths)), lengths)
    whole = np.flatnonzero(inside + LENGTH <= lengths[entry])
    return gram_hashes(data, LENGTH)[whole], entry[whole], inside[whole]


def _joined(owner, tie, start) -> tuple[np.ndarray, ...]:
    """Spans of strings: those at neighbouring places of a text become one."""
    order = np.lexsort((start, tie, owner))
    owner, tie, start = owner[order], tie[order], start[order].astype(np.int64)
    if not len(owner):
        return owner, tie, start, start
    gap = (owner[1:] != owner[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(np.concatenate(([True], gap)))
    last = np.concatenate((first[1:], [len(owner)])) - 1
    return owner[first], tie[first], start[first], start[last] - start[first] + LENGTH


def _deal_strings(buckets: int, dests: int):
    """Rows of ordinary buckets as they are; the strings of the others, by their hash, to the parts.

    Strings that several documents of a row have go out once, from the smallest; for the others
    they are found already.
    """
    kinds = {n: pa.int64() for n in ("bucket", "part", "dest")}
    names = [c.split()[0] for c in _DEALT.split(", ")]

    def dealt(row: dict) -> Iterator[tuple]:
        lengths = np.frombuffer(row["lengths"], np.uint32)
        ends = np.cumsum(lengths, dtype=np.int64)
        cuts = np.unique(np.append(np.searchsorted(ends, np.arange(STEP_BYTES, int(ends[-1]), STEP_BYTES)), len(ends)))
        columns = [np.frombuffer(row[c], k) for c, k in zip(("ids", "ties", "starts"), _KINDS)]
        for a, b in zip([0, *cuts], cuts):
            if a < b:
                data = np.frombuffer(row["texts"], np.uint8)[ends[a] - lengths[a]:ends[b - 1]]
                yield from some(row, data, *(c[a:b] for c in columns), lengths[a:b])

    def some(row: dict, data, owner, tie, start, length) -> Iterator[tuple]:
        strings, entry, inside = _strings(data, length)
        owner, tie, start = owner[entry], tie[entry], start[entry] + inside
        order = np.lexsort((owner, strings))
        strings, owner, tie, start = strings[order], owner[order], tie[order], start[order]
        first = _runs(strings)
        found = owner > np.repeat(owner[first], np.diff(np.concatenate((first, [len(strings)]))))
        for dest, *entries in _packed(_joined(owner[found], tie[found], start[found]), dests):
            yield (dest % buckets, 0, b"", b"", dest, *entries)
        send = np.flatnonzero(~found)
        part = (mix(strings[send]) % np.uint64(row["parts"])).astype(np.int64)
        by = np.argsort(part, kind="stable")
        send, part = send[by], part[by]
        for a, b in _split(part):
            one = send[a:b]
            yield (row["bucket"], int(part[a]), b"", strings[one].tobytes(), 0, owner[one].tobytes(), tie[one].tobytes(),
                   start[one].astype(np.uint32).tobytes(), b"")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hot = np.array([p is not None and n > 0 for p, n in zip(
                batch.column("parts").to_pylist(), pc.binary_length(batch.column("texts")).to_pylist())], bool)
            plain = batch.filter(pa.array(~hot))
            if plain.num_rows:
                more = {"part": pa.array(np.zeros(plain.num_rows, np.int64)), "strings": pa.array([b""] * plain.num_rows, pa.binary())}
                yield pa.RecordBatch.from_arrays([more[n] if n in more else plain.column(n) for n in names], names)
            for n in np.flatnonzero(hot).tolist():
                out = dealt(batch.slice(n, 1).to_pylist()[0])
                while rows := list(itertools.islice(out, 256)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.binary())) for c, n in zip(zip(*rows), names)], names)
                _tidy()

    return run


def _scan_bucket(dests: int):
    """Spans of the strings of a bucket, or of its part, that a smaller document has, by destination."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        texts, strings = rows["texts"].map(len) > 0, rows["strings"].map(len) > 0
        out = [tuple(r) for r in rows.loc[~(texts | strings), ["dest", "ids", "ties", "starts", "lengths"]].itertuples(index=False)]
        sent = rows[texts]
        if len(sent):
            out += _packed(_spans(np.frombuffer(b"".join(sent["texts"]), np.uint8), *_unpacked(sent)), dests)
        alone = rows[strings]
        if len(alone):
            out += _packed(_string_spans(np.frombuffer(b"".join(alone["strings"]), np.uint64), *_unpacked(alone)[:3]), dests)
        _tidy()
        return pd.DataFrame(out, columns=["dest", "ids", "ties", "starts", "lengths"])

    return run


def _string_spans(strings, owner, tie, start) -> tuple[np.ndarray, ...]:
    """As ``_spans``, for strings that come one by one."""
    order = np.argsort(owner, kind="stable")
    family, found = IndexFamily(), np.zeros(len(strings), bool)
    for at in range(0, len(order), INDEX_BATCH):
        batch = order[at:at + INDEX_BATCH]
        found[batch] = family.scan_and_add(strings[batch], owner[batch])
    return _joined(owner[found], tie[found], start[found])


def _spans(data, owner, tie, start, length) -> tuple[np.ndarray, ...]:
    """Entries of strings that a smaller document has; ``data`` holds the surroundings one after another."""
    at = np.cumsum(length, dtype=np.int64) - length
    order = np.argsort(owner, kind="stable")
    family, spans = IndexFamily(), []
    counts = length.astype(np.int64)[order] - LENGTH + 1
    cuts = np.searchsorted(np.cumsum(counts), np.arange(INDEX_BATCH, int(counts.sum()) + INDEX_BATCH, INDEX_BATCH))
    for a, b in zip(np.concatenate(([0], cuts + 1)), np.concatenate((cuts + 1, [len(order)]))):
        batch = order[a:min(b, len(order))]
        if not len(batch):
            continue
        lengths = length[batch].astype(np.int64)
        ends = np.cumsum(lengths)
        inside = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths)
        entry = np.repeat(np.arange(len(batch)), lengths)
        whole = np.flatnonzero(inside + LENGTH <= lengths[entry])
        strings = gram_hashes(data[at[batch][entry] + inside], LENGTH)[whole]
        found = whole[family.scan_and_add(strings, owner[batch][entry[whole]])]
        if len(found):
            gap = np.concatenate(([True], (found[1:] != found[:-1] + 1) | (entry[found[1:]] != entry[found[:-1]])))
            first = np.flatnonzero(gap)
            last = np.concatenate((first[1:], [len(found)])) - 1
            rows = batch[entry[found[first]]]
            spans.append((owner[rows], tie[rows], start[rows] + inside[found[first]], found[last] - found[first] + LENGTH))
    if not spans:
        return tuple(np.zeros(0, k) for k in _KINDS)
    return tuple(np.concatenate(c) for c in zip(*spans))


def _cut(text: bytes, starts: bytes, lengths: bytes) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs, and what is left."""
    cover = np.zeros(len(text) + 1, np.int32)
    begin = np.frombuffer(starts, np.uint32).astype(np.int64)
    np.add.at(cover, begin, 1)
    np.add.at(cover, begin + np.frombuffer(lengths, np.uint32), -1)
    gone = np.cumsum(cover[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist())), np.frombuffer(text, np.uint8)[~gone].tobytes()


def _remove(texts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    kind = pa.struct([("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
    for text, starts, lengths in texts:
        rows = []
        for t, s, n in zip(utf8(text), starts.to_pylist(), lengths.to_pylist()):
            spans, kept = _cut(t, s, n) if s else ([], t)
            rows.append({"spans": [{"start": a, "end": b} for a, b in spans], "kept": kept})
        yield pa.array(rows, kind)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", into: str = "repeats") -> DataFrame:
    """``docs`` with a struct: spans (removed bytes, end exclusive, maximal) and kept (the rest, as bytes).

    A byte goes if a 50-byte string over it also starts in a document of smaller key,
    judged on the input.  Rows of equal key never remove from one another; a null key is
    larger than any other; a null text is empty.
    """
    total = docs.agg(F.sum(text_bytes(F.col(f"`{text}`")))).first()[0] or 0
    buckets, dests = max(1, -(-total // BUCKET_BYTES)), max(1, -(-total // DEST_BYTES))
    own_id = F.coalesce(F.col(f"`{key}`").cast("bigint"), F.lit(NO_ID))
    own_text = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    own_tie = F.xxhash64(own_text)
    plain = docs.select(own_id.alias("id"), own_tie.alias("tie"), own_text.alias("text"))
    shared = settle(
        plain.select("id", "text").mapInArrow(_send_anchors(buckets, dests), _POSTINGS)
        .groupBy("bucket").applyInPandas(_shared_anchors(dests), _SHARED)
        .groupBy("dest").applyInPandas(_places_by_document, f"{_FOUND}, bucket bigint, places bigint"), "shared-anchors")
    # Stored by itself, so that Spark knows how small it is.
    hot = settle(shared.where(F.col("places") > HOT_PLACES).select(
        "bucket", F.ceil(F.col("places") / PART_PLACES).alias("parts")), "hot-buckets")
    places = shared.where(F.col("id").isNotNull()).select("id", F.col("starts").alias("places"))
    # A row holds a batch's share of a bucket: few of them make an Arrow batch.
    with setting(docs.sparkSession, _ARROW_ROWS, "16"):
        spans = settle(
            plain.join(places.hint("shuffle_hash"), "id")
            .select("id", "tie", "text", "places")
            .mapInArrow(_send_surroundings(buckets, dests), _SURROUNDINGS)
            .join(hot, "bucket", "left")
            .mapInArrow(_deal_strings(buckets, dests), _DEALT)
            .groupBy("bucket", "part").applyInPandas(_scan_bucket(dests), _ENTRIES)
            .groupBy("dest").applyInPandas(_by_document, _FOUND), "repeat-spans")
    discard(shared, hot)
    by_row = spans.toDF("_id", "_tie", "_starts", "_lengths")
    rows = packed(docs, _id=own_id, _tie=own_tie).join(by_row.hint("shuffle_hash"), ["_id", "_tie"], "left")
    cut = F.arrow_udf(_remove, "struct<spans:array<struct<start:bigint,end:bigint>>,kept:binary>")
    return unpacked(rows, **{into: cut(F.coalesce(F.col("_row")[text], F.lit("")), F.col("_starts"), F.col("_lengths"))})
