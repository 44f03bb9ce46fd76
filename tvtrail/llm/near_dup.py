"""Near-duplicate documents: SetSketch registers, banded, estimated, then verified.

Every shingle set is summed up by registers: the logarithm, to a base near 1, of the
smallest of exponentially distributed hashes, so registers of a union are the maxima
of the parts' registers and equal registers tell of similar sets.  Documents that agree
on all registers of some band are candidates; the likelihood of the registers' order,
given both set sizes, estimates the similarity; pairs that may reach the threshold are
confirmed on their full sets.

Documents of equal sets are one class.  In a band's bucket every class is first
compared with the smallest one only, so a bucket costs its size and not its square.
Links make components; a bucket whose classes are one component is settled, since no
further link could change anything.  In the other buckets all pairs across components
are looked at, in blocks spread over tasks: on registers first, then, where the estimate
allows, on the full sets at once, so that only confirmed links leave a task.  Buckets
with the same classes are looked at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tvtrail.llm.common import discard, packed, row_hash, settle, unpacked, utf8
from tvtrail.llm.components import components
from tvtrail.llm.shingles import batches, mix, shingle_sets

SIMILARITY = 75  # per cent
BANDS = 32
BAND_REGISTERS = 4
REGISTERS = BANDS * BAND_REGISTERS
# SetSketch parameters: base, rate and largest register.
BASE, RATE, TOP = 1.001, 20.0, 65_534
# Pairs estimated below are not verified; more than five standard errors under the threshold.
MIN_ESTIMATE = 0.55
BLOCK = 512
CHUNK_PAIRS = 1 << 15

_RANDOM = np.random.default_rng(97)
_FLIP = _RANDOM.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_TIMES = _RANDOM.integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_BAND = _RANDOM.integers(0, 1 << 63, (BANDS, BAND_REGISTERS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers of non-empty sets of 64-bit hashes, one row per set."""
    out = np.empty((len(sets), REGISTERS), np.uint16)
    if not sets:
        return out
    hashes = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    for k in range(REGISTERS):
        draws = (hashes ^ _FLIP[k]) * _TIMES[k]
        draws ^= draws >> np.uint32(16)
        least = np.minimum.reduceat(draws, at).astype(np.float64)
        smallest = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
        out[:, k] = np.clip(np.floor(1 - np.log(smallest) / np.log(BASE)), 0, TOP)
    return out


def band_keys(rows: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per band; equal where all registers of the band are."""
    parts = rows.reshape(len(rows), BANDS, BAND_REGISTERS).astype(np.uint64)
    keys = (mix(parts + np.uint64(1)) * _BAND).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)
    return mix(keys).view(np.int64)


def likeliest(above: np.ndarray, below: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity of greatest likelihood for set sizes n, m and counts of larger and smaller registers."""
    u, v = n / (n + m), m / (n + m)
    equal = REGISTERS - above - below

    def chance(x):
        return -np.log1p(-np.clip(x, 1e-12, 1.0) * (BASE - 1) / BASE) / np.log(BASE)

    def score(j):
        more, fewer = chance(u - v * j), chance(v - u * j)
        return above * np.log(more) + below * np.log(fewer) + equal * np.log(np.maximum(1 - more - fewer, 1e-12))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak
        a, b = low + (high - low) / 3, high - (high - low) / 3
        left = score(a) < score(b)
        low, high = np.where(left, a, low), np.where(left, high, b)
    return (low + high) / 2


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, REGISTERS)


_SKETCH = "struct<n:bigint,digest:binary,bands:array<bigint>,registers:binary>"


def _sketch(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """An empty set has n = 0, no digest and no bands."""
    for column in texts:
        n, digests, bands, rows = [], [], [], []
        for part in batches(utf8(column)):
            sets = shingle_sets(part)
            full = [s for s in sets if len(s)]
            made = registers(full)
            keys, at = band_keys(made), 0
            for s in sets:
                n.append(len(s))
                digests.append(blake2b(s.astype("<u8").tobytes(), digest_size=16).digest() if len(s) else None)
                bands.append(keys[at] if len(s) else [])
                rows.append(made[at].astype("<u2").tobytes() if len(s) else None)
                at += bool(len(s))
        yield pa.StructArray.from_arrays(
            [pa.array(n, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
             pa.array(rows, pa.binary())], ["n", "digest", "bands", "registers"])


def _set(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in texts:
        yield pa.array(
            [s.view(np.int64) for part in batches(utf8(column)) for s in shingle_sets(part)], pa.list_(pa.int64()))


def _estimate(n: pa.Array, m: pa.Array, first: pa.Array, second: pa.Array) -> pa.Array:
    if not len(n):
        return pa.array([], pa.float64())
    a, b = _matrix(first.to_pylist()), _matrix(second.to_pylist())
    sizes = (x.to_numpy(zero_copy_only=False).astype(np.float64) for x in (n, m))
    return pa.array(likeliest((a > b).sum(axis=1), (a < b).sum(axis=1), *sizes))


def sketches(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Settled (id, n, digest, bands, registers), one row per document row."""
    return settle(
        docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.arrow_udf(_sketch, _SKETCH)(F.col(f"`{text}`")).alias("s"))
        .select("id", "s.*"), "sketches")


def _sets(docs: DataFrame, text: str, key: str, wanted: DataFrame) -> DataFrame:
    """Settled (node, set) of the ids in ``wanted`` (node)."""
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("node"), F.col(f"`{text}`").alias("text"))
    # Hashed on the ids, so that texts are neither sorted nor, at some sizes only, left in place.
    return settle(rows.join(wanted.hint("shuffle_hash"), "node", "left_semi").select(
        "node", F.arrow_udf(_set, "array<bigint>")("text").alias("set")), "shingle-sets")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Of (a, b) pairs those whose full sets are similar enough, settled."""
    first, second = (sets.toDF(x, f"set_{x}") for x in "ab")
    shared = F.size(F.array_intersect("set_a", "set_b")).cast("bigint")
    whole = F.size("set_a") + F.size("set_b") - shared
    return settle(
        pairs.hint("shuffle_hash").join(first, "a").join(second, "b").where(shared * 100 >= whole * similarity).select("a", "b").distinct(),
        "links")


def _near_pairs(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, apart: np.ndarray):
    """Places (i, j) where ``apart`` holds and the estimate allows a link, best first."""
    equal = np.zeros(apart.shape, np.int16)
    for k in range(REGISTERS):
        equal += a[:, k, None] == b[None, :, k]
    left, right = np.nonzero(apart & (equal >= int(REGISTERS * (MIN_ESTIMATE - 0.1))))
    guess = np.zeros(len(left))
    for at in range(0, len(left), CHUNK_PAIRS):
        i, j = left[at:at + CHUNK_PAIRS], right[at:at + CHUNK_PAIRS]
        x, y = a[i], b[j]
        guess[at:at + CHUNK_PAIRS] = likeliest((x > y).sum(axis=1), (x < y).sum(axis=1), n[i], m[j])
    good = np.flatnonzero(guess >= MIN_ESTIMATE)
    good = good[np.argsort(-guess[good], kind="stable")]
    return left[good].tolist(), right[good].tolist()


def _link_blocks(similarity: int):
    """Confirmed links across components between two blocks of a bucket.

    A link joins its components, so pairs that it makes needless are skipped.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", ignore_index=True)
        one, two = rows[rows["block"] == rows["one"]], rows[rows["block"] == rows["two"]]
        comp_a, comp_b = one["component"].to_numpy(), two["component"].to_numpy()
        apart = comp_a[:, None] != comp_b[None, :]
        if rows["one"].iloc[0] == rows["two"].iloc[0]:
            apart = np.triu(apart, 1)
        left, right = _near_pairs(
            _matrix(one["registers"]), _matrix(two["registers"]), one["n"].to_numpy(float), two["n"].to_numpy(float), apart)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        sets_a, sets_b = one["set"].tolist(), two["set"].tolist()
        nodes_a, nodes_b = one["node"].tolist(), two["node"].tolist()
        found = []
        for i, j in zip(left, right):
            x, y = find(comp_a[i]), find(comp_b[j])
            if x != y:
                s, t = sets_a[i], sets_b[j]
                shared = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * shared >= similarity * (len(s) + len(t) - shared):
                    found.append((nodes_a[i], nodes_b[j]))
                    root[x] = y
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def _open_buckets(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (key, node, component, size) of buckets of three or more classes in several components.

    Of buckets with the same classes one is kept.
    """
    known = shared.where("size > 2").select("key", "node", "size").join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed = known.groupBy("key", "size").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.bit_xor(F.xxhash64("node")).alias("mark"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("more"),
    ).where("low <> high")
    once = settle(mixed.groupBy("size", "mark", "more").agg(F.min("key").alias("key")).select("key"), "mixed-buckets")
    out = settle(known.join(once, "key"), "open-buckets")
    discard(once)
    return out


def _across(buckets: DataFrame, sketch: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """Links across components in open buckets; blocks bound what a task holds."""
    count = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = (
        buckets.withColumn("block", F.pmod(F.xxhash64("node"), count).cast("int"))
        .hint("shuffle_hash").join(sketch, "node").hint("shuffle_hash").join(sets, "node")
        .withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
        .withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    )
    return settle(
        rows.select("key", "node", "component", "n", "registers", "set", "block", "one", "two")
        .groupBy("key", "one", "two").applyInPandas(_link_blocks(similarity), "a bigint, b bigint")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")


def link(
    docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: int = SIMILARITY,
) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and (id, component) of every id that is not alone.

    Ids are nodes: rows of the same id count as one document.  Rows without an id and
    texts without words link with nothing.
    """
    made = sketches(docs, text, key)
    usable = made.where("id IS NOT NULL AND n > 0")
    classes = usable.groupBy("digest").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    # Settled first, so that the join can split the rows of a class that holds many copies.
    copied = settle(classes.where("copies > 1").select("digest", "node"), "copied-classes")
    same = settle(usable.select("id", "digest").join(copied, "digest").select("id", "node").distinct(), "copies")
    first = usable.join(same.where("id <> node").select("id").distinct(), "id", "left_anti")
    nodes = settle(first.dropDuplicates(["id", "digest"]).select(F.col("id").alias("node"), "n", "registers", "bands"), "classes")
    sketch = nodes.select("node", "n", "registers")
    members = nodes.select("node", F.explode("bands").alias("key"))
    # Settled for the same reason: a large family of near copies shares a bucket.
    center = settle(
        members.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("size")).where("size > 1"), "bucket-centers")
    shared = settle(members.join(center, "key"), "shared-buckets")
    stars = settle(shared.where("node <> a").select("a", F.col("node").alias("b")).distinct(), "stars")
    sets = _sets(docs, text, key, stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct())
    one, two = (sketch.toDF(x, f"n_{x}", f"r_{x}") for x in "ab")
    estimate = F.arrow_udf(_estimate, "double")("n_a", "n_b", "r_a", "r_b")
    likely = stars.join(one, "a").join(two, "b").where(estimate >= MIN_ESTIMATE).select("a", "b")
    links = _verified(likely.distinct(), sets, similarity)
    labels = components(links)
    buckets = _open_buckets(shared, labels)
    if not buckets.isEmpty():
        more = _across(buckets, sketch, sets, similarity)
        if not more.isEmpty():
            labels = components(links.unionByName(more))
    discard(copied, center, shared, stars, sets, buckets)
    # Copies belong to the component of their class.
    joined = same.join(labels, "node", "left").select(
        F.col("id").alias("node"), F.coalesce("component", "node").alias("component"))
    every = settle(joined.unionByName(labels).distinct(), "components")
    return made, every.select(F.col("node").alias("id"), "component")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: int = SIMILARITY) -> DataFrame:
    """Per document row: the key, n_shingles, component_id (smallest linked id) and kept."""
    made, labels = link(docs, text, key, similarity)
    return made.select("id", "n").join(labels, "id", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", similarity: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the smallest id, and of an id one row.

    Rows without an id all stay.
    """
    _, labels = link(docs, text, key, similarity)
    gone = labels.where("id <> component").select(F.col("id").alias("_id")).distinct()
    rows = packed(docs, _id=F.col(f"`{key}`").cast("bigint"), _tie=row_hash(docs))
    named = rows.where("_id IS NOT NULL").join(gone, "_id", "left_anti")
    place = F.row_number().over(Window.partitionBy("_id").orderBy("_tie"))
    first = named.withColumn("_place", place).where("_place = 1").select("_row")
    return unpacked(first.unionByName(rows.where("_id IS NULL").select("_row")))
