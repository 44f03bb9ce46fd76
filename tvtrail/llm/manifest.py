"""Merkle manifest of a data set, and proofs climbed by a recursive query.

Each row is a leaf.  The leaves of a group, in order, are hashed two by two up to the
group's root; the roots of the groups, in order, likewise up to the root of all.
Levels are stored every ``HEIGHT`` levels, as node rows that link to their parent, the node
``HEIGHT`` levels up, and hold the siblings on the way; a leaf's own row is the first of its
way.  A recursive query then climbs from every leaf at once, appends the siblings and folds
the leaf's hash with them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructType

from tvtrail.llm.common import discard, number_rows, setting, settle

# Levels from a stored node to its parent; a task group holds 2 ** HEIGHT hashes.
HEIGHT = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_TOP = -1  # level of a climber that has arrived
_PATH = ArrayType(StructType().add("before", "binary").add("after", "binary"))
# A climb takes a step per stored level, whatever the number of leaves.
_ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

_FOLD = "aggregate({path}, {hash}, (hash, step) -> sha2(concat(lower(hex(step.before)), hash, lower(hex(step.after))), 256))"
_APPEND = "aggregate({path}, {proof}, (found, step) -> concat(found, step.before, step.after))"
CLIMB = f"""WITH RECURSIVE climb(leaf, node, level, folded, proof) AS (
    SELECT leaf, parent, parent_level, {_FOLD.format(path='path', hash='folded')}, {_APPEND.format(path='path', proof="X''")}
    FROM {{leaves}}
  UNION ALL
    SELECT c.leaf, n.parent, n.parent_level, {_FOLD.format(path='n.path', hash='c.folded')}, {_APPEND.format(path='n.path', proof='c.proof')}
    FROM climb c JOIN {{nodes}} n ON n.node = c.node AND n.level = c.level)
SELECT leaf, folded, proof FROM climb WHERE level = {_TOP}"""


def leaf_hash(values: list[Column]) -> Column:
    """Hash of a row: of each value its UTF-8 length, a colon and the value, or ``-`` for null."""
    def told(value: Column) -> Column:
        written = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))

    return F.sha2(F.concat(*[told(v) for v in values]), 256)


def parent_hash(hashes: list[str]) -> str:
    return hashlib.sha256("".join(hashes).encode()).hexdigest()


def fold_block(hashes: list[str], height: int) -> tuple[list[list[dict]], str]:
    """Of consecutive nodes below one parent ``height`` levels up: each one's steps, and the parent."""
    paths: list[list[dict]] = [[] for _ in hashes]
    level = hashes
    for h in range(height):
        raw = [bytes.fromhex(x) for x in level]
        for k, path in enumerate(paths):
            at = k >> h
            path.append({
                "before": raw[at - 1] if at % 2 else b"",
                "after": raw[at + 1] if at % 2 == 0 and at + 1 < len(raw) else b""})
        level = [parent_hash(level[k:k + 2]) for k in range(0, len(level), 2)]
    return paths, level[0]


def _fold(block: pa.Table) -> pa.Table:
    block = block.sort_by("_place")
    paths, top = fold_block(block["hash"].to_pylist(), block["_height"][0].as_py())
    step = pa.struct([("before", pa.binary()), ("after", pa.binary())])
    block = block.drop_columns(["_height", "_block"]).append_column("path", pa.array(paths, pa.list_(step)))
    return block.append_column("top", pa.array([top] * len(paths), pa.string()))


def _depth() -> Column:
    """Levels of hashing above the leaves of a tree."""
    return F.when(F.col("_size") > 1, F.length(F.bin(F.col("_size") - 1))).otherwise(0)


def _levels(hashes: DataFrame, deepest: int) -> list[DataFrame]:
    """Settled node rows of levels 0, HEIGHT, ... of all trees.

    From (``_tree``, ``_size`` in leaves, ``_first``, ``_place``, hash, and what else leaves have).  A node row
    has the steps to its parent, and the parent's hash as ``top``.
    """
    nodes, stored = hashes, []
    for level in range(0, max(1, deepest), HEIGHT):
        given = StructType(list(nodes.schema.fields)).add("path", _PATH).add("top", "string")
        rows = nodes.withColumn("_height", F.least(F.lit(HEIGHT), _depth() - level))
        blocks = rows.withColumn("_block", F.shiftright("_place", HEIGHT)).groupBy("_tree", "_block")
        stored.append(settle(blocks.applyInArrow(_fold, given), "manifest-nodes"))
        nodes = stored[-1].where(_leads() & (_depth() > level + HEIGHT)).select(
            "_tree", "_size", "_first", F.shiftright("_place", HEIGHT).alias("_place"), F.col("top").alias("hash"))
    return stored


def _leads() -> Column:
    """The first node of its block."""
    return F.col("_place").bitwiseAND(F.lit((1 << HEIGHT) - 1)) == 0


@dataclass(frozen=True)
class Manifest:
    """``leaves``: settled (``_number``, ``_own``, leaf, changed, subroot, path, parent, parent_level).  ``nodes``:
    settled (node, level, path, parent, parent_level).  ``root``: hash of all, null without rows."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id",
          keep: tuple[str, ...] = ("doc_id",), changed: dict[str, Column] | None = None) -> Manifest:
    """Leaves and levels.  ``changed``: columns as they are found later, for the leaves ``changed``.

    Groups ascend with null first; rows of a group ascend by ``order``, null first, ties by hash.  Only hashes,
    ``group``, ``order`` and the columns to ``keep`` are stored; texts are read once.
    """
    found = changed or {}
    values = {f: F.col(f"`{f}`") for f in fields}
    rows = docs.select(
        F.col(f"`{group}`").alias("_group"), F.col(f"`{order}`").alias("_order"),
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_own"), leaf_hash(list(values.values())).alias("leaf"),
        leaf_hash([found.get(f, v) for f, v in values.items()]).alias("changed"))
    hashed = settle(rows, "manifest-leaves")
    numbered = number_rows(hashed, ["_group", "_order", "leaf"], "manifest-order")
    # One row per group: its first leaf, its size, and its place among the groups.
    groups = number_rows(
        numbered.groupBy("_group").agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_size")),
        ["_group"], "manifest-groups").withColumnRenamed("_number", "_tree")
    groups = settle(groups, "manifest-groups")
    largest, n_groups = groups.agg(F.max("_size"), F.count(F.lit(1))).first()
    placed = numbered.join(groups, numbered["_group"].eqNullSafe(groups["_group"])).select(
        "_own", F.col("leaf").alias("hash"), "changed", "_tree", "_size", "_first", (F.col("_number") - F.col("_first")).alias("_place"))
    low = _levels(placed, (max(largest or 1, 1) - 1).bit_length())
    subroots = settle(_roots(low), "manifest-subroots")
    of_groups = subroots.select(
        F.lit(0).cast("bigint").alias("_tree"), F.lit(n_groups).cast("bigint").alias("_size"),
        F.lit(0).cast("bigint").alias("_first"), F.col("_tree").alias("_place"), F.col("root").alias("hash"))
    high = _levels(of_groups, (max(n_groups, 1) - 1).bit_length())
    root = _roots(high).first()
    nodes = settle(_upper(low, high), "manifest-upper")
    leaves = settle(low[0].join(subroots.withColumnRenamed("root", "subroot"), "_tree").select(
        (F.col("_first") + F.col("_place")).alias("_number"), "_own", F.col("hash").alias("leaf"), "changed", "subroot",
        "path", _block().alias("parent"), _parent_level(0, len(low)).alias("parent_level")), "manifest-proved")
    discard(hashed, groups, subroots, *low, *high)
    return Manifest(leaves, nodes, root["root"] if root else None)


def _roots(levels: list[DataFrame]) -> DataFrame:
    """(``_tree``, root): the parent that ends each tree."""
    last = F.floor((F.greatest(_depth(), F.lit(1)) - 1) / HEIGHT)
    ends = [table.where((F.col("_place") == 0) & (last == n)).select("_tree", F.col("top").alias("root"))
            for n, table in enumerate(levels)]
    return reduce(DataFrame.unionByName, ends)


def _block() -> Column:
    """The number of the first leaf of a leaf's block: the 2 ** HEIGHT leaves below one node of the first stored level."""
    return F.col("_first") + F.shiftleft(F.shiftright("_place", HEIGHT), HEIGHT)


def _parent_level(n: int, levels: int) -> Column:
    """The stored levels of the groups' own tree are numbered on from those of the groups."""
    return F.when(_depth() > (n + 1) * HEIGHT, n + 1).otherwise(levels)


def _upper(low: list[DataFrame], high: list[DataFrame]) -> DataFrame:
    """Node rows above the leaves, (node, level, path, parent, parent_level).

    Above, a leaf climbs in the name of its block: a node has a row for every block below it, so that no
    row of the table is met by more leaves than a block has.
    """
    levels, rows = len(low), []
    blocks = low[0].where(_leads()).select(F.col("_tree").alias("_of"), F.shiftright("_place", HEIGHT).alias("_at"), _block().alias("node"))
    for n, table in enumerate(low[1:], start=1):
        below = blocks.withColumn("_place", F.shiftright("_at", (n - 1) * HEIGHT))
        rows.append(below.join(table.withColumnRenamed("_tree", "_of"), ["_of", "_place"]).select(
            "node", F.lit(n).alias("level"), "path", F.col("node").alias("parent"), _parent_level(n, levels).alias("parent_level")))
    for n, table in enumerate(high):
        below = blocks.withColumn("_place", F.shiftright("_of", n * HEIGHT))
        rows.append(below.join(table, "_place").select(
            "node", F.lit(levels + n).alias("level"), "path", F.col("node").alias("parent"),
            F.lit(levels + n + 1 if n + 1 < len(high) else _TOP).alias("parent_level")))
    return reduce(DataFrame.unionByName, rows)


def climb(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """Settled (leaf, folded, proof) from (leaf: number, folded: hash of the row as it is found, path, parent, parent_level).

    ``proof`` is the siblings in the order of the climb, as bytes; ``folded`` the root that the hash leads to.
    """
    spark = nodes.sparkSession
    with setting(spark, _ROW_LIMIT, "-1"):
        return settle(spark.sql(CLIMB, leaves=leaves, nodes=nodes), "manifest-climb")


def prove(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", order: str = "doc_id",
          keep: tuple[str, ...] = ("doc_id",), changed: dict[str, Column] | None = None, into: str = "manifest") -> DataFrame:
    """The columns to ``keep`` and a struct: leaf, subroot, root, proof_sha256, folded_root, verified.

    ``folded_root`` is what the row leads to with the columns of ``changed`` in place of its own;
    ``verified`` tells whether that is the root.  The proof's hash is over the siblings in hex.

    Null fields are written as ``-``; rows whose group is null form a group; a group of one row has its leaf as root;
    a lone group's root is the root.  Equal rows are leaves side by side, each with its proof.  No rows give no rows.
    """
    made = build(docs, fields, group, order, keep, changed)
    climbed = climb(made.leaves.select(
        F.col("_number").alias("leaf"), F.col("changed").alias("folded"), "path", "parent", "parent_level"), made.nodes)
    discard(made.nodes)
    found = made.leaves.join(climbed.withColumnRenamed("leaf", "_number"), "_number")
    root = F.lit(made.root)
    return found.select(
        *[F.col("_own")[c].alias(c) for c in keep if c.lower() != into.lower()],
        F.struct(
            "leaf", "subroot", root.alias("root"), F.sha2(F.lower(F.hex("proof")), 256).alias("proof_sha256"),
            F.col("folded").alias("folded_root"), (F.col("folded") == root).alias("verified")).alias(into))
