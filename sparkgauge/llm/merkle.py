"""A Merkle manifest of a dataset whose parents retain hash states.

A row is a leaf; the leaves of a language ascend by document id, and every run of up to eight
nodes becomes the SHA-256 of their digests (as text) until one node, the subroot, is left.
Subroots are the leaves of one more tree of the same kind, whose top is the root.

A parent keeps a copy of its hash state before each child slot. To fold a changed leaf, the
state before its slot is resumed and takes in the replacement and the right siblings only;
the left ones are in the state already.

Trees are built in blocks of 512 leaves (three levels), one task's work each; the tops of
blocks are the leaves of the next tier. Paths run down the tiers the other way: a block gets
the siblings above its top, makes their states once and folds each of its leaves to the root.
Leaves are ranked by range partitions with prefix counts, so no task holds a language.

Defined results
  - nulls are `-` in a leaf; a null language is a group of its own and comes first;
  - equal ids are ordered by leaf; equal rows are leaves of their own with equal digests;
  - a null id comes first in its language; it has no decimal form, so it is never tampered with;
  - ids keep their type; other columns are ignored, whatever their names; an empty table has
    no root and gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.sql.window import Window

from sparkgauge.llm.common import ascii_lower, small, store

FANOUT, BLOCK_LEVELS = 8, 3
HEX = 64
MEMBERS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def leaf(*members: Column) -> Column:
    """Digest of a row: each member as its UTF-8 byte count, a colon and the value, or - for null."""
    texts = [m.cast("string") for m in members]
    return F.sha2(F.concat(*(F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256)


def scope_of(lang: Column) -> Column:
    return F.when(lang.isNull(), "-").otherwise(F.concat(F.lit("+"), lang))


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds idx (from 0 within scope, by the order) and total (rows of the scope).

    A range partition holds neighbours only; its first place in a scope is the sum of the
    scope's rows in earlier partitions. Rows equal in all of the order are spread by a row number.
    """
    rows = store(rows.withColumn("tie", F.monotonically_increasing_id()), "unranked")
    keys = [F.col(c).asc_nulls_first() for c in ("scope", *order, "tie")]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    placed = store(placed, "ranked").withColumn("part", F.shiftrightunsigned("at", 33))
    runs = placed.groupBy("scope", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("scope").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "scope",
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("scope")).alias("total"),
    )
    return placed.join(small(runs), ["scope", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift", "tie")


# --- blocks, inside a task -----------------------------------------------------------------


def levels(total: int) -> int:
    """Levels above so many leaves until one node is left."""
    n = 0
    while total > 1:
        total, n = -(-total // FANOUT), n + 1
    return n


class Parent:
    """A parent's children, and its hash state before each of their slots."""

    def __init__(self, children: list[bytes]):
        self.children, self.states = b"".join(children), []
        state = hashlib.sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child)
        self.digest = state.hexdigest().encode()

    def left(self, slot: int) -> bytes:
        return self.children[: HEX * slot]

    def right(self, slot: int) -> bytes:
        return self.children[HEX * (slot + 1) :]


def block_tree(leaves: list[bytes], total: int, high: int) -> tuple[list[list[Parent]], bytes]:
    """Parents of a block by level, and its top."""
    tree = []
    for _ in range(min(high, levels(total))):
        parents = [Parent(leaves[i : i + FANOUT]) for i in range(0, len(leaves), FANOUT)]
        tree.append(parents)
        leaves = [p.digest for p in parents]
    return tree, leaves[0]


def resume(state, replacement: bytes, right: bytes) -> bytes:
    state = state.copy()
    state.update(replacement)
    state.update(right)
    return state.hexdigest().encode()


def _steps(tree: list[list[Parent]], at: int) -> Iterator[tuple[Parent, int]]:
    for parents in tree:
        at, slot = divmod(at, FANOUT)
        yield parents[at], slot


def _sorted(table: pa.Table) -> tuple[pa.Table, list[bytes], int]:
    table = table.sort_by("idx")
    return table, [d.encode() for d in table.column("digest").to_pylist()], table.column("total")[0].as_py()


def _tops(high: int):
    """A block's top, as a node of the next tier."""

    def run(table: pa.Table) -> pa.Table:
        table, leaves, total = _sorted(table)
        _, top = block_tree(leaves, total, high)
        return pa.table(
            {
                "scope": pa.array([table.column("scope")[0].as_py()], pa.string()),
                "idx": pa.array([table.column("block")[0].as_py()], pa.int64()),
                "digest": pa.array([top.decode()], pa.string()),
                "total": pa.array([-(-total // FANOUT**high)], pa.int64()),
            }
        )

    return run


_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _paths(high: int):
    """Path of every node of a block: its siblings level by level, then those above the block."""

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        table, leaves, total = _sorted(table)
        tree, _ = block_tree(leaves, total, high)
        up = above.column("path")[0].as_py()
        paths = [[{"left": p.left(s).decode(), "right": p.right(s).decode()} for p, s in _steps(tree, i)] + up for i in range(len(leaves))]
        n = len(leaves)
        return pa.table(
            {
                "scope": table.column("scope"),
                "block": table.column("idx"),
                "path": pa.array(paths, _PATH_TYPE),
                "subroot": pa.array(above.column("subroot").to_pylist() * n, pa.string()),
                "root": pa.array(above.column("root").to_pylist() * n, pa.string()),
            }
        )

    return run


def _folds(id_type: pa.DataType, high: int):
    """Every leaf of a block: its proof, and the root recomputed from what it is now."""

    def run(table: pa.Table, above: pa.Table) -> pa.Table:
        table, leaves, total = _sorted(table)
        tree, _ = block_tree(leaves, total, high)
        up = [(s["left"].encode(), s["right"].encode()) for s in above.column("path")[0].as_py()]
        states = [hashlib.sha256(left) for left, _ in up]
        beyond = b"".join(left + right for left, right in up)
        proofs, roots = [], []
        for i, (original, now) in enumerate(zip(leaves, table.column("now").to_pylist())):
            value, siblings = now.encode() if now else original, []
            for parent, slot in _steps(tree, i):
                right = parent.right(slot)
                siblings += (parent.left(slot), right)
                value = resume(parent.states[slot], value, right)
            for state, (_, right) in zip(states, up):
                value = resume(state, value, right)
            proofs.append(hashlib.sha256(b"".join(siblings) + beyond).hexdigest())
            roots.append(value.decode())
        n = len(leaves)
        return pa.table(
            {
                "doc_id": table.column("doc_id").cast(id_type),
                "leaf": table.column("digest"),
                "subroot": pa.array(above.column("subroot").to_pylist() * n, pa.string()),
                "root": pa.array(above.column("root").to_pylist() * n, pa.string()),
                "proof_sha256": pa.array(proofs, pa.string()),
                "folded_root": pa.array(roots, pa.string()),
            }
        )

    return run


# --- trees as tables -----------------------------------------------------------------------


_NODE = ["scope", "idx", "total", "digest"]
_ABOVE = f"scope string, block long, path {_PATH}, subroot string, root string"


def blocks(nodes: DataFrame, high: int):
    """Nodes (scope, idx, total, digest) dealt out by block."""
    return nodes.withColumn("block", F.expr(f"idx DIV {FANOUT**high}")).groupBy("scope", "block")


def under(nodes: DataFrame, above: DataFrame, high: int) -> DataFrame:
    """Paths of nodes from the paths of their blocks; a node is the block of that number one tier down."""
    return blocks(nodes.select(_NODE), high).cogroup(above.groupBy("scope", "block")).applyInArrow(_paths(high), _ABOVE)


def grow(nodes: DataFrame, high: int) -> tuple[list[DataFrame], DataFrame]:
    """Tiers of nodes of all scopes, and each scope's top: scope, digest, tier (of its last block)."""
    tiers, tops = [nodes], []
    while True:
        found = blocks(tiers[-1].select(_NODE), high).applyInArrow(_tops(high), "scope string, idx long, digest string, total long")
        found = store(found, "block-tops")
        tops.append(found.filter("total = 1").select("scope", "digest", F.lit(len(tiers) - 1).alias("tier")))
        rest = found.filter("total > 1")
        if rest.isEmpty():
            return tiers, reduce(DataFrame.unionByName, tops)
        tiers.append(rest)


def descend(tiers: list[DataFrame], ends: DataFrame, high: int) -> DataFrame:
    """Paths of the blocks of the lowest tier: scope, block, path, subroot, root.

    ends has the path above each scope's top and the tier in which it ends.
    """
    above = None
    for tier in reversed(range(len(tiers))):
        ending = ends.filter(F.col("tier") == tier).selectExpr("scope", "0L AS block", "path", "subroot", "root")
        above = ending if above is None else above.unionByName(ending)
        if tier:
            above = under(tiers[tier], above, high)
    return store(above, "block-paths")


def verify(docs: DataFrame, now: Column | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Manifest of the rows, and whether each row still folds to its root.

    now is the row's text at the time of verification (default: unchanged). Columns: doc_id,
    leaf, subroot, root, proof_sha256, folded_root, verified.
    """
    members = [F.col(c) for c in MEMBERS]
    changed = F.lit(None).cast("string") if now is None else F.when(~now.eqNullSafe(F.col("text")), leaf(*members[:-1], now))
    rows = docs.select(scope_of(F.col("lang")).alias("scope"), "doc_id", leaf(*members).alias("digest"), changed.alias("now"))
    tiers, subroots = grow(ranked(rows, ["doc_id", "digest"]), block_levels)

    # The languages' subroots are the leaves of one more tree, whose scope has no name.
    lang = F.expr("CASE WHEN scope <> '-' THEN substr(scope, 2) END").alias("lang")
    langs = ranked(subroots.select(F.lit("").alias("scope"), lang, "digest", F.col("scope").alias("of"), F.col("tier").alias("of_tier")), ["lang"])
    top_tiers, top = grow(langs, block_levels)
    ends = top.selectExpr("scope", "tier", f"CAST(array() AS {_PATH}) AS path", "'' AS subroot", "digest AS root")
    over = under(langs, descend(top_tiers, ends, block_levels), block_levels)
    ends = langs.select("idx", F.col("of").alias("scope"), F.col("of_tier").alias("tier"), F.col("digest").alias("subroot")).join(
        over.select(F.col("block").alias("idx"), "path", "root"), "idx"
    )

    paths = descend(tiers, store(ends, "subroot-paths"), block_levels)
    id_type = docs.schema["doc_id"].dataType
    schema = StructType([StructField("doc_id", id_type), *(StructField(n, StringType()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root"))])
    folds = _folds(to_arrow_type(id_type), block_levels)
    folded = blocks(tiers[0], block_levels).cogroup(paths.groupBy("scope", "block")).applyInArrow(folds, schema)
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered(text: Column, doc_id: Column) -> Column:
    """The text in lower case (A-Z) where 3 divides the checksum of the id."""
    return F.when(F.crc32(doc_id.cast("string")) % 3 == 0, ascii_lower(text)).otherwise(text)
