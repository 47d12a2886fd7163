"""Merkle manifest of a table, and multiproofs of any of its rows.

Every row is a leaf: the SHA-256 of its fields.  The leaves of a group (here a
language) are ordered and hashed pairwise, level by level, to the group's
subroot; the subroots in order of their groups are the leaves of a top tree
that gives the root.  All digests are hashed as lower-case hex text.

:func:`build` numbers the leaves without sorting a group in one task: rows are
range-partitioned by group, id and digest, counted by partition, and numbered
inside their partition.  Equal rows travel as one row with a count until
they are dealt to blocks, so a row repeated any number of times fills no task.
Trees are reduced in blocks of ``2**BLOCK_BITS`` aligned nodes, then blocks of
block roots, and so on: the number of rounds is the depth over ``BLOCK_BITS``.

:func:`prove` is an octopus multiproof: each partition of leaves (one block)
computes the smallest set of node coordinates that its leaves need and that
cannot be derived from them (:func:`missing_nodes`); the sets are joined with
the node table, so a node is fetched once by a partition however many of its
leaves need it; the partition then derives the interior nodes its leaves share
and writes each leaf's own list of siblings from them.

Defined cases: a null field is written ``-``; null ids come first, and a null
id is never altered; a null group is a group of its own and comes first; rows
of one id are ordered by digest, equal rows are interchangeable and each has its own place; empty and very long texts are
hashed whole where they are read; an empty table has no rows, no nodes and no root; extra
columns are never read, whatever their names.  The trees of groups take one
row per group in :func:`build`; leaves of a block and its fetched nodes are
the most that a task holds at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import deploy, store

BLOCK_BITS = 10
ROWS_PER_RANGE = 65_536
TOP = -1                        # number of the tree over the subroots

LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree int, level int, idx long, hash binary, size long"


def field_text(column: Column) -> Column:
    """A field as it is hashed: ``-`` for null, else byte count, colon, value."""
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field_text(c) for c in fields]), 256))


def depth(size: int) -> int:
    """Levels above the leaves of a tree with ``size`` leaves."""
    return max(int(size) - 1, 0).bit_length()


def width(size: int, level: int) -> int:
    """Nodes of one level."""
    return -(-int(size) // (1 << level))


def digest(*hexes: str) -> str:
    return hashlib.sha256("".join(hexes).encode()).hexdigest()


def missing_nodes(places: Sequence[int], size: int) -> list[tuple[int, int]]:
    """``(level, idx)`` of the nodes that prove ``places`` and cannot be derived from them, bottom up, left to right."""
    out: list[tuple[int, int]] = []
    known = np.unique(np.asarray(places, np.int64))
    for level in range(depth(size)):
        beside = np.setdiff1d(known ^ 1, known)
        out += [(level, int(i)) for i in beside[beside < width(size, level)]]
        known = np.unique(known >> 1)
    return out


def derive(nodes: dict[tuple[int, int], str], places: Sequence[int], size: int) -> None:
    """Add to ``nodes`` every ancestor of ``places``; their level-0 and missing nodes are there already."""
    known = sorted(set(places))
    for level in range(depth(size)):
        known = sorted({i >> 1 for i in known})
        last = width(size, level) - 1
        for i in known:
            pair = (nodes[level, 2 * i],) if 2 * i == last else (nodes[level, 2 * i], nodes[level, 2 * i + 1])
            nodes[level + 1, i] = digest(*pair)


def path(nodes: dict[tuple[int, int], str], place: int, size: int) -> list[tuple[bool, str | None]]:
    """Per level of one leaf's path: whether the sibling lies on the left, and the sibling (None where there is none)."""
    out = []
    for level in range(depth(size)):
        beside = (place >> level) ^ 1
        out.append((beside < place >> level, nodes[level, beside] if beside < width(size, level) else None))
    return out


def fold(leaf: str, steps: Sequence[tuple[bool, str | None]]) -> str:
    """The root that a leaf and its siblings give."""
    h = leaf
    for left, beside in steps:
        h = digest(h) if beside is None else digest(beside, h) if left else digest(h, beside)
    return h


@dataclass(frozen=True)
class Manifest:
    """``leaves``: blocks of numbered leaf rows (``tree, block, size, first, n, id, leaf, altered``); ``nodes``: every
    node of every tree; ``groups``: ``tree, group, size, subroot``; ``trees``: their number; ``top``: the root's level."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    trees: int
    top: int


def _numbered(keyed: DataFrame, rows: int, rows_per_range: int) -> tuple[DataFrame, DataFrame]:
    """(leaf rows with tree, size, first place; one row per group with tree and size)."""
    # the partition number is written with its rows, so counting and numbering see the same partitions
    dealt = store(keyed.repartitionByRange(max(1, -(-rows // rows_per_range)), F.col("grp").asc_nulls_first(),
                                           F.col("id").asc_nulls_first(), "leaf")
                  .withColumn("part", F.spark_partition_id()), "merkle-ranges")
    totals = dealt.groupBy("grp", "part").agg(F.sum("n").alias("rows"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("grp").alias("grp2"), F.col("part").alias("part2"),
                           F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    trees = store(totals.groupBy("grp").agg(F.sum("rows").alias("size")).select(      # one row per group
        (F.row_number().over(Window.orderBy(F.col("grp").asc_nulls_first())) - 1).alias("tree"), "grp", "size"), "merkle-trees")
    inside = Window.partitionBy("grp", "part").orderBy(F.col("id").asc_nulls_first(), "leaf").rowsBetween(
        Window.unboundedPreceding, -1)
    counted = dealt.withColumn("rank", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    t = trees.select("tree", F.col("grp").alias("grp3"), "size")
    placed = counted.join(starts, F.col("grp").eqNullSafe(F.col("grp2")) & (F.col("part") == F.col("part2"))).join(
        t, F.col("grp").eqNullSafe(F.col("grp3")))
    return placed.select("tree", "size", (F.col("start") + F.col("rank")).alias("first"), "n", "id", "leaf", "altered"), trees


def _expand(table: pa.Table, *columns: str) -> list[list]:
    """Places of a block's leaf rows in ascending order, and the named columns repeated alongside."""
    first, n = (np.asarray(table.column(c), np.int64) for c in ("first", "n"))
    order = np.argsort(first, kind="stable")
    row = np.repeat(order, n[order])
    ends = np.cumsum(n[order])
    places = np.arange(len(row)) - np.repeat(ends - n[order], n[order]) + first[row]
    taken = table.take(pa.array(row))
    return [places.tolist(), *[taken.column(c).to_pylist() for c in columns]]


def _reduced(tree: int, size: int, base: int, at: list[int], hexes: list[str], keep: bool, bits: int) -> pa.Table:
    """Nodes above an aligned run of nodes of level ``base``, up to ``bits`` levels (and the run itself, to ``keep`` it)."""
    levels, idx, out = ([base] * len(at), list(at), list(hexes)) if keep else ([], [], [])
    for level in range(base, min(base + bits, depth(size))):
        hexes = [digest(*hexes[i:i + 2]) for i in range(0, len(hexes), 2)]
        at = [i >> 1 for i in at[::2]]
        levels += [level + 1] * len(at)
        idx += at
        out += hexes
    k = len(idx)
    return pa.table({"tree": pa.array([tree] * k, pa.int32()), "level": pa.array(levels, pa.int32()), "idx": pa.array(idx, pa.int64()),
                     "hash": pa.array([bytes.fromhex(h) for h in out], pa.binary()), "size": pa.array([size] * k, pa.int64())})


def _climb(nodes: list[DataFrame], levels: int, label: str, bits: int) -> list[DataFrame]:
    """Append the rounds above level ``bits`` of the trees whose lower nodes are ``nodes[-1]``."""
    def up(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        tree, size, base = (table.column(c)[0].as_py() for c in ("tree", "size", "level"))
        return _reduced(tree, size, base, table.column("idx").to_pylist(),
                        [h.hex() for h in table.column("hash").to_pylist()], False, bits)

    for base in range(bits, levels, bits):
        run = nodes[-1].filter((F.col("level") == base) & (F.col("size") > F.lit(1 << base)))
        nodes.append(store(run.groupBy("tree", F.shiftright("idx", bits)).applyInArrow(up, NODE), f"merkle-{label}-{base}"))
    return nodes


def build(docs: DataFrame, fields: Sequence[str] = LEAF_FIELDS, id_col: str = "doc_id", group_col: str = "lang",
          altered: dict[str, Column] | None = None, where: Column | None = None, bits: int = BLOCK_BITS,
          rows_per_range: int = ROWS_PER_RANGE) -> Manifest:
    """Number the leaves and write the nodes of all trees.

    ``altered`` names fields and the values that a tampered copy of the rows
    ``where`` holds (columns over the fields' names); their digests travel with
    the leaves for verification and are no part of the manifest.
    """
    deploy(docs.sparkSession)
    names = list(dict.fromkeys([*fields, id_col, group_col]))
    rows = docs.select(*[F.col(f"`{c}`").alias(c) for c in names])
    other = leaf_digest([(altered or {}).get(c, F.col(f"`{c}`")) for c in fields])
    keyed = rows.select(F.col(f"`{group_col}`").cast("string").alias("grp"), F.col(f"`{id_col}`").alias("id"),
                        leaf_digest([F.col(f"`{c}`") for c in fields]).alias("leaf"),
                        F.when(where, other).alias("altered") if where is not None else F.lit(None).cast("binary").alias("altered"))
    keyed = store(keyed.groupBy("grp", "id", "leaf", "altered").agg(F.count("*").alias("n")), "merkle-keys")
    rows_in_all = int(keyed.agg(F.sum("n")).first()[0] or 0)
    numbered, trees = _numbered(keyed, rows_in_all, rows_per_range)
    # a repeated row is cut at block borders, then dealt with its block
    cut = numbered.withColumn("block", F.explode(F.sequence(F.shiftright("first", bits), F.shiftright(F.col("first") + F.col("n") - 1, bits))))
    start = F.greatest(F.col("first"), F.shiftleft("block", bits))
    end = F.least(F.col("first") + F.col("n"), F.shiftleft(F.col("block") + 1, bits))
    leaves = store(cut.select("tree", "block", "size", start.alias("first"), (end - start).alias("n"), "id", "leaf", "altered"), "merkle-leaves")

    def from_leaves(table: pa.Table) -> pa.Table:
        places, digests = _expand(table, "leaf")
        return _reduced(table.column("tree")[0].as_py(), table.column("size")[0].as_py(), 0, places,
                        [d.hex() for d in digests], True, bits)

    low = leaves.select("tree", "block", "size", "first", "n", "leaf").groupBy("tree", "block").applyInArrow(from_leaves, NODE)
    nodes = [store(low, "merkle-nodes")]
    most = trees.agg(F.max("size"), F.count("*")).first()
    largest, count = int(most[0] or 0), int(most[1])
    _climb(nodes, depth(largest), "nodes", bits)
    every = nodes[0]
    for more in nodes[1:]:
        every = every.unionByName(more)
    # one subroot a group: the only node of its highest level
    highest = F.expr("idx = 0 AND shiftleft(1L, level) >= size AND (level = 0 OR shiftleft(1L, level - 1) < size)")
    subroots = store(every.filter(highest).select("tree", "hash"), "merkle-subroots")

    def from_subroots(table: pa.Table) -> pa.Table:
        table = table.sort_by("tree")
        return _reduced(TOP, count, 0, table.column("tree").to_pylist(), [h.hex() for h in table.column("hash").to_pylist()], True, bits)

    top = [store(subroots.groupBy(F.shiftright("tree", bits)).applyInArrow(from_subroots, NODE), "merkle-top")]
    _climb(top, depth(count), "top", bits)
    for more in top:
        every = every.unionByName(more)
    groups = trees.join(subroots.withColumnRenamed("tree", "tree2"), F.col("tree") == F.col("tree2")).select(
        "tree", F.col("grp").alias("group"), "size", F.lower(F.hex("hash")).alias("subroot"))
    return Manifest(leaves, every, groups, count, depth(count))


PROOF = "id {id}, leaf string, subroot string, root string, proof array<string>, folded_root string"


def wanted_nodes(manifest: Manifest, leaves: DataFrame) -> DataFrame:
    """``(at_tree, at_block, tree, level, idx)``: the coordinates that each partition of ``leaves`` fetches.

    The root itself is among them: the manifest's root is what proofs are held against.
    """
    count, top = manifest.trees, manifest.top

    def coordinates(table: pa.Table) -> pa.Table:
        tree, block, size = (table.column(c)[0].as_py() for c in ("tree", "block", "size"))
        own = missing_nodes(_expand(table)[0], size)
        above = missing_nodes([tree], count) + ([(top, 0)] if top else [])
        k = len(own) + len(above)
        return pa.table({
            "at_tree": pa.array([tree] * k, pa.int32()), "at_block": pa.array([block] * k, pa.int64()),
            "tree": pa.array([tree] * len(own) + [TOP] * len(above), pa.int32()),
            "level": pa.array([x for x, _ in own + above], pa.int32()), "idx": pa.array([i for _, i in own + above], pa.int64())})

    return leaves.select("tree", "block", "size", "first", "n").groupBy("tree", "block").applyInArrow(
        coordinates, "at_tree int, at_block long, tree int, level int, idx long")


def prove(manifest: Manifest, leaves: DataFrame | None = None) -> DataFrame:
    """``id, leaf, subroot, root, proof, folded_root`` of each leaf (of all of the manifest's, or of some of its rows).

    ``proof`` lists the siblings from the leaf to the root; ``folded_root`` is
    what the altered digest, if the row has one, or else the leaf gives with them.
    """
    leaves = manifest.leaves if leaves is None else leaves
    wanted = store(wanted_nodes(manifest, leaves), "merkle-wanted")
    fetched = wanted.join(manifest.nodes.select("tree", "level", "idx", "hash"), ["tree", "level", "idx"])
    count, top = manifest.trees, manifest.top
    kind = leaves.schema["id"].dataType.simpleString()
    id_type = pa.from_numpy_dtype(np.int64) if kind == "bigint" else pa.int32() if kind == "int" else pa.string()

    def expand(left: pa.Table, right: pa.Table) -> pa.Table:
        tree, size = left.column("tree")[0].as_py(), left.column("size")[0].as_py()
        own: dict[tuple[int, int], str] = {}
        above: dict[tuple[int, int], str] = {}
        for t, level, i, h in zip(*[right.column(c).to_pylist() for c in ("tree", "level", "idx", "hash")]):
            (above if t == TOP else own)[level, i] = h.hex()
        places, ids, digests, others = _expand(left, "id", "leaf", "altered")
        hexes = [d.hex() for d in digests]
        own.update({(0, p): h for p, h in zip(places, hexes)})
        derive(own, places, size)
        subroot = own[depth(size), 0]
        root = above.get((top, 0), subroot)      # a single group's subroot is the root
        above[0, tree] = subroot
        high = path(above, tree, count)
        proofs, folded = [], []
        for p, h, other in zip(places, hexes, others):
            steps = path(own, p, size) + high
            proofs.append([s for _, s in steps if s is not None])
            folded.append(fold(h if other is None else other.hex(), steps))
        k = len(places)
        return pa.table({"id": pa.array(ids, id_type), "leaf": hexes, "subroot": [subroot] * k, "root": [root] * k,
                         "proof": pa.array(proofs, pa.list_(pa.string())), "folded_root": folded})

    return leaves.groupBy("tree", "block").cogroup(fetched.groupBy("at_tree", "at_block")).applyInArrow(
        expand, PROOF.format(id=kind))


def tampered(id_col: str = "doc_id", every: int = 7) -> Column:
    """Rows whose id's decimal text has a crc32 divisible by ``every``; never a null id."""
    return F.col(id_col).isNotNull() & (F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0)


def audit(docs: DataFrame, every: int = 7) -> DataFrame:
    """Manifest of ``docs`` and a proof of every row, some of them tampered with after the manifest was made."""
    one_more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    manifest = build(docs, altered={"n_chars": one_more}, where=tampered(every=every))
    return prove(manifest).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))
