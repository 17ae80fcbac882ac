"""Merkle manifest of a dataset, with inclusion proofs and tamper checks by resumed hash states.

A row's leaf is the SHA-256 of its fields.  Leaves of a group ascend by id; while several nodes remain,
every ``ARITY`` consecutive ones (the last run may hold fewer, even one) become the hash of their digests'
hex text.  The groups' last nodes, ordered by group, give the root in the same way.

A run's parent keeps a copy of its hash state before each child slot (the midstate there).  Folding a
replaced child resumes the state of its slot with the new digest and the siblings to its right; nothing to
its left is hashed again.

How it is laid out: leaves are ranked by one range sort (positions from counts per partition, so no group
is ever in one task) and packed into blocks of ``ARITY ** LEVELS`` consecutive leaves, a few hundred
kilobytes each.  A block's task does three levels of the tree at once, so each further round has 1/4096 of
the nodes, and a tree over 10^10 rows takes three rounds.  On the way down every block is told the siblings
on its path to the root (at most fifteen a level), with which its task folds and proves all its leaves.
Every round is a written table in the shared folder; lost tasks are run again from it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import materialize

ARITY = 16
#: Levels of the tree that one task does at once.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_BLOCK = ("_group string, _block bigint, _total bigint, _ids array<{id}>, _nodes binary, _changed array<binary>, "
          "_top binary")
_PATH = "_group string, _pos bigint, _path array<struct<left: binary, right: binary>>, _subroot binary, _root binary"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each as its UTF-8 byte count, a colon and its text, or ``-`` for null."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*[one(c) for c in fields]), 256))


def group_key(c: Column) -> Column:
    """A text that is never null and orders as the group does: null first, then by UTF-8 bytes."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.lit("="), s), F.lit("-"))


# ---- the tree inside one task -------------------------------------------------------------------------

class Parent:
    """Hash state of a run of children with copies before each child slot."""

    __slots__ = ("children", "states", "digest")

    def __init__(self, children: list[bytes]):
        self.children, self.states = children, []
        h = hashlib.sha256()
        for c in children:
            self.states.append(h.copy())
            h.update(c)
        self.digest = h.hexdigest().encode()

    def fold(self, slot: int, replacement: bytes) -> bytes:
        """Digest with another child in ``slot``: the state there, the replacement, the right siblings."""
        h = self.states[slot].copy()
        h.update(replacement)
        for c in self.children[slot + 1:]:
            h.update(c)
        return h.hexdigest().encode()

    def siblings(self, slot: int) -> tuple[bytes, bytes]:
        return b"".join(self.children[:slot]), b"".join(self.children[slot + 1:])


class Step:
    """One level of a path above a block: the state after the left siblings, and the right siblings."""

    __slots__ = ("state", "left", "right")

    def __init__(self, left: bytes, right: bytes):
        self.left, self.right = left, right
        self.state = hashlib.sha256(left)

    def fold(self, replacement: bytes) -> bytes:
        h = self.state.copy()
        h.update(replacement)
        h.update(self.right)
        return h.hexdigest().encode()


def levels_of(nodes: list[bytes], total: int, arity: int, levels: int) -> list[list[Parent]]:
    """Levels of parents over a block's nodes: ``levels`` of them if the group holds more than a block,
    else until one node remains."""
    whole, out = total > arity ** levels, []
    while len(out) < levels if whole else len(nodes) > 1:
        row = [Parent(nodes[i:i + arity]) for i in range(0, len(nodes), arity)]
        out.append(row)
        nodes = [p.digest for p in row]
    return out


def split_digests(packed: bytes) -> list[bytes]:
    return [packed[i:i + 32].hex().encode() for i in range(0, len(packed), 32)]


# ---- ranking and packing ------------------------------------------------------------------------------

def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``_pos`` (place within ``_group`` by ``order``) and ``_total`` (rows of the group)."""
    spread = rows.withColumn("_tie", F.monotonically_increasing_id())  # equal rows need not share a task
    keys = ["_group", *order, "_tie"]
    at = materialize(spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
                     .withColumn("_at", F.monotonically_increasing_id()), "merkle-ranked")
    at = at.withColumn("_part", F.shiftright("_at", 33))
    # a group has as many rows here as partitions, not as leaves
    counts = at.groupBy("_group", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_group")
    before = w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_group", "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
                           F.sum("_n").over(w).alias("_total"))
    return at.join(starts, ["_group", "_part"]) \
        .withColumn("_pos", F.col("_start") + F.col("_at") - F.col("_first")).drop("_part", "_at", "_first", "_start")


def _pack(rows: DataFrame, arity: int, levels: int) -> DataFrame:
    """Blocks of consecutive nodes of a group, each with the node that its part of the tree ends in."""
    size = arity ** levels
    schema = _BLOCK.format(id=rows.schema["_id"].dataType.simpleString())

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_pos")
        nodes = table.column("_node").to_pylist()
        total = table.column("_total")[0].as_py()
        tree = levels_of([n.hex().encode() for n in nodes], total, arity, levels)
        top = bytes.fromhex(tree[-1][0].digest.decode()) if tree else nodes[0]
        one = {"_group": [table.column("_group")[0].as_py()], "_block": [table.column("_block")[0].as_py()],
               "_total": [total], "_nodes": [b"".join(nodes)], "_changed": [table.column("_changed").to_pylist()],
               "_top": [top]}
        cols = {k: pa.array(v, {"_group": pa.string(), "_block": pa.int64(), "_total": pa.int64(), "_nodes": pa.binary(),
                                "_changed": pa.list_(pa.binary()), "_top": pa.binary()}[k]) for k, v in one.items()}
        ids = table.column("_id").combine_chunks()
        cols["_ids"] = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
        return pa.table({k: cols[k] for k in ("_group", "_block", "_total", "_ids", "_nodes", "_changed", "_top")})

    blocks = rows.withColumn("_block", F.floor(F.col("_pos") / size).cast("bigint")) \
        .select("_group", "_block", "_total", "_pos", "_id", "_node", "_changed")
    return materialize(blocks.groupBy("_group", "_block").applyInArrow(run, schema), "merkle-blocks")


def _rise(first: DataFrame, arity: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of blocks over packed ``first`` until every group has one block, and (_group, _top) of each."""
    size, rounds, ends = arity ** levels, [first], None
    while True:
        blocks = rounds[-1]
        done = blocks.where(F.col("_total") <= size).select("_group", "_top")
        ends = done if ends is None else ends.unionAll(done)
        more = blocks.where(F.col("_total") > size)
        if more.isEmpty():
            return rounds, ends
        nodes = more.select(
            "_group", F.col("_block").alias("_pos"), F.ceil(F.col("_total") / size).cast("bigint").alias("_total"),
            F.lit(None).cast("int").alias("_id"), F.col("_top").alias("_node"), F.lit(None).cast("binary").alias("_changed"))
        rounds.append(_pack(nodes, arity, levels))


def _told(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """Blocks with the path above each."""
    p = paths.select(F.col("_group").alias("_g"), F.col("_pos").alias("_b"), "_path", "_subroot", "_root")
    return blocks.join(p, (F.col("_group") == F.col("_g")) & (F.col("_block") == F.col("_b"))).drop("_g", "_b")


def _spread(told: DataFrame, arity: int, levels: int) -> DataFrame:
    """The path of every node of the blocks, from the path above each block."""
    path_type = pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                nodes = split_digests(r["_nodes"])
                tree = levels_of(nodes, r["_total"], arity, levels)
                first = r["_block"] * arity ** levels
                out = []
                for i in range(len(nodes)):
                    at, steps = i, []
                    for row in tree:
                        left, right = row[at // arity].siblings(at % arity)
                        steps.append({"left": left, "right": right})
                        at //= arity
                    out.append(steps + r["_path"])
                n = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["_group"]] * n, pa.string()), pa.array(range(first, first + n), pa.int64()),
                     pa.array(out, path_type), pa.array([r["_subroot"]] * n, pa.binary()),
                     pa.array([r["_root"]] * n, pa.binary())],
                    names=["_group", "_pos", "_path", "_subroot", "_root"])

    cols = ["_group", "_block", "_total", "_nodes", "_path", "_subroot", "_root"]
    return told.select(*cols).mapInArrow(run, _PATH)


def _descend(rounds: list[DataFrame], ends: DataFrame, arity: int, levels: int) -> DataFrame:
    """The first round's blocks with the path above each; ``ends`` has the path of every group's last node."""
    size, spread = arity ** levels, None
    for blocks in reversed(rounds):
        told = _told(blocks.where(F.col("_total") <= size), ends)  # the group's only block
        if spread is not None:
            told = told.unionAll(_told(blocks.where(F.col("_total") > size), spread))
        if blocks is not rounds[0]:
            spread = materialize(_spread(told, arity, levels), "merkle-paths")
    return told


@dataclass
class Manifest:
    """``blocks``: packed leaves, their changed digests and the path above each block; ``groups``: (_group,
    _top), one node per group; ``root``: hex digest, None for an empty table."""

    blocks: DataFrame
    groups: DataFrame
    root: str | None
    arity: int
    levels: int


def build(docs: DataFrame, *, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS,
          changes: dict[str, Column] | None = None, changed_where: Column | None = None,
          arity: int = ARITY, levels: int = LEVELS) -> Manifest:
    """The manifest of ``docs``: leaves in blocks, the path above each block, the groups' nodes and the root.

    ``changes`` gives other values for fields and ``changed_where`` the rows that have them: their
    leaves are computed too, and :func:`fold_proofs` folds them with the manifest's siblings.  Rows with a
    null id come first in their group; rows that repeat an id are ordered by their digest, so the tree does
    not depend on the order of the input.  A null group is a group of its own, before all others.  Columns
    other than these are not read and may have any name."""
    named = [F.col(f"`{c}`") for c in fields]
    leaf, changed = leaf_digest(named), F.lit(None).cast("binary")
    if changes:
        other = leaf_digest([changes.get(c, F.col(f"`{c}`")) for c in fields])
        changed = F.when(changed_where, other) if changed_where is not None else other
    leaves = materialize(docs.select(group_key(F.col(f"`{group_col}`")).alias("_group"), F.col(f"`{id_col}`").alias("_id"),
                                     leaf.alias("_node"), changed.alias("_changed")), "merkle-leaves")
    rounds, ends = _rise(_pack(_ranked(leaves, ["_id", "_node", "_changed"]), arity, levels), arity, levels)
    groups = materialize(ends, "merkle-groups")

    # the tree over the groups' nodes: they are ranked and packed in the same way, as one group
    nodes = groups.select(F.lit("").alias("_group"), F.col("_group").alias("_id"), F.col("_top").alias("_node"),
                          F.lit(None).cast("binary").alias("_changed"))
    ranked = materialize(_ranked(nodes, ["_id"]), "merkle-group-order")
    above, top = _rise(_pack(ranked, arity, levels), arity, levels)
    last = top.first()
    end = top.select("_group", F.lit(0).cast("bigint").alias("_pos"),
                     F.array().cast("array<struct<left: binary, right: binary>>").alias("_path"),
                     F.lit(None).cast("binary").alias("_subroot"), F.col("_top").alias("_root"))
    paths = _spread(_descend(above, end, arity, levels), arity, levels)
    names = ranked.select(F.col("_id").alias("_name"), F.col("_pos").alias("_place"), F.col("_node").alias("_end"))
    ends = materialize(paths.join(names, F.col("_pos") == F.col("_place")).select(
        F.col("_name").alias("_group"), F.lit(0).cast("bigint").alias("_pos"), "_path",
        F.col("_end").alias("_subroot"), "_root"), "merkle-paths")
    return Manifest(_descend(rounds, ends, arity, levels), groups, last["_top"].hex() if last else None, arity, levels)


def fold_proofs(manifest: Manifest, id_col: str = "doc_id", siblings: bool = False) -> DataFrame:
    """One row per leaf: id, ``leaf``, ``subroot``, ``root`` (hex, as built), ``proof_sha256`` (hash of the
    siblings' hex text, level by level from the leaf to the root, left to right), ``folded_root`` (from
    the changed leaf, or the leaf itself where nothing is changed, by resumed states) and ``verified``
    (equal to the root); with ``siblings`` also the siblings' hex text itself."""
    arity, levels = manifest.arity, manifest.levels
    id_type = manifest.blocks.schema["_ids"].dataType.elementType.simpleString()
    names = ["_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "siblings"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in range(batch.num_rows):
                ids = batch.column("_ids")[b].values
                r = batch.select(["_total", "_nodes", "_changed", "_path", "_subroot", "_root"]).slice(b, 1).to_pylist()[0]
                nodes = split_digests(r["_nodes"])
                tree = levels_of(nodes, r["_total"], arity, levels)
                steps = [Step(s["left"], s["right"]) for s in r["_path"]]
                above = b"".join(s.left + s.right for s in steps)
                proofs, folded, shown = [], [], []
                for i, changed in enumerate(r["_changed"]):
                    value = nodes[i] if changed is None else changed.hex().encode()
                    at, beside = i, []
                    for row in tree:
                        parent, slot = row[at // arity], at % arity
                        beside.extend(parent.children[:slot])
                        beside.extend(parent.children[slot + 1:])
                        value = parent.fold(slot, value)
                        at //= arity
                    for s in steps:
                        value = s.fold(value)
                    beside.append(above)
                    beside = b"".join(beside)
                    proofs.append(hashlib.sha256(beside).hexdigest())
                    folded.append(value.decode())
                    shown.append(beside.decode() if siblings else None)
                n = len(nodes)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([x.decode() for x in nodes]), pa.array([r["_subroot"].hex()] * n),
                     pa.array([r["_root"].hex()] * n), pa.array(proofs), pa.array(folded), pa.array(shown, pa.string())],
                    names=names)

    got = manifest.blocks.select("_ids", "_total", "_nodes", "_changed", "_path", "_subroot", "_root") \
        .mapInArrow(run, f"_id {id_type}, " + ", ".join(f"{n} string" for n in names[1:]))
    cols = [F.col("_id").alias(id_col), *names[1:6], (F.col("folded_root") == F.col("root")).alias("verified")]
    return got.select(*cols, "siblings") if siblings else got.select(*cols)
