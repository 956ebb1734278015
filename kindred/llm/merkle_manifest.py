"""A Merkle manifest of a dataset: a tree per source, a tree over the sources, and a proof for every row.

Each row is a leaf, the digest of its fields. The leaves of a source stand in the order of their ids; every three
nodes that follow each other become one node (a last run may be shorter) until one is left, the subroot. The
subroots, in the order of their sources, become the root in the same way.

Witnesses are built by appending. A leaf starts with an empty witness and belongs to an open subtree; when the run
it stands in is complete, the siblings of the run extend the witness of every leaf below them, and the new parent is
appended one level up. Leaves are dealt out to aligned blocks of 3 ** 8, so a block is a subtree and needs no other
block. The roots of the blocks are then further appends: the same step over them extends the witnesses of their
leaves, block by block, until one node of each source is left, and once more over the sources.

A witness is a list of steps; a step holds the digests left and right of the node in its run. Folding a leaf
with its witness gives the root if neither the leaf nor the witness was changed.

Positions come from one sort by ranges and the counts of its parts: no task sees a whole source, and equal rows can
stand in several parts. Only digests are sorted and shuffled, never texts.

Defined cases: a NULL field, empty text and empty table have their own digest or no row; a NULL id comes first
in its source and is never tampered with, a NULL source comes first of the sources; rows of one id follow the order
of their leaves, equal rows stand next to each other. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.shared import scratch, stored

FAN = 3
HEIGHT = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<left:binary,right:binary>>"


def digest(*inputs: Column) -> Column:
    """Lower-case hex digest of the inputs one after the other."""
    return F.sha2(F.concat(*inputs), 256)


def field(value: Column) -> Column:
    """``-`` for NULL, else the number of bytes, a colon and the value."""
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def tampered(key: Column, text: Column) -> Column:
    """The text without its line ends in the rows that are tampered with."""
    changes = F.crc32(key.cast("string").cast("binary")) % 2 == 0
    return F.when(changes, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def leaves(docs: DataFrame) -> DataFrame:
    """``key, group, leaf, changed``: id, source, and the digests of the row and of the tampered row."""
    others = [field(F.col(c)) for c in FIELDS[:-1]]
    text, key = F.col(FIELDS[-1]), F.col(FIELDS[0])
    return docs.select(
        key.alias("key"), F.col("source").alias("group"), F.unhex(digest(*others, field(text))).alias("leaf"),
        F.unhex(digest(*others, field(tampered(key, text)))).alias("changed"),
    )


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` with ``pos``, the place of a node in its group, and ``of``, the size of the group."""
    spread_out = nodes.withColumn("_copy", F.monotonically_increasing_id())
    # Numbers that rise with the order of a sorted table; the part they start in stands in their upper bits.
    ordered = stored(
        stored(spread_out, "nodes").orderBy("group", *order, "_copy").drop("_copy").withColumn("_seq", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("_part", F.shiftright("_seq", 33))
    parts = ordered.groupBy("group", "_part").agg(F.min("_seq").alias("_first"), F.count("*").alias("_n"))
    before = F.expr("sum(_n) OVER (PARTITION BY group ORDER BY _part) - _n")
    placed = parts.select(
        F.col("group").alias("_group"), F.col("_part").alias("_of_part"), (before - F.col("_first")).alias("_shift"),
        F.expr("sum(_n) OVER (PARTITION BY group)").alias("of"),
    )
    same = F.col("group").eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of_part"))
    return ordered.join(placed, same).withColumn("pos", F.col("_seq") + F.col("_shift")).drop(
        "_seq", "_part", "_group", "_of_part", "_shift"
    )


class OpenSubtrees:
    """Nodes are appended at the lowest level; witnesses grow with every run that is completed."""

    def __init__(self) -> None:
        self.witnesses: list[list[tuple[bytes, bytes]]] = []
        self.runs: list[list[tuple[bytes, int, int]]] = []

    def append(self, node: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._place(0, (node, at, at + 1))

    def _place(self, level: int, node: tuple[bytes, int, int]) -> None:
        if level == len(self.runs):
            self.runs.append([])
        self.runs[level].append(node)
        if len(self.runs[level]) == FAN:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        digests = [node for node, _, _ in run]
        for i, (_, first, end) in enumerate(run):
            step = (b"".join(digests[:i]), b"".join(digests[i + 1 :]))
            for witness in self.witnesses[first:end]:
                witness.append(step)
        parent = hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()
        self._place(level + 1, (parent, run[0][1], run[-1][2]))

    def close(self, height: int) -> bytes:
        """Complete the short runs below a height; the node there."""
        for level in range(height):
            if self.runs[level]:
                self._complete(level)
        return self.runs[height][0][0]


def _height(nodes: int) -> int:
    height = 0
    while FAN**height < nodes:
        height += 1
    return height


def _block_witnesses(table: pa.Table) -> pa.Table:
    table = table.sort_by("pos")
    subtree = OpenSubtrees()
    for node in table.column("leaf").to_pylist():
        subtree.append(node)
    root = subtree.close(min(HEIGHT, _height(table.column("of")[0].as_py())))
    sizes = [0]
    for witness in subtree.witnesses:
        sizes.append(sizes[-1] + len(witness))
    steps = [step for witness in subtree.witnesses for step in witness]
    sides = [pa.array([step[i] for step in steps], pa.binary()) for i in (0, 1)]
    lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(sides, ["left", "right"]))
    return table.append_column("steps", lists).append_column("block_root", pa.array([root] * len(table), pa.binary()))


def _inner(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``group, pos, of, leaf`` and others) with ``block``, ``steps`` up to its root, and ``block_root``."""
    dealt = nodes.withColumn("block", F.expr(f"pos DIV {FAN**HEIGHT}"))
    schema = ", ".join(f"`{name}` {kind}" for name, kind in dealt.dtypes)
    found = dealt.groupBy("group", "block").applyInArrow(_block_witnesses, f"{schema}, steps {STEPS}, block_root binary")
    return stored(found, "witnesses")


def _extended(inner: DataFrame, blocks: DataFrame) -> DataFrame:
    """The witnesses of ``inner`` continued by those of its blocks; the other columns of the blocks are added."""
    above = blocks.withColumnsRenamed({"group": "_group", "pos": "_pos", "steps": "_steps"}).drop("of", "leaf")
    same = F.col("group").eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_pos"))
    longer = inner.join(above, same).withColumn("steps", F.concat("steps", "_steps"))
    return longer.drop("_group", "_pos", "_steps", "block", "block_root")


def _tops(inner: DataFrame) -> DataFrame:
    """``group, pos, steps, top``: per block its root's own way up, the roots being appended one after the other."""
    blocks = inner.where(f"pos % {FAN**HEIGHT} = 0").select(
        "group", F.col("block").alias("pos"), F.expr(f"(of + {FAN**HEIGHT - 1}) DIV {FAN**HEIGHT}").alias("of"),
        F.col("block_root").alias("leaf"),
    )
    if (blocks.agg(F.max("of")).first()[0] or 0) <= 1:
        return blocks.select("group", "pos", F.expr(f"CAST(array() AS {STEPS})").alias("steps"), F.col("leaf").alias("top"))
    outer = _inner(blocks)
    return _extended(outer, _tops(outer)).select("group", "pos", "steps", "top")


def proofs(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (``group, leaf`` and others) with ``steps`` up to the root, ``subtop`` (of the group) and ``top``."""
    inner = _inner(numbered(rows, order))
    blocks = stored(_tops(inner), "blocks")
    # The roots of the groups are the leaves of one more tree.
    subroots = blocks.where("pos = 0").select(F.lit(0).alias("group"), F.col("group").alias("name"), F.col("top").alias("leaf"))
    over = _inner(numbered(subroots, ["name"]))
    named = _extended(over, _tops(over)).select("name", F.col("steps").alias("_over"), F.col("top").alias("_root"))
    whole = blocks.join(named, F.col("group").eqNullSafe(F.col("name"))).select(
        "group", "pos", F.concat("steps", "_over").alias("steps"), F.col("top").alias("subtop"), F.col("_root").alias("top")
    )
    return _extended(inner, whole).drop("pos", "of")


def _hex(value: str | Column) -> Column:
    return F.lower(F.hex(value))


def folded(leaf: Column, steps: str) -> Column:
    """The root that a leaf and a witness lead to."""
    return F.aggregate(steps, _hex(leaf), lambda node, step: digest(_hex(step["left"]), node, _hex(step["right"])))


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, steps`` of the untampered rows, and ``changed``, the leaf of the tampered row."""
    with scratch(docs.sparkSession) as keep:
        found = keep(proofs(leaves(docs), ["key", "leaf", "changed"]), "manifest")
    return found.select(
        F.col("key").alias("doc_id"), "leaf", F.col("subtop").alias("subroot"), F.col("top").alias("root"), "steps", "changed"
    )


def checked(found: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: every tampered row held against its proof."""
    siblings = F.array_join(F.transform("steps", lambda step: _hex(F.concat(step["left"], step["right"]))), "")
    way = found.withColumn("folded_root", folded(F.col("changed"), "steps"))
    return way.select(
        "doc_id", _hex("leaf").alias("leaf"), _hex("subroot").alias("subroot"), _hex("root").alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == _hex("root")).alias("verified"),
    )
