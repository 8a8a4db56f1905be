"""Merkle manifest of a table: SHA-256 trees whose parents retain their state before each child."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import Scratch, stage

FANOUT = 3
# Levels of a tree that one row of a staged table holds: FANOUT ** HEIGHT nodes side by side.
HEIGHT = 5
# Leaves whose results are handed on at once.
ROWS_OUT = 2_000

STEP = "array<struct<slot:int,run:array<string>>>"


@dataclass(frozen=True)
class Manifest:
    """``groups`` (group, n_leaves, subroot, root), and ``leaves`` with a proof for each row."""

    groups: DataFrame
    leaves: DataFrame


def leaf(*values: Column) -> Column:
    """Digest of the values, each as its UTF-8 byte count, a colon and itself, or ``-`` for null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t),
                                        F.lit("-")) for t in texts)), 256)


def manifest(rows: DataFrame, group_col: str = "group", key_col: str = "key", leaf_col: str = "leaf",
             new_leaf_col: str | None = None, height: int = HEIGHT) -> Manifest:
    """Tree over the leaves of each group, tree over the groups' roots, and every leaf's proof.

    Leaves of a group stand in the order of their keys (null first, equal keys by leaf); while
    several nodes remain, each FANOUT consecutive ones (the last run may be shorter, even one) become
    the digest of their hex digests in a row. The roots of the groups, in the order of the groups (null
    first, by UTF-8 bytes), are built on alike to ``root``.

    ``leaves`` has (group, key, position, leaf, subroot, root, siblings, folded_root, verified), one row
    per row: ``siblings`` are the others of each run, level by level up to the root, left to right;
    ``folded_root`` is the root that follows from ``new_leaf_col`` (where it is null or not given: from
    the leaf itself) and those siblings. A parent keeps a copy of its hash state before each child; a
    fold resumes the copy at the leaf's slot with the new digest and the right siblings, so nothing left
    of it is hashed again.

    Positions come from a range partitioning, so a group of any size is spread over tasks; a staged row
    holds FANOUT ** ``height`` leaves, and the trees are built ``height`` levels a pass, each over a
    table that many times smaller. Repeated rows are leaves of their own; the columns named are the only ones read; an empty
    table gives empty tables.
    """
    scratch = Scratch(rows.sparkSession)
    new_leaf = F.col(new_leaf_col) if new_leaf_col else F.lit(None)
    # The mark before a name keeps null apart from the empty one, and first.
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("g"), F.col(group_col).cast("string")), F.lit("")).alias("tree"),
        F.col(key_col).alias("key"), F.col(leaf_col).alias("node"),
        new_leaf.cast("string").alias("new_node"))
    chunks = _chunks(_numbered(leaves, ["tree", "key", "node"], scratch), ["key", "new_node"], height,
                     scratch)
    above = scratch.stage(_above(chunks, height, scratch), "above")
    tops = above.filter("pos = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"),
                                          F.col("top").alias("node"))
    crown = _chunks(_numbered(tops, ["tree", "name"], scratch), ["name"], height, scratch)
    ends = stage(crown.join(_as_chunk(_above(crown, height, scratch)), ["tree", "chunk"])
                 .mapInArrow(_down("name", height), f"tree string, name string, path {STEP}, top string")
                 .select("name", F.col("path").alias("end"), F.col("top").alias("root")), "ends")
    paths = (above.join(ends, above["tree"] == ends["name"])
             .select("tree", F.col("pos").alias("chunk"), F.concat("path", "end").alias("path"),
                     F.col("top").alias("subroot"), "root"))
    whole = stage(chunks.join(paths, ["tree", "chunk"]).select(
        _name("tree"), "chunk", "size", "nodes", "members.key", "members.new_node", "path", "subroot",
        "root"), "whole")
    scratch.clear()
    key_type = rows.schema[key_col].dataType.simpleString()
    proofs = whole.mapInArrow(_prove(height), (
        f"group string, key {key_type}, position long, leaf string, subroot string, root string, "
        "siblings array<string>, folded_root string, verified boolean"))
    groups = whole.filter("chunk = 0").select("group", F.col("size").alias("n_leaves"), "subroot", "root")
    return Manifest(groups, proofs)


def _name(column: str) -> Column:
    return F.when(F.col(column) != "", F.substring(column, 2, 1 << 30)).alias("group")


def _numbered(rows: DataFrame, order: list[str], scratch: Scratch) -> DataFrame:
    """``rows`` with their position in their tree and the tree's size, without one task per tree.

    Rows are range-partitioned and numbered within partitions; what comes before a partition is a
    sum over at most one row per partition of a tree.
    """
    held = scratch.stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id()), "numbered")
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (held.groupBy("tree", "part").agg(F.min("at").alias("low"), F.count("*").alias("n"))
             .select("tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low"))
                     .alias("shift"), F.sum("n").over(tree).alias("size")))
    return held.join(parts, ["tree", "part"]).select(
        *rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "size")


def _chunks(nodes: DataFrame, payload: list[str], height: int, scratch: Scratch) -> DataFrame:
    """(tree, chunk, size, nodes, members, top): neighbours in one row, and the node above them all.

    A tree of one chunk ends in its root; chunks of a larger one are all ``height`` levels high.
    """
    grouped = nodes.groupBy("tree", F.expr(f"pos div {FANOUT ** height}").alias("chunk")).agg(
        F.max("size").alias("size"),
        F.array_sort(F.collect_list(F.struct("pos", "node", *payload))).alias("members"))
    schema = grouped.select("*", F.col("members.node").alias("nodes"))
    return scratch.stage(schema.mapInArrow(_topped(height), schema.withColumn("top", F.lit("")).schema), "chunks")


def _above(chunks: DataFrame, height: int, scratch: Scratch) -> DataFrame:
    """(tree, pos, path, top): what stands over each chunk of ``chunks`` (pos), up to its tree's root."""
    nodes = chunks.select("tree", F.col("chunk").alias("pos"), F.col("top").alias("node"),
                          F.ceil(F.col("size") / FANOUT ** height).alias("size"))
    if nodes.filter("size > 1").isEmpty():
        return nodes.select("tree", "pos", F.array().cast(STEP).alias("path"), F.col("node").alias("top"))
    upper = _chunks(nodes, [], height, scratch)
    return upper.join(_as_chunk(_above(upper, height, scratch)), ["tree", "chunk"]).mapInArrow(
        _down("pos", height), f"tree string, pos long, path {STEP}, top string")


def _as_chunk(above: DataFrame) -> DataFrame:
    return above.select("tree", F.col("pos").alias("chunk"), "path", F.col("top").alias("root"))


class Parent:
    """A run of children, its digest, and the hash state before each child."""

    def __init__(self, run: list[str]):
        self.run = run
        self._states = []
        state = hashlib.sha256()
        for child in run:
            self._states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def fold(self, slot: int, child: str) -> str:
        """The digest with another child at ``slot``."""
        state = self._states[slot].copy()
        state.update(child.encode())
        for right in self.run[slot + 1:]:
            state.update(right.encode())
        return state.hexdigest()

    def siblings(self, slot: int) -> list[str]:
        return self.run[:slot] + self.run[slot + 1:]


def levels(nodes: list[str], size: int, height: int) -> list[list[Parent]]:
    """Parents over a chunk of a tree of ``size`` nodes, level by level: one chunk goes up to its root."""
    out: list[list[Parent]] = []
    while (len(nodes) > 1) if size <= FANOUT ** height else (len(out) < height):
        out.append([Parent(nodes[k:k + FANOUT]) for k in range(0, len(nodes), FANOUT)])
        nodes = [p.digest for p in out[-1]]
    return out


def _small(batches: Iterator[pa.RecordBatch], height: int) -> Iterator[pa.RecordBatch]:
    step = max(1, ROWS_OUT // FANOUT ** height)
    for whole in batches:
        for k in range(0, len(whole), step):
            yield whole.slice(k, step)


def _topped(height: int):
    def topped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches, height):
            tops = []
            for nodes, size in zip(batch["nodes"].to_pylist(), batch["size"].to_pylist()):
                tree = levels(nodes, size, height)
                tops.append(tree[-1][0].digest if tree else nodes[0])
            yield batch.append_column("top", pa.array(tops, pa.string()))
    return topped


def _steps(tree: list[list[Parent]], at: int) -> Iterator[tuple[Parent, int]]:
    for level in tree:
        yield level[at // FANOUT], at % FANOUT
        at //= FANOUT


def _down(name: str, height: int):
    """Path and root of each member of each chunk, with the members' column ``name``."""
    path_type = pa.list_(pa.struct([("slot", pa.int32()), ("run", pa.list_(pa.string()))]))

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches, height):
            trees, named, paths, tops = [], [], [], []
            for row in batch.select(["tree", "size", "nodes", "members", "path", "root"]).to_pylist():
                tree = levels(row["nodes"], row["size"], height)
                for at, member in enumerate(row["members"]):
                    trees.append(row["tree"])
                    named.append(member[name])
                    paths.append([{"slot": slot, "run": parent.run} for parent, slot in _steps(tree, at)]
                                 + row["path"])
                    tops.append(row["root"])
            kinds = {f.name: f.type for f in batch["members"].type.value_type}
            yield pa.RecordBatch.from_arrays(
                [pa.array(trees, pa.string()), pa.array(named, kinds[name]),
                 pa.array(paths, path_type), pa.array(tops, pa.string())],
                names=["tree", name, "path", "top"])
    return down


def _prove(height: int):
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _small(batches, height):
            columns: dict[str, list] = {n: [] for n in (
                "group", "key", "position", "leaf", "subroot", "root", "siblings", "folded_root",
                "verified")}
            for row in batch.to_pylist():
                tree = levels(row["nodes"], row["size"], height)
                upper = [(Parent(step["run"]), step["slot"]) for step in row["path"]]
                over = [s for parent, slot in upper for s in parent.siblings(slot)]
                for at, own in enumerate(row["nodes"]):
                    siblings, value = [], row["new_node"][at] or own
                    for parent, slot in _steps(tree, at):
                        siblings += parent.siblings(slot)
                        value = parent.fold(slot, value)
                    for parent, slot in upper:
                        value = parent.fold(slot, value)
                    for name, v in zip(columns, (
                            row["group"], row["key"][at], row["chunk"] * FANOUT ** height + at, own,
                            row["subroot"], row["root"], siblings + over, value, value == row["root"])):
                        columns[name].append(v)
            types = {"key": batch["key"].type.value_type, "position": pa.int64(),
                     "siblings": pa.list_(pa.string()), "verified": pa.bool_()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, types.get(n, pa.string())) for n, v in columns.items()], names=list(columns))
    return prove
