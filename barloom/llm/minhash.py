"""Near-duplicate texts by one-permutation MinHash, banded buckets and star-shaped candidates."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import shingles
from barloom.llm.components import components
from barloom.llm.shingles import U64
from barloom.session import Scratch, small_batches, stage

# Largest chance that a pair just at the threshold shares no bucket.
MISS = 1e-6
PER_BAND = 5
# 64-bit words of a set's sketch; sets of up to some thousand shingles are told apart by it.
SKETCH = 16
# Members and shingles of a block of a tile; a task holds two blocks.
BLOCK_MEMBERS = 1_024
BLOCK_SHINGLES = 400_000
# Shingle hashes sent to Python's output at once.
ROWS_OUT = 2000


def bands_for(percent: int, per_band: int = PER_BAND, miss: float = MISS) -> int:
    """Bands after which a pair at the threshold has met with probability 1 - ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** per_band)))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Two texts are linked when 100 x intersection >= ``percent`` x union of their sets of distinct
    ``width``-word shingles (words: runs without ASCII white space, A-Z lowered; a shorter text is
    one shingle). ``component_id`` is the smallest id reachable over links, ``kept`` marks the row
    that bears it.

    Equal sets are folded first, so groups of exact copies cost one row. The rest meets in banded
    buckets of a one-permutation signature. A bucket never emits its pairs: members that can be
    linked to any other, judged by their shingles that no other set has, are held against one hub;
    pairs whose sketches differ in more bits than the sets may in shingles are left out by the join,
    the rest is confirmed on full sets, and components are taken. What a bucket then still holds of
    several components is cut into blocks; a task compares two blocks, sketches first, full sets where
    these allow a link between components, and returns the links that join components in it, fewer than
    it has members. All filters are exact bounds, so within the buckets no link between components is
    lost, and a pair at the threshold shares no bucket with probability 1e-6.

    Null and blank texts have no shingle and stay alone, as do rows whose id is null (component_id
    null, kept). Rows are judged by text: a repeated id on equal texts gives equal rows. Other
    columns of ``docs`` are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    bands = bands_for(percent)
    with small_batches(docs.sparkSession):
        signed = stage(rows.mapInArrow(
            _signer(width, bands), "doc_id long, node binary, n_shingles long, bands array<long>"),
            "signed")
    scratch = Scratch(docs.sparkSession)
    groups = scratch.stage(signed.filter("doc_id IS NOT NULL AND node IS NOT NULL")
                   .groupBy("node").agg(F.min("doc_id").alias("first_id"),
                                        F.first("n_shingles").alias("n"),
                                        F.first("bands").alias("bands")), "groups")
    roots = components(_links(rows, groups, width, percent, scratch), scratch)
    named = groups.select("node", "first_id").join(roots, "node", "left") \
        .withColumn("root", F.coalesce("root", "node"))
    smallest = scratch.stage(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    of_node = stage(scratch.stage(named, "named").join(smallest, "root").select("node", "component_id"),
                    "of_node")
    scratch.clear()
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(
        F.coalesce("component_id", "doc_id"))
    return (signed.select("doc_id", "n_shingles", "node").join(of_node, "node", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _signer(width: int, bands: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for start, stop, data, offsets in shingles.text_slices(batch.column(1)):
                values, ends = shingles.shingle_sets(data, offsets, width)
                keys = shingles.band_keys(
                    shingles.one_permutation(values, ends, bands * PER_BAND), PER_BAND)
                flat = pa.array(keys.reshape(-1).view(np.int64))
                steps = pa.array(np.arange(stop - start + 1, dtype=np.int32) * bands)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, stop - start),
                     pa.array(shingles.set_prints(values, ends), pa.binary()),
                     pa.array(np.diff(ends).astype(np.int64)),
                     pa.ListArray.from_arrays(steps, flat)],
                    names=["doc_id", "node", "n_shingles", "bands"])
        # Workers wait for later tasks and would keep what the batches took.
        pa.default_memory_pool().release_unused()
    return sign


def _set_writer(width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in shingles.text_slices(batch.column(0)):
                values, ends = shingles.shingle_sets(data, offsets, width)
                prints = shingles.set_prints(values, ends)
                sketches = shingles.odd_sketches(values, ends, SKETCH)
                for k in range(0, len(prints), ROWS_OUT):
                    cut = ends[k:k + ROWS_OUT + 1]
                    held = values[cut[0]:cut[-1]].view(np.int64)
                    bits = sketches[k:k + ROWS_OUT].reshape(-1).view(np.int64)
                    steps = np.arange(len(cut), dtype=np.int32) * SKETCH
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(prints[k:k + ROWS_OUT], pa.binary()),
                         pa.ListArray.from_arrays(pa.array(steps), pa.array(bits)),
                         pa.ListArray.from_arrays(pa.array((cut - cut[0]).astype(np.int32)),
                                                  pa.array(held))],
                        names=["node", "sketch", "hashes"])
        pa.default_memory_pool().release_unused()
    return write


def _links(rows: DataFrame, groups: DataFrame, width: int, percent: int, scratch: Scratch) -> DataFrame:
    """Confirmed links (a, b) that connect all groups which share a bucket and pass the threshold."""
    star = Scratch(rows.sparkSession)
    entries = groups.select("node", "n", F.explode("bands").alias("bucket"))
    shared = star.stage(entries.groupBy("bucket").count().filter("count > 1").select("bucket"), "shared")
    members = star.stage(entries.join(shared, "bucket").select("bucket", "node", "n",
                                                               F.col("node").alias("root")), "members")
    with small_batches(rows.sparkSession):
        sets = scratch.stage(_sets(rows, groups, members, width, star), "sets")
    able = _viable(members, sets, percent, star)
    hubs = star.stage(_hubs(able), "hubs")
    links = scratch.stage(_confirmed(able, hubs, sets, percent, star), "links")
    left = _without(able, hubs, components(links, star), scratch)
    star.clear()
    tiles = _tiles(left, sets).groupBy("bucket", "low", "high").applyInPandas(
        _joined(percent), "a binary, b binary")
    return links.union(scratch.stage(tiles, "joined"))


def _tiles(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members with their sets, copied to the tiles of their block with each block of their bucket."""
    blocks = members.groupBy("bucket").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).alias("own")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    placed = members.join(blocks, "bucket").select("bucket", "node", "root", own, "blocks") \
        .select("bucket", "node", "root", "own", other)
    return placed.join(sets, "node").select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own",
        "node", "root", "sketch", "hashes")


def _joined(percent: int):
    """Links between members of a tile that join components not joined before, one after the other."""
    def join(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values("node")
        nodes, hashes = tile["node"].to_numpy(), tile["hashes"].to_numpy()
        sketch = np.stack(tile["sketch"].to_numpy()).view(U64)
        size = np.array([len(h) for h in hashes])
        label = np.unique(tile["root"].to_numpy(), return_inverse=True)[1]
        own, low, high = tile["own"].to_numpy(), tile["low"].iloc[0], tile["high"].iloc[0]
        rows = np.flatnonzero(own == low)
        links = []
        for i in rows:
            # A block met with itself holds each pair twice.
            others = np.arange(i + 1, len(nodes)) if low == high else np.flatnonzero(own == high)
            others = others[label[others] != label[i]]
            both = size[others] + size[i]
            apart = np.bitwise_count(sketch[others] ^ sketch[i]).sum(axis=1, dtype=np.int64)
            may = ((100 + percent) * apart <= (100 - percent) * both) & (
                100 * np.minimum(size[others], size[i]) >= percent * np.maximum(size[others], size[i]))
            for j in others[may]:
                if label[j] == label[i]:
                    continue
                common = len(np.intersect1d(hashes[i], hashes[j], assume_unique=True))
                if 100 * common >= percent * (size[i] + size[j] - common):
                    links.append((nodes[i], nodes[j]))
                    label[label == label[j]] = label[i]
        return pd.DataFrame(links, columns=["a", "b"], dtype=object)
    return join


def _sets(rows: DataFrame, groups: DataFrame, members: DataFrame, width: int,
          scratch: Scratch) -> DataFrame:
    """(node, sketch, hashes) of every group that shares a bucket, from the text of its first id."""
    chosen = scratch.stage(groups.join(members.select("node").distinct(), "node", "left_semi")
                   .select(F.col("first_id").alias("doc_id")).distinct(), "chosen")
    texts = rows.join(chosen, "doc_id", "left_semi").select("text")
    return (texts.mapInArrow(_set_writer(width), "node binary, sketch array<long>, hashes array<long>")
            .filter("node IS NOT NULL").dropDuplicates(["node"]))


def _viable(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Members that some other member may be linked to, with the number of shingles only they have.

    A shingle of one set alone is in no intersection, so a set with too many of them reaches the
    threshold with nothing. In large groups of loose copies this leaves few.
    """
    owner = F.xxhash64("node").alias("owner")
    held = sets.join(members.select("node").distinct(), "node", "left_semi")
    alone = (held.select(owner, F.explode("hashes").alias("hash"))
             .groupBy("hash").agg(F.count("*").alias("sets"), F.min("owner").alias("owner"))
             .filter("sets = 1").groupBy("owner").agg(F.count("*").alias("alone")))
    counted = (members.withColumn("owner", owner).join(alone, "owner", "left").drop("owner")
               .withColumn("alone", F.coalesce("alone", F.lit(0))))
    able = counted.filter(100 * (F.col("n") - F.col("alone")) >= percent * F.col("n"))
    return _mixed(scratch.stage(able, "viable"), scratch)


def _mixed(members: DataFrame, scratch: Scratch) -> DataFrame:
    """Members of buckets that hold more than one component."""
    mixed = (members.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
             .filter("low != high").select("bucket"))
    return scratch.stage(members.join(mixed, "bucket").select(members.columns), "open")


def _hubs(members: DataFrame) -> DataFrame:
    """One hub per bucket: the member with the smallest part of shingles of its own, nearest to others."""
    part = (F.col("alone") / F.col("n")).alias("part")
    return members.groupBy("bucket").agg(
        F.min(F.struct(part, "node", "n", "alone", "root")).alias("hub")).select(
        "bucket", "hub.node", "hub.n", "hub.alone", "hub.root")


def _confirmed(members: DataFrame, hubs: DataFrame, sets: DataFrame, percent: int,
               scratch: Scratch) -> DataFrame:
    """Links between hubs and the members of their bucket that are in another component.

    Sizes, shingles of one set alone and sketches bound the similarity from above, all within the
    join: a pair that cannot reach the threshold is never emitted.
    """
    sketches = sets.select("node", "sketch")
    members = members.join(sketches, "node")
    hub = hubs.join(sketches.withColumnRenamed("sketch", "sketch_a"), "node").select(
        "sketch_a", "bucket", F.col("node").alias("a"), F.col("n").alias("n_a"),
                      F.col("alone").alias("alone_a"), F.col("root").alias("root_a"))
    both = F.col("n") + F.col("n_a")
    most = F.least(F.col("n") - F.col("alone"), F.col("n_a") - F.col("alone_a"))
    apart = sum((F.bit_count(F.get("sketch", F.lit(k)).bitwiseXOR(F.get("sketch_a", F.lit(k))))
                 for k in range(SKETCH)), F.lit(0))
    pairs = scratch.stage(
        members.join(hub, "bucket").filter("root != root_a")
        .filter(100 * most >= percent * (both - most))
        .filter((100 + percent) * apart <= (100 - percent) * both)
        .select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b"),
                both.alias("both")).distinct(), "pairs")
    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("set_a")), "a")
    with_b = with_a.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("set_b")), "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return (with_b.select("a", "b", "both", common.alias("common"))
            .filter(100 * F.col("common") >= percent * (F.col("both") - F.col("common")))
            .select("a", "b"))


def _without(members: DataFrame, hubs: DataFrame, roots: DataFrame, scratch: Scratch) -> DataFrame:
    """Members other than the hub under their new roots, where a bucket still mixes components."""
    rest = members.select("bucket", "node", "n").join(
        hubs.select("bucket", "node"), ["bucket", "node"], "left_anti")
    rooted = rest.join(roots, "node", "left").select(
        "bucket", "node", "n", F.coalesce("root", "node").alias("root"))
    return _mixed(scratch.stage(rooted, "rooted"), scratch)
