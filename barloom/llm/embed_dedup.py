"""Near-duplicate embeddings: spherical k-means cells and blocked cosine products within cells."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.components import components
from barloom.session import stage

# Vectors the cells are fitted on, in the order of their digests; every vector is then indexed.
SAMPLE_ROWS = 4_000
ROUNDS = 8
# Distinct vectors of one label per cell aimed at, and the most cells per dimension. More vectors
# in a cell only mean more blocks.
CELL_ROWS = 4_096
MAX_CELLS = 64
# Rows of a block; a task holds two blocks and multiplies CHUNK rows at once.
BLOCK_ROWS = 4_096
CHUNK = 256
# Slack for rounding when deciding which cells a vector is copied to.
EPSILON = 1e-9

UNITS = "vec_id long, place binary, node binary, dim int, unit array<double>"
ENTRIES = "place binary, dim int, cell int, home boolean, node binary, copies long, unit array<double>"


def near_vectors(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Two vectors of the same label (not null) and dimension are linked if their cosine, in double
    precision, reaches ``threshold``. ``n_links`` counts the other vectors linked directly,
    ``component_id`` is the smallest id reachable, ``kept`` marks the row that bears it.

    Equal vectors of a label are folded first. Cells are the nearest of k centroids; a vector is
    also copied to each cell that a vector within the threshold of it may belong to: its distance
    to the plane between the two centroids is at most the sine of the threshold's angle. That
    bound is exact, so no link is lost, whatever the data; vectors without any structure are copied
    to most cells, clustered ones to few. A cell is cut into blocks, a task holds two of them, and
    what leaves a task is a count per vector and the edges of a spanning forest, never all pairs.

    Vectors that are null, empty, zero, or hold null or non-finite components, null labels and
    null ids link with nothing (component_id is the id, kept). A repeated id gives equal rows for
    equal vectors. Other columns are ignored; an empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(label_col).cast("string").alias("label"),
                          F.col(vector_col).cast("array<double>").alias("vector"))
    units = stage(rows.mapInArrow(_units, UNITS), "units")
    folded = stage(units.filter("vec_id IS NOT NULL AND node IS NOT NULL")
                   .groupBy("node").agg(F.min("vec_id").alias("first_id"),
                                        F.count("*").alias("copies"), F.first("place").alias("place"),
                                        F.first("dim").alias("dim"), F.first("unit").alias("unit")),
                   "folded")
    entries = stage(folded.mapInArrow(
        _assigner(_centroids(folded), math.sqrt(1 - threshold ** 2)), ENTRIES), "entries")
    tiles = stage(_tiled(entries).groupBy("place", "dim", "cell", "row_block", "other_block")
                  .applyInPandas(_compare(threshold), "a binary, b binary, n long"), "tiles")
    found = tiles.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(tiles.filter("b IS NOT NULL"))
    named = stage(folded.select("node", "first_id", "copies").join(found, "node", "left")
                  .join(roots, "node", "left")
                  .select("node", "first_id", F.coalesce("root", "node").alias("root"),
                          (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")),
                  "named")
    smallest = stage(named.groupBy("root").agg(F.min("first_id").alias("component_id")), "smallest")
    of_node = stage(named.join(smallest, "root").select("node", "n_links", "component_id"), "of_node")
    known = F.col("vec_id").isNotNull()
    return (units.select("vec_id", "node").join(of_node, "node", "left")
            .select("vec_id",
                    F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
                    F.when(known, F.coalesce("component_id", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors; ``place`` names label, ``node`` label and vector; both null if it cannot link."""
    for batch in batches:
        places, nodes, dims, units = [], [], [], []
        for label, vector in zip(batch.column(1).to_pylist(), batch.column(2)):
            unit = None
            if label is not None and vector.is_valid and vector.values.null_count == 0:
                values = vector.values.to_numpy(zero_copy_only=False)
                top = np.abs(values).max(initial=0.0)
                if 0 < top < math.inf:  # false for NaN too
                    unit = values / top
                    unit = unit / math.sqrt(unit @ unit)
            units.append(unit)
            dims.append(None if unit is None else len(unit))
            # + 0.0 makes the two zeros one.
            places.append(None if unit is None else hashlib.md5(label.encode()).digest())
            nodes.append(None if unit is None else
                         hashlib.md5(places[-1] + (values + 0.0).tobytes()).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(places, pa.binary()), pa.array(nodes, pa.binary()),
             pa.array(dims, pa.int32()), pa.array(units, pa.list_(pa.float64()))],
            names=["vec_id", "place", "node", "dim", "unit"])


def _centroids(folded: DataFrame) -> dict[int, np.ndarray]:
    """Spherical k-means per dimension on a bounded sample; other dimensions have one cell."""
    largest = folded.groupBy("place", "dim").count().groupBy("dim").agg(F.max("count").alias("n"))
    # Dimensions of the sample's vectors only, so at most SAMPLE_ROWS rows reach the driver.
    sample: dict[int, list[list[float]]] = {}
    for row in folded.orderBy("node").limit(SAMPLE_ROWS).select("dim", "unit").collect():
        sample.setdefault(row["dim"], []).append(row["unit"])
    sizes = {r["dim"]: r["n"] for r in largest.filter(F.col("dim").isin(list(sample))).collect()}
    fitted = {}
    for dim, vectors in sample.items():
        held = np.array(vectors)
        k = min(max(1, math.ceil(sizes[dim] / CELL_ROWS)), MAX_CELLS, len(held))
        centres = held[:k].copy()
        for _ in range(ROUNDS):
            nearest = (held @ centres.T).argmax(axis=1)
            for j in range(k):
                total = held[nearest == j].sum(axis=0)
                if (length := math.sqrt(total @ total)) > 0:
                    centres[j] = total / length
        fitted[dim] = centres
    return fitted


def _assigner(centres: dict[int, np.ndarray], sine: float):
    """Entries of each vector: in its own cell, and in those where a near vector may be."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column(batch.schema.names.index("dim")))
            take, cells, homes = [], [], []
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                held = batch.column(batch.schema.names.index("unit")).take(pa.array(at))
                c = centres.get(int(dim), np.zeros((1, dim)))
                near = held.flatten().to_numpy().reshape(len(at), dim) @ c.T
                home = near.argmax(axis=1)
                apart = np.sqrt(np.maximum(
                    ((c[home][:, None, :] - c[None]) ** 2).sum(axis=2), 0)) if len(c) > 1 else \
                    np.zeros((len(at), 1))
                lead = near[np.arange(len(at)), home][:, None] - near
                row, cell = np.nonzero(lead <= sine * apart + EPSILON)
                take.append(at[row])
                cells.append(cell)
                homes.append(cell == home[row])
            if not take:
                continue
            chosen = pa.array(np.concatenate(take))
            column = {n: batch.column(k).take(chosen) for k, n in enumerate(batch.schema.names)}
            yield pa.RecordBatch.from_arrays(
                [column["place"], column["dim"], pa.array(np.concatenate(cells).astype(np.int32)),
                 pa.array(np.concatenate(homes)), column["node"], column["copies"],
                 column["unit"]],
                names=["place", "dim", "cell", "home", "node", "copies", "unit"])
    return assign


def _tiled(entries: DataFrame) -> DataFrame:
    """Entries copied to their tiles: block of own rows of a cell x block of all rows of it."""
    cell = ["place", "dim", "cell"]
    blocks = stage(entries.groupBy(*cell).agg(
        F.ceil(F.count(F.when(F.col("home"), 1)) / BLOCK_ROWS).cast("int").alias("row_blocks"),
        F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("other_blocks"))
        .filter("row_blocks > 0"), "blocks")
    sized = entries.join(blocks, cell)
    digest = F.xxhash64("node")
    every = [*cell, "node", "copies", "unit"]
    own = (sized.filter("home").withColumn("row_block", F.pmod(digest, "row_blocks"))
           .withColumn("other_block", F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1)))
           .select(*every, "row_block", F.col("other_block").cast("long").alias("other_block"),
                   F.lit(True).alias("own")))
    others = (sized.withColumn("other_block", F.pmod(digest, "other_blocks"))
              .withColumn("row_block", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
              .select(*every, F.col("row_block").cast("long").alias("row_block"), "other_block",
                      F.lit(False).alias("own")))
    return own.union(others)


def _compare(threshold: float):
    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        own, other = tile[tile["own"]], tile[~tile["own"]]
        if own.empty or other.empty:
            return pd.DataFrame({"a": [], "b": [], "n": []})
        nodes = pd.Index(own["node"]).append(pd.Index(other["node"])).unique()
        left, right = nodes.get_indexer(own["node"]), nodes.get_indexer(other["node"])
        x, y = np.stack(own["unit"].to_numpy()), np.stack(other["unit"].to_numpy())
        copies = other["copies"].to_numpy()
        counts, label = np.zeros(len(own), np.int64), np.arange(len(nodes))
        for k in range(0, len(x), CHUNK):
            linked = x[k:k + CHUNK] @ y.T >= threshold
            linked &= left[k:k + CHUNK, None] != right[None]
            counts[k:k + CHUNK] = linked @ copies
            i, j = np.nonzero(linked)
            label = _joined(label, left[k + i], right[j])
        off = np.flatnonzero((label != np.arange(len(nodes))))
        some = np.flatnonzero(counts)
        return pd.DataFrame({
            "a": [*nodes[left[some]], *nodes[off]],
            "b": [*[None] * len(some), *nodes[label[off]]],
            "n": [*counts[some], *[0] * len(off)]})
    return compare


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Component labels after adding links i - j; a label is a member and labels itself."""
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        for end in (i, j, label[i], label[j]):
            np.minimum.at(new, end, low)
        while not np.array_equal(jumped := new[new], new):
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new
