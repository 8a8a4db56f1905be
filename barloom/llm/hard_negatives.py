"""Hard negatives of anchors by inner products of integers, several candidates in one wide integer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import Scratch, stage

# Rows and anchors of a tile: a task holds one block of each.
ROW_BLOCK = 16_384
ANCHOR_BLOCK = 2_048
# Largest components and dimension: with these every score fits into 62 bits.
LARGEST = 1 << 26
MOST_DIMS = 1 << 10

POSITIVE = "anchor_id long, anchor_mark long, positive_id long, positive_mark long, positive_score long"
NEGATIVE = POSITIVE + ", negative_id long, negative_mark long, negative_score long"


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, scale: int = 256, id_col: str = "vec_id",
                   vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components x become floor(``scale`` * x); a score is the integer inner product with the anchor.
    Higher scores come first, ties by smaller id. The rows that ``anchor`` names are the anchors; the
    first ``positives`` other rows of an anchor's label are its positives; for each of them the first
    ``negatives`` rows of other labels with low * p <= 100 * n <= high * p are returned, rank from 1.

    Kronecker packing: the rows of a block are made non-negative by adding a bias, and one component
    of all of them stands in separated fields of one wide integer. An anchor's component multiplies it
    once for all rows (positive and negative ones are added up apart, so that no field borrows), the
    fields are wide enough for the largest sum, and unpacking gives exact scores.

    Every anchor meets every row, in tiles of a block of each; a tile returns at most ``positives`` or
    positives x negatives rows per anchor, which are ranked over the tiles. Positives meet rows of
    their label only. A label of any size is cut into blocks.

    Rows with a null id, a null label, a null or empty vector, null or non-finite components, components
    beyond LARGEST or more than MOST_DIMS of them take no part; vectors of different dimensions are not
    compared. Equal rows (id, label, vector) count as one, of equal ids with other vectors or labels each
    counts, ties by a hash. Anchors without a positive, or positives without a negative, give no row.
    Other columns are read by ``anchor`` only; an empty table gives an empty result.
    """
    scratch = Scratch(vectors.sparkSession)
    vector = F.col(vector_col).cast("array<double>")
    scaled = F.transform(vector, lambda x: F.floor(x * F.lit(float(scale))))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                      & (F.abs(x * F.lit(float(scale))) <= LARGEST))
    rows = (vectors.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
            .filter((F.size(vector) > 0) & (F.size(vector) <= MOST_DIMS) & usable)
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                    scaled.cast("array<int>").alias("parts"), F.coalesce(anchor, F.lit(False)).alias("asks"))
            .withColumn("mark", F.xxhash64("label", "parts"))
            .groupBy("id", "mark").agg(F.first("label").alias("label"), F.first("parts").alias("parts"),
                                       F.max("asks").alias("asks"))
            .withColumn("dim", F.size("parts")))
    rows = scratch.stage(rows, "rows")
    asked = rows.filter("asks")
    tile = ["label", "dim", "anchor_block", "row_block"]
    near = _tiled(asked.withColumn("wanted", F.array().cast("array<struct<id:long,mark:long,score:long>>")),
                  rows, ["label", "dim"], scratch)
    found = near.groupBy(*tile).applyInPandas(_positives(positives), POSITIVE)
    found = scratch.stage(_first(found, ["anchor_id", "anchor_mark"], "positive", positives), "positives")
    wanted = found.groupBy(F.col("anchor_id").alias("id"), F.col("anchor_mark").alias("mark")).agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("positive_id").alias("id"), F.col("positive_mark").alias("mark"),
            F.col("positive_score").alias("score")))).alias("wanted"))
    far = _tiled(asked.join(wanted, ["id", "mark"]), rows, ["dim"], scratch)
    mined = far.groupBy("dim", "anchor_block", "row_block").applyInPandas(
        _negatives(negatives, low, high), NEGATIVE)
    pair = ["anchor_id", "anchor_mark", "positive_id", "positive_mark"]
    best = stage(_first(mined, pair, "negative", negatives), "negatives")
    scratch.clear()
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                       "negative_score")


def _first(found: DataFrame, of: list[str], kind: str, n: int) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.desc(f"{kind}_score"), f"{kind}_id", f"{kind}_mark")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _tiled(anchors: DataFrame, rows: DataFrame, place: list[str], scratch: Scratch) -> DataFrame:
    """Anchors and rows of a place, each copied to the tiles of its block with all blocks of the others."""
    sizes = rows.groupBy(*place).agg(F.ceil(F.count("*") / ROW_BLOCK).alias("row_blocks")).join(
        anchors.groupBy(*place).agg(F.ceil(F.count("*") / ANCHOR_BLOCK).alias("anchor_blocks")), place)
    sizes = scratch.stage(sizes, "sizes")
    digest = F.xxhash64("id", "mark")

    def all_of(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    held = ["dim", "id", "mark", "label", "parts"]
    asking = (anchors.join(sizes, place).withColumn("anchor_block", F.pmod(digest, "anchor_blocks"))
              .withColumn("row_block", all_of("row_blocks"))
              .select(*held, "anchor_block", "row_block", "wanted", F.lit(True).alias("asks")))
    others = (rows.join(sizes, place).withColumn("row_block", F.pmod(digest, "row_blocks"))
              .withColumn("anchor_block", all_of("anchor_blocks"))
              .select(*held, "anchor_block", "row_block",
                      F.lit(None).cast(asking.schema["wanted"].dataType).alias("wanted"),
                      F.lit(False).alias("asks")))
    return asking.unionByName(others)


class PackedRows:
    """The j-th components of all rows as the fields of one wide integer."""

    def __init__(self, rows: np.ndarray, largest_sum: int):
        """``largest_sum``: the largest sum of absolute components of an anchor that will be multiplied."""
        self.n = len(rows)
        self.bias = -int(rows.min(initial=0))
        held = (rows + self.bias).astype("<u8")
        self.width = max(1, -(-(int(held.max(initial=0)) * largest_sum).bit_length() // 8))
        fields = held.T.copy().view(np.uint8).reshape(*held.T.shape, 8)[:, :, :self.width]
        self.packed = [int.from_bytes(f.tobytes(), "little") for f in fields]

    def _unpacked(self, total: int) -> np.ndarray:
        out = np.zeros((self.n, 8), np.uint8)
        out[:, :self.width] = np.frombuffer(
            total.to_bytes(self.n * self.width, "little"), np.uint8).reshape(self.n, self.width)
        return out.view("<u8").ravel().astype(np.int64)

    def scores(self, anchor: list[int]) -> np.ndarray:
        up = sum(a * p for a, p in zip(anchor, self.packed) if a > 0)
        down = sum(-a * p for a, p in zip(anchor, self.packed) if a < 0)
        return self._unpacked(up) - self._unpacked(down) - self.bias * sum(anchor)


def _scored(tile: pd.DataFrame) -> Iterator[tuple]:
    """(anchor row, rows' ids, marks, labels, scores), the rows in the order of ids and marks."""
    rows = tile[~tile["asks"]].sort_values(["id", "mark"])
    anchors = tile[tile["asks"]]
    if rows.empty or anchors.empty:
        return
    vectors = np.stack(anchors["parts"].to_numpy()).astype(np.int64)
    packed = PackedRows(np.stack(rows["parts"].to_numpy()).astype(np.int64),
                        int(np.abs(vectors).sum(axis=1).max()))
    ids, marks, labels = (rows[c].to_numpy() for c in ("id", "mark", "label"))
    for anchor, vector in zip(anchors.itertuples(), vectors):
        yield anchor, ids, marks, labels, packed.scores(vector.tolist())


def _frame(found: list[tuple], schema: str) -> pd.DataFrame:
    names = [part.split()[0] for part in schema.split(", ")]
    return pd.DataFrame(np.array(found, dtype=np.int64).reshape(-1, len(names)), columns=names)


def _positives(n: int):
    def best(tile: pd.DataFrame) -> pd.DataFrame:
        found = []
        for anchor, ids, marks, _, scores in _scored(tile):
            order = np.argsort(-scores, kind="stable")[:n + 1]
            others = [k for k in order if ids[k] != anchor.id or marks[k] != anchor.mark][:n]
            found += [(anchor.id, anchor.mark, ids[k], marks[k], scores[k]) for k in others]
        return _frame(found, POSITIVE)
    return best


def _negatives(n: int, low: int, high: int):
    def best(tile: pd.DataFrame) -> pd.DataFrame:
        found = []
        for anchor, ids, marks, labels, scores in _scored(tile):
            other = np.flatnonzero(labels != anchor.label)
            other = other[np.argsort(-scores[other], kind="stable")]
            falling = -scores[other]
            for want in anchor.wanted:
                p = want["score"]
                # low p <= 100 n <= high p, in whole numbers of any size
                start = np.searchsorted(falling, -(high * p // 100), side="left")
                stop = np.searchsorted(falling, low * -p // 100, side="right")
                found += [(anchor.id, anchor.mark, want["id"], want["mark"], p, ids[k], marks[k], scores[k])
                          for k in other[start:max(start, stop)][:n]]
        return _frame(found, NEGATIVE)
    return best
