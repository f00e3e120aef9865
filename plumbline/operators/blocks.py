"""Block pairing for distance work: bounded blocks, pruned by the boxes around them.

Rows are cut into regions by a small k-d split tree, and regions into blocks of
bounded size by a hash of the row id, so a crowded region becomes many blocks.
Only pairs of regions that pass a distance bound meet. A pair of blocks is one
cogroup, which is the most one task ever holds.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.limits import BLOCK_ROWS, BOUNDARY_SAMPLE_ROWS, MAX_REGIONS


def matrix(column: pd.Series) -> np.ndarray:
    return np.concatenate(column.to_numpy()).reshape(len(column), -1) if len(column) else np.empty((0, 0))


@dataclass
class SplitTree:
    """Complete binary tree in heap order: go right where ``x[feature] > threshold``."""

    feature: np.ndarray
    threshold: np.ndarray
    depth: int

    @property
    def regions(self) -> int:
        return 2 ** self.depth

    def region(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x))
        for _ in range(self.depth):
            node = 2 * node + 1 + (x[rows, self.feature[node]] > self.threshold[node])
        return node - (self.regions - 1)


def split_tree(df: DataFrame, rows: int, block_rows: int = BLOCK_ROWS, max_regions: int = MAX_REGIONS) -> SplitTree:
    """Tree with about one leaf per block of rows, from a bounded sample.

    The sample only places boundaries; which rows are compared never depends on it.
    """
    depth = 0 if rows <= block_rows else min(int(math.log2(max_regions)), math.ceil(math.log2(rows / block_rows)))
    n = 2 ** depth - 1
    tree = SplitTree(np.zeros(max(n, 1), dtype=np.int64), np.zeros(max(n, 1)), depth)
    if depth == 0:
        return tree
    share = min(1.0, BOUNDARY_SAMPLE_ROWS / rows)
    sample = df.select("x").sample(share, seed=7).limit(2 * BOUNDARY_SAMPLE_ROWS).toPandas()["x"]
    parts = {0: matrix(sample)}
    for node in range(n):
        part = parts.pop(node)
        if len(part):
            f = int(np.argmax(part.var(axis=0)))
            tree.feature[node], tree.threshold[node] = f, np.median(part[:, f])
        right = part[:, tree.feature[node]] > tree.threshold[node] if len(part) else np.zeros(0, dtype=bool)
        parts[2 * node + 1], parts[2 * node + 2] = part[~right], part[right]
    return tree


def with_region(df: DataFrame, tree: SplitTree) -> DataFrame:
    if tree.depth == 0:
        return df.withColumn("region", F.lit(0))

    @F.pandas_udf("int")
    def assign(x: pd.Series) -> pd.Series:
        return pd.Series(tree.region(matrix(x)).astype("int32"))

    return df.withColumn("region", assign("x"))


@dataclass
class Side:
    """One input of a block pairing, with the size and bounding box of its regions."""

    df: DataFrame
    counts: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    block_rows: int

    @property
    def blocks(self) -> np.ndarray:
        return -(-self.counts // self.block_rows)

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.blocks)[:-1]])

    def with_block(self, id_col: str) -> DataFrame:
        if self.blocks.sum() <= 1:
            return self.df.withColumn("block", F.lit(0))
        offsets = F.array(*[F.lit(int(v)) for v in self.offsets])
        blocks = F.array(*[F.lit(int(v)) for v in self.blocks])
        salt = F.pmod(F.xxhash64(id_col), F.greatest(blocks[F.col("region")], F.lit(1)).cast("bigint")).cast("int")
        return self.df.withColumn("block", offsets[F.col("region")] + salt)


def measure_side(df: DataFrame, tree: SplitTree, dims: int, block_rows: int = BLOCK_ROWS,
                 at_most: int | None = None) -> Side:
    """Count rows and bound values per region: one map-side combined aggregation.

    Rows already known to be ``at_most`` one block in an undivided space need no look.
    """
    r = tree.regions
    if r == 1 and at_most is not None and at_most <= block_rows:
        return Side(df, np.array([at_most]), np.zeros((1, dims)), np.zeros((1, dims)), block_rows)
    counts, lo, hi = np.zeros(r, dtype=np.int64), np.full((r, dims), np.inf), np.full((r, dims), -np.inf)
    x = F.col("x")
    edges = [] if r == 1 else [f(x[i]).alias(f"{n}{i}") for i in range(dims) for n, f in (("l", F.min), ("h", F.max))]
    for row in df.groupBy("region").agg(F.count(F.lit(1)).alias("n"), *edges).collect():
        g = row["region"]
        counts[g] = row["n"]
        if r > 1:
            lo[g], hi[g] = [row[f"l{i}"] for i in range(dims)], [row[f"h{i}"] for i in range(dims)]
    return Side(df, counts, lo, hi, block_rows)


def box_bounds(a: Side, b: Side, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible p-distance between the boxes of all region pairs."""
    near, far = np.full((len(a.counts), len(b.counts)), np.inf), np.full((len(a.counts), len(b.counts)), np.inf)
    if len(a.counts) == 1 and len(b.counts) == 1:
        return np.zeros((1, 1)), far
    for i in np.flatnonzero(a.counts):
        js = np.flatnonzero(b.counts)
        gap = np.maximum(0.0, np.maximum(b.lo[js] - a.hi[i], a.lo[i] - b.hi[js]))
        span = np.maximum(np.abs(a.hi[i] - b.lo[js]), np.abs(b.hi[js] - a.lo[i]))
        near[i, js] = (gap ** p).sum(axis=1) ** (1 / p)
        far[i, js] = (span ** p).sum(axis=1) ** (1 / p)
    return near, far


def pair_blocks(left: Side, right: Side, allowed: np.ndarray, left_id: str, right_id: str, half: bool = False):
    """Cogroup of every block of a left region with every block of the regions it may meet.

    ``allowed`` is a boolean matrix over region pairs. Both sides carry the key
    ``(lb, rb)``; use ``.applyInPandas(kernel, schema)`` on the result. With ``half``,
    for two equal sides and a symmetric kernel, each pair of blocks meets once.
    """
    lblocks, rblocks = left.with_block(left_id), right.with_block(right_id)
    if left.blocks.sum() <= 1 and right.blocks.sum() <= 1:
        lkeyed = lblocks.withColumn("lb", F.lit(0)).withColumn("rb", F.lit(0))
        rkeyed = rblocks.withColumn("lb", F.lit(0)).withColumn("rb", F.lit(0))
    else:
        lkeyed = _meet(lblocks, allowed, right, "lb", "rb")
        rkeyed = _meet(rblocks, allowed.T, left, "rb", "lb")
        if half:
            lkeyed, rkeyed = lkeyed.where("lb <= rb"), rkeyed.where("lb <= rb")
    return cogroup_blocks(lkeyed, rkeyed)


def cogroup_blocks(left: DataFrame, right: DataFrame):
    """Cogroup on ``(lb, rb)``; fresh names keep two sides made from one table apart."""
    renamed = right.select([F.col(c).alias(c) for c in right.columns])
    return left.groupBy("lb", "rb").cogroup(renamed.groupBy("lb", "rb"))


def _meet(df: DataFrame, allowed: np.ndarray, other: Side, own: str, theirs: str) -> DataFrame:
    # at most MAX_REGIONS squared entries
    pairs = [(int(i), int(other.offsets[j]), int(other.blocks[j]))
             for i, j in zip(*np.nonzero(allowed), strict=True) if other.blocks[j]]
    table = df.sparkSession.createDataFrame(pairs, "region int, first int, many int")
    met = df.join(F.broadcast(table), "region")
    return (met.withColumn(theirs, F.explode(F.sequence("first", F.col("first") + F.col("many") - 1)))
            .withColumnRenamed("block", own).drop("first", "many"))
