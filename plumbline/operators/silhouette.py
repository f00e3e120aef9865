"""Mean Euclidean silhouette of one or many labelings of the same rows, exactly.

Distances between all rows are what the score is defined on. They are computed
once for all labelings of few clusters: a block pair turns its distances into sums per
cluster of every labeling, so no pair of rows is ever written. A labeling of many
clusters has a pass of its own, in which whole clusters lie in one tile, so that only
the own and the nearest mean of a row leave the task. Equal rows with equal labels are
one weighted row.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.limits import BLOCK_ROWS, LABEL_COLUMNS_PER_PASS, TILE_CELLS, TILE_ROWS
from plumbline.operators.blocks import cogroup_blocks, matrix
from plumbline.session import cut_lineage

#: Rows of a side whose distances are held at a time.
PIECE_ROWS = 1024


def tiles_for(rows: int, width: int, slots: int, block_rows: int | None = None) -> int:
    """Tiles per side: as few as fit a task's memory, but enough for all task slots.

    A row is copied once for every tile of the other side, which is about the square
    root of twice the tasks. A tile's sums are ``rows x width`` numbers.
    """
    if block_rows is not None:
        return max(1, -(-rows // block_rows))
    fit = max(BLOCK_ROWS, min(TILE_ROWS, TILE_CELLS // max(1, width)))
    return max(1, -(-rows // fit), min(math.ceil(math.sqrt(2 * slots)), -(-rows // BLOCK_ROWS)))


def silhouettes(points: DataFrame, labelings: list[str], block_rows: int | None = None,
                columns_per_pass: int = LABEL_COLUMNS_PER_PASS) -> dict[str, float | None]:
    """Score per labeling column of ``points(row_id, x, <labelings>)``.

    A null label leaves the row out of that labeling. A labeling with fewer than
    two clusters, or as many clusters as rows, scores ``None``.
    """
    counts = points.agg(*[f(F.col(n)).alias(f"{k}_{n}") for n in labelings for k, f in (("clusters", F.count_distinct), ("rows", F.count))]).first()
    known = [n for n in labelings if 2 <= counts[f"clusters_{n}"] <= counts[f"rows_{n}"] - 1]
    many = [n for n in known if counts[f"clusters_{n}"] > columns_per_pass]
    out: dict[str, float | None] = dict.fromkeys(labelings)
    for n in many:
        out[n] = _score_of_many(points, n, counts[f"rows_{n}"], block_rows)
    scored = [n for n in known if n not in many]
    if not scored:
        return out
    sizes = _cluster_sizes(points, scored)
    columns = [(n, c) for n in scored for c in sorted(sizes[n])]
    unique = (points.where(F.coalesce(*[F.col(n).cast("bigint") for n in scored]).isNotNull())
              .groupBy("x", *scored).agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("w"))).persist()
    slots = points.sparkSession.sparkContext.defaultParallelism
    blocks = tiles_for(unique.count(), min(len(columns), columns_per_pass), slots, block_rows)
    passes = [columns[i:i + columns_per_pass] for i in range(0, len(columns), columns_per_pass)]
    parts = [_pass(unique, scored, sizes, cols, blocks) for cols in passes]
    merged = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            merged = merged.unionByName(part)
        merged = merged.groupBy("row_id", "w").agg(*[
            f(f"{kind}_{n}").alias(f"{kind}_{n}") for n in scored for kind, f in (("own", F.max), ("near", F.min))])
    aggs = []
    for n in scored:
        a, b = F.col(f"own_{n}"), F.col(f"near_{n}")
        # a cluster of one row scores zero: its own mean distance is missing but it has a nearest other cluster
        s = F.when(a.isNull(), 0.0).otherwise((b - a) / F.nullif(F.greatest(a, b), F.lit(0.0)))
        rows = sum(sizes[n].values())
        aggs.append((F.sum(F.when(b.isNotNull(), F.coalesce(s, F.lit(0.0)) * F.col("w"))) / rows).alias(n))
    row = merged.agg(*aggs).first()
    unique.unpersist()
    out.update({n: row[n] for n in scored})
    return out


def _score_of_many(points: DataFrame, name: str, rows: int, tile_rows: int | None) -> float:
    """The score of a labeling of many clusters: every row meets every tile of whole clusters once.

    Clusters of more than half a tile are spread over tiles, and the sums over their parts are added up; there
    are at most two such clusters for each tile's worth of rows.
    """
    tile = tile_rows or BLOCK_ROWS
    label = F.col(name).cast("bigint").alias("c")
    unique = points.where(F.col(name).isNotNull()).groupBy("x", label).agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("w"))
    sizes = unique.groupBy("c").agg(F.sum("w").alias("size"), F.count(F.lit(1)).alias("kinds"))
    # labels are dealt by their own value first, so a large cluster is no single key of this join
    unique = cut_lineage(unique.join(sizes, "c"))
    tiles = max(1, -(-unique.count() // tile))
    large = F.col("kinds") > tile // 2
    by_cluster = F.pmod(F.xxhash64("c"), F.lit(tiles))
    placed = unique.withColumn("rb", F.when(large, F.pmod(F.xxhash64("row_id"), F.lit(tiles))).otherwise(by_cluster).cast("int")).withColumn("large", large)
    left = unique.select("row_id", "x", "c", "size", "w", F.pmod(F.xxhash64("row_id", F.lit(1)), F.lit(tiles)).cast("int").alias("lb")).withColumn(
        "rb", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    right = placed.withColumn("lb", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    found = cogroup_blocks(left, right).applyInPandas(_nearest_of_tile, "row_id bigint, c bigint, other bigint, own double, near double, part double")
    whole = found.where("other IS NULL").groupBy("row_id").agg(F.sum("own").alias("own"), F.min("near").alias("near"))
    parts = found.where("other IS NOT NULL").groupBy("row_id", "c", "other").agg(F.sum("part").alias("sum")).join(
        sizes.where(F.col("kinds") > tile // 2).select(F.col("c").alias("other"), F.col("size").alias("others")), "other")
    spread = parts.groupBy("row_id").agg(F.sum(F.when(F.col("c") == F.col("other"), F.col("sum"))).alias("own_large"),
                                         F.min(F.when(F.col("c") != F.col("other"), F.col("sum") / F.col("others"))).alias("near_large"))
    met = unique.select("row_id", "w", "size").join(whole, "row_id").join(spread, "row_id", "left")
    a = F.coalesce("own", "own_large") / F.nullif(F.col("size") - 1, F.lit(0))
    b = F.least("near", "near_large")
    s = F.when(F.col("size") == 1, 0.0).otherwise(F.coalesce((b - a) / F.nullif(F.greatest(a, b), F.lit(0.0)), F.lit(0.0)))
    return met.agg(F.sum(s * F.col("w")) / rows).first()[0]


def _nearest_of_tile(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """For each row on the left: its sum over its own cluster and the nearest mean of another, of clusters that lie whole on
    the right; and its sums over the parts of large clusters there."""
    names = ["row_id", "c", "other", "own", "near", "part"]
    if left.empty:
        return pd.DataFrame({n: [] for n in names})
    ids, label = left["row_id"].to_numpy(), left["c"].to_numpy()
    own, near = np.full(len(ids), np.nan), np.full(len(ids), np.nan)
    extra = []
    if len(right):
        right = right.sort_values("c", kind="stable")
        b, weight, others, cluster = matrix(right["x"]), right["w"].to_numpy(float), right["row_id"].to_numpy(), right["c"].to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], cluster[1:] != cluster[:-1]]))
        names_here, size = cluster[starts], right["size"].to_numpy(float)[starts]
        split = right["large"].to_numpy(bool)[starts]
        by_id = np.argsort(others)
        squares = (b * b).sum(axis=1)
        for i in range(0, len(ids), PIECE_ROWS):
            cut = slice(i, i + PIECE_ROWS)
            a = matrix(left["x"].iloc[cut])
            d = (a * a).sum(axis=1)[:, None] + squares[None, :] - 2.0 * (a @ b.T)
            np.sqrt(np.maximum(d, 0.0, out=d), out=d)
            at = by_id[np.minimum(np.searchsorted(others, ids[cut], sorter=by_id), len(others) - 1)]
            itself = np.flatnonzero(others[at] == ids[cut])
            d[itself, at[itself]] = 0.0
            sums = np.add.reduceat(d * weight, starts, axis=1)
            mine = names_here[None, :] == label[cut, None]
            for k in np.flatnonzero(split):
                extra.append(pd.DataFrame({"row_id": ids[cut], "c": label[cut], "other": names_here[k], "own": np.nan, "near": np.nan, "part": sums[:, k]}))
            if not split.all():
                whole = ~split
                mean = np.where(mine[:, whole], np.inf, sums[:, whole] / size[whole])
                near[cut] = mean.min(axis=1)
                has = (mine & whole).any(axis=1)
                own[cut] = np.where(has, np.where(mine & whole, sums, 0.0).sum(axis=1), np.nan)
        near[np.isinf(near)] = np.nan
    base = pd.DataFrame({"row_id": ids, "c": label, "other": pd.array([None] * len(ids), "Int64"), "own": own, "near": near, "part": np.nan})
    out = pd.concat([base, *[e.astype({"other": "Int64"}) for e in extra]], ignore_index=True)
    for n in ("own", "near", "part"):
        out[n] = out[n].astype("object").where(out[n].notna(), None)
    return out


def _cluster_sizes(points: DataFrame, labelings: list[str]) -> dict[str, dict]:
    cells = F.array(*[F.struct(F.lit(n).alias("n"), F.col(n).cast("bigint").alias("c")) for n in labelings])
    counted = (points.select(F.explode(cells).alias("e")).select("e.*").where("c is not null")
               .groupBy("n", "c").agg(F.count(F.lit(1)).alias("rows")).collect())
    sizes: dict[str, dict] = {n: {} for n in labelings}
    for r in counted:
        sizes[r["n"]][r["c"]] = r["rows"]
    return sizes


def _members(at: np.ndarray, weights: np.ndarray, width: int) -> list[np.ndarray]:
    """Matrices whose product has the weight of each row in the columns of its clusters: rows by their kinds, few
    in a piece, and kinds by columns; or one matrix where there are as many kinds as columns."""
    new = np.concatenate([[True], (at[1:] != at[:-1]).any(axis=1)])
    kind, kinds = np.cumsum(new) - 1, at[new]
    hot = np.zeros((len(kinds), width + 1))
    np.put_along_axis(hot, np.where(kinds < 0, width, kinds), 1.0, axis=1)
    hot = hot[:, :width]
    if len(kinds) >= width:
        return [hot[kind] * weights[:, None]]
    few = np.zeros((len(at), len(kinds)))
    few[np.arange(len(at)), kind] = weights
    return [few, hot]


def _summed(d: np.ndarray, parts: list[np.ndarray]) -> np.ndarray:
    for part in parts:
        d = d @ part
    return d


def _tile(rows: pa.Table, labelings: list[str], place: dict) -> tuple[np.ndarray, ...]:
    """Ids, coordinates, weights and columns of labels (-1 where there is none), rows of equal labels side by side."""
    at = np.full((rows.num_rows, len(labelings)), -1, dtype=np.int64)
    for i, n in enumerate(labelings):
        known = np.array(sorted(place[n]), dtype=np.int64)
        if len(known):
            column = rows.column(n)
            label, there = column.fill_null(0).to_numpy(), column.is_valid().to_numpy()
            spot = np.minimum(np.searchsorted(known, label), len(known) - 1)
            at[:, i] = np.where(there & (known[spot] == label), np.array([place[n][c] for c in known.tolist()])[spot], -1)
    order = np.lexsort(at.T)
    x = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in rows.column("x").chunks]).reshape(rows.num_rows, -1)
    return rows.column("row_id").to_numpy()[order], x[order], rows.column("w").to_numpy()[order], at[order]


def _tile_sums(one: tuple, two: tuple, same: bool, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Weighted sums of distances to each cluster, for the rows of both sides; distances are made a piece at a time."""
    (ids, a, left_w, left_at), (others, b, right_w, right_at) = one, two
    to_left, to_right = np.zeros((len(a), width)), np.zeros((0 if same else len(b), width))
    for j in range(0, len(b), PIECE_ROWS):
        part = b[j:j + PIECE_ROWS]
        squares, hot = (part * part).sum(axis=1), _members(right_at[j:j + PIECE_ROWS], right_w[j:j + PIECE_ROWS], width)
        for i in range(0, len(a), PIECE_ROWS):
            own = a[i:i + PIECE_ROWS]
            d = own @ part.T
            d *= 2.0
            np.subtract((own * own).sum(axis=1)[:, None] + squares[None, :], d, out=d)
            np.sqrt(np.maximum(d, 0.0, out=d), out=d)
            if same:
                d[ids[i:i + PIECE_ROWS, None] == others[None, j:j + PIECE_ROWS]] = 0.0
            to_left[i:i + PIECE_ROWS] += _summed(d, hot)
            if not same:
                to_right[j:j + PIECE_ROWS] += _summed(d.T, _members(left_at[i:i + PIECE_ROWS], left_w[i:i + PIECE_ROWS], width))
    return to_left, to_right


def _sums_table(found: list[tuple[np.ndarray, np.ndarray]], width: int) -> pa.Table:
    """Rows ``(row_id, sums)`` around the buffers of the sums."""
    kind = pa.schema([("row_id", pa.int64()), ("sums", pa.list_(pa.float64()))])
    return pa.Table.from_batches([pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(
        np.arange(0, sums.size + 1, width, dtype=np.int32), pa.array(sums.ravel()))], schema=kind) for ids, sums in found], kind)


def _pass(unique: DataFrame, labelings: list[str], sizes: dict, columns: list, blocks: int) -> DataFrame:
    """Own and nearest-other mean distance per row, over the clusters in ``columns``."""
    place = {n: {c: i for i, (m, c) in enumerate(columns) if m == n} for n in labelings}
    width = len(columns)

    def kernel(left: pa.Table, right: pa.Table) -> pa.Table:
        """A tile goes in and out as plain buffers: objects for each row would take several times its numbers."""
        if not left.num_rows or not right.num_rows:
            return _sums_table([], width)
        same = left.column("lb")[0] == right.column("rb")[0]
        one = _tile(left, labelings, place)
        two = one if same else _tile(right, labelings, place)
        to_one, to_two = _tile_sums(one, two, same, width)
        return _sums_table([(one[0], to_one)] if same else [(one[0], to_one), (two[0], to_two)], width)

    block = F.pmod(F.xxhash64("row_id"), F.lit(blocks)).cast("int")
    rows = unique.select("row_id", "x", F.col("w").cast("double").alias("w"), *[F.col(n).cast("bigint").alias(n) for n in labelings], block.alias("block"))
    left = rows.withColumn("rb", F.explode(F.sequence("block", F.lit(blocks - 1)))).withColumnRenamed("block", "lb")
    right = rows.withColumn("lb", F.explode(F.sequence(F.lit(0), F.col("block")))).withColumnRenamed("block", "rb")
    partial = cogroup_blocks(left, right).applyInArrow(kernel, "row_id bigint, sums array<double>")
    total = partial.groupBy("row_id").agg(F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums"))
    joined = total.join(unique.select("row_id", "w", *labelings), "row_id")
    out = []
    for n in labelings:
        own, near = F.lit(None).cast("double"), []
        label = F.col(n).cast("bigint")
        for c, j in place[n].items():
            size = sizes[n][c]
            mean = F.col("sums")[j] / F.lit(float(size))
            near.append(F.when(label != c, mean))
            if size > 1:
                own = F.when(label == c, F.col("sums")[j] / F.lit(float(size - 1))).otherwise(own)
        out += [own.alias(f"own_{n}"),
                (F.array_min(F.array(*near)) if near else F.lit(None).cast("double")).alias(f"near_{n}")]
    return joined.select("row_id", "w", *out)


def squared_silhouette(points: DataFrame, labeling: str) -> float | None:
    """Silhouette on squared distances: linear in the rows, but a different number."""
    live = points.where(F.col(labeling).isNotNull()).select(
        array_to_vector("x").alias("features"), F.col(labeling).cast("double").alias("prediction"))
    if live.select("prediction").distinct().limit(2).count() < 2:
        return None
    return ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(live)
