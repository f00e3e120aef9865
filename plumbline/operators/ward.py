"""Agglomerative clustering with Ward linkage.

Ward linkage is reducible, so merging all pairs of mutual nearest clusters at once
gives the same tree as merging one pair at a time (Murtagh, 1983). Rounds of such
merges run as block pairs until few enough clusters are left for one task, which
finishes the tree. A cluster is its size and centroid; the distance between two is
``sqrt(2ab / (a + b))`` times the distance of their centroids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.limits import BLOCK_ROWS, WARD_FINISH_ROWS
from plumbline.operators.blocks import Side, SplitTree, matrix, pair_blocks, split_tree, with_region
from plumbline.operators.components import connected_components
from plumbline.session import cut_lineage

#: Clusters of a region that one box bounds, regions at most, and clusters whose distances are held at a time.
LEAF_ROWS, LEAVES, PIECE_ROWS = 256, 4096, 128

MERGE_SCHEMA = "a bigint, b bigint, dist double, stage int, seq int"


def ward_labels(points: DataFrame, k: int, dims: int | None = None, finish_rows: int = WARD_FINISH_ROWS,
                block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``(row_id, cluster)`` after cutting the tree of ``points(row_id, x)`` into ``k`` clusters.

    Clusters are numbered by their lowest row. Equal rows merge at distance zero
    before anything else, so they start as one weighted cluster.
    """
    unique = cut_lineage(points.groupBy("x").agg(F.min("row_id").alias("cid"), F.count(F.lit(1)).alias("size")))
    n = unique.count()
    k = min(k, n)
    if n <= finish_rows:
        rows = unique.select(F.lit(0).alias("g"), "cid", "x", "size")
        by_cid = rows.groupBy("g").applyInPandas(lambda pdf: _cut_in_one_task(pdf, k), "cid bigint, cluster bigint")
    else:
        merges = merge_rounds(unique, n, dims, finish_rows, block_rows)
        last = merges.orderBy(F.desc("dist"), F.desc("stage"), F.desc("seq")).limit(k - 1).select("a", "b")
        kept = merges.join(F.broadcast(last), ["a", "b"], "left_anti")
        groups = connected_components(kept.select("a", "b")).withColumnRenamed("id", "cid")
        joined = unique.select("cid").join(groups, "cid", "left").select("cid", F.coalesce("component", "cid").alias("root"))
        roots = sorted(r["root"] for r in joined.select("root").distinct().collect())  # k rows
        number = F.create_map(*[F.lit(v) for i, r in enumerate(roots) for v in (r, i)])
        by_cid = joined.select("cid", number[F.col("root")].cast("bigint").alias("cluster"))
    by_x = unique.select("x", "cid").join(by_cid, "cid").select("x", "cluster")
    return points.select("row_id", "x").join(by_x, "x").select("row_id", "cluster")


def merge_rounds(clusters: DataFrame, n: int, dims: int | None, finish_rows: int, block_rows: int) -> DataFrame:
    """All merges ``(a, b, dist, stage, seq)``; ``a < b`` are the lowest rows of the merged clusters."""
    if dims is None:
        dims = len(clusters.select("x").first()["x"])
    merges: DataFrame | None = None
    stage, tree, built = 0, None, n
    while n > finish_rows:
        if tree is None or 2 * n < built:  # boundaries only prune, so some rounds share them
            tree, built = region_tree(clusters, n, block_rows), n
        pairs = cut_lineage(mutual_pairs(nearest_cluster(clusters, n, dims, block_rows, tree)))
        found = pairs.select("a", "b", "dist", F.lit(stage).alias("stage"), F.lit(0).alias("seq"))
        merges = found if merges is None else merges.unionByName(found)
        clusters = cut_lineage(merge_clusters(clusters, pairs))
        n -= pairs.count()
        stage += 1
    rest = clusters.select(F.lit(0).alias("g"), "cid", "x", "size").groupBy("g").applyInPandas(
        lambda pdf: _finish(pdf, stage), MERGE_SCHEMA)
    rest = cut_lineage(rest)
    return rest if merges is None else merges.unionByName(rest)


def nearest_cluster(clusters: DataFrame, n: int, dims: int, block_rows: int = BLOCK_ROWS, tree: SplitTree | None = None) -> DataFrame:
    """``(cid, dist, lo, hi)``: each cluster with its nearest; ties go to the lowest id pair.

    A cluster looks into its own region first. What it finds there bounds the regions it has to visit: those
    whose box may hold a nearer one. Where that would copy clusters more often than meeting all blocks does,
    as in many dimensions, all blocks meet.
    """
    tree = tree or region_tree(clusters, n, block_rows)
    placed = with_region(clusters, tree)
    counts, small, large = np.zeros(tree.regions, np.int64), np.ones(tree.regions), np.ones(tree.regions)
    lo, hi = np.full((tree.regions, dims), np.inf), np.full((tree.regions, dims), -np.inf)
    edges = [f(F.col("x")[i]) for f in (F.min, F.max) for i in range(dims)]
    for g, rows, least, most, *ends in placed.groupBy("region").agg(F.count(F.lit(1)), F.min("size"), F.max("size"), *edges).collect():
        counts[g], small[g], large[g], lo[g], hi[g] = rows, least, most, ends[:dims], ends[dims:]
    blocks = np.maximum(1, -(-counts // block_rows))
    offsets, of = np.cumsum(blocks) - blocks, np.repeat(np.arange(tree.regions), blocks)
    bounds = lo[of], hi[of], small[of], large[of], counts[of] > 0

    @F.pandas_udf("int")
    def block_of(region: pd.Series, cid: pd.Series) -> pd.Series:
        return (offsets[region] + cid % blocks[region]).astype("int32")

    blocked = placed.withColumn("block", block_of("region", "cid")).drop("region")

    def inside(own: pa.Table) -> pa.Table:
        own = own.sort_by("cid")
        ids, x, size = own.column("cid").to_numpy(), rows_of(own.column("x"), dims), own.column("size").to_numpy().astype(float)
        dist, other = _nearest(ids, x, size, ids, x, size)
        visits = _visits(x, size, dist, own.column("block")[0].as_py(), *bounds)
        ends = np.concatenate([[0], np.cumsum([len(v) for v in visits])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(visits), pa.int32()))
        low, high = (pa.array(f(ids, ids[other]), mask=other < 0) for f in (np.minimum, np.maximum))
        return pa.table([own.column("cid"), own.column("x"), own.column("size"), pa.array(dist, mask=other < 0), low, high, lists],
                        ["cid", "x", "size", "dist", "lo", "hi", "visits"])

    def beside(asked: pa.Table, there: pa.Table) -> pa.Table:
        names = ["cid", "dist", "lo", "hi"]
        if not asked.num_rows or not there.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.float64(), pa.int64(), pa.int64())], names)
        there = there.sort_by("cid")
        ids, others = asked.column("cid").to_numpy(), there.column("cid").to_numpy()
        dist, other = _nearest(ids, rows_of(asked.column("x"), dims), asked.column("size").to_numpy().astype(float),
                               others, rows_of(there.column("x"), dims), there.column("size").to_numpy().astype(float))
        met = other >= 0
        ids, dist, other = ids[met], dist[met], others[other[met]]
        return pa.table([ids, dist, np.minimum(ids, other), np.maximum(ids, other)], names)

    result = "cid bigint, dist double, lo bigint, hi bigint"
    seen = cut_lineage(blocked.groupBy("block").applyInArrow(inside, "cid bigint, x array<double>, size bigint, dist double, lo bigint, hi bigint, visits array<int>"))
    copies = seen.agg(F.sum(F.size("visits"))).first()[0] or 0
    if copies <= n * max(1, -(-n // block_rows)):
        asked = seen.select("cid", "x", "size", F.explode("visits").alias("block"))
        partial = asked.groupBy("block").cogroup(blocked.groupBy("block")).applyInArrow(beside, result)
    else:
        side = Side(clusters.withColumn("region", F.lit(0)), np.array([n]), lo[:1], hi[:1], block_rows)
        partial = pair_blocks(side, side, np.ones((1, 1), dtype=bool), "cid", "cid").applyInArrow(beside, result)
    found = partial.unionByName(seen.where("dist IS NOT NULL").select("cid", "dist", "lo", "hi"))
    return found.groupBy("cid").agg(F.min(F.struct("dist", "lo", "hi")).alias("m")).select("cid", "m.*")


def region_tree(clusters: DataFrame, n: int, block_rows: int = BLOCK_ROWS) -> SplitTree:
    return split_tree(clusters, n, min(LEAF_ROWS, block_rows), LEAVES)


def rows_of(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    return np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks] or [np.empty(0)]).reshape(-1, dims)


def _visits(x: np.ndarray, size: np.ndarray, dist: np.ndarray, own: int, lo: np.ndarray, hi: np.ndarray, small: np.ndarray,
            large: np.ndarray, full: np.ndarray) -> list[np.ndarray]:
    """For each cluster the other blocks whose boxes may hold one that is no farther than ``dist``."""
    out = []
    there = full.copy()
    there[own] = False
    for i in range(0, len(x), PIECE_ROWS):
        a, s = x[i:i + PIECE_ROWS], size[i:i + PIECE_ROWS, None]
        near, reach = np.zeros((len(a), len(lo))), dist[i:i + PIECE_ROWS]
        with np.errstate(invalid="ignore"):
            for f in range(x.shape[1]):
                gap = np.maximum(np.maximum(lo[None, :, f] - a[:, None, f], a[:, None, f] - hi[None, :, f]), 0.0)
                near += gap * gap
            # the factor grows with both sizes, so the extremes bound it
            near = np.sqrt(near) * np.sqrt(2 * s * small / (s + small))
            alone = np.flatnonzero(np.isinf(reach))
            if len(alone) and there.any():
                far = sum(np.maximum(np.abs(a[alone, None, f] - lo[None, there, f]), np.abs(hi[None, there, f] - a[alone, None, f])) ** 2 for f in range(x.shape[1]))
                reach = reach.copy()
                reach[alone] = (np.sqrt(far) * np.sqrt(2 * s[alone] * large[there] / (s[alone] + large[there]))).min(axis=1)
        may = (near <= reach[:, None] * (1 + 1e-9)) & there
        out += [np.flatnonzero(row) for row in may]
    return out


def _nearest(ids: np.ndarray, x: np.ndarray, size: np.ndarray, others: np.ndarray, y: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distance and place of the nearest of ``others``, which are sorted by id; infinite and -1 where there is none.

    Candidates are found by a matrix product, widened by more than its rounding, then by their plain distances.
    """
    dist, place = np.full(len(ids), np.inf), np.full(len(ids), -1, np.int64)
    middle = y.mean(axis=0)
    b, inverse = y - middle, 1.0 / sizes
    squares = (b * b).sum(axis=1)
    columns = np.vstack([-2.0 * b.T, np.ones(len(b)), squares])
    spot = np.minimum(np.searchsorted(others, ids), len(others) - 1)
    itself = others[spot] == ids
    for i in range(0, len(ids), PIECE_ROWS):
        cut = slice(i, i + PIECE_ROWS)
        a = x[cut] - middle
        norms = (a * a).sum(axis=1)
        share = 1.0 / size[cut]
        error = 16 * (x.shape[1] + 8) * np.finfo(float).eps * (np.sqrt(norms) + np.sqrt(squares.max())) ** 2 / (share + inverse.min())
        with np.errstate(invalid="ignore", over="ignore"):
            d = np.hstack([a, norms[:, None], np.ones((len(a), 1))]) @ columns
            d /= share[:, None] + inverse[None, :]
            mine = np.flatnonzero(itself[cut])
            d[mine, spot[cut][mine]] = np.inf
            low = d.min(axis=1)
            near = d <= (low + error + 1e-14 * np.abs(low))[:, None] if np.isfinite(error).all() else np.ones(d.shape, bool)
        near[mine, spot[cut][mine]] = False
        r, c = np.nonzero(near)
        r += i
        exact = np.sqrt(2 * size[r] * sizes[c] / (size[r] + sizes[c])) * np.sqrt(((y[c] - x[r]) ** 2).sum(axis=1))
        order = np.lexsort((c, exact, r))
        r, c, exact = r[order], c[order], exact[order]
        first = np.concatenate([[True], r[1:] != r[:-1]])[:len(r)] & np.isfinite(exact)
        dist[r[first]], place[r[first]] = exact[first], c[first]
    return dist, place


def mutual_pairs(nearest: DataFrame) -> DataFrame:
    """Pairs that are each other's nearest: both ends name the same (lo, hi)."""
    ends = nearest.groupBy("lo", "hi").agg(F.count(F.lit(1)).alias("ends"), F.min("dist").alias("dist"))
    return ends.where("ends = 2").select(F.col("lo").alias("a"), F.col("hi").alias("b"), "dist")


def merge_clusters(clusters: DataFrame, pairs: DataFrame) -> DataFrame:
    """Replace both ends of every pair by one cluster named after the lower."""
    renamed = pairs.select(F.col("b").alias("cid"), F.col("a").alias("into"))
    moved = clusters.join(renamed, "cid", "left").select(F.coalesce("into", "cid").alias("cid"), "x", "size")
    # at most two rows per group
    both = moved.groupBy("cid").agg(F.min(F.struct("size", "x")).alias("p"), F.max(F.struct("size", "x")).alias("q"),
                                    F.sum("size").alias("size"), F.count(F.lit(1)).alias("parts"))
    mean = F.zip_with("p.x", "q.x", lambda u, v: (u * F.col("p.size") + v * F.col("q.size")) / F.col("size"))
    return both.select("cid", F.when(F.col("parts") == 2, mean).otherwise(F.col("p.x")).alias("x"), "size")


def _ward(x: np.ndarray, size: float, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.sqrt(2 * size * sizes / (size + sizes)) * np.sqrt(((others - x) ** 2).sum(axis=1))


def chain_merges(x: np.ndarray, size: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges of a bounded set of clusters along chains of nearest neighbours, sorted by distance.

    An index names a cluster by its lowest member.
    """
    x, size = x.astype(float).copy(), size.astype(float).copy()
    alive, name, chain, merges = np.ones(len(x), dtype=bool), np.arange(len(x)), [], []
    for left in range(len(x), 1, -1):
        if 2 * left <= len(x):  # merged clusters are left behind; the others keep their order
            place = np.cumsum(alive) - 1
            x, size, name, chain = x[alive], size[alive], name[alive], [int(place[c]) for c in chain]
            alive = np.ones(left, dtype=bool)
        if not chain:
            chain = [int(np.argmax(alive))]
        while True:
            d = _ward(x[chain[-1]], size[chain[-1]], x, size)
            d[~alive] = np.inf
            d[chain[-1]] = np.inf
            j = int(np.argmin(d))
            if len(chain) > 1 and d[chain[-2]] <= d[j]:
                j = chain[-2]
                break
            chain.append(j)
        i = chain.pop()
        chain.pop()
        lo, hi = min(i, j), max(i, j)
        merges.append((int(name[lo]), int(name[hi]), float(d[j])))
        x[lo] = (x[lo] * size[lo] + x[hi] * size[hi]) / (size[lo] + size[hi])
        size[lo] += size[hi]
        alive[hi] = False
    return sorted(merges, key=lambda m: m[2])


def _finish(pdf: pd.DataFrame, stage: int) -> pd.DataFrame:
    pdf = pdf.sort_values("cid", ignore_index=True)
    ids = pdf["cid"].to_numpy()
    merges = chain_merges(matrix(pdf["x"]), pdf["size"].to_numpy())
    return pd.DataFrame([(ids[a], ids[b], d, stage, s) for s, (a, b, d) in enumerate(merges)],
                        columns=["a", "b", "dist", "stage", "seq"])


def _root(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def _cut_in_one_task(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    pdf = pdf.sort_values("cid", ignore_index=True)
    up = list(range(len(pdf)))
    for a, b, _ in chain_merges(matrix(pdf["x"]), pdf["size"].to_numpy())[:len(pdf) - k]:
        ra, rb = _root(up, a), _root(up, b)
        up[max(ra, rb)] = min(ra, rb)
    roots = [_root(up, i) for i in range(len(pdf))]
    number = {r: i for i, r in enumerate(sorted(set(roots)))}
    return pd.DataFrame({"cid": pdf["cid"], "cluster": [number[r] for r in roots]})


def merge_tree(points: DataFrame, limit: int = 200) -> DataFrame:
    """``(step, left, right, distance, size)`` over the first ``limit`` rows, as a tree report shows.

    Leaves are numbered by row order; step s makes node ``leaves + s``.
    """
    # the ids alone decide which rows are first, so only those rows are read in full
    ids = [r["row_id"] for r in points.select("row_id").orderBy("row_id").limit(limit).collect()]
    first = points.where(F.col("row_id") <= max(ids, default=0)).select(F.lit(0).alias("g"), "row_id", "x")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id", ignore_index=True)
        n = len(pdf)
        up, node, size = list(range(n)), list(range(n)), [1] * n
        out = []
        for step, (a, b, d) in enumerate(chain_merges(matrix(pdf["x"]), np.ones(n))):
            ra, rb = _root(up, a), _root(up, b)
            lo, hi = sorted((node[ra], node[rb]))
            up[rb] = ra
            node[ra], size[ra] = n + step, size[ra] + size[rb]
            out.append((step, lo, hi, d, size[ra]))
        return pd.DataFrame(out, columns=["step", "left", "right", "distance", "size"])

    return first.groupBy("g").applyInPandas(build, "step int, left bigint, right bigint, distance double, size bigint")
