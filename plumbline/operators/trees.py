"""Decision trees and forests with exact splits, all trees of a search grown together.

A row meets a tree as a pair with a weight: 1 in a single tree, a Poisson draw keyed by the
row's id in a forest, and 0 where the row only rides along to be predicted (the fold that the
tree leaves out). A split may fall between any two distinct values of a feature. Nodes with
more than ``largest_node`` pairs are split by Spark, all of them in one pass a level: values are
summed, dealt by range and sorted, and prefix sums over the sorted partitions give the gain of
every cut. Smaller nodes are finished as arrays, many subtrees at a time, a level a step.

A tree is grown to its end once. Depth limits and least rows of a split only stop the walk
down earlier, so every candidate of a grid reads the same trees.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.limits import BROADCAST_ROWS
from plumbline.session import cut_lineage, scratch_folder

#: Pairs of a node that one task may hold; larger nodes are split by Spark.
NODE_ROWS = 100_000
#: Numbers in the features of these pairs that a task may hold in any case, so that narrow tables need fewer levels by Spark.
NODE_CELLS = 1_500_000
#: Pairs of complete subtrees that a task grows at a time, if one subtree has no more.
CHUNK_ROWS = 200_000
#: Nodes of a fitted model that are broadcast at a time; every task slot holds a copy of about 50 bytes a node.
NODES_HELD = 1_000_000

#: Gains are compared after rounding, so that sums in another order choose the same cut.
_PLACES = 9
_PRIME = 2147483647
#: The Poisson distribution with mean 1, summed up.
_POISSON = np.cumsum([np.exp(-1.0) / np.prod(np.arange(1.0, k + 1)) for k in range(9)])


@dataclass(frozen=True)
class Growth:
    """How trees grow: ``classes`` is 0 for regression, ``features`` how many a split looks at."""

    classes: int
    criterion: str  # variance, gini or entropy
    trees: int
    bootstrap: bool
    features: int
    dims: int
    seed: int

    @property
    def width(self) -> int:
        return max(self.classes, 1)


def largest_node(growth: Growth) -> int:
    """Pairs of a node that one task may hold."""
    return max(NODE_ROWS, NODE_CELLS // growth.dims)


def _feature_codes(dims: int) -> list[int]:
    return [int(hashlib.md5(f"feature-{f}".encode()).hexdigest()[:7], 16) + 1 for f in range(dims)]


def _node_code(seed: int, tree: int, path: str) -> int:
    return int(hashlib.md5(f"{seed}-{tree}-{path}".encode()).hexdigest()[:7], 16) + 1


def _ranks(growth: Growth, codes: np.ndarray) -> np.ndarray:
    """``[node, feature]``: the place of a feature in the order in which a node looks at them."""
    keys = codes[:, None] * np.array(_feature_codes(growth.dims), np.int64) % _PRIME
    return np.argsort(np.argsort(keys, axis=1, kind="stable"), axis=1, kind="stable")


# ---------------------------------------------------------------- subtrees as arrays

@dataclass
class Subtrees:
    """Nodes of all subtrees, level by level: the root each belongs to, the cut, the children, rows, depth and values."""

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    rows: np.ndarray
    depth: np.ndarray
    value: np.ndarray  # [node, width]


def _node_stats(growth: Growth, node: np.ndarray, y: np.ndarray, w: np.ndarray, m: int):
    """Rows, values and impurity of ``m`` nodes; zeros for one without rows."""
    rows, total = np.bincount(node, minlength=m), np.bincount(node, w, minlength=m)
    safe = np.maximum(total, 1e-300)
    if not growth.classes:
        mean = np.bincount(node, w * y, minlength=m) / safe
        spread = np.bincount(node, w * (y - mean[node]) ** 2, minlength=m)
        low, high = np.full(m, np.inf), np.full(m, -np.inf)
        np.minimum.at(low, node, y)
        np.maximum.at(high, node, y)
        return rows, mean[:, None], spread, low < high
    counts = np.bincount(node * growth.classes + y.astype(np.int64), w, minlength=m * growth.classes).reshape(m, growth.classes)
    return rows, counts / safe[:, None], total, (counts > 0).sum(axis=1) > 1


def _plogp(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.where(x > 0, x, 1.0)), 0.0)


class _Segments:
    """Prefix sums inside runs of equal nodes."""

    def __init__(self, node: np.ndarray):
        self.starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        self.length = np.diff(np.concatenate([self.starts, [len(node)]]))

    def running(self, x: np.ndarray) -> np.ndarray:
        sums = np.cumsum(x)
        return sums - np.repeat(sums[self.starts] - x[self.starts], self.length)

    def last(self, x: np.ndarray) -> np.ndarray:
        return np.repeat(x[self.starts + self.length - 1], self.length)


def _gains(growth: Growth, node: np.ndarray, y: np.ndarray, w: np.ndarray, value: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Rounded gain of a cut after each pair; pairs are sorted by node and feature value."""
    runs = _Segments(node)
    left = runs.running(w)
    total = runs.last(left)
    right = total - left
    nl, nr = np.maximum(left, 1e-300), np.maximum(right, 1e-300)
    if not growth.classes:
        s = runs.running(w * (y - value[node, 0]))
        gain = (s * s / nl + s * s / nr) / np.maximum(scale[node], 1e-300)
    else:
        gain = np.zeros(len(node))
        for c in range(growth.classes):
            lc = runs.running(np.where(y == c, w, 0.0))
            rc = runs.last(lc) - lc
            gain += lc * lc / nl + rc * rc / nr if growth.criterion == "gini" else _plogp(lc) + _plogp(rc)
        if growth.criterion == "entropy":
            gain -= _plogp(left) + _plogp(right)
        gain /= total
    return np.round(gain, _PLACES)


def _best_cuts(growth: Growth, x, y, w, node, order: list[np.ndarray], wanted: np.ndarray, value, scale, codes) -> tuple:
    """Feature (-1 without one) and threshold of every node; ``order`` has the pairs by feature value and node."""
    m = len(wanted)
    rank = _ranks(growth, codes) if growth.features < growth.dims else np.zeros((m, growth.dims), np.int64)
    best, feature, threshold = np.full(m, -np.inf), np.full(m, -1), np.zeros(m)
    spare_rank, spare_feature, spare_threshold = np.full(m, growth.dims), np.full(m, -1), np.zeros(m)
    for f in range(growth.dims):
        idx = order[f]
        idx = idx[wanted[node[idx]]]
        if not len(idx):
            continue
        nd, v = node[idx], x[idx, f]
        gain = _gains(growth, nd, y[idx], w[idx], value, scale)
        open_ = np.concatenate([(nd[1:] == nd[:-1]) & (v[1:] != v[:-1]), [False]])
        gain = np.where(open_, gain, -np.inf)
        starts = np.flatnonzero(np.concatenate([[True], nd[1:] != nd[:-1]]))
        top = np.maximum.reduceat(gain, starts)
        place = np.where(gain == np.repeat(top, np.diff(np.concatenate([starts, [len(nd)]]))), np.arange(len(nd)), len(nd))
        at, nodes = np.minimum.reduceat(place, starts), nd[starts]
        cut = np.isfinite(top)
        at, nodes, top = at[cut], nodes[cut], top[cut]
        middle = v[at] / 2 + v[at + 1] / 2
        middle = np.where((middle >= v[at + 1]) | (middle < v[at]), v[at], middle)
        inside = rank[nodes, f] < growth.features
        better = inside & (top > best[nodes])
        for mask, keys in ((better, (best, feature, threshold)), (~inside & (rank[nodes, f] < spare_rank[nodes]),
                                                                    (spare_rank, spare_feature, spare_threshold))):
            chosen = nodes[mask]
            keys[0][chosen] = (top if keys[0] is best else rank[nodes, f])[mask]
            keys[1][chosen], keys[2][chosen] = f, middle[mask]
    lost = feature < 0
    return np.where(lost, spare_feature, feature), np.where(lost, spare_threshold, threshold)


def grow(growth: Growth, x: np.ndarray, y: np.ndarray, w: np.ndarray, root: np.ndarray, trees: list[int], paths: list[str],
         depths: np.ndarray, stops: list[tuple[int | None, int]]) -> tuple[Subtrees, np.ndarray]:
    """Subtrees below ``len(trees)`` roots, and the values that pairs without weight reach.

    ``root`` numbers each pair's root. The values are ``[stop, pair, width]``: a stop is a greatest
    depth (None for any) and the least rows of a split.
    """
    node, live = root.astype(np.int64), np.arange(len(w))
    riders = np.flatnonzero(w == 0)
    reached = np.full((len(stops), len(riders), growth.width), np.nan)
    slot = np.full(len(w), -1)
    slot[riders] = np.arange(len(riders))
    names, tree_of, depth = list(paths), np.array(trees), np.asarray(depths)
    belongs, base, levels = np.arange(len(trees)), 0, []
    fit = np.flatnonzero(w > 0)
    order = [fit[np.argsort(x[fit, f], kind="stable")] for f in range(growth.dims)]
    while len(names):
        m = len(names)
        fit = live[w[live] > 0]
        rows, value, scale, mixed = _node_stats(growth, node[fit], y[fit], w[fit], m)
        order = [o[np.argsort(node[o], kind="stable")] for o in order]
        codes = np.array([_node_code(growth.seed, t, p) for t, p in zip(tree_of.tolist(), names, strict=True)], np.int64) if \
            growth.features < growth.dims else np.ones(m, np.int64)
        feature, threshold = _best_cuts(growth, x, y, w, node, order, mixed, value, scale, codes)
        split = feature >= 0
        child = np.where(split, base + m + 2 * (np.cumsum(split) - 1), -1)
        levels.append((belongs, feature, threshold, child, rows, depth, value))
        going = live[w[live] == 0]
        if len(going):
            at, spot = node[going], slot[going]
            for s, (deepest, least) in enumerate(stops):
                here = ~split[at] | (rows[at] < least) | (depth[at] == (-1 if deepest is None else deepest))
                here &= np.isnan(reached[s, spot, 0])
                reached[s, spot[here]] = value[at[here]]
        live = live[split[node[live]]]
        at = node[live]
        right = x[live, feature[at]] > threshold[at]
        moved = np.full(len(w), -1, np.int64)
        moved[live] = child[at] - base - m + right
        node = moved
        order = [o[node[o] >= 0] for o in order]
        names = [p + side for p, s in zip(names, split.tolist(), strict=True) if s for side in "01"]
        belongs, tree_of = np.repeat(belongs[split], 2), np.repeat(tree_of[split], 2)
        depth, base = np.repeat(depth[split] + 1, 2), base + m
    return Subtrees(*(np.concatenate([level[i] for level in levels]) for i in range(7))), reached


# ---------------------------------------------------------------- large nodes by Spark

def _draw(growth: Growth, tree: Column) -> Column:
    """A number below 1 from a hash of the seed, the tree and the row."""
    text = F.md5(F.concat_ws("-", F.lit(f"bag{growth.seed}"), tree.cast("string"), F.col("row_id").cast("string")))
    return (F.conv(F.substring(text, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0


def _weight(draw: Column) -> Column:
    """The Poisson weight of a draw."""
    return reduce(lambda a, b: a + b, [F.when(draw > float(p), 1.0).otherwise(0.0) for p in _POISSON])


def spread(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` dealt by id if they make more than ``CHUNK_ROWS`` pairs, so that a task makes no more, however few
    partitions a small file has."""
    return rows.repartition(_tasks(rows.sparkSession, count), "row_id") if count > CHUNK_ROWS else rows


def pairs(rows: DataFrame, growth: Growth, folds: int) -> DataFrame:
    """``(tree, path, depth, w, row_id, x, label)`` of all rows ``(row_id, x, label, fold)`` and trees.

    With ``folds`` tree ``t`` leaves out the rows of fold ``t // trees``, which ride along; without, rows
    of a null fold ride along.
    """
    count = growth.trees * max(folds, 1)

    def rides(tree: Column) -> Column:
        return F.col("fold") == F.floor(tree / growth.trees) if folds else F.col("fold").isNull()

    # a draw is an entry of a list of its own, so that its hash is taken once and not for every threshold and filter
    draws = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda t: F.when(~rides(t), _draw(growth, t) if growth.bootstrap else F.lit(1.0)))
    weights = F.transform(draws, lambda d, t: F.struct(t.alias("tree"), F.when(d.isNull(), 0.0).otherwise(
        _weight(d) if growth.bootstrap else d).alias("w"), d.isNull().alias("rides")))
    met = F.filter(weights, lambda m: m["rides"] | (m["w"] > 0))
    # an outer explode: Spark puts a filter on the list before a plain one, which makes the list twice
    out = rows.select("row_id", "x", F.col("label").cast("double").alias("label"), F.explode_outer(met).alias("m")).where("m IS NOT NULL")
    return out.select("m.tree", F.lit("").alias("path"), F.lit(0).alias("depth"), "m.w", "row_id", "x", "label")


def _sums(growth: Growth, w: str = "w") -> dict[str, Column]:
    """Sums of weights that gains are made of: by class, or of the label."""
    if growth.classes:
        return {f"s{c}": F.sum(F.when(F.col("label") == c, F.col(w)).otherwise(0.0)) for c in range(growth.classes)}
    return {"s0": F.sum(F.col(w) * F.col("label")), "q": F.sum(F.col(w) * F.col("label") * F.col("label"))}


def _impurity_kept(growth: Growth) -> Column:
    """Rounded gain of a cut with sums ``l_*`` on its left, of a node with sums ``t_*``."""
    nl, n = F.col("l_w"), F.col("t_w")
    nr = n - nl
    if not growth.classes:
        mean = F.col("t_s0") / n
        s = F.col("l_s0") - nl * mean
        return F.round((s * s / nl + s * s / nr) / (F.col("t_q") - n * mean * mean), _PLACES)
    def entropy(v):
        return F.when(v > 0, v * F.log(v)).otherwise(0.0)
    parts = []
    for c in range(growth.classes):
        left = F.col(f"l_s{c}")
        right = F.col(f"t_s{c}") - left
        parts.append(left * left / nl + right * right / nr if growth.criterion == "gini" else entropy(left) + entropy(right))
    gain = reduce(lambda a, b: a + b, parts)
    return F.round((gain if growth.criterion == "gini" else gain - entropy(nl) - entropy(nr)) / n, _PLACES)


def _order_rank(growth: Growth) -> Column:
    """The place of ``feature`` in the order in which the node looks at features, as ``_ranks`` has it."""
    if growth.features >= growth.dims:
        return F.lit(0)
    code = F.conv(F.substring(F.md5(F.concat_ws("-", F.lit(str(growth.seed)), F.col("tree").cast("string"), "path")), 1, 7), 16, 10).cast("bigint") + 1
    codes = F.array(*[F.lit(c).cast("bigint") for c in _feature_codes(growth.dims)])
    own = code * F.get(codes, F.col("feature")) % _PRIME
    earlier = [F.when((code * c % _PRIME < own) | ((code * c % _PRIME == own) & (F.lit(f) < F.col("feature"))), 1).otherwise(0)
               for f, c in enumerate(_feature_codes(growth.dims))]
    return reduce(lambda a, b: a + b, earlier)


def _cuts(growth: Growth, live: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(tree, path, feature, threshold)`` of every node in ``nodes`` that can be split.

    Distinct values are dealt by range and sorted, so that a node's values may lie in many
    partitions; the sums of a partition's share of a node are added up over the partitions.
    """
    key, names = ["tree", "path", "feature"], ["w", *[f"s{c}" for c in range(growth.width)]]
    values = live.where("w > 0").select("tree", "path", "w", "label", F.posexplode("x").alias("feature", "v")).groupBy(*key, "v").agg(
        F.sum("w").alias("w"), *[c.alias(n) for n, c in _sums(growth).items() if n != "q"])
    dealt = cut_lineage(values.repartitionByRange(*key, "v").sortWithinPartitions(*key, "v").withColumn("part", F.spark_partition_id()))
    window = "PARTITION BY tree, path, feature ORDER BY part"
    shares = dealt.groupBy("part", *key).agg(F.min("v").alias("first"), *[F.sum(n).alias(n) for n in names]).select(
        "part", *key, F.expr(f"lead(first) OVER ({window})").alias("after"),
        *[F.expr(f"sum({n}) OVER ({window}) - {n}").alias(f"b_{n}") for n in names])
    inner = "PARTITION BY part, tree, path, feature ORDER BY v"
    running = dealt.select("part", *key, "v", F.expr(f"lead(v) OVER ({inner})").alias("next"),
                           *[F.expr(f"sum({n}) OVER ({inner} ROWS UNBOUNDED PRECEDING)").alias(f"c_{n}") for n in names])
    totals = nodes.select("tree", "path", *[F.col(n).alias(f"t_{n}") for n in names], *([] if growth.classes else [F.col("q").alias("t_q")]))
    cuts = running.join(shares, ["part", *key]).withColumn("next", F.coalesce("next", "after")).where("next IS NOT NULL").select(
        *key, "v", "next", *[(F.col(f"c_{n}") + F.col(f"b_{n}")).alias(f"l_{n}") for n in names])
    totals = F.broadcast(totals) if _few(totals) else totals
    gained = cuts.join(totals, ["tree", "path"]).withColumn("gain", _impurity_kept(growth)).withColumn("rank", _order_rank(growth))
    middle = F.col("v") / 2 + F.col("next") / 2
    inside = F.col("rank") < growth.features
    best = gained.select("tree", "path", F.struct(
        inside.alias("inside"), F.when(inside, F.col("gain")).otherwise(-F.col("rank").cast("double")).alias("by"),
        F.when(inside, 0.0).otherwise(F.col("gain")).alias("then"), (-F.col("feature")).alias("f"), (-F.col("v")).alias("low"),
        F.when((middle >= F.col("next")) | (middle < F.col("v")), F.col("v")).otherwise(middle).alias("threshold")).alias("cut"))
    return best.groupBy("tree", "path").agg(F.max("cut").alias("cut")).select(
        "tree", "path", (-F.col("cut.f")).alias("feature"), F.col("cut.threshold").alias("threshold"))


def _few(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _value(growth: Growth) -> Column:
    safe = F.when(F.col("w") > 0, F.col("w")).otherwise(1.0)
    return F.array(*[F.coalesce(F.col(f"s{c}"), F.lit(0.0)) / safe for c in range(growth.width)])


_NODE = "tree int, path string, feature int, threshold double, rows bigint, depth int, value array<double>"


def split_large(growth: Growth, live: DataFrame, stops: list[tuple[int | None, int]], node_rows: int, rows: int | None = None) -> tuple:
    """Split nodes of more than ``node_rows`` pairs until none is left; a tree over no more ``rows`` has none.

    Returns the pairs in their small nodes, the large nodes, and ``(tree, row_id, label, stop, value)`` of
    pairs without weight whose walk has ended before; pairs keep the stops that ended in ``done``.
    """
    spark = live.sparkSession
    live = live.withColumn("done", F.array().cast("array<int>"))
    small, large, ended = [], [], []
    while True:
        if rows is not None and rows <= node_rows:  # a row meets a tree once, so no count is needed
            small.append(live)
            break
        nodes = cut_lineage(live.groupBy("tree", "path", "depth").agg(
            F.count(F.lit(1)).alias("pairs"), F.count_if(F.col("w") > 0).alias("rows"), F.sum("w").alias("w"),
            F.min(F.when(F.col("w") > 0, F.col("label"))).alias("low"), F.max(F.when(F.col("w") > 0, F.col("label"))).alias("high"),
            *[c.alias(n) for n, c in _sums(growth).items()]).where(F.col("pairs") > node_rows))
        if nodes.isEmpty():
            small.append(live)
            break
        facts = nodes.withColumn("value", _value(growth)).select("tree", "path", "rows", "value")
        at = F.broadcast(facts) if _few(nodes) else facts
        small.append(live.join(at.select("tree", "path"), ["tree", "path"], "left_anti"))
        mixed = nodes.where("low < high")
        inside = live.join(at, ["tree", "path"])
        cuts = cut_lineage(_cuts(growth, inside, mixed))
        large.append(facts.join(nodes.select("tree", "path", "depth"), ["tree", "path"]).join(cuts, ["tree", "path"], "left").select(
            "tree", "path", F.coalesce("feature", F.lit(-1)).alias("feature"), F.coalesce("threshold", F.lit(0.0)).alias("threshold"),
            "rows", "depth", "value"))
        routed = cut_lineage(inside.join(F.broadcast(cuts) if _few(cuts) else cuts, ["tree", "path"], "left"))
        for s, (deepest, least) in enumerate(stops):
            stop = F.col("feature").isNull() | (F.col("rows") < least) | (F.lit(False) if deepest is None else F.col("depth") == deepest)
            ended.append(routed.where((F.col("w") == 0) & stop & ~F.array_contains("done", s)).select(
                "tree", "row_id", "label", F.lit(s).alias("stop"), "value"))
            routed = routed.withColumn("done", F.when(stop, F.array_union("done", F.array(F.lit(s)))).otherwise(F.col("done")))
        side = F.when(F.get("x", F.col("feature")) <= F.col("threshold"), "0").otherwise("1")
        live = routed.where("feature IS NOT NULL").select(
            "tree", F.concat("path", side).alias("path"), (F.col("depth") + 1).alias("depth"), "w", "row_id", "x", "label", "done")
    union = lambda parts, empty: reduce(DataFrame.unionByName, parts, spark.createDataFrame([], empty))
    return (union(small, live.schema), union(large, _NODE),
            union(ended, "tree int, row_id bigint, label double, stop int, value array<double>"))


# ---------------------------------------------------------------- small nodes by tasks

def _whole_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """All pairs of some subtrees at a time, from batches sorted by tree and path."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        if count >= CHUNK_ROWS:
            table = pa.Table.from_batches(held)
            tree, path = table.column("tree"), table.column("path")
            other = np.flatnonzero(pc.or_(pc.not_equal(tree, tree[-1]), pc.not_equal(path, path[-1])).to_numpy())
            if len(other):
                cut = int(other[-1]) + 1
                held, count = table.slice(cut).to_batches(), count - cut
                yield table.slice(0, cut)
    if count:
        yield pa.Table.from_batches(held)


def _grown(growth: Growth, table: pa.Table, stops: list[tuple[int | None, int]]):
    """Roots, subtrees, riders and what they reach, of a table of whole subtrees."""
    tree, path = table.column("tree").to_numpy(), table.column("path")
    new = np.concatenate([[True], (tree[1:] != tree[:-1]) | pc.not_equal(path.slice(1), path.slice(0, len(path) - 1)).to_numpy()])
    starts = np.flatnonzero(new)
    x = table.column("x").combine_chunks()
    x = (x.chunk(0) if isinstance(x, pa.ChunkedArray) else x).flatten().to_numpy(zero_copy_only=False).reshape(len(tree), -1)
    w, depth = table.column("w").to_numpy(), table.column("depth").to_numpy()
    roots = tree[starts].tolist(), path.take(pa.array(starts)).to_pylist()
    return roots, *grow(growth, x, table.column("label").to_numpy(), w, np.cumsum(new) - 1, *roots, depth[starts], stops), np.flatnonzero(w == 0)


def _dealt(small: DataFrame, tasks: int) -> DataFrame:
    return small.repartition(tasks, "tree", "path").sortWithinPartitions("tree", "path")


def _tasks(spark: SparkSession, count: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-count // CHUNK_ROWS))


def _batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")


def ride(rows: DataFrame, growth: Growth, folds: int, stops: list[tuple[int | None, int]], sizes: list[int], node_rows: int | None = None) -> DataFrame:
    """``(row_id, label, stop, size, votes)``: what the first ``size`` trees say of the rows that ride along, summed up by stop."""
    spark = rows.sparkSession
    held = rows.count()
    count = held * growth.trees * max(folds, 1)
    small, _, ended = split_large(growth, pairs(spread(rows, count), growth, folds), stops, node_rows or largest_node(growth), held)
    trees, width = growth.trees, growth.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_subtrees(batches):
            _, _, reached, riders = _grown(growth, table, stops)
            if not len(riders):
                continue
            ids, label = table.column("row_id").to_numpy()[riders], table.column("label").to_numpy()[riders]
            place = table.column("tree").to_numpy()[riders] % trees
            done = table.column("done").take(pa.array(riders)).to_pylist()
            for s, d in ((s, i) for i, past in enumerate(done) for s in past):
                reached[s, d] = 0.0
            known, first, row = np.unique(ids, return_index=True, return_inverse=True)
            for s in range(len(stops)):
                for k, size in enumerate(sizes):
                    few = place < size
                    votes = np.stack([np.bincount(row[few], reached[s, few, c], minlength=len(known)) for c in range(width)], axis=1).astype(np.float64)
                    n = len(known)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(known), pa.array(label[first]), pa.array(np.full(n, s, np.int32)), pa.array(np.full(n, k, np.int32)),
                         *[pa.array(votes[:, c]) for c in range(width)]], ["row_id", "label", "stop", "size", *[f"v{c}" for c in range(width)]])

    _batches(spark)
    columns = ", ".join(f"v{c} double" for c in range(width))
    voted = _dealt(small, _tasks(spark, count)).mapInArrow(run, f"row_id bigint, label double, stop int, size int, {columns}")
    before = [ended.where(F.col("tree") % trees < size).select(
        "row_id", "label", "stop", F.lit(k).alias("size"), *[F.col("value")[c].alias(f"v{c}") for c in range(width)]) for k, size in enumerate(sizes)]
    return reduce(DataFrame.unionByName, before, voted).groupBy("row_id", "label", "stop", "size").agg(
        F.array(*[F.sum(f"v{c}") for c in range(width)]).alias("votes"))


def prediction_of(growth: Growth, votes: str, trees: Column) -> Column:
    """The mean of the trees, or the class with most votes, the first of equal ones."""
    if not growth.classes:
        return F.col(votes)[0] / trees
    rounded = F.transform(votes, lambda v: F.round(v, _PLACES))
    return (F.array_position(rounded, F.array_max(rounded)) - 1).cast("double")


# ---------------------------------------------------------------- fitted models

def fit_trees(rows: DataFrame, growth: Growth, node_rows: int | None = None) -> DataFrame:
    """Subtrees and large nodes of all trees on all rows ``(row_id, x, label)``, written to the shared folder.

    A row has the nodes of a subtree as lists, its root first; ``left`` is the place of the left
    child, whose sibling follows it, -1 in a leaf, and -2 in a large node, whose children are other rows.
    """
    spark = rows.sparkSession
    held = rows.count()
    count = held * growth.trees
    dealt = spread(rows.select("row_id", "x", "label", F.lit(0).alias("fold")), count)
    small, large, _ = split_large(growth, pairs(dealt, growth, 0), [], node_rows or largest_node(growth), held)
    names = ["tree", "path", "feature", "threshold", "left", "rows", "depth", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_subtrees(batches):
            (trees, paths), found, _, _ = _grown(growth, table, [])
            order = np.argsort(found.root, kind="stable")
            place = np.empty(len(order), np.int64)
            starts = np.searchsorted(found.root[order], np.arange(len(trees)))
            place[order] = np.arange(len(order)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(order)]])))
            left = np.where(found.left >= 0, place[np.maximum(found.left, 0)], -1)
            ends = np.concatenate([starts, [len(order)]]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(c[order], t)) for c, t in (
                (found.feature, pa.int32()), (found.threshold, pa.float64()), (left, pa.int32()), (found.rows, pa.int64()), (found.depth, pa.int32()))]
            values = pa.ListArray.from_arrays(ends * growth.width, pa.array(found.value[order].ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(trees, pa.int32()), pa.array(paths), *lists, values], names)

    _batches(spark)
    schema = "tree int, path string, feature array<int>, threshold array<double>, left array<int>, rows array<bigint>, depth array<int>, value array<double>"
    folder = scratch_folder(spark, "trees")
    grown = _dealt(small, _tasks(spark, count)).mapInArrow(run, schema)
    above = large.select("tree", "path", F.array("feature").alias("feature"), F.array("threshold").alias("threshold"),
                         F.array(F.when(F.col("feature") < 0, -1).otherwise(-2)).alias("left"), F.array("rows").alias("rows"),
                         F.array("depth").alias("depth"), "value")
    grown.unionByName(above).write.parquet(folder)
    return spark.read.parquet(folder)


@dataclass
class Forest:
    """Fitted trees, read down to a depth and a least number of rows; the first ``trees`` of them."""

    growth: Growth
    table: DataFrame
    max_depth: int | None
    min_rows: int
    trees: int
    kind: str = "forest"
    _blocks: list = field(default_factory=list, repr=False)

    def _parts(self, spark: SparkSession):
        """Broadcast parts of the trees of at most ``NODES_HELD`` nodes each, all with the large nodes.

        Nodes deeper than ``max_depth`` are reached by no walk and stay behind; a subtree has its nodes level by
        level, so the others are the first of its lists.
        """
        own = self.table.where(F.col("tree") < self.trees)
        if self.max_depth is not None:
            own = own.withColumn("kept", F.size(F.filter("depth", lambda d: d <= self.max_depth))).where("kept > 0")
            lists = {c: F.slice(c, F.lit(1), F.col("kept")) for c in ("feature", "threshold", "left", "rows", "depth")}
            own = own.withColumns(lists | {"value": F.slice("value", F.lit(1), F.col("kept") * self.growth.width)}).drop("kept")
        # a large node that ends all walks is a leaf, so it speaks in one part only
        first = [F.get(c, F.lit(0)) for c in ("left", "rows", "depth")]
        ends = (first[1] < self.min_rows) | (F.lit(False) if self.max_depth is None else first[2] == self.max_depth)
        own = own.withColumn("left", F.when((first[0] == -2) & ends, F.array(F.lit(-1))).otherwise(F.col("left"))).withColumn("nodes", F.size("left"))
        count = own.agg(F.sum("nodes")).first()[0] or 0
        parts = -(-count // NODES_HELD) or 1
        dealt = own.withColumn("block", F.when(F.get("left", F.lit(0)) == -2, -1).otherwise(F.pmod(F.xxhash64("tree", "path"), F.lit(parts))))
        for block in range(parts):
            rows = dealt.where(F.col("block").isin(-1, block)).drop("block", "nodes").toArrow()
            yield spark.sparkContext.broadcast(_flat(rows, self.growth.width))

    def votes(self, df: DataFrame) -> DataFrame:
        """``df`` with ``votes``, the sum of what the trees say of a row."""
        spark, names, width = df.sparkSession, df.columns, self.growth.width
        deepest, least = self.max_depth, self.min_rows
        position = names.index("x")
        state = df.withColumn("votes", F.array(*[F.lit(0.0)] * width))
        parts = list(self._parts(spark)) if len(self._blocks) == 0 else self._blocks
        self._blocks = parts if len(parts) == 1 else []
        for part in parts:
            def run(batches: Iterator[pa.RecordBatch], part=part) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    if batch.num_rows:
                        x = batch.column(position).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                        said = batch.column(len(names)).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) + _walk(part.value, x, deepest, least)
                        lists = pa.ListArray.from_arrays(np.arange(0, said.size + 1, width, dtype=np.int32), pa.array(said.ravel()))
                        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists], batch.schema.names)
            _batches(spark)
            state = state.mapInArrow(run, state.schema)
            if len(parts) > 1:
                state = cut_lineage(state)
                part.unpersist()
        return state

    def save(self, spark: SparkSession, path: str) -> dict:
        self.table.where(F.col("tree") < self.trees).write.mode("overwrite").parquet(f"{path}/model")
        return {"growth": asdict(self.growth), "max_depth": self.max_depth, "min_rows": self.min_rows, "trees": self.trees}

    @staticmethod
    def load(spark: SparkSession, path: str, facts: dict) -> Forest:
        return Forest(Growth(**facts["growth"]), spark.read.parquet(f"{path}/model"), facts["max_depth"], facts["min_rows"], facts["trees"])

    def predict(self, df: DataFrame) -> DataFrame:
        plain = df.select(*[c for c in df.columns if c not in ("features", "prediction")])
        return self.votes(plain).withColumn("prediction", prediction_of(self.growth, "votes", F.lit(float(self.trees)))).drop("votes")


def _flat(rows: pa.Table, width: int) -> dict:
    """Nodes of all rows in one array each; ``roots`` are the places where a walk down a tree begins."""
    flat = {c: _numbers(rows, c) for c in ("feature", "threshold", "left", "rows", "depth", "value")}
    sizes = pc.list_value_length(rows.column("left")).to_numpy().astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    own, base, ends = flat["left"], np.repeat(starts, sizes), np.repeat(starts + sizes, sizes)
    left = np.where(own >= 0, own + base, -1)
    left[left >= ends] = -1  # children below the depth that is read
    right = np.where(left >= 0, left + 1, -1)
    path, tree = rows.column("path"), rows.column("tree").to_numpy()
    if (own == -2).any():
        place = dict(zip(zip(tree.tolist(), path.to_pylist(), strict=True), starts.tolist(), strict=True))
        for (t, p), at in place.items():
            if own[at] == -2:  # -2 as a child: a subtree that is in another part
                left[at], right[at] = place.get((t, p + "0"), -2), place.get((t, p + "1"), -2)
    return {"left": left.astype(np.int32), "right": right.astype(np.int32), "feature": flat["feature"].astype(np.int32),
            "threshold": flat["threshold"].astype(float), "rows": flat["rows"].astype(np.int64), "depth": flat["depth"].astype(np.int32),
            "value": flat["value"].astype(float).reshape(-1, width), "roots": starts[pc.equal(path, "").to_numpy().astype(bool)]}


def _numbers(rows: pa.Table, name: str) -> np.ndarray:
    """The lists of a column behind one another."""
    return np.concatenate([np.empty(0, np.int64), *[c.flatten().to_numpy(zero_copy_only=False) for c in rows.column(name).chunks]])


def _walk(flat: dict, x: np.ndarray, deepest: int | None, least: int) -> np.ndarray:
    """Sum over the trees of the values that rows reach; a walk into another part adds nothing here."""
    said = np.zeros((len(x), flat["value"].shape[1]))
    rows = np.arange(len(x))
    for root in flat["roots"].tolist():
        at, live = np.full(len(x), root), rows
        while len(live):
            here = at[live]
            stop = (flat["left"][here] == -1) | (flat["rows"][here] < least) | (flat["depth"][here] == (-1 if deepest is None else deepest))
            said[live[stop]] += flat["value"][here[stop]]
            live, here = live[~stop], here[~stop]
            low = x[live, flat["feature"][here]] <= flat["threshold"][here]
            at[live] = np.where(low, flat["left"][here], flat["right"][here])
            live = live[at[live] >= 0]
    return said
