"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are ordered by length and cut into buckets of similar length. A query holds a
lower bound of its k-th best score; divided by its own length and a bucket's largest,
that is the cosine a vector of the bucket must reach. Above 1 the bucket is left out.
A low cosine prunes little, so the bucket is cut by length only; a high one bounds the
coordinates, and only vectors within the feasible ranges of the query's largest
coordinates are multiplied out. What remains is verified by its integer product.

Vectors lie in tiles by falling length, queries in tiles by the length a vector must have for
them. All queries meet the first tile, which gives their bounds; after that a query meets only the
tiles that hold a vector long enough, and a pair of tiles is one task's work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.llm.common import bounded_batches, numbered, set_down

#: Vectors of a tile and queries of a tile; a task holds one of each.
TILE_ROWS, QUERY_ROWS = 16_384, 8192
#: Vectors of one bucket within a tile.
BUCKET_ROWS = 512
#: Local cosine from which coordinates prune more than they cost, and the coordinates used.
COORDINATE_COSINE, FOCUS = 0.8, 2
#: Queries multiplied out together.
STRIP = 256
#: Rounding allowance of a cosine; pruning by it never drops a vector that reaches its bound.
SLACK = 1e-9
_OUT = "query_id bigint, vec_id bigint, score bigint"


def quantised(vectors: DataFrame, id_col: str = "vec_id", embedding: str = "embedding", scale: int = 256) -> DataFrame:
    """``(vec_id, x, dim, length)`` with x = floor(scale * component); vectors with gaps or without an id are left out."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
                          F.transform(F.col(f"`{embedding}`"), lambda c: c.cast("double")).alias("x"))
    rows = rows.where("vec_id is not null and x is not null").where(
        F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))))
    rows = rows.select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("bigint")).alias("x"))
    length = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
    return rows.select("vec_id", "x", F.size("x").alias("dim"), length.alias("length"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(len(column), dim)


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer products; through doubles where these hold every sum exactly."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    most = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * queries.shape[1]
    if most < 2.0 ** 52:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


class _Best:
    """The k best (score, id) of each query so far, and the score a further vector must reach."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.copy()
        self.kept: dict[int, list[tuple[int, int]]] = {}

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        rows = self.kept.get(query, []) + list(zip((-scores).tolist(), ids.tolist(), strict=True))
        rows.sort()
        self.kept[query] = rows = rows[:self.k]
        if len(rows) == self.k:
            self.floors[query] = max(self.floors[query], -rows[-1][0])


def _search_bucket(q: np.ndarray, q_ids: np.ndarray, q_len: np.ndarray, v: np.ndarray, v_ids: np.ndarray,
                   v_len: np.ndarray, best: _Best) -> None:
    """Adds what the bucket (vectors by falling length) holds for each query."""
    top = v_len[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(np.isneginf(best.floors), -np.inf, best.floors / (q_len * top))
    cosine[(q_len * top) == 0] = np.where(best.floors[(q_len * top) == 0] > 0, np.inf, -np.inf)
    alive = np.flatnonzero(cosine <= 1 + SLACK)
    by_coordinate = alive[cosine[alive] >= COORDINATE_COSINE]
    by_length = alive[cosine[alive] < COORDINATE_COSINE]
    if len(by_length):
        floors = best.floors[by_length]
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(floors > 0, floors / q_len[by_length] * (1 - SLACK), 0.0)
        reach = np.searchsorted(-v_len, -least, "right")
        order = np.argsort(-reach, kind="stable")
        for s in range(0, len(order), STRIP):  # queries that reach about as far are multiplied out together, no further
            rows = order[s:s + STRIP]
            scores = _products(q[by_length[rows]], v[:reach[rows[0]]])
            for row in np.flatnonzero((scores >= floors[rows, None]).any(axis=1)):
                i, far = by_length[rows[row]], reach[rows[row]]
                good = np.flatnonzero((scores[row, :far] >= best.floors[i]) & (v_ids[:far] != q_ids[i]))
                if len(good):
                    best.add(i, scores[row, good], v_ids[good])
    if len(by_coordinate):
        unit = v / np.maximum(v_len, 1e-300)[:, None]
        for i in by_coordinate:
            near = np.flatnonzero(_feasible(unit, q[i] / q_len[i], min(1.0, cosine[i] - SLACK)) & (v_ids != q_ids[i]))
            if len(near):
                scores = _products(q[i:i + 1], v[near])[0]
                good = scores >= best.floors[i]
                if good.any():
                    best.add(i, scores[good], v_ids[near][good])


def _feasible(unit: np.ndarray, direction: np.ndarray, theta: float) -> np.ndarray:
    """Which unit vectors can reach cosine ``theta`` with ``direction``, by its largest coordinates alone.

    On one coordinate two directions at angles a and b to its axis are at least
    abs(a - b) apart, so b lies within acos(theta) of a.
    """
    focus = np.argsort(-np.abs(direction))[:FOCUS]
    d = direction[focus]
    spread = np.sqrt(np.maximum(0.0, (1 - theta ** 2) * (1 - d ** 2))) + 1e-7
    low = np.where(d < -theta, -np.inf, d * theta - spread)
    high = np.where(d > theta, np.inf, d * theta + spread)
    return ((unit[:, focus] >= low) & (unit[:, focus] <= high)).all(axis=1)


def _tile(k: int, dim: int):
    """Best candidates for the queries of a tile among the vectors of a tile."""
    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        q_ids, floors = queries.column("q_vec_id").to_numpy(), queries.column("q_floor").to_numpy()
        q, v = (_matrix(c.combine_chunks(), dim) for c in (queries.column("q_x"), vectors.column("v_x")))
        ids, length = vectors.column("v_vec_id").to_numpy(), vectors.column("v_length").to_numpy()
        q_len, best = queries.column("q_length").to_numpy(), _Best(floors.astype(np.float64), k)
        order = np.argsort(-length, kind="stable")
        for s in range(0, len(ids) if len(q_ids) else 0, BUCKET_ROWS):
            part = order[s:s + BUCKET_ROWS]
            _search_bucket(q, q_ids, q_len, v[part], ids[part], length[part], best)
        rows = [(int(q_ids[i]), vec, -neg) for i, kept in best.kept.items() for neg, vec in kept]
        return pa.table([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["query_id", "vec_id", "score"])
    return run


def _searched(queries: DataFrame, vectors: DataFrame, k: int, dim: int) -> DataFrame:
    """Candidates of ``queries(tile, q_tile, vec_id, x, length, floor)`` among ``vectors(tile, q_tile, vec_id, x, length)``."""
    # new names, as both sides may come from one frame
    asking = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("tile", "q_tile", "vec_id", "x", "length", "floor")])
    given = vectors.select(*[F.col(c).alias(f"v_{c}") for c in ("tile", "q_tile", "vec_id", "x", "length")])
    return asking.groupBy("q_tile", "q_q_tile").cogroup(given.groupBy("v_tile", "v_q_tile")).applyInArrow(_tile(k, dim), _OUT)


def _best_of(rows: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _tiled(rows: DataFrame, size: int, name: str, *order) -> DataFrame:
    """``rows`` with the number of their tile in the given order, set down."""
    return set_down(numbered(set_down(rows), *order).withColumn(name, F.floor(F.col("position") / size)).drop("position", "part"))


def _last_tiles(asked: DataFrame, held: DataFrame) -> DataFrame:
    """``asked`` with ``last``, the last tile of ``held`` that has a vector as long as the query's ``need``.

    Needs and the tiles' largest lengths are put in one falling order: the tiles before a need are its
    place there less its place among the needs.
    """
    order = F.desc("length"), F.asc("kind"), F.asc("vec_id"), F.asc("x")
    needs = set_down(asked.select("vec_id", "x", F.col("need").alias("length"), F.lit(1).alias("kind")))
    tiles = held.groupBy("tile").agg(F.max("length").alias("length")).select(
        F.col("tile").alias("vec_id"), F.array().cast("array<bigint>").alias("x"), "length", F.lit(0).alias("kind"))
    place = numbered(set_down(needs.unionByName(tiles)), *order).where("kind = 1").select("vec_id", "x", "position")
    among = numbered(needs, *order).select("vec_id", "x", F.col("position").alias("before"))
    last = place.join(among, ["vec_id", "x"]).select("vec_id", "x", (F.col("position") - F.col("before") - 1).alias("last"))
    return asked.join(last, ["vec_id", "x"])


def _of_dimension(vectors: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """``(query_id, vec_id, score)`` of vectors and queries of one dimension, the best ``k`` among others."""
    fields = "tile", "q_tile", "vec_id", "x", "length"
    held = _tiled(vectors, TILE_ROWS, "tile", F.desc("length"), F.asc("vec_id"))
    asked = queries.select("vec_id", "x", "length").distinct()
    one = _tiled(asked, QUERY_ROWS, "q_tile", F.asc("vec_id")).withColumn("floor", F.lit(float("-inf"))).withColumn("tile", F.lit(0).cast("bigint"))
    tiles = one.agg(F.max("q_tile")).first()[0]
    if tiles is None:
        return queries.sparkSession.createDataFrame([], _OUT)
    longest = held.where("tile = 0").withColumn("q_tile", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles).cast("bigint"))))
    found = set_down(_best_of(_searched(one.select(*fields, "floor"), longest.select(*fields), k, dim), k))
    floors = found.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("bound"))
    bounded = one.drop("floor", "tile", "q_tile").join(floors, "vec_id", "left").withColumn(
        "floor", F.coalesce("bound", F.lit(float("-inf")))).drop("bound")
    need = F.when((F.col("floor") > 0) & (F.col("length") > 0), F.col("floor") / F.col("length") * (1 - SLACK)).otherwise(F.lit(-1.0))
    further = _last_tiles(set_down(bounded.withColumn("need", need)), held).where("last > 0")
    dealt = _tiled(further, QUERY_ROWS, "q_tile", F.desc("last"), F.asc("vec_id"))
    pairs = dealt.groupBy("q_tile").agg(F.max("last").alias("last")).select(
        "q_tile", F.explode(F.sequence(F.lit(1).cast("bigint"), "last")).alias("tile"))
    asking = dealt.withColumn("tile", F.explode(F.sequence(F.lit(1).cast("bigint"), "last"))).select(*fields, "floor")
    rest = _searched(asking, held.where("tile > 0").join(pairs, "tile").select(*fields), k, dim)
    return found.select("query_id", "vec_id", "score").unionByName(rest)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best products of each query with the vectors, its own id apart.

    Both frames come from ``quantised``. Ties go to the smaller vec_id; a query meets
    vectors of its own dimension only, so one that is alone has no rows. Empty vectors are a dimension
    of their own, in which all products are 0. Repeated rows are candidates each; rows that share an id
    are no candidates of each other, and queries that repeat an id have one list. Empty frames give
    an empty result. Only the dimensions and the number of query tiles are known to the driver.
    """
    spark = vectors.sparkSession
    bounded_batches(spark, 8192)
    held, asked = set_down(vectors), set_down(queries)
    found = spark.createDataFrame([], _OUT)
    for (dim,) in sorted(asked.select("dim").distinct().collect()):
        of_dim = held.where(F.col("dim") == dim).select("vec_id", "x", "length")
        found = found.unionByName(_of_dimension(of_dim, asked.where(F.col("dim") == dim), dim, k))
    return _best_of(found, k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
