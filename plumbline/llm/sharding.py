"""Shards of near equal bytes: the minimax contiguous partition of atomic groups.

Groups are the rows of one text, ordered by a hash of the text. The smallest feasible
capacity is found by binary search; whether a capacity is feasible is checked by
filling shards greedily, and the groups are cut where that check cuts them.

The driver never sees the groups. It sees ranges of hashes with their sums, and
halves the range of possible answers with them: taking every range as one atom gives
a capacity that surely is feasible, taking it as freely divisible one below which
none is. Only ranges in which a cut can fall for some capacity between the two are
opened, by one aggregation a round, until these hold single groups.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumbline.llm.common import set_down, string

#: Bits of the hash by which the first ranges are told apart, and by which a range is opened.
FIRST_BITS, OPEN_BITS = 10, 6
#: Rows of one slot run aimed at; runs are numbered in parallel.
RUN_ROWS = 50_000
#: Slot runs at most, which bounds the table of their offsets.
MOST_RUNS = 1 << 16


def greedy_cuts(sizes: list[int], shards: int, capacity: int) -> list[int] | None:
    """Ends of the shards when each takes as many whole atoms as fit; None if they need more shards."""
    sums, ends, at = [0, *accumulate(sizes)], [], 0
    while at < len(sizes) and len(ends) < shards:
        end = bisect_right(sums, sums[at] + capacity) - 1
        if end == at:
            return None
        ends.append(end)
        at = end
    return ends + [at] * (shards - len(ends)) if at == len(sizes) else None


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """The least capacity at which contiguous atoms fit into the shards."""
    low, high = max([0, *sizes, -(-sum(sizes) // shards)]), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(sizes, shards, middle) is None:
            low = middle + 1
        else:
            high = middle
    return low


class _Ranges:
    """Ranges of the group order: start, bits that name them, sum, number of groups, largest group."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        self.rows = self._sums(FIRST_BITS, None)

    def _sums(self, bits: int, within: list[tuple[int, int]] | None) -> list[tuple[int, int, int, int, int]]:
        part, rows = F.expr(f"shiftrightunsigned(place, {64 - bits})"), self.groups
        if within is not None:
            before = bits - OPEN_BITS
            names = self.groups.sparkSession.createDataFrame([(s >> (64 - before),) for s, _ in within], "prefix bigint")
            rows = rows.join(F.broadcast(names), F.expr(f"shiftrightunsigned(place, {64 - before})") == F.col("prefix"), "left_semi")
        found = rows.groupBy(part.alias("part")).agg(F.sum("size"), F.count(F.lit(1)), F.max("size")).collect()
        return sorted(((r[0] % (1 << bits)) << (64 - bits), bits, r[1], r[2], r[3]) for r in found)

    def open(self, indexes: set[int]) -> None:
        by_bits: dict[int, list] = {}
        for i in indexes:
            by_bits.setdefault(self.rows[i][1], []).append(self.rows[i][:2])
        kept = [r for i, r in enumerate(self.rows) if i not in indexes]
        for bits, within in by_bits.items():
            kept += self._sums(min(64, bits + OPEN_BITS), within)
        self.rows = sorted(kept)


def minimax_cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity, and for each shard but the first the place of its first group.

    ``groups``: ``(place bigint, size bigint)``, one row for each atomic group.
    """
    ranges = _Ranges(groups)
    while True:
        rows = ranges.rows
        sizes = [r[2] for r in rows]
        total, largest = sum(sizes), max([0, *(r[4] for r in rows)])
        high = smallest_capacity(sizes, shards)
        low = max(largest, -(-total // shards))
        opened = _uncertain(rows, sizes, shards, low, high)
        if not opened:
            break
        ranges.open(opened)
    ends = greedy_cuts(sizes, shards, high) or []
    starts = [rows[e][0] for e in ends[:-1] if e < len(rows)]
    return high, starts + [1 << 64] * (shards - 1 - len(starts))


def _uncertain(rows, sizes: list[int], shards: int, low: int, high: int) -> set[int]:
    """Ranges of several groups that hold a cut for some capacity from ``low`` to ``high``.

    A greedy cut moves right with the capacity and with the cut before it. At ``low``
    a shard holds at least the whole ranges that fit; at ``high`` at most that many
    bytes, or what ends before a single group that the limit falls into.
    """
    sums, opened, left, right = [0, *accumulate(sizes)], set(), 0, 0
    for _ in range(shards - 1):
        first = bisect_right(sums, left + low) - 1
        left, right = sums[first], min(sums[-1], right + high)
        last = bisect_right(sums, right) - 1
        if last < len(rows) and rows[last][3] == 1:
            right = sums[last]
        opened.update(i for i in range(first, min(last + 1, len(rows))) if rows[i][3] > 1 and (i < last or sums[i] < right))
    return opened


def _giants(groups: DataFrame, shards: int) -> list[int]:
    """Places of the groups larger than an even share of what is left; at most ``shards - 1``."""
    left, found = groups.agg(F.sum("size")).first()[0] or 0, []
    for place, size in groups.orderBy(F.desc("size"), "place").select("place", "size").limit(shards - 1).collect():
        if size * (shards - len(found)) <= left:
            break
        found.append(place)
        left -= size
    return found


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` for every document, law ``bytes``.

    ``size`` is the text's UTF-8 bytes plus 8. Rows of equal text are one atomic
    group and share a shard, whatever their number. Groups larger than an even share
    come first in the order, each a shard of its own; the others follow by hash. A
    null text is as an empty one (size 8). Slots number the rows of a shard from 0
    without gaps; rows equal in text and doc_id have theirs in any order. With few
    groups shards stay empty. Other columns are not read.
    """
    rows = docs.select("doc_id", string("text").alias("body"))
    rows = set_down(rows.select("doc_id", (F.octet_length("body") + 8).cast("bigint").alias("size"),
                                F.crc32(F.col("body").cast("binary")).alias("text_crc32"), F.xxhash64("body").alias("place")))
    groups = set_down(rows.groupBy("place").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")))
    giants = _giants(groups, shards)
    _, starts = minimax_cuts(groups.where(~F.col("place").isin(giants)) if giants else groups, shards - len(giants))
    # Places are ordered as unsigned numbers; flipping the top bit makes that the signed order.
    order = F.expr("place ^ (-9223372036854775807L - 1L)")
    shard = F.lit(len(giants))
    for start in starts:
        if start < 1 << 64:
            shard = shard + (order >= F.lit(start - (1 << 63))).cast("int")
    for number, place in enumerate(giants):
        shard = F.when(F.col("place") == place, F.lit(number)).otherwise(shard)
    placed = rows.withColumn("shard", shard.cast("int")).withColumn("order", order)
    return _number(placed, groups).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def _number(placed: DataFrame, groups: DataFrame) -> DataFrame:
    """Slots by runs: a run is a range of places, or a hashed part of a place with many rows.

    Runs are numbered side by side; a run's first slot comes from the counts of the
    runs before it, a table of at most ``MOST_RUNS`` rows and those of the heavy places.
    """
    spark = placed.sparkSession
    total = groups.agg(F.sum("n")).first()[0] or 0
    bits = max(1, min(MOST_RUNS, -(-total // RUN_ROWS) * 2).bit_length() - 1)
    floor = max(RUN_ROWS // 4, total // 4096)
    heavy = [(r["place"], -(-r["n"] // floor)) for r in groups.where(F.col("n") > floor).collect()]
    parts = F.broadcast(spark.createDataFrame(heavy, T.StructType([
        T.StructField("place", T.LongType()), T.StructField("parts", T.IntegerType())])))
    run = placed.join(parts, "place", "left").select(
        "doc_id", "size", "text_crc32", "shard", "order", F.expr(f"shiftrightunsigned(place, {64 - bits})").alias("run"),
        F.when(F.col("parts").isNotNull(), F.col("place")).alias("alone"),
        F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("doc_id", F.lit(7)), F.col("parts"))).alias("part"))
    run = run.withColumn("run", F.concat_ws(" ", "run", "alone", "part"))
    counts = run.groupBy("shard", "run").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "run", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("shard", "run").orderBy("order", "doc_id"))
    return run.withColumn("nth", nth).join(F.broadcast(first), ["shard", "run"]).withColumn(
        "slot", (F.col("nth") - 1 + F.col("start")).cast("bigint"))
