"""What the corpus operators share: reading, batch bounds, heavy keys, table set-down."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import cut_lineage

#: Rows of one Arrow batch; a Python worker holds one batch, so this bounds its memory.
BATCH_ROWS = 512
#: Bytes of one Arrow batch, beyond which Spark starts another.
BATCH_BYTES = 8 << 20
#: Rows of one key that a join may send to one task, and keys with more that may be broadcast.
KEY_ROWS, HEAVY_KEYS = 2000, 20_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Hold Arrow batches small, so that very long texts do not add up in a worker; numbers may come in more ``rows``."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def utf8(column: str) -> Column:
    """The text as bytes, null as empty: Python then gets bytes without decoding them."""
    return F.coalesce(F.col(f"`{column}`"), F.lit("")).cast("binary")


def string(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`"), F.lit(""))


def filtered(batches: Iterator[pa.RecordBatch], position: int, keep) -> Iterator[pa.RecordBatch]:
    """Rows whose text (column ``position``) passes ``keep(list of str) -> list of bool``; no column is renamed."""
    for batch in batches:
        if batch.num_rows:
            texts = [t or "" for t in batch.column(position).to_pylist()]
            yield batch.filter(pa.array(keep(texts), pa.bool_()))


def replaced(batches: Iterator[pa.RecordBatch], position: int, edit) -> Iterator[pa.RecordBatch]:
    """The same rows with ``edit(list of str or None)`` as the text column."""
    for batch in batches:
        texts = pa.array(edit(batch.column(position).to_pylist()), batch.schema.field(position).type)
        yield batch.set_column(position, batch.schema.field(position), texts)


def join_with_heavy_keys(left: DataFrame, right: DataFrame, key: str, weight: str, rows: int = KEY_ROWS, how: str = "left") -> DataFrame:
    """Join on ``key``, where ``right`` has one row per key and ``weight``, the key's rows in ``left``.

    Keys of more than ``rows`` rows are joined by a broadcast, at most ``HEAVY_KEYS`` of them, the
    heaviest. The others meet in an ordinary join; if keys of more rows are left for it, both sides
    are salted so that no task meets more than about ``rows`` rows of a key.
    """
    slim = right.drop(weight)
    heavy = right.where(F.col(weight) > rows).orderBy(F.desc(weight)).limit(HEAVY_KEYS + 1).collect()
    rest, salts = slim, 1
    if len(heavy) > HEAVY_KEYS:
        salts = -(-heavy.pop()[weight] // rows)
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)) if salts > 1 else None
    if salts > 1:
        rest = slim.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    if not heavy:
        return left.join(slim, key, how)
    names = [c for c in right.columns if c != weight]
    few = F.broadcast(left.sparkSession.createDataFrame([tuple(r[c] for c in names) for r in heavy], slim.schema))
    hot = left.join(few, key, "inner")
    cold = left.join(few.select(key), key, "left_anti")
    if salts > 1:
        cold = cold.withColumn("__salt", spread).join(rest, [key, "__salt"], how).drop("__salt")
    else:
        cold = cold.join(rest, key, how)
    return hot.unionByName(cold)


def set_down(df: DataFrame) -> DataFrame:
    """A copy in the shared checkpoint folder; the plan starts anew from it."""
    return cut_lineage(df)


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``position`` (0 upwards in the given order) and ``part``, the sorted partition it lies in; set down.

    The rows are dealt by range and sorted there; only the rows of each partition are counted
    on the driver. Equal rows follow in any order, dealt over partitions by their place in the
    input, so a row that repeats very often is no large partition: put ``rows`` down before.
    """
    spread = rows.withColumn("__tie", F.monotonically_increasing_id())
    dealt = set_down(spread.repartitionByRange(*order, F.col("__tie")).sortWithinPartitions(*order, F.col("__tie"))
                     .withColumn("__at", F.monotonically_increasing_id()))
    part, within = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r[0], r[1]) for r in dealt.groupBy(part).count().collect())
    starts, before = [], 0
    for number, n in counts:
        starts.append((number, before))
        before += n
    offsets = F.broadcast(rows.sparkSession.createDataFrame(starts, "part bigint, __before bigint"))
    return dealt.withColumn("part", part).join(offsets, "part").withColumn("position", F.col("__before") + within).drop(
        "__tie", "__at", "__before")
