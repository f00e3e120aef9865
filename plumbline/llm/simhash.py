"""SimHash near-duplicates found through the anchor points of a covering code.

A fingerprint has two halves of 32 bits. If two fingerprints differ in at most d
bits, one half differs in at most t = d // 2. The anchors of a half are the words
of the perfect Hamming code of 31 bits, with one bit free: every 32-bit word is
within distance 1 of an anchor (covering radius 1). A pair with at most t differing
bits has a midpoint within (t + 1) // 2 of both, and an anchor within 1 of that
midpoint; so each half goes to all anchors within 1 + (t + 1) // 2 of it, at most 17
for d = 4, and no link is lost. Fingerprints are compared per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.limits import BROADCAST_ROWS
from plumbline.llm.common import bounded_batches, join_with_heavy_keys, set_down, utf8
from plumbline.operators.components import connected_components

SEED = 42
#: Shingles hashed at a time, so that a very long text needs no more memory.
CHUNK = 200_000
#: Rows of a batch that holds numbers only.
NUMBER_ROWS = 1 << 14
#: Groups up to this size are compared by shifts, larger ones by growing components.
SMALL_GROUP = 12
#: Fingerprints of one anchor up to which they meet in one task, and of a block of a crowded one.
ANCHOR_ROWS = 20_000


# ---------------------------------------------------------------- fingerprints

def _shingles(words: list[bytes], size: int):
    if len(words) < size:
        return iter([b" ".join(words)] if words else [])
    return map(b" ".join, zip(*(islice(words, i, None) for i in range(size)), strict=False))


def fingerprint(text: bytes, size: int = 4) -> int:
    """64 bits: bit b is set if over half of the shingle hashes have it. No words: zero."""
    shingles, total, ones = _shingles(text.lower().split(), size), 0, np.zeros(64, np.int64)
    while hashes := list(map(xxhash.xxh64_intdigest, islice(shingles, CHUNK), repeat(SEED))):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0]) if total else 0


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, fp)``: one row per document, the fingerprint as a signed bigint."""
    bounded_batches(docs.sparkSession)
    plan = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), utf8(text).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(b, shingle) for b in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], ["id", "fp"])

    return plan.mapInArrow(run, "id bigint, fp bigint")


# ---------------------------------------------------------------- anchors

_BIT = np.array([0, *(1 << i for i in range(31))], np.uint32)  # position 1..31 of the code
_FREE = np.uint32(1 << 31)
_CHECKS = [np.uint32(sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1)) for j in range(5)]
#: For each syndrome the two-bit corrections: positions i and i ^ s.
_PAIRS = np.array([[0] * 15] + [[_BIT[i] | _BIT[i ^ s] for i in range(1, 32) if 0 < (i ^ s) and i < (i ^ s)]
                                for s in range(1, 32)], np.uint32)


def anchors(half: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(position in half, anchor)`` of every anchor within distance 2 of each 32-bit word."""
    syndrome = np.zeros(len(half), np.uint8)
    for j, mask in enumerate(_CHECKS):
        syndrome |= ((np.bitwise_count(half & mask) & 1) << j).astype(np.uint8)
    nearest = half ^ _BIT[syndrome]
    where, out = [np.arange(len(half))] * 2, [nearest, nearest ^ _FREE]
    off = np.flatnonzero(syndrome)
    for k in range(15):
        where.append(off)
        out.append(half[off] ^ _PAIRS[syndrome[off], k])
    return np.concatenate(where), np.concatenate(out)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fp = np.asarray(batch.column(0)).view(np.uint64)
        for side in (0, 1):
            half = (fp >> np.uint64(32 * side)).astype(np.uint32)
            where, anchor = anchors(half)
            key = anchor.astype(np.int64) | (side << 32)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[where].view(np.int64))], ["anchor", "fp"])


def _grow(fp: np.ndarray, most: int) -> tuple[list, list]:
    """Links that connect what is connected within one anchor's fingerprints, one per reached fingerprint."""
    a, b, rest = [], [], fp
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(rest ^ x) <= most
            if near.any():
                found = rest[near]
                a.extend([x] * len(found))
                b.extend(found)
                front.extend(found)
                rest = rest[~near]
    return a, b


def _compare(anchor: np.ndarray, fp: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    sizes = np.diff(np.r_[starts, len(anchor)])
    a, b = [], []
    few = np.repeat((sizes > 1) & (sizes <= SMALL_GROUP), sizes)
    x, y = anchor[few], fp[few]
    for shift in range(1, SMALL_GROUP):
        i = np.flatnonzero(x[shift:] == x[:-shift]) if len(x) > shift else np.empty(0, np.int64)
        if not len(i):
            break
        near = i[np.bitwise_count(y[i] ^ y[i + shift]) <= most]
        a.append(y[near])
        b.append(y[near + shift])
    for s, n in zip(starts[sizes > SMALL_GROUP], sizes[sizes > SMALL_GROUP], strict=True):
        one, other = _grow(fp[s:s + n], most)
        a.append(np.array(one, np.uint64))
        b.append(np.array(other, np.uint64))
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *a]), np.concatenate([none, *b])


def _links(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor; the last anchor of a batch waits for the next batch."""
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, fp = np.asarray(batch.column(0)), np.asarray(batch.column(1)).view(np.uint64)
            if anchor[0] == anchor[-1] and (not held or held[-1][0][-1] == anchor[0]):
                held.append((anchor, fp))
                continue
            cut = int(np.searchsorted(anchor, anchor[-1]))
            held.append((anchor[:cut], fp[:cut]))
            yield _pairs(held, most)
            held = [(anchor[cut:], fp[cut:])]
        if held:
            yield _pairs(held, most)
    return run


def _pairs(held, most: int) -> pa.RecordBatch:
    a, b = _compare(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), most)
    a, b = a.view(np.int64), b.view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _split_anchors(wide: DataFrame) -> DataFrame:
    """``wide(anchor, fp)`` where the fingerprints of a crowded anchor are cut into blocks, and each two blocks meet.

    Two blocks are named by a hash; if it is that of other ones too, their fingerprints are compared in vain.
    """
    crowded = set_down(wide.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > ANCHOR_ROWS))
    many = crowded.count()
    if not many:
        return wide
    blocks = crowded.select("anchor", F.ceil(F.col("n") / ANCHOR_ROWS).alias("blocks"))
    dealt = wide.join(F.broadcast(blocks) if many <= BROADCAST_ROWS else blocks, "anchor", "left")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(
        F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).alias("other")
    met = dealt.select("anchor", "fp", "blocks", own.alias("own"), other)
    pair = F.xxhash64("anchor", F.least("own", "other"), F.greatest("own", "other"))
    return met.select(F.when(F.col("blocks").isNull(), F.col("anchor")).otherwise(pair).alias("anchor"), "fp")


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """``(a, b)``: links that connect all distinct fingerprints ``fp`` joined by chains of at most ``max_bits`` bits."""
    if not 0 <= max_bits <= 5:
        raise ValueError("anchors within radius 2 cover up to 5 differing bits")
    wide = _split_anchors(distinct.select("fp").mapInArrow(_replicate, "anchor bigint, fp bigint"))
    met = wide.repartition("anchor").sortWithinPartitions("anchor")
    return met.mapInArrow(_links(max_bits), "a bigint, b bigint").distinct()


# ---------------------------------------------------------------- groups

def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``(id, fp, root, component_id)``, a row for every document; ``root`` is a fingerprint that names the group.

    ``component_id`` is the smallest id reachable through links, the document itself
    included; rows without an id take part but never name a group (it is null where
    no member has one). A null text has no words, like an empty one: fingerprint
    zero. Equal fingerprints are one node, so copies never multiply; a repeated id
    keeps its rows. An empty table gives an empty result. Only ``id_col`` and
    ``text`` are read, so other columns cannot clash.
    """
    hashed = set_down(fingerprints(docs, shingle, id_col, text))
    nodes = set_down(hashed.groupBy("fp").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")))
    bounded_batches(docs.sparkSession, NUMBER_ROWS)
    linked = connected_components(links(nodes, max_bits)).withColumnRenamed("id", "fp")
    bounded_batches(docs.sparkSession)
    grouped = set_down(nodes.join(linked, "fp", "left").select(
        "fp", "low", "n", F.coalesce("component", "fp").alias("root")))
    roots = grouped.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("members"))
    placed = join_with_heavy_keys(grouped.select("fp", "n", "root"), roots, "root", "members")
    return join_with_heavy_keys(hashed, placed, "fp", "n").select("id", "fp", "root", "component_id")


def hex_of(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one_of_each(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents with one row of each group: that of its smallest id (a null id counts as the largest).

    Rows that share the surviving id and fingerprint are copies; one of them stays.
    """
    found = set_down(near_duplicates(docs, shingle, max_bits))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "fp")).alias("kept"))
    first = first.select(F.col("kept.id").alias("__keep_id"), F.col("kept.fp").alias("__keep_fp"))
    if found.groupBy("id").count().where("count > 1").limit(1).count():
        return _with_repeated_ids(docs, first, shingle)
    return docs.join(first.select("__keep_id").hint("shuffle_hash"),
                     docs["doc_id"].cast("bigint").eqNullSafe(F.col("__keep_id")), "left_semi")


def _with_repeated_ids(docs: DataFrame, first: DataFrame, shingle: int) -> DataFrame:
    """The same where ids repeat: the fingerprint is part of the key, and one row of each key stays."""
    position, names = docs.columns.index("text"), docs.columns
    hidden = docs.toDF(*[f"__{i}" for i in range(len(names))])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hidden.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = batch.column(position).to_pylist()
            fp = np.array([fingerprint((t or "").encode("utf-8"), shingle) for t in bodies], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp)], [*batch.schema.names, "__fp"])

    key = f"__{names.index('doc_id')}"
    kept = hidden.mapInArrow(run, f"{fields}, __fp bigint").join(
        first, F.col(key).cast("bigint").eqNullSafe(F.col("__keep_id")) & (F.col("__fp") == F.col("__keep_fp")),
        "left_semi")
    return kept.dropDuplicates([key, "__fp"]).drop("__fp").toDF(*names)
