"""Resampling of a corpus towards a target distribution, over hashed word n-grams.

The texts of a batch are joined into one buffer with a sentinel between them. One pass of a
regular expression over the buffer finds all words and sentinels; ``searchsorted`` over the
places of the sentinels tells the document of every word and masks the n-grams that would
reach over a sentinel; ``bincount`` sums what is left. A bucket's gain compares its share of
the target with its share of the corpus, a document's weight is the mean gain of its n-grams,
and noise keyed by its id turns the weights into a draw without replacement.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, numbered, set_down, utf8

#: Words a worker remembers, and their bytes, before it starts anew between two batches.
WORDS_HELD = 200_000
BYTES_HELD = 32 << 20
#: Words up to this length are appended to a checksum by table.
TABLE_BYTES = 64

_SENTINEL = b"\0"
#: A-Z lowered; the sentinel's own byte becomes a space in texts.
_LOWERED = bytes(b + 32 if 65 <= b <= 90 else b or 32 for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+|\x00")


def _append_tables() -> np.ndarray:
    """``[n, k, v]``: what byte ``k`` of value ``v`` of a CRC-32 becomes when ``n`` bytes are appended."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> 1), step >> 1).astype(np.uint32)
    tables = np.empty((TABLE_BYTES + 1, 4, 256), np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << np.array([[0], [8], [16], [24]], np.uint32)
    for n in range(TABLE_BYTES):
        tables[n + 1] = step[tables[n] & 255] ^ (tables[n] >> 8)
    return tables


class Words(dict):
    """Word -> number, with checksum and length by number; the sentinel is number 0."""

    def __init__(self):
        self.start_anew()

    def start_anew(self) -> None:
        self.clear()
        self.words, self.bytes = [], 0
        self[_SENTINEL]  # noqa: B018

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        self.bytes += len(word)
        return number


class Buckets:
    """Hashed n-grams of 1 to ``order`` words of a batch of texts."""

    def __init__(self, order: int, buckets: int):
        self.order, self.buckets = order, buckets
        self.known, self.crc, self.size = Words(), np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.tables = _append_tables()

    def _facts(self) -> None:
        """Checksums and lengths of the words that are new."""
        new = self.known.words[len(self.crc):]
        self.crc = np.concatenate([self.crc, np.fromiter(map(zlib.crc32, new), np.uint32, len(new))])
        self.size = np.concatenate([self.size, np.fromiter(map(len, new), np.int64, len(new))])

    def _appended(self, crc: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Checksums of runs when a space and a word are appended to each."""
        space, out = self.tables[1], np.uint32(zlib.crc32(b" "))
        out = out ^ space[0][crc & 255] ^ space[1][crc >> 8 & 255] ^ space[2][crc >> 16 & 255] ^ space[3][crc >> 24]
        size = self.size[number]
        row = np.minimum(size, TABLE_BYTES)
        done = (self.crc[number] ^ self.tables[row, 0, out & 255] ^ self.tables[row, 1, out >> 8 & 255]
                ^ self.tables[row, 2, out >> 16 & 255] ^ self.tables[row, 3, out >> 24])
        for i in np.flatnonzero(size > TABLE_BYTES):
            done[i] = zlib.crc32(self.known.words[number[i]], int(out[i]))
        return done

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(words of each text, text index of every n-gram, its bucket)``."""
        if len(self.known.words) > WORDS_HELD or self.known.bytes > BYTES_HELD:
            self.known.start_anew()
            self.crc, self.size = self.crc[:0], self.size[:0]
        found = _WORD.findall(_SENTINEL.join(t.translate(_LOWERED) for t in texts))
        number = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        self._facts()
        ends = np.flatnonzero(number == 0)  # places of the sentinels, one fewer than texts
        place = np.flatnonzero(number)
        owner = np.searchsorted(ends, place)
        number = number[place]
        crc = self.crc[number]
        owners, crcs = [owner], [crc]
        for length in range(2, self.order + 1):
            inside = owner[length - 1:] == owner[:len(owner) - length + 1] if len(owner) >= length else np.zeros(0, bool)
            crc = self._appended(crc[:max(len(number) - length + 1, 0)], number[length - 1:])
            owners.append(owner[length - 1:][inside])
            crcs.append(crc[inside])
        words = np.bincount(owner, minlength=len(texts))
        return words, np.concatenate(owners), np.concatenate(crcs).astype(np.int64) % self.buckets


def count_buckets(docs: DataFrame, order: int, buckets: int) -> np.ndarray:
    """N-grams of all texts by bucket; a task sends one row a bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, total = Buckets(order, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(grams.of(batch.column(0).to_pylist())[2], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    bounded_batches(docs.sparkSession)
    sums = docs.select(utf8("text").alias("body")).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the natural logarithm of a bucket's smoothed share of the target over that of the corpus, rounded down."""
    n = len(corpus)
    all_corpus, all_target = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * (all_corpus + n) / ((float(s) + 1) * (all_target + n))))
                     for s, t in zip(corpus, target, strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, order: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight)``: the mean gain of a document's n-grams, rounded down, 0 without any."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        grams = Buckets(order, len(gain))
        for batch in batches:
            words, owner, bucket = grams.of(batch.column(1).to_pylist())
            count = np.bincount(owner, minlength=batch.num_rows)
            total = np.bincount(owner, gain[bucket], minlength=batch.num_rows).astype(np.int64)  # exact below 2^53
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(count, pa.int64()), pa.array(total // np.maximum(count, 1))],
                ["doc_id", "n_words", "n_features", "weight"])

    bounded_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), utf8("text").alias("body")).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resample_towards(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, order: int = 2,
                     buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document; ``rank`` is null for those not drawn.

    Of the documents with ``min_words`` words, ``percent`` in a hundred (rounded down) with the
    highest scores are drawn and ranked from 1, ties to the smaller id. Null and empty texts have no
    n-gram, weight 0 and are not drawn unless ``min_words`` is 0. An empty target favours rare buckets;
    an empty corpus gives no rows. Repeated rows count and compete each for itself, with the same
    noise if they share the id; a null id has the noise of an empty one and loses ties. Only doc_id
    and text are read, so other columns cannot clash.
    """
    gain = gains(count_buckets(docs, order, buckets), count_buckets(target, order, buckets))
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10)
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((draw.cast("double") + 0.5) / F.lit(4294967296.0))))
    rows = set_down(weigh(docs, gain, order).withColumn("score", (F.col("weight") + noise).cast("bigint")))
    enough = F.col("n_words") >= min_words
    drawn = rows.where(enough).count() * percent // 100
    ranked = numbered(rows.where(enough), F.desc("score"), F.asc_nulls_last("doc_id")).withColumn("rank", F.col("position") + 1)
    fields = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*fields, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(
        rows.where(~enough).select(*fields, F.lit(None).cast("bigint").alias("rank")))
