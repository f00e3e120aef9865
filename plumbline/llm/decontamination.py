"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are windows of consecutive benchmark words; the alphabet is the words of
the benchmark. For windows of one length a shift table says, for the block of two
words under the end of the search position, how far no window can end; at shift zero
the bucket of that block holds the windows that end with it, of which those with the
right first block are compared word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, filtered, set_down, utf8

#: Words of a window.
WINDOW = 10
#: (window, item) rows of one block; a block is what is broadcast at a time, so this bounds the broadcast.
BLOCK_WINDOWS = 100_000

_SPACE = 32
#: A-Z lowered; bytes that are no digit, letter or part of a non-ASCII character become a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else _SPACE
                    for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class WuManber:
    """All windows of one length; ``items`` are what a match stands for."""

    def __init__(self, size: int, windows: dict[tuple[int, ...], list[str]]):
        self.size, self.windows = size, windows
        self.block = min(2, size)
        self.shift: dict = {}
        self.buckets: dict = {}
        for window in windows:
            for end in range(self.block, size + 1):
                key = window[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, size), size - end)
            self.buckets.setdefault(window[size - self.block:], {}).setdefault(window[:self.block], []).append(window)

    def find(self, ids: list[int]) -> Iterator[tuple[int, tuple[int, ...]]]:
        """``(first word, window)`` of every occurrence; -1 is a word that no window has."""
        size, block, shift, buckets, n = self.size, self.block, self.shift, self.buckets, len(ids)
        away, end = size - block + 1, size - 1
        while end < n:
            last = ids[end]
            if last < 0:
                end += size
                continue
            key = (ids[end - 1], last) if block == 2 else (last,)
            step = shift.get(key, away)
            if step:
                end += step
                continue
            start = end - size + 1
            for window in buckets[key].get(tuple(ids[start:start + block]), ()):
                if tuple(ids[start:end + 1]) == window:
                    yield start, window
            end += 1


class Matcher:
    """The windows of a block, one search for each window length."""

    def __init__(self, rows: list[tuple[str, str | None]]):
        self.vocabulary: dict[bytes, int] = {}
        lengths: dict[int, dict[tuple[int, ...], list[str]]] = {}
        for window, item in rows:
            words = window.encode("utf-8").split(b" ")
            key = tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words)
            named = lengths.setdefault(len(key), {}).setdefault(key, [])
            if item is not None:
                named.append(item)
        self.searches = [WuManber(size, windows) for size, windows in sorted(lengths.items())]

    def match(self, words: list[bytes], hit: bytearray, items: set[str]) -> None:
        """Marks the words inside occurrences in ``hit`` and adds the items that occur."""
        ids = list(map(self.vocabulary.get, words, repeat(-1)))
        for search in self.searches:
            for start, window in search.find(ids):
                hit[start:start + search.size] = b"\1" * search.size
                items.update(search.windows[window])

    def any(self, words: list[bytes]) -> bool:
        ids = list(map(self.vocabulary.get, words, repeat(-1)))
        return any(True for search in self.searches for _ in search.find(ids))


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            found = {b" ".join(words[i:i + WINDOW]) for i in range(max(1, len(words) - WINDOW + 1))} if words else set()
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8") for w in found], pa.string()),
                                              pa.array([item] * len(found), pa.string())], ["window", "item"])


def _blocks(benchmark: DataFrame) -> Iterator[tuple[object, bool]]:
    """Blocks of windows, each of about ``BLOCK_WINDOWS`` rows at most, and whether it is the last.

    A block is collected and broadcast when it is asked for, and released when the next one is.
    """
    spark = benchmark.sparkSession
    bounded_batches(spark)
    named = benchmark.select(F.col("item_id").cast("string").alias("item"), utf8("text").alias("body"))
    rows = set_down(named.mapInArrow(_windows, "window string, item string").distinct())
    count = -(-rows.count() // BLOCK_WINDOWS) or 1
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(count)))
    for b in range(count):
        block = spark.sparkContext.broadcast([(r[0], r[1]) for r in dealt.where(F.col("block") == b).drop("block").collect()])
        yield block, b == count - 1
        if b < count - 1:
            block.destroy()


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``, a row for every document.

    Null or empty texts have no words and no hit. A benchmark item of fewer than
    ``WINDOW`` words is one window, one of no words is none; an empty benchmark leaves
    all clean. Windows of an item without an id make words hit but name no item.
    Repeated rows give repeated rows. Only the id and text columns are read, so other
    columns cannot clash. The benchmark is searched in blocks of bounded size, one at a
    time; with several, what is found so far is set down between two passes.
    """
    bounded_batches(docs.sparkSession)
    state = docs.select(F.col("doc_id"), utf8("text").alias("body"), F.lit(b"").alias("hit"),
                        F.array().cast("array<string>").alias("items"))
    id_type = state.schema["doc_id"].dataType.simpleString()
    for block, last in _blocks(benchmark):
        if not last:
            state = set_down(state.mapInArrow(_search(block, False), f"doc_id {id_type}, body binary, hit binary, items array<string>"))
    return state.mapInArrow(_search(block, True), f"doc_id {id_type}, n_words bigint, n_hit bigint, n_items bigint, "
                            "items_sha256 string, contaminated boolean")


def _search(block, final: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block.value)
        for batch in batches:
            hits, lists, lengths = [], [], []
            for body, before, items in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                words, found = words_of(body), set(items)
                hit = bytearray(before or len(words))
                matcher.match(words, hit, found)
                hits.append(bytes(hit))
                lists.append(sorted(found))
                lengths.append(len(words))
            if not final:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, pa.binary()),
                                                  pa.array(lists, pa.list_(pa.string()))], batch.schema.names)
                continue
            n_hit = [h.count(1) for h in hits]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(list(map(len, lists)), pa.int64()),
                 pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists], pa.string()),
                 pa.array([n > 0 for n in n_hit], pa.bool_())],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with all their columns."""
    bounded_batches(docs.sparkSession)
    position = docs.columns.index("text")
    for block, last in _blocks(benchmark):
        docs = docs.mapInArrow(_clean(block, position), docs.schema)
        docs = docs if last else set_down(docs)
    return docs


def _clean(block, position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(block.value)
        return filtered(batches, position, lambda texts: [not matcher.any(words_of(t.encode("utf-8"))) for t in texts])
    return run
