"""Language-model scores by context-tree weighting over bytes.

A text is the sequence of its lower-cased words, each followed by a space, the last (or none) by
the end sign. Each byte is eight binary decisions, so there are 255 decision nodes, and each has a
tree of contexts: the bytes before it, none to ``depth`` of them. At every node of every tree the
training decisions have a Krichevsky-Trofimov estimate. Bottom-up, a node's weighted probability of
the training data is half its own estimate and half the product of its children's; the odds of the two
halves are the node's say. Top-down these odds mix the estimates of all depths into one probability
of a decision, and the logarithms of eight of them are the code length of a byte after its context.

Everything that grows is a Spark table: counts of (context, byte) over the corpus, the levels of the
trees, and the code lengths. The deepest two levels, which are most of a tree, are worked out as arrays,
the codes of many stems at a time: below a stem there are at most 2^24 codes, in real text some thousands. Texts are scored in one pass against the most frequent code lengths and
word counts, as many as ``HELD_GRAMS`` and ``HELD_TOKENS`` allow; what is rarer is joined.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, utf8
from plumbline.session import scratch_folder

#: Bytes of the longest context.
DEPTH = 6
#: Bytes by which the contexts below a stem are longer than it; what lies below one stem is worked on together.
BELOW = 2
#: Codes of whole stems in one packed row, if one stem has no more.
CHUNK = 250_000
#: Code lengths and word counts that are broadcast at most, the most frequent ones.
HELD_GRAMS = 2_000_000
HELD_TOKENS = 1_000_000
#: Distinct (context, byte) pairs, distinct words, and bytes of text that a task sums up before it sends the counts on.
SUMMED_GRAMS, SUMMED_TOKENS, SUMMED_BYTES = 2_000_000, 400_000, 64 << 20
#: Texts of one batch, if these have fewer bytes than a batch may, and bytes of texts that are arrays at a time, counted or scored.
TEXTS, PIECE_BYTES, SCORED_BYTES = 2048, 2 << 20, 512 << 10

END = b"\n"
_LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_TABLE = 16  # gamma values below this come from a table, larger ones from a series


def tokens_of(text: bytes) -> list[bytes]:
    """Words between spaces and control white space, A-Z lowered."""
    return text.translate(_LOWERED).split()


def grams_of(lists: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of the (context, byte) pair at every byte of every text, and where each text starts.

    The byte lies above the context, the context's latest byte above its earlier ones, so a shift by
    eight bits forgets the earliest. Before a text there are only end signs.
    """
    buffer = b"".join([END * depth + b" ".join(words) + END for words in lists]) + bytes(8)
    size = np.array([sum(map(len, words)) + max(len(words), 1) for words in lists], np.int64)
    starts = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(lists) else np.zeros(0, np.int64)
    n = len(buffer) - 8 - depth
    if n <= 0:
        return np.zeros(0, np.int64), starts
    codes = np.ndarray((n,), "<u8", buffer, 0, (1,)) & np.uint64((1 << 8 * (depth + 1)) - 1)
    inside = np.ones(n, bool)
    for k in range(depth):  # positions that are signs before a text
        inside[(starts + depth * np.arange(len(lists)) - depth + k)[1:]] = False
    return codes[inside].view(np.int64), starts


def _added(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Sorted codes with their counts, of several such; sorted runs are merged, not sorted anew."""
    codes = np.concatenate([p[0] for p in parts])
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    codes, counts = codes[starts], []
    for i in range(1, len(parts[0])):
        column = np.concatenate([p[i] for p in parts])[order]
        counts.append(np.add.reduceat(column, starts, dtype=np.int64) if len(starts) else column)
    return codes, *counts


def _pieces(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """``(start, count)`` of runs of texts of at most ``most`` bytes together, or of one text."""
    start, size = 0, 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if i > start and size + n > most:
            yield start, i - start
            start, size = i, 0
        size += n
    if len(texts) > start:
        yield start, len(texts) - start


class _Sums:
    """Counts of codes and words of held out texts and of training texts."""

    def __init__(self, depth: int):
        self.depth = depth
        self.start_anew()

    def start_anew(self) -> None:
        self.codes, self.tokens, self.bytes = [], (Counter(), Counter()), 0

    def add(self, lists: list[list[bytes]], train: bool) -> None:
        codes, n = np.unique(grams_of(lists, self.depth)[0], return_counts=True)
        n = n.astype(np.uint32)  # at most the bytes of the texts
        self.codes.append((codes, n * np.uint32(train), n))
        self.tokens[train].update(chain.from_iterable(lists))
        self.tokens[train][END] += len(lists)
        self.bytes += sum(sum(map(len, words)) for words in lists)
        if sum(len(c[0]) for c in self.codes) > SUMMED_GRAMS + SUMMED_GRAMS // 2:
            self._merge()

    def _merge(self) -> None:
        if len(self.codes) > 1:
            codes, *counts = _added(self.codes)
            self.codes = [(codes, *[c.astype(np.uint32) for c in counts])]

    def full(self) -> bool:
        return (self.bytes > SUMMED_BYTES or sum(map(len, self.tokens)) > SUMMED_TOKENS
                or (len(self.codes) == 1 and len(self.codes[0][0]) > SUMMED_GRAMS))

    def rows(self, buckets: int, stem: int) -> Iterator[pa.RecordBatch]:
        """One row a bucket: its codes and their counts, packed, and its words with counts. The sums start anew."""
        self._merge()
        codes, train, n = self.codes[0] if self.codes else (np.zeros(0, np.int64),) * 3
        at = _stems(codes, self.depth, stem) % buckets
        order = np.argsort(at, kind="stable")  # codes stay in order inside a bucket
        cuts = np.searchsorted(at[order], np.arange(buckets + 1))
        held, learnt = self.tokens
        words: list[tuple[list, list, list]] = [([], [], []) for _ in range(buckets)]
        for word in chain(learnt, held.keys() - learnt.keys()):
            own, own_train, own_n = words[zlib.crc32(word) % buckets]
            t = learnt.get(word, 0)  # a Counter's own way to say zero is slow
            own.append(word)
            own_train.append(t)
            own_n.append(t + held.get(word, 0))
        for bucket in range(buckets):
            some = order[cuts[bucket]:cuts[bucket + 1]]
            if len(some) or words[bucket][0]:
                yield _packed_row(bucket, codes[some], train[some], n[some], *words[bucket])
        self.start_anew()


#: A packed row: codes as bytes of their sorted differences, counts as bytes of 32 bits where these do, and words with counts.
_PACKED = "bucket int, codes binary, train binary, n binary, words array<binary>, word_train array<bigint>, word_n array<bigint>"


def _packed_row(bucket: int, codes: np.ndarray, train: np.ndarray, n: np.ndarray, words: list, word_train: list, word_n: list) -> pa.RecordBatch:
    width = "<i8" if len(n) and n.max() >> 32 else "<u4"
    values = [[bucket], [np.diff(codes, prepend=0).astype("<i8").tobytes()], [train.astype(width).tobytes()], [n.astype(width).tobytes()],
              [words], [word_train], [word_n]]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)],
                                      ["bucket", "codes", "train", "n", "words", "word_train", "word_n"])


def _unpacked(codes: bytes, train: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    width = "<i8" if len(n) == len(codes) else "<u4"
    return np.cumsum(np.frombuffer(codes, "<i8")), *(np.frombuffer(c, width).astype(np.int64) for c in (train, n))


def _stems(codes: np.ndarray, depth: int, stem: int) -> np.ndarray:
    return (codes & ((1 << 8 * depth) - 1)) >> 8 * (depth - stem)


def _merged(rows: list[tuple], depth: int, stem: int) -> Iterator[pa.RecordBatch]:
    """A bucket's rows as one row for each ``CHUNK`` codes of whole stems, and one for its words."""
    bucket = rows[0][0]
    codes, train, n = _added([_unpacked(*r[1:4]) for r in rows])
    order = np.argsort(_stems(codes, depth, stem), kind="stable")
    stems = _stems(codes, depth, stem)[order]
    start = 0
    while start < len(order):
        end = len(order) if start + CHUNK >= len(order) else int(np.searchsorted(stems, stems[start + CHUNK], "right"))
        some = np.sort(order[start:end])
        yield _packed_row(bucket, codes[some], train[some], n[some], [], [], [])
        start = end
    learnt, every = {}, {}
    for r in rows:
        for word, t, k in zip(r[4], r[5], r[6], strict=True):
            learnt[word] = learnt.get(word, 0) + t
            every[word] = every.get(word, 0) + k
    none = np.zeros(0, np.int64)
    yield _packed_row(bucket, none, none, none, list(every), list(learnt.values()), list(every.values()))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A copy of ``df`` as Parquet in the shared folder."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def count_corpus(docs: DataFrame, held_out: Column, depth: int, stem: int, buckets: int) -> DataFrame:
    """Packed rows with the counts of all (context, byte) pairs and all words, in training texts and in all.

    Tasks sum up what they read, deal it into buckets by stem or word, and send a row a bucket; a bucket
    is merged by one task.
    """
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(depth)
        for batch, at, n in ((b, *piece) for b in batches for piece in _pieces(b.column(0), PIECE_BYTES)):
            lists, held = [tokens_of(t) for t in batch.column(0).slice(at, n).to_pylist()], batch.column(1).slice(at, n).to_pylist()
            for train in (False, True):
                some = [words for words, h in zip(lists, held, strict=True) if h != train]
                if some:
                    sums.add(some, train)
            if sums.full():
                yield from sums.rows(buckets, stem)
        yield from sums.rows(buckets, stem)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    yield from _merged(held, depth, stem)
                    held = []
                held.append(row)
        if held:
            yield from _merged(held, depth, stem)

    bounded_batches(spark, TEXTS)
    rows = docs.select(utf8("text").alias("body"), F.coalesce(held_out, F.lit(False)).alias("held"))
    dealt = rows.mapInArrow(count, _PACKED).repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return _stored(dealt.mapInArrow(merge, _PACKED), "counted")


def _log_gamma(n: Column, extra: float) -> Column:
    """Logarithm of the gamma function of ``n + extra``, ``n`` a whole number."""
    table = F.array(*[F.lit(math.lgamma(i + extra)) for i in range(_TABLE)])
    x = n + F.lit(extra)
    series = (x - 0.5) * F.log(x) - x + F.lit(0.5 * math.log(2 * math.pi)) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (
        1260 * x * x * x * x * x)
    return F.when(n < _TABLE, F.get(table, n.cast("int"))).otherwise(series)


def _estimate(a: Column, b: Column) -> Column:
    """Logarithm of the Krichevsky-Trofimov probability of ``a`` zeros and ``b`` ones."""
    return _log_gamma(a, 0.5) + _log_gamma(b, 0.5) - F.lit(math.log(math.pi)) - _log_gamma(a + b, 1.0)


def _log_gammas(n: np.ndarray, extra: float) -> np.ndarray:
    x = n + extra
    series = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x ** 3) + 1 / (1260 * x ** 5)
    table = np.array([math.lgamma(i + extra) for i in range(_TABLE)])
    return np.where(n < _TABLE, table[np.minimum(n, _TABLE - 1)], series)


class Below:
    """The levels of the trees from the full depth up to the stems, for all codes below some stems.

    A node is keyed by its context and, in the last eight bits, its decision; ``levels`` has for each
    depth, the full one first, ``(keys, zeros, ones, own, children, parents)``, the last being the places
    of the nodes' parents in the next entry.
    """

    def __init__(self, codes: np.ndarray, train: np.ndarray, depth: int, stem: int):
        byte, context = codes >> 8 * depth, codes & ((1 << 8 * depth) - 1)
        steps = np.arange(8)[:, None]
        self.bits = (byte >> (7 - steps)) & 1
        keys, place = np.unique((context << 8 | ((byte | 256) >> (8 - steps))).ravel(), return_inverse=True)
        self.place = place.reshape(8, -1)
        zeros, ones = (np.bincount(place, np.where(self.bits == bit, train, 0).ravel(), len(keys)).astype(np.int64) for bit in (0, 1))
        self.levels, weighted, children = [], None, None
        for d in range(depth, stem - 1, -1):
            own = _log_gammas(zeros, 0.5) + _log_gammas(ones, 0.5) - math.log(math.pi) - _log_gammas(zeros + ones, 1.0)
            weighted = own if children is None else np.logaddexp(own, children) - math.log(2)
            above, parents = np.unique(keys >> 16 << 8 | keys & 255, return_inverse=True) if d > stem else (None, None)
            self.levels.append((keys, zeros, ones, own, children, parents))
            if d > stem:
                children = np.bincount(parents, weighted, len(above))
                zeros, ones = (np.bincount(parents, x, len(above)).astype(np.int64) for x in (zeros, ones))
                keys = above

    def costs(self, key: np.ndarray, zero: np.ndarray, one: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """log10 probability of every code; the arguments are what the nodes at the stems, and those above, make of a decision."""
        order = np.argsort(key)
        at = order[np.searchsorted(key, self.levels[-1][0], sorter=order)]
        zero, one, rest = zero[at], one[at], rest[at]
        for _, a, b, own, children, parents in self.levels[-2::-1]:
            share = 1.0 if children is None else 1 / (1 + np.exp(np.minimum(children - own, 700)))
            zero, one, rest, seen = zero[parents], one[parents], rest[parents], a + b + 1.0
            zero, one, rest = zero + rest * share * (a + 0.5) / seen, one + rest * share * (b + 0.5) / seen, rest * (1 - share)
        return np.log10(np.where(self.bits == 0, zero[self.place], one[self.place])).sum(axis=0)


def tree_levels(counted: DataFrame, depth: int, stem: int) -> list[DataFrame]:
    """Nodes ``(ctx, node, a, b, own, children)`` by length of the context, from none to that of the stems.

    ``a`` and ``b`` count zeros and ones, ``own`` is the logarithm of the node's own estimate and
    ``children`` the sum of the logarithms of its children's weighted ones.
    """
    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                codes, train, _ = _unpacked(*packed)
                keys, zeros, ones, own, children, _ = Below(codes, train, depth, stem).levels[-1]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys >> 8, (keys & 255).astype(np.int32), zeros, ones, own, children)],
                                                 ["ctx", "node", "a", "b", "own", "children"])

    chunks = counted.where(F.octet_length("codes") > 0).select("codes", "train", "n")
    level = _stored(chunks.mapInArrow(climb, "ctx bigint, node int, a bigint, b bigint, own double, children double"), "stems")
    levels = [level]
    weighted = F.greatest("own", "children") + F.log1p(F.exp(-F.abs(F.col("own") - F.col("children")))) - F.lit(math.log(2))
    for d in range(stem - 1, -1, -1):
        level = _stored(level.groupBy(F.shiftright("ctx", 8).alias("ctx"), "node").agg(
            F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum(weighted).alias("children")).withColumn(
                "own", _estimate(F.col("a"), F.col("b"))), f"tree-{d}")
        levels.append(level)
    return levels[::-1]


def code_lengths(counted: DataFrame, depth: int, stem: int, buckets: int) -> DataFrame:
    """``(gram, n, cost)``: log10 probability of the byte after its context, for every code in packed rows.

    Codes with no training count add nothing to the model; they only ask for a probability.
    """
    mixed = None
    for d, level in enumerate(tree_levels(counted, depth, stem)):
        rows = level.withColumns({"zero": F.lit(0.0), "one": F.lit(0.0), "rest": F.lit(1.0)}) if mixed is None else level.join(
            mixed.withColumnsRenamed({"ctx": "above", "node": "above_node"}),
            (F.shiftright("ctx", 8) == F.col("above")) & (F.col("node") == F.col("above_node")))
        # the node's own share of what shallower nodes left
        share, seen = 1 / (1 + F.exp(F.col("children") - F.col("own"))), F.col("a") + F.col("b") + 1
        mixed = _stored(rows.select(
            "ctx", "node", (F.col("zero") + F.col("rest") * share * (F.col("a") + 0.5) / seen).alias("zero"),
            (F.col("one") + F.col("rest") * share * (F.col("b") + 0.5) / seen).alias("one"),
            (F.col("rest") * (1 - share)).alias("rest")), f"mixed-{d}")

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = batch.column("states")
            for i, packed in enumerate(zip(*(batch.column(c).to_pylist() for c in ("codes", "train", "n")), strict=True)):
                codes, train, n = _unpacked(*packed)
                key, *state = (states[i].values.field(c).to_numpy(zero_copy_only=False) for c in ("key", "zero", "one", "rest"))
                cost = Below(codes, train, depth, stem).costs(key, *state)
                yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n), pa.array(cost)], ["gram", "n", "cost"])

    key = F.shiftleft("ctx", 8).bitwiseOR(F.col("node").cast("bigint")).alias("key")
    states = mixed.groupBy(F.pmod("ctx", F.lit(buckets)).cast("int").alias("bucket")).agg(
        F.collect_list(F.struct(key, "zero", "one", "rest")).alias("states"))
    chunks = counted.where(F.octet_length("codes") > 0).select("bucket", "codes", "train", "n").join(states, "bucket")
    return _stored(chunks.mapInArrow(descend, "gram bigint, n bigint, cost double"), "costs")


class Slots:
    """Values by 64-bit key, in open addressing with arrays; half of the slots or more are empty."""

    EMPTY = -1  # no key has this value

    def __init__(self, keys: np.ndarray, *values: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        size = 1 << self.bits
        place = np.full(size, -1, np.int32)
        pending, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(pending):
            free = place[at] < 0
            place[at[free]] = pending[free]
            left = place[at] != pending
            pending, at = pending[left], (at[left] + 1) & (size - 1)
        used = np.flatnonzero(place >= 0)
        self.keys, self.values = np.full(size, self.EMPTY, np.int64), [np.zeros(size, v.dtype) for v in values]
        for array, v in zip((self.keys, *self.values), (keys, *values), strict=True):
            array[used] = v[place[used]]

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if there is none."""
        at = self._home(keys)
        here = self.keys[at]
        open_ = np.flatnonzero(here != keys)
        open_, lost = open_[(used := here[open_] != self.EMPTY)], open_[~used]
        at[lost] = -1
        while len(open_):
            step = (at[open_] + 1) & (len(self.keys) - 1)
            here = self.keys[step]
            used = here != self.EMPTY
            at[open_] = np.where(used, step, -1)
            open_ = open_[used & (here != keys[open_])]
        return at


def _frequent(rows: DataFrame, limit: int) -> int:
    """The least power of two that at most ``limit`` rows have as their ``n``."""
    powers = [1 << j for j in range(62)]
    counts = rows.agg(*[F.count_if(F.col("n") >= p) for p in powers]).first()
    return next(p for p, n in zip(powers, counts, strict=True) if n <= limit)


def _word_keys(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash a word, in two halves."""
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), np.int64).reshape(-1, 2)
    return np.where(digests[:, 0] == Slots.EMPTY, 0, digests[:, 0]), np.ascontiguousarray(digests[:, 1])


class Model:
    """What a worker knows: the frequent code lengths and training counts, and whether these are all.

    ``facts`` are plain values, as they are broadcast; a worker process makes its tables of them once.
    """

    _made: tuple = (None, None)

    @classmethod
    def of(cls, facts: dict) -> Model:
        if cls._made[0] != facts["name"]:
            cls._made = facts["name"], cls(facts)
        return cls._made[1]

    def __init__(self, facts: dict):
        self.costs, self.counts = Slots(*facts["costs"]), Slots(*facts["counts"])
        self.all_counts, self.total, self.distinct = facts["all_counts"], facts["total"], facts["distinct"]
        self.ends, self.depth = facts["ends"], facts["depth"]

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


class _Scorer(dict):
    """Word -> number; the training count by number, -1 where it must be joined."""

    def __init__(self, model: Model):
        self.model, self.words, self.counts = model, [], np.zeros(0, np.int64)

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.words)
        self.words.append(word)
        return number

    def _learn(self) -> None:
        first, second = _word_keys(self.words[len(self.counts):])
        at = self.model.counts.find(first)
        known = (at >= 0) & (self.model.counts.values[0][at] == second)
        count = np.where(known, self.model.counts.values[1][at], 0 if self.model.all_counts else -1)
        self.counts = np.concatenate([self.counts, count])

    def score(self, texts: list[bytes]) -> tuple:
        """``(tokens, known, base, score, places of codes to join, codes, places of words to join, words)`` of the texts."""
        model, n = self.model, len(texts)
        if len(self.words) > SUMMED_TOKENS or sum(map(len, self.words[::64])) > SUMMED_BYTES // 64:
            self.clear()
            self.words, self.counts = [], self.counts[:0]
        lists = [tokens_of(t) for t in texts]
        size = np.array([len(words) for words in lists], np.int64)
        number = np.fromiter(map(self.__getitem__, chain.from_iterable(lists)), np.int64, int(size.sum()))
        if len(self.words) > len(self.counts):
            self._learn()
        owner, count = np.repeat(np.arange(n), size), self.counts[number]
        rare = np.flatnonzero(count < 0)
        base = np.bincount(owner, np.where(count < 0, 0.0, model.base(np.maximum(count, 0))), minlength=n)
        known = np.bincount(owner, count > 0, minlength=n).astype(np.int64) + (model.ends > 0)
        codes, starts = grams_of(lists, model.depth)
        at = model.costs.find(codes)
        cost = np.where(at >= 0, model.costs.values[0][at].astype(np.float64), 0.0)
        open_ = np.flatnonzero(at < 0)
        score = np.add.reduceat(cost, starts) if n else cost
        places = np.searchsorted(starts, open_, "right") - 1
        return (size + 1, known, base + model.base(np.array(model.ends)), score, places, codes[open_], owner[rare],
                [self.words[i] for i in number[rare].tolist()])


def _lists(places: np.ndarray, values, n: int, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(places, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _scored(docs: DataFrame, held_out: Column, shared) -> DataFrame:
    schema = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, "
              "codes array<bigint>, words array<binary>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(Model.of(shared.value))
        for batch in (b.slice(*piece) for b in batches for piece in _pieces(b.column(2), SCORED_BYTES)):
            n = batch.num_rows
            tokens, known, base, score, at, codes, word_at, words = scorer.score(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tokens), pa.array(known), pa.array(base), pa.array(score),
                 _lists(at, codes, n, pa.int64()), _lists(word_at, words, n, pa.binary())],
                ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "codes", "words"])

    bounded_batches(docs.sparkSession, TEXTS)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       utf8("text").alias("body"))
    return rows.mapInArrow(run, schema)


def _load(costs: DataFrame, tokens: DataFrame, depth: int, held_grams: int, held_tokens: int) -> tuple[dict, int, int]:
    """The facts of the broadcast model, and the counts from which a code or a word is in it."""
    total, distinct, ends = tokens.agg(F.sum("train"), F.count_if(F.col("train") > 0),
                                       F.max(F.when(F.col("token") == END, F.col("train")))).first()
    from_codes, from_words = _frequent(costs, held_grams), _frequent(tokens, held_tokens)
    few = costs.where(F.col("n") >= from_codes).select("gram", "cost").toArrow()
    lengths = few.column("gram").to_numpy(), few.column("cost").to_numpy().astype(np.float32)
    few = tokens.where(F.col("n") >= from_words).select("token", "train").toArrow()
    counts = *_word_keys(few.column("token").to_pylist()), few.column("train").to_numpy()
    return {"name": uuid4().hex, "costs": lengths, "counts": counts, "all_counts": from_words == 1, "total": total or 0, "distinct": distinct or 0,
            "ends": ends or 0, "depth": depth}, from_codes, from_words


def score_documents(docs: DataFrame, held_out: Column, depth: int = DEPTH, held_grams: int = HELD_GRAMS,
                    held_tokens: int = HELD_TOKENS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, a row for every document.

    ``score`` is the log10 probability of the document's words, in order, and its end, as bytes, by the
    model of the documents that are not ``held_out``; its code length per byte is that over the bytes and
    the logarithm of 2. ``base_score`` is that of the same words by their smoothed counts alone. A null
    or empty text is its end sign only. Rows of null ``held_out`` are learned from; repeated rows count as
    often as they occur. If nothing is learned, all decisions are even. An empty table gives no rows.
    Only doc_id and text are read, so other columns cannot clash; ``depth`` is 1 to 6 bytes.
    """
    if not 1 <= depth <= 6:
        raise ValueError("depth is 1 to 6")
    spark = docs.sparkSession
    stem = max(depth - BELOW, 0)
    # as many buckets as partitions of the input, at least those of a shuffle; odd, as codes end in like bytes
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions()) | 1
    counted = count_corpus(docs, held_out, depth, stem, buckets)
    costs = code_lengths(counted, depth, stem, buckets)
    tokens = counted.select(F.explode(F.arrays_zip("words", "word_train", "word_n")).alias("w")).select(
        F.col("w.words").alias("token"), F.col("w.word_train").alias("train"), F.col("w.word_n").alias("n"))
    facts, from_codes, from_words = _load(costs, tokens, depth, held_grams, held_tokens)
    scored = _scored(docs, held_out, spark.sparkContext.broadcast(facts))
    if from_codes > 1 or from_words > 1:
        scored = _with_rare(_stored(scored, "scored"), costs.where(F.col("n") < from_codes), tokens.where(F.col("n") < from_words), facts)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(facts["total"]).cast("bigint").alias("train_tokens"),
                         "base_score", "score")


def _with_rare(scored: DataFrame, costs: DataFrame, tokens: DataFrame, facts: dict) -> DataFrame:
    """Adds the rare codes and words of each row, which the tables have by join: none occurs often, so no key is hot."""
    rows = scored.withColumn("row", F.monotonically_increasing_id())
    codes = rows.select("row", F.explode("codes").alias("gram")).join(costs, "gram").groupBy("row").agg(F.sum("cost").alias("more_score"))
    count = F.coalesce("train", F.lit(0))
    base = F.log10((count + 0.5) / F.lit(facts["total"] + 0.5 * (facts["distinct"] + 1)))
    words = rows.select("row", F.explode("words").alias("token")).join(tokens, "token", "left").groupBy("row").agg(
        F.sum(base).alias("more_base"), F.count_if(count > 0).alias("more_known"))
    none = F.lit(0.0)
    return rows.drop("codes", "words").join(codes, "row", "left").join(words, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        (F.col("base_score") + F.coalesce("more_base", none)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", none)).alias("score"))
