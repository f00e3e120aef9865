"""Quality by importance resampling: target against raw hashed n-gram models, and Gumbel top-k.

A text is a bag of hashed n-grams of two kinds: word unigrams and bigrams, and
trigrams of token shapes (case, digits, punctuation, repetition). The target model is
that of texts labelled good, the raw model that of all texts. The importance weight
of a text is the ratio of its probabilities under both. Adding Gumbel noise to the
logarithm and keeping the k largest draws k texts without replacement in proportion
to their weights; k is the number of texts whose weight is that of a good text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, set_down, string
from plumbline.session import scratch_folder

#: Buckets of each kind of n-gram; the models are two numbers a bucket, whatever the corpus.
BUCKETS = 1 << 16
#: Labelled rows that the target model and the cut are fitted on at most.
FIT_ROWS = 20_000
#: Pseudo-count of a bucket.
SMOOTHING = 0.5
#: Share of labelled good texts that the cut may lose at most.
LOST_GOOD = 0.002
#: Tokens a worker remembers before it starts anew.
TOKENS_HELD = 300_000
#: Bins of one pass that narrows the range of the k-th largest key.
BINS = 4096

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_SHAPES = 32


def _shape(token: str) -> int:
    """A small number for how a token looks, not what it says."""
    first = token[0]
    if token.isalpha():
        return 7 if token.islower() else 5 if len(token) > 1 and token.isupper() else 6 if first.isupper() else 8
    if first.isalnum() or first == "_":
        if token.isdigit():
            return 1 + min(len(token), 4) // 2
        if any(c.isdigit() or c == "_" for c in token):
            return 4
        if len(token) > 1 and token.isupper():
            return 5
        return 6 if first.isupper() else 7 if token.islower() else 8
    if len(token) == 1:
        return 9 + (".,;:'\"-|".find(first) + 1)
    return 18 + (("!?.-*&%$#|=~".find(first) + 1) if token == first * len(token) else 13)


class _Codes(dict):
    """Token -> hash of 16 bits and shape, packed."""

    def __missing__(self, token: str) -> int:
        if len(self) > TOKENS_HELD:
            self.clear()
        self[token] = code = (zlib.crc32(token.encode("utf-8", "surrogatepass")) & 0xFFFF) << 8 | min(_shape(token), _SHAPES - 2)
        return code


class Features:
    """Texts of a batch to n-gram buckets."""

    def __init__(self):
        self.codes = _Codes()

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(text index, bucket)`` of every n-gram; shape trigrams lie above ``BUCKETS``."""
        look, find, lists = self.codes.__getitem__, _TOKEN.findall, []
        for text in texts:
            lists.append(np.fromiter(map(look, find(text)), np.int64))
        owner = np.repeat(np.arange(len(lists)), list(map(len, lists)))
        code = np.concatenate([*lists, np.empty(0, np.int64)])
        word, shape = (code >> 8).astype(np.uint32), (code & 0xFF).astype(np.uint32)
        same = owner[1:] == owner[:-1]
        shape[1:][same & (code[1:] == code[:-1])] = _SHAPES - 1
        pair = (word[:-1] * np.uint32(40503) ^ word[1:] * np.uint32(30011)) & np.uint32(BUCKETS - 1)
        three = same[1:] & same[:-1]
        triple = ((shape[:-2] << np.uint32(10)) | (shape[1:-1] << np.uint32(5)) | shape[2:]) & np.uint32(BUCKETS - 1)
        return (np.concatenate([owner, owner[1:][same], owner[2:][three]]),
                np.concatenate([word, pair[same], BUCKETS + triple[three]]).astype(np.int64))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(text, good)``; n-grams of all texts and of the good ones, one row a bucket and task."""
    features, raw, target = Features(), np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for batch in batches:
        good = np.array([bool(g) for g in batch.column(1).to_pylist()], bool)
        owner, bucket = features.of(batch.column(0).to_pylist())
        raw += np.bincount(bucket, minlength=2 * BUCKETS)
        if good.any():
            target += np.bincount(bucket[good[owner]], minlength=2 * BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])


def _chosen(labels: DataFrame, limit: int) -> DataFrame:
    """``(__id, quality)`` of at most ``limit`` labelled ids, those of the lowest hash; of several labels the lowest counts."""
    rows = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit).collect()
    return labels.sparkSession.createDataFrame([(int(r[0]), int(r[1])) for r in rows], "__id bigint, quality int")


def _marked(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """``(doc_id, text, quality)``; quality is null but for at most ``limit`` labelled rows, which are broadcast."""
    few = _chosen(labels, limit)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), string("text").alias("text"))
    return rows.join(F.broadcast(few), F.col("doc_id") == F.col("__id"), "left").drop("__id")


def fit_ratio(docs: DataFrame, labels: DataFrame, limit: int = FIT_ROWS) -> np.ndarray:
    """Logarithm of target over raw probability per bucket; zeros if no text is labelled good."""
    bounded_batches(docs.sparkSession)
    rows = _marked(docs, labels, limit).select("text", (F.col("quality") == 1).alias("good"))
    sums = rows.mapInArrow(_count, "bucket bigint, raw double, target double").groupBy("bucket").agg(F.sum("raw"), F.sum("target"))
    raw, target = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for bucket, r, t in sums.collect():
        raw[bucket], target[bucket] = r, t
    if not target.any():
        return np.zeros(2 * BUCKETS)
    out = []
    for part in (slice(0, BUCKETS), slice(BUCKETS, None)):
        p, q = target[part] + SMOOTHING, raw[part] + SMOOTHING
        out.append(np.log(p / p.sum()) - np.log(q / q.sum()))
    return np.concatenate(out)


class Weigher:
    """Log importance weights and Gumbel keys of texts."""

    def __init__(self, ratio: np.ndarray, seed: int):
        self.ratio, self.seed, self.features = ratio, seed, Features()

    def weights(self, texts: list[str]) -> np.ndarray:
        owner, bucket = self.features.of(texts)
        return np.bincount(owner, self.ratio[bucket], minlength=len(texts)).astype(np.float64)  # integers if there is no n-gram

    def keys(self, texts: list[str], ids: list) -> tuple[np.ndarray, np.ndarray]:
        """Weights, and keys with noise that depends on the id, the text and the seed only."""
        weight = self.weights(texts)
        draws = [xxhash.xxh64_intdigest(f"{i}|{t}".encode("utf-8", "surrogatepass"), self.seed) >> 11 for i, t in zip(ids, texts, strict=True)]
        uniform = (np.array(draws, np.float64) + 0.5) / 2.0 ** 53
        return weight, weight - np.log(-np.log(uniform))


def _weighed(docs: DataFrame, ratio, seed: int) -> DataFrame:
    """``(doc_id, quality, log_weight, key)`` from ``(doc_id, text, quality)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher = Weigher(ratio.value, seed)
        for batch in batches:
            weight, key = weigher.keys(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(weight), pa.array(key)],
                                             ["doc_id", "quality", "log_weight", "key"])
    return docs.mapInArrow(run, "doc_id bigint, quality int, log_weight double, key double")


def cut_of(good: np.ndarray, bad: np.ndarray) -> float:
    """The log weight that best parts labelled good from bad texts, of those that lose at most ``LOST_GOOD`` of the good."""
    if not len(good):
        return -np.inf
    highest = np.quantile(good, LOST_GOOD, method="lower")
    places = np.unique(np.concatenate([good[good <= highest], bad[bad <= highest], [highest]]))
    right = [(bad < p).mean() + (good >= p).mean() if len(bad) else (good >= p).mean() for p in places]
    best = int(np.argmax(right))
    below = max([x for x in (*good[good < places[best]], *bad[bad < places[best]])], default=places[best] - 2.0)
    return float((places[best] + below) / 2)


def kth_largest(rows: DataFrame, key: str, k: int) -> float:
    """The k-th largest value, by counts in ever narrower bins; equal values cannot be parted and stay together."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    above = 0  # values known to be larger than ``high``
    while low < high:
        width = (high - low) / BINS
        inside = rows.where((F.col(key) >= low) & (F.col(key) <= high))
        place = F.least(F.floor((F.col(key) - low) / width), F.lit(BINS - 1))
        bins = sorted(((r[0], r[1], r[2], r[3]) for r in inside.groupBy(place).agg(
            F.count(F.lit(1)), F.min(key), F.max(key)).collect()), reverse=True)
        for _, n, least, most in bins:
            if above + n >= k:
                break
            above += n
        if (least, most) == (low, high):
            break
        low, high = least, most
    return low


def _threshold(rows: DataFrame, weight: str, key: str, known: list) -> float:
    """The key that keeps as many rows as have the weight of a good text."""
    cut = cut_of(np.array([r[1] for r in known if r[0] == 1]), np.array([r[1] for r in known if r[0] != 1]))
    k = rows.where(F.col(weight) >= cut).count()
    return kth_largest(rows, key, k) if k else float("inf")


def resample(docs: DataFrame, labels: DataFrame, seed: int = 17, limit: int = FIT_ROWS) -> DataFrame:
    """``(doc_id, log_weight, key)`` of the documents drawn.

    Null and empty texts have weight one: they compete by noise alone. Rows that
    repeat in id and text share their noise, so they are drawn or left together, as
    are other ties at the threshold. Without labels no text is better than another
    and all are drawn. Only doc_id and text of the documents are read.
    """
    spark = docs.sparkSession
    ratio = spark.sparkContext.broadcast(fit_ratio(docs, labels, limit))
    bounded_batches(spark)
    weighed = set_down(_weighed(_marked(docs, labels, limit), ratio, seed))
    known = weighed.where("quality is not null").select("quality", "log_weight").collect()
    threshold = _threshold(weighed, "log_weight", "key", known)
    return weighed.where(F.col("key") >= threshold).select("doc_id", "log_weight", "key")


def keep_drawn(docs: DataFrame, labels: DataFrame, seed: int = 17, limit: int = FIT_ROWS) -> DataFrame:
    """The documents drawn, with all their columns, as ``resample`` draws them.

    The documents are written once with their keys to the shared folder, and read
    from there when the threshold is known.
    """
    spark, names = docs.sparkSession, docs.columns
    ratio = spark.sparkContext.broadcast(fit_ratio(docs, labels, limit))
    bounded_batches(spark)
    text, ident = names.index("text"), names.index("doc_id")
    hidden = docs.toDF(*[f"__{i}" for i in range(len(names))])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in hidden.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher = Weigher(ratio.value, seed)
        for batch in batches:
            weight, key = weigher.keys([t or "" for t in batch.column(text).to_pylist()], batch.column(ident).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(weight), pa.array(key)],
                                             [*batch.schema.names, "__weight", "__key"])

    folder = scratch_folder(spark, "weighed")
    hidden.mapInArrow(run, f"{fields}, __weight double, __key double").write.parquet(folder)
    weighed = spark.read.parquet(folder)
    chosen = _chosen(labels, limit)
    known = weighed.select(F.col(f"__{ident}").cast("bigint").alias("__id"), "__weight").join(F.broadcast(chosen), "__id")
    threshold = _threshold(weighed, "__weight", "__key", known.select("quality", "__weight").collect())
    return weighed.where(F.col("__key") >= threshold).drop("__weight", "__key").toDF(*names)
