"""Language identification by interpolated Kneser-Ney character models.

Each language has a model of the characters of its words, order ``ORDER``, from all
training rows. The n-grams are counted, discounted and interpolated in Spark. Models of
up to ``MODEL_BYTES`` are broadcast: their probabilities and backoff weights lie in
sorted arrays of 64-bit n-gram hashes, one column per language, so that one search
serves all languages. Larger ones stay in Spark: the distinct words are scored by
joining their n-grams with the tables, and the texts by joining their words. A text
goes to the language of the lowest cross-entropy per character; confidence and
rejection are calibrated on training rows kept out of the counts.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, join_with_heavy_keys, set_down, string

ORDER = 4
#: Bytes up to which the tables of all languages are collected and broadcast; beyond, texts are scored by joins.
MODEL_BYTES = 64 << 20
#: Probability of a character before any n-gram is known, and the least one.
FLOOR, LEAST = 1.0 / 1000, 1e-12
#: Longer runs of letters are scored in pieces of this size.
WORD_LETTERS = 64
#: Words a Python worker remembers or counts before it starts anew.
WORDS_HELD = 200_000
#: Training rows kept for calibration: at most so many in all, alike for each language, and at most one in so many of a language.
CALIBRATION_ROWS, CALIBRATION_SHARE = 4000, 50
#: Standard deviations above its language's usual cross-entropy at which a text is rejected.
REJECT_SIGMA = 6.0

_LETTERS = re.compile(r"[^\W\d_]{1,%d}" % WORD_LETTERS)
#: Vowel signs and accents that are characters of their own belong to the word; texts without any take the plain form.
_MARKED = regex.compile(r"\p{L}[\p{L}\p{M}\u200c\u200d]{0,%d}" % (WORD_LETTERS - 1))
_MARKS = frozenset(chr(c) for c in range(0x300, 0x1F000) if unicodedata.category(chr(c))[0] == "M")
_HIGH = re.compile("[\u0300-\U0010ffff]")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- counting

def find_words(text: str) -> list[str]:
    """Runs of letters, with the marks that follow a letter."""
    plain = text.isascii() or not _HIGH.search(text) or _MARKS.isdisjoint(text)
    return (_LETTERS if plain else _MARKED).findall(text)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def out():
        rows = [(lang, word, n) for lang, words in held.items() for word, n in words.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                                           pa.array([r[2] for r in rows], pa.int64())], ["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, Counter()).update(find_words(text.lower()))
        if sum(map(len, held.values())) > WORDS_HELD:
            yield out()
    yield out()


def word_counts(rows: DataFrame) -> DataFrame:
    """``(lang, word, n)`` over all ``rows(lang, text)``."""
    counted = rows.select("lang", string("text").alias("text")).mapInArrow(_count_words, "lang string, word string, n bigint")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _words(text: str) -> list[str]:
    """The words of a text; none where it has no letter at all."""
    words = find_words(text.lower())
    return words if any(x.isalpha() or any(c.isalpha() for c in x) for x in words) else []


# ---------------------------------------------------------------- the models

def _top_grams(order: int) -> Column:
    """The n-grams that end at each character of ``p`` but the first, as long as order and word allow."""
    return F.explode(F.expr(f"transform(sequence(2, length(p)), i -> substring(p, greatest(1, i - {order} + 1), least(i, {order})))"))


def _levels(words: DataFrame, order: int) -> dict[int, DataFrame]:
    """Per length ``(lang, gram, c)``: counts at the top and at a word's start, else numbers of different left neighbours."""
    grams = words.withColumn("p", F.concat(F.lit(" "), "word", F.lit(" "))).select("lang", "n", _top_grams(order).alias("gram"))
    top = set_down(grams.groupBy("lang", "gram").agg(F.sum("n").alias("c")))
    levels = {order: top.where(F.length("gram") == order)}
    for k in range(order - 1, 0, -1):
        seen = levels[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count(F.lit(1)).alias("c"))
        levels[k] = set_down(seen.unionByName(top.where(F.length("gram") == k)))
    return levels


def _interpolated(level: DataFrame, k: int) -> DataFrame:
    """``(k, kind, lang, gram, value)``: discounted probabilities of grams, and weights of what follows a context."""
    repeats = level.groupBy("lang").agg(F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice"))
    discount = F.when(F.col("once") > 0, F.col("once") / (F.col("once") + 2 * F.col("twice"))).otherwise(F.lit(0.5))
    discount = F.least(F.greatest(discount, F.lit(0.1)), F.lit(0.95))
    rows = level.join(F.broadcast(repeats.select("lang", discount.alias("d"))), "lang").withColumn(
        "context", F.substring("gram", 1, k - 1) if k > 1 else F.lit(""))
    contexts = rows.groupBy("lang", "context", "d").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"))
    p = rows.drop("d").join(contexts, ["lang", "context"]).select(
        F.lit(k).alias("k"), F.lit("p").alias("kind"), "lang", "gram", (F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total")).alias("value"))
    weight = contexts.select(F.lit(k).alias("k"), F.lit("w").alias("kind"), "lang", F.col("context").alias("gram"),
                             (F.col("d") * F.col("kinds") / F.col("total")).alias("value"))
    return p.unionByName(weight)


def _hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """For every position the hash of the ``k`` characters that end there."""
    h, power = np.zeros(len(codes), np.uint64), np.uint64(1)
    for back in range(k):
        h[back:] += codes[:len(codes) - back] * power
        power = power * _FACTOR
    return _slot(h)


def _slot(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h ^ (h >> np.uint64(32))).view(np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            grams = batch.column(3).to_pylist()
            out = np.empty(len(grams), np.int64)
            lengths = np.array(list(map(len, grams)), np.int64)
            for k in np.unique(lengths):
                at = np.flatnonzero(lengths == k)
                if k == 0:
                    out[at] = 0
                    continue
                codes = _codes("".join(grams[i] for i in at))
                out[at] = _hashes(codes, int(k))[k - 1::k]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(out), batch.column(4)],
                                             ["k", "kind", "column", "slot", "value"])


def fit(rows: DataFrame, order: int = ORDER) -> dict:
    """Languages and tables from all ``rows(lang, text)``; rows without a language are left out."""
    bounded_batches(rows.sparkSession)
    words = set_down(word_counts(rows.where("lang is not null")))
    levels = _levels(words, order)
    parts = None
    for k in range(1, order + 1):
        part = _interpolated(levels[k], k)
        parts = part if parts is None else parts.unionByName(part)
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    column = F.array_position(F.array(*[F.lit(lang) for lang in langs]), F.col("lang")) - 1 if langs else F.lit(0)
    held = set_down(parts.select("k", "kind", column.cast("int").alias("column"), "gram", F.col("value").cast("float").alias("value")).repartition("gram"))
    model = {"langs": langs, "order": order, "sharpness": 20.0, "limits": {}}
    if held.count() * (8 + 4 * len(langs)) > MODEL_BYTES:
        return model | {"held": held}
    slotted = set_down(held.mapInArrow(_slots, "k int, kind string, column int, slot bigint, value float"))
    tables = {}
    for k in range(1, order + 1):
        for kind in ("p", "w"):  # one table at a time, so that the driver holds plain numbers of one only besides the model
            part = slotted.where((F.col("k") == k) & (F.col("kind") == kind)).select("slot", "column", "value").toPandas()
            if not len(part):
                continue
            slots, row = np.unique(part["slot"].to_numpy(np.int64), return_inverse=True)
            values = np.full((len(slots) + 1, len(langs)), 0.0 if kind == "p" else 1.0, np.float32)
            values[row, part["column"].to_numpy()] = part["value"]
            tables[k, kind] = (slots, values)
    return model | {"tables": tables}


# ---------------------------------------------------------------- scoring

class Scorer:
    """Log-probabilities of words under every language, remembered by word."""

    def __init__(self, model: dict):
        self.model, self.langs, self.order = model, model["langs"], model["order"]
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.langs)))

    def _look(self, k: int, kind: str, slots: np.ndarray) -> np.ndarray:
        keys, values = self.model["tables"][k, kind]
        if not len(keys):
            return np.broadcast_to(values[-1], (len(slots), len(self.langs)))
        at = np.minimum(np.searchsorted(keys, slots), len(keys) - 1)
        return values[np.where(keys[at] == slots, at, len(keys))]

    def _score(self, words: list[str]) -> np.ndarray:
        """Sum of log2 probabilities of the characters of each word and of its end."""
        codes = _codes("".join(f" {w} " for w in words))
        sizes = np.array(list(map(len, words)), np.int64) + 2
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        back = np.arange(len(codes)) - np.repeat(starts, sizes)  # characters before, within the word
        use = np.flatnonzero(back > 0)
        back = back[use]
        p = np.full((len(use), len(self.langs)), FLOOR)
        weight = self._look(1, "w", np.zeros(1, np.int64))[0]
        hashed = {k: _hashes(codes, k) for k in range(1, self.order + 1)}
        for k in range(1, self.order + 1):
            if (k, "p") not in self.model["tables"]:
                continue
            on = slice(None) if k <= 2 else np.flatnonzero(back >= k - 1)
            at = use[on]
            if k > 1:
                weight = self._look(k, "w", hashed[k - 1][at - 1])
            p[on] = self._look(k, "p", hashed[k][at]) + weight * p[on]
        logs = np.log2(np.maximum(p, LEAST))
        return np.add.reduceat(logs, np.r_[0, np.cumsum(sizes - 1)[:-1]], axis=0)

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Bits per character of each text under each language; NaN where a text has no letter."""
        split = [_words(t) for t in texts]
        new = {w for words in split for w in words}.difference(self.rows)
        if new:
            if len(self.rows) + len(new) > WORDS_HELD:
                self.rows.clear()
                new = {w for words in split for w in words}
            new = list(new)
            with np.errstate(over="ignore"):
                scores = np.concatenate([self._score(new[i:i + 20_000]) for i in range(0, len(new), 20_000)])
            first = len(self.rows)
            while first + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[first:first + len(new)] = scores
            self.rows.update(zip(new, range(first, first + len(new)), strict=True))
        out, get = np.full((len(texts), len(self.langs)), np.nan), self.rows.__getitem__
        for i, words in enumerate(split):
            if words:
                out[i] = -self.table[list(map(get, words))].sum(axis=0) / (sum(map(len, words)) + len(words))
        return out


def _by_language(model: dict, k: int, kind: str) -> DataFrame:
    """``(gram, value)`` of one table, with an array of the languages' values."""
    default = F.lit(0.0 if kind == "p" else 1.0)
    values = [F.coalesce(F.max(F.when(F.col("column") == i, F.col("value"))).cast("double"), default) for i in range(len(model["langs"]))]
    return model["held"].where((F.col("k") == k) & (F.col("kind") == kind)).groupBy("gram").agg(F.array(*values).alias("value"))


def _chances(wanted: DataFrame, model: dict) -> DataFrame:
    """``(gram, logs)``: log2 of the interpolated probabilities of distinct ``wanted(gram)``, one for each language.

    Lengths are worked off upwards, each from the next shorter one; an n-gram meets at
    most as many others at a join as the alphabet has characters.
    """
    order, each = model["order"], range(len(model["langs"]))
    needed = {order: wanted.where(F.length("gram") == order)}
    for k in range(order - 1, 0, -1):
        shorter = needed[k + 1].select(F.substring("gram", 2, k).alias("gram"))
        needed[k] = set_down(shorter.unionByName(wanted.where(F.length("gram") == k)).distinct())
    below, out = wanted.sparkSession.createDataFrame([("", [FLOOR] * len(each))], "rest string, below array<double>"), None
    for k in range(1, order + 1):
        parts = needed[k].select("gram", F.substring("gram", 1, k - 1).alias("context"), F.substring("gram", 2, k - 1).alias("rest"))
        joined = parts.join(_by_language(model, k, "p").withColumnRenamed("value", "own"), "gram", "left").join(
            _by_language(model, k, "w").select(F.col("gram").alias("context"), F.col("value").alias("weight")), "context", "left").join(below, "rest")
        chance = [F.coalesce(F.col("own")[i], F.lit(0.0)) + F.coalesce(F.col("weight")[i], F.lit(1.0)) * F.col("below")[i] for i in each]
        level = set_down(joined.select("gram", F.array(*chance).alias("chance")))
        below = level.select(F.col("gram").alias("rest"), F.col("chance").alias("below"))
        out = level if out is None else out.unionByName(level)
    return out.select("gram", F.transform("chance", lambda p: F.log2(F.greatest(p, F.lit(LEAST)))).alias("logs"))


def _joined_scores(rows: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """``rows`` with the ``logs`` of their ``key``; keys of many rows are joined by a broadcast of bounded size."""
    weights = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    return join_with_heavy_keys(rows, set_down(scores.join(weights, key)), key, "__rows", how="inner")


def _word_logs(words: DataFrame, model: dict) -> DataFrame:
    """``(word, logs)`` of distinct ``words(word)``: sums of log2 probabilities of the characters and of the word's end."""
    grams = set_down(words.withColumn("p", F.concat(F.lit(" "), "word", F.lit(" "))).select("word", _top_grams(model["order"]).alias("gram")))
    met = _joined_scores(grams, _chances(grams.select("gram").distinct(), model), "gram")
    return met.groupBy("word").agg(F.array(*[F.sum(F.col("logs")[i]) for i in range(len(model["langs"]))]).alias("logs"))


def _text_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = Counter(_words(text))
            yield pa.RecordBatch.from_arrays([pa.array([key] * len(words), pa.string()), pa.array(list(words), pa.string()),
                                              pa.array(list(words.values()), pa.int64())], ["key", "word", "n"])


def _text_entropies(texts: DataFrame, model: dict) -> DataFrame:
    """``(key, entropy)`` of ``texts(key, text)`` with a letter: bits per character under each language, by joins."""
    met = set_down(texts.mapInArrow(_text_words, "key string, word string, n bigint").distinct())
    scored = _joined_scores(met, _word_logs(met.select("word").distinct(), model), "word")
    size = F.sum(F.col("n") * (F.length("word") + 1))
    return scored.groupBy("key").agg(F.array(*[-F.sum(F.col("n") * F.col("logs")[i]) / size for i in range(len(model["langs"]))]).alias("entropy"))


def _with_entropies(rows: DataFrame, model: dict) -> DataFrame:
    """``rows`` with ``entropy`` instead of their last column, the text; null where it has no letter."""
    names = rows.columns
    hidden = rows.toDF(*[f"__{i}" for i in range(len(names) - 1)], "text").withColumn("key", F.sha2("text", 256))
    entropies = _text_entropies(hidden.select("key", "text"), model)
    sizes = hidden.groupBy("key").agg(F.count(F.lit(1)).alias("__rows"))
    found = join_with_heavy_keys(hidden.drop("text"), set_down(entropies.join(sizes, "key", "right")), "key", "__rows")
    return found.select(*[F.col(f"__{i}").alias(name) for i, name in enumerate(names[:-1])], "entropy")


def _confidence(entropy: np.ndarray, sharpness: float) -> np.ndarray:
    z = np.exp(-(entropy - entropy.min(axis=1, keepdims=True)) * sharpness)
    return z / z.sum(axis=1, keepdims=True)


def _fit_confidence(model: dict, rows: DataFrame) -> dict:
    """Sharpness by likelihood and rejection limits from ``rows(lang, text, key)`` not counted in the model."""
    chosen = rows.select("lang", "key", string("text").alias("text"))
    if "held" in model:
        lowest = chosen.select("key").orderBy("key").limit(CALIBRATION_ROWS).agg(F.max("key")).first()[0]
        scored = _with_entropies(chosen.where(F.col("key") <= F.lit(lowest)), model)
    else:
        shared = rows.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = Scorer(shared.value)
            for batch in batches:
                entropy = scorer.entropies(batch.column(2).to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(entropy.tolist(), pa.list_(pa.float64()))],
                                                 ["lang", "key", "entropy"])

        scored = chosen.mapInArrow(run, "lang string, key bigint, entropy array<double>")
    sample = scored.orderBy("key").limit(CALIBRATION_ROWS).collect()
    known = [(model["langs"].index(r["lang"]), r["entropy"]) for r in sample
             if r["lang"] in model["langs"] and r["entropy"] is not None and not np.isnan(r["entropy"]).any()]
    if not known:
        return model
    truth, entropy = np.array([k for k, _ in known]), np.array([e for _, e in known])
    grid = np.geomspace(1, 200, 30)
    loss = [-np.log(np.maximum(_confidence(entropy, s)[np.arange(len(truth)), truth], 1e-9)).mean() for s in grid]
    limits = {}
    for i, lang in enumerate(model["langs"]):
        own = entropy[truth == i, i]
        if len(own) >= 5:
            limits[lang] = float(np.median(own) + REJECT_SIGMA * 1.4826 * (np.median(np.abs(own - np.median(own))) + 0.02))
    return model | {"sharpness": float(grid[int(np.argmin(loss))]), "limits": limits}


def _judged(entropy: np.ndarray, model: dict) -> list[pa.Array]:
    """Language, score, cross-entropy and rejection for every row of ``entropy``; NaN where a text has no letter."""
    langs, size = model["langs"], len(entropy)
    preds, scores, bits, rejected = ["und"] * size, np.zeros(size), [None] * size, [True] * size
    for i in np.flatnonzero(~np.isnan(entropy).any(axis=1)) if langs else ():
        best = int(np.argmin(entropy[i]))
        preds[i], bits[i] = langs[best], float(entropy[i, best])
        scores[i] = _confidence(entropy[i:i + 1], model["sharpness"])[0, best]
        rejected[i] = bits[i] > model["limits"].get(langs[best], np.inf)
    return [pa.array(preds, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64()),
            pa.array(list(map(bool, rejected)), pa.bool_())]


def predict(docs: DataFrame, model: dict, carry: list[str]) -> DataFrame:
    """``carry`` columns, ``lang_pred``, ``score``, ``cross_entropy`` (bits a character) and ``rejected``."""
    bounded_batches(docs.sparkSession)
    n, langs = len(carry), model["langs"]
    plan = docs.select(*[F.col(f"`{c}`") for c in carry], string("text").alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema.fields[:n])
    result = f"{fields}, lang_pred string, score double, cross_entropy double, rejected boolean"
    names = ["lang_pred", "score", "cross_entropy", "rejected"]
    if "held" in model:
        small, none = {x: model[x] for x in ("langs", "sharpness", "limits")}, [np.nan] * len(langs)

        def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                entropy = np.array([none if e is None else e for e in batch.column(n).to_pylist()], np.float64).reshape(batch.num_rows, len(langs))
                yield pa.RecordBatch.from_arrays([*batch.columns[:n], *_judged(entropy, small)], [*batch.schema.names[:n], *names])

        return _with_entropies(plan, model).mapInArrow(judge, result)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            entropy = scorer.entropies(batch.column(n).to_pylist()) if langs else np.zeros((batch.num_rows, 0))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *_judged(entropy, scorer.model)], [*batch.schema.names[:n], *names])

    return plan.mapInArrow(run, result)


def _kept_aside(train: DataFrame) -> list[int]:
    """Keys of the rows to calibrate on: of each language those of lowest key, none that occurs twice.

    Keys are hashes, so the lowest lie below a cut that the number of rows tells; only what lies below
    is collected.
    """
    rows = {r["lang"]: r["count"] for r in train.groupBy("lang").count().collect()}
    wanted = {lang: min(CALIBRATION_ROWS // len(rows), n // CALIBRATION_SHARE) for lang, n in rows.items()}
    cuts = [(lang, int(2.0 ** 63 * min(1.0, 2 * wanted[lang] / n)) - 2 ** 62 - 2 ** 62) for lang, n in rows.items() if wanted[lang]]
    if not cuts:
        return []
    low = F.broadcast(train.sparkSession.createDataFrame(cuts, "lang string, cut bigint"))
    found: dict[str, list] = {}
    once = train.join(low, "lang").where(F.col("key") < F.col("cut")).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("lang").alias("lang"))
    for r in once.where("n = 1").orderBy("key").collect():
        found.setdefault(r["lang"], []).append(r["key"])
    return [key for lang, keys in found.items() for key in keys[:wanted[lang]]]


def identify(docs: DataFrame, held_out: Column) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, cross_entropy, rejected)`` for every document.

    Learns from the text and non-null ``lang`` of rows that are not held out: all of them are counted
    but the at most ``CALIBRATION_ROWS`` kept for calibration. Predicts from the text alone. A null text and one without a letter are ``und`` with score 0,
    as is every text when there is nothing to learn from. ``rejected`` marks a text
    unlike all learned languages; its ``lang_pred`` is still the nearest. Ties go to
    the first language by name. Repeated rows give repeated rows; other columns are
    not read.
    """
    held = F.coalesce(held_out, F.lit(False))
    key = F.xxhash64("doc_id", "text")
    train = docs.where(~held).where("lang is not null").select("lang", "text", key.alias("key"))
    aside = F.broadcast(docs.sparkSession.createDataFrame([(k,) for k in _kept_aside(train)], "key bigint"))
    model = fit(train.join(aside, "key", "left_anti"))
    if model["langs"]:
        model = _fit_confidence(model, train.join(aside, "key", "left_semi"))
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), model, ["doc_id", "held_out"])
