"""Kneser-Ney models against a plain computation, held-out accuracy and odd rows."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import language


def held(column):
    return F.crc32(column.cast("string").cast("binary")) % 3 == 1


WORDS = {"en": "the this that with from and have there where which thing other".split(),
         "de": "der die das und nicht mit einer sich auch schon über größe".split(),
         "xx": "слово дело время человек город день рука дорога вода место".split()}


def corpus(n=300):
    random.seed(3)
    return [(i, " ".join(random.choices(WORDS[lang], k=25)), lang) for i in range(n) for lang in [list(WORDS)[i % 3]]]


def brute_model(words, order):
    """log2 probability of a padded word under interpolated Kneser-Ney, by the definition."""
    top, levels = Counter(), {}
    for w, n in words.items():
        p = f" {w} "
        for i in range(1, len(p)):
            top[p[max(0, i - order + 1):i + 1]] += n
    levels[order] = Counter({g: c for g, c in top.items() if len(g) == order})
    for k in range(order - 1, 0, -1):
        level = Counter(g[1:] for g in levels[k + 1])
        level.update({g: c for g, c in top.items() if len(g) == k})
        levels[k] = level
    tables = {}
    for k, level in levels.items():
        once, twice = sum(c == 1 for c in level.values()), sum(c == 2 for c in level.values())
        d = min(max(once / (once + 2 * twice) if once else 0.5, 0.1), 0.95)
        total, kinds = defaultdict(float), Counter()
        for g, c in level.items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        tables[k] = (level, d, total, kinds)

    def log2(word):
        padded, sums = f" {word} ", 0.0
        for i in range(1, len(padded)):
            p = 1 / 1000
            for k in range(1, min(order, i + 1) + 1):
                level, d, total, kinds = tables[k]
                gram = padded[i - k + 1:i + 1]
                context = gram[:-1]
                if context in total:
                    p = max(level.get(gram, 0) - d, 0) / total[context] + d * kinds[context] / total[context] * p
            sums += math.log2(max(p, 1e-12))
        return sums

    return log2


def test_models_are_kneser_ney(spark):
    rows = spark.createDataFrame([(lang, t) for _, t, lang in corpus(90)], "lang string, text string")
    model = language.fit(rows)
    scorer = language.Scorer(model)
    assert model["langs"] == sorted(WORDS)
    probes = ["the", "thing", "größe", "zzz", "слово", "unknownword"]
    with np.errstate(over="ignore"):
        got = scorer._score(probes)
    for column, lang in enumerate(model["langs"]):
        words = Counter(w for _, t, own in corpus(90) if own == lang for w in t.split())
        log2 = brute_model(words, language.ORDER)
        for row, word in enumerate(probes):
            assert got[row, column] == pytest.approx(log2(word), rel=1e-4)


def test_documents(spark, make_docs, monkeypatch):
    monkeypatch.setattr(language, "CALIBRATION_SHARE", 5)
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 !? ²", "en"), (903, "the thing " * 40_000, None), (904, "x" * 5000, None),
           (None, "der die das und", None), (3, *corpus()[3][1:])]
    rows = corpus() + odd
    got = language.identify(make_docs(rows), held(F.col("doc_id"))).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(0 <= r.score <= 1 for r in got)
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (900, 901, 902))
    assert by_id[903].lang_pred == "en" and by_id[None].lang_pred == "de" and by_id[904].rejected
    truth = {i: lang for i, _, lang in corpus()}
    assert all(by_id[i].lang_pred == lang for i, lang in truth.items() if by_id[i].held_out)
    assert sum(r.rejected for r in got if r.doc_id in truth) < 10


def test_held_out_languages_are_not_read(spark, make_docs):
    rows = corpus()
    docs = make_docs(rows)
    changed = docs.withColumn("lang", F.when(held(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    a, b = (sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in language.identify(d, held(F.col("doc_id"))).collect()) for d in (docs, changed))
    assert a == b


def test_all_but_the_calibration_rows_are_counted(spark, make_docs, monkeypatch):
    """Every training row is counted or calibrated on, copies of a row and a language of one row are counted."""
    monkeypatch.setattr(language, "CALIBRATION_ROWS", 20)
    monkeypatch.setattr(language, "CALIBRATION_SHARE", 5)
    rows = corpus() + [(i, f"solo{i % 3}", "zz") for i in range(4)] + [(5000, "copied", "en")] * 50
    docs, seen = make_docs(rows), {}
    real = {"fit": language.fit, "_fit_confidence": language._fit_confidence}
    monkeypatch.setattr(language, "fit", lambda rows: seen.update(counted=rows) or real["fit"](rows))
    monkeypatch.setattr(language, "_fit_confidence", lambda model, rows: seen.update(aside=rows) or real["_fit_confidence"](model, rows))
    language.identify(docs, held(F.col("doc_id")))
    train = docs.where(~held(F.col("doc_id")))
    parts = {k: sorted((r.lang, r.text) for r in v.select("lang", "text").collect()) for k, v in seen.items()}
    assert sorted(parts["counted"] + parts["aside"]) == sorted((r.lang, r.text) for r in train.select("lang", "text").collect())
    per_lang = Counter(lang for lang, _ in parts["aside"])
    assert set(per_lang) == set(WORDS) and max(per_lang.values()) == 5 and ("en", "copied") not in parts["aside"]


def test_marks_belong_to_words():
    assert language.find_words("हिन्दी भाषा 12 e\u0301te\u0301, la") == ["हिन्दी", "भाषा", "e\u0301te\u0301", "la"]
    assert language.find_words("größe x1y") == ["größe", "x", "y"]


def test_nothing_to_learn_from(spark, make_docs):
    docs = make_docs([(1, "the thing", None), (2, None, None)])
    assert [r.lang_pred for r in language.identify(docs, held(F.col("doc_id"))).collect()] == ["und", "und"]
    assert language.identify(docs.limit(0), held(F.col("doc_id"))).count() == 0


def many_words(n):
    random.seed(5)
    return ["".join(chr(0x4E00 + random.randrange(3000)) for _ in range(random.randint(2, 4))) for _ in range(n)]


def test_grams_never_share_a_slot(spark):
    """Thousands of different n-grams keep their own probabilities, and unseen ones have none."""
    words = many_words(12_000)
    model = language.fit(spark.createDataFrame([("zh", " ".join(words[:9000])), ("en", "the thing other")], "lang string, text string"))
    log2 = brute_model(Counter(words[:9000]), language.ORDER)
    probes = words[:2000] + words[9000:]
    with np.errstate(over="ignore"):
        got = language.Scorer(model)._score(probes)[:, model["langs"].index("zh")]
    assert got == pytest.approx([log2(w) for w in probes], rel=1e-4)


def test_large_models_are_joined(spark, make_docs, monkeypatch):
    monkeypatch.setattr(language, "CALIBRATION_SHARE", 5)
    copies = [(2000, corpus()[1][1], None)] * 40
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 !? ²", "en"), (903, "the thing " * 4000, None), (904, "x" * 5000, None), (None, "der die das", None)]
    docs = make_docs(corpus() + odd + copies + [(3000 + i, w, "zh") for i, w in enumerate(many_words(300))])

    def rows():
        return sorted((str(r.doc_id), r.held_out, r.lang_pred, round(r.score, 6), r.cross_entropy and round(r.cross_entropy, 6), r.rejected)
                      for r in language.identify(docs, held(F.col("doc_id"))).collect())

    want = rows()
    monkeypatch.setattr(language, "MODEL_BYTES", 0)
    monkeypatch.setattr(language.Scorer, "__init__", None)  # nothing is broadcast
    assert rows() == want
