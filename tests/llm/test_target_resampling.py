import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from plumbline.llm import target_resampling as R

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, order):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i:i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f.encode()) for f in runs]


def brute(docs, target, percent, min_words, order, buckets, seed):
    found = [(i, *features(t, order)) for i, t in docs]
    corpus, wanted = Counter(), Counter()
    for _, _, f in found:
        corpus.update(x % buckets for x in f)
    for t in target:
        wanted.update(x % buckets for x in features(t, order)[1])
    s, t = sum(corpus.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((corpus[b] + 1) * (t + buckets)))) for b in range(buckets)]
    rows = []
    for i, words, f in found:
        weight = sum(gain[x % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), words))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[:percent * len(able) // 100]
    return sorted([(*r[:4], n + 1) for n, r in enumerate(drawn)] + [(*r[:4], None) for r in able[len(drawn):]]
                  + [(*r[:4], None) for r in rows if r[4] < min_words], key=repr)


def sample():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "x1", "ñandú", "日本", "the", "of", "w" * 70, "é" * 40, "0"]
    texts = [rng.choice([" ", "\n", "--"]).join(rng.choice(words) for _ in range(rng.randrange(50))) for _ in range(80)]
    return ([(i, t) for i, t in enumerate(texts)] + [(200, None), (201, ""), (202, "\x00 \x00"), (None, texts[3] + " a" * 30), (203, "the " * 5000)]
            + [(204, "same words " * 15)] * 3), ["the of alpha", "日本 beta x1 the of", None, "", "é"]


@pytest.mark.parametrize(("percent", "min_words", "order", "buckets", "seed"), [(25, 20, 2, 10_000, 7), (60, 0, 3, 64, 1), (100, 5, 1, 7, 9)])
def test_rows_are_those_of_plain_counting(spark, make_docs, percent, min_words, order, buckets, seed):
    docs, target = sample()
    got = R.resample_towards(make_docs(docs), make_docs(list(enumerate(target))), percent, min_words, order, buckets, seed)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, target, percent, min_words, order, buckets, seed)


def test_words_forgotten_between_batches(spark, make_docs, monkeypatch):
    docs, target = sample()
    monkeypatch.setattr(R, "WORDS_HELD", 2)
    got = R.resample_towards(make_docs(docs), make_docs(list(enumerate(target))))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, target, 25, 20, 2, 10_000, 7)


def test_checksums_by_table():
    grams = R.Buckets(2, 1 << 32)
    _, owner, bucket = grams.of([b"ab cd", b"", b"E" * 100 + b" " + b"f" * 64])
    assert owner.tolist() == [0, 0, 2, 2, 0, 2]
    assert bucket.tolist() == [zlib.crc32(x) for x in (b"ab", b"cd", b"e" * 100, b"f" * 64, b"ab cd", b"e" * 100 + b" " + b"f" * 64)]


def test_empty_tables(spark, make_docs):
    assert R.resample_towards(make_docs([]), make_docs([(1, "a")])).count() == 0
    rows = R.resample_towards(make_docs([(1, "a b " * 20), (2, "c")]), make_docs([]), percent=100).collect()
    assert sorted((r["doc_id"], r["rank"]) for r in rows) == [(1, 1), (2, None)]
