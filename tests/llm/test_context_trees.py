import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plumbline.llm import context_trees as C


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def held_rows():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1



def words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()


class Brute:
    """Context-tree weighting by recursion over dictionaries."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.kids, self.memo = depth, defaultdict(lambda: [0, 0]), defaultdict(set), {}
        for text in texts:
            for context, node, bit in self.steps(text):
                for d in range(depth + 1):
                    self.counts[context[depth - d:], node][bit] += 1
                    if d < depth:
                        self.kids[context[depth - d:], node].add(context[depth - d - 1:])

    def steps(self, text):
        s = b"\n" * self.depth + b" ".join(words(text)) + b"\n"
        for i in range(self.depth, len(s)):
            for k in range(8):
                yield s[i - self.depth:i], 1 << k | s[i] >> 8 - k, s[i] >> 7 - k & 1

    def weighted(self, context, node):
        if (context, node) not in self.memo:
            a, b = self.counts[context, node]
            own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
            children = sum(self.weighted(k, node)[0] for k in self.kids[context, node])
            top = max(own, children)
            both = own if len(context) == self.depth else top + math.log(0.5 * math.exp(own - top) + 0.5 * math.exp(children - top))
            self.memo[context, node] = both, own, children
        return self.memo[context, node]

    def probability(self, context, node, bit, d=0):
        here = context[self.depth - d:]
        seen = self.counts[here, node]
        p = (seen[bit] + 0.5) / (sum(seen) + 1)
        if d == self.depth:
            return p
        _, own, children = self.weighted(here, node)
        share = 1 / (1 + math.exp(min(children - own, 700)))
        return share * p + (1 - share) * self.probability(context, node, bit, d + 1)

    def score(self, text):
        return sum(math.log10(self.probability(*step)) for step in self.steps(text))


def sample():
    rng = random.Random(3)
    syllables = ["the", "Re", "on", "é", "ing", "ß", "an\t", " ", "\n", "x1", "日本", ","]
    texts = ["".join(rng.choice(syllables) for _ in range(rng.randrange(60))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (102, " \t\n"), (103, texts[5]), (103, texts[5]), (None, "the"),
                                                    (104, "a" * 3000 + " " + "ab " * 500), (105, "\x00\x1f\x7f")]
    return rows


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_scores_are_those_of_a_recursion(spark, make_docs, depth):
    rows = sample()
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r) for r in C.score_documents(make_docs(rows), held_rows(), depth).collect())
    train = [t for i, t in rows if not held(i)]
    brute, counts = Brute(train, depth), Counter(w for t in train for w in [*words(t), b"\n"])
    total, distinct = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    for (i, text), (_, r) in zip(sorted(rows, key=lambda x: -1 if x[0] is None else x[0]), got, strict=True):
        tokens = [*words(text), b"\n"]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held(i), len(tokens), sum(w in counts for w in tokens), total)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], brute.score(text), rel_tol=1e-6)


def test_rare_codes_and_words_are_joined(spark, make_docs):
    docs = make_docs(sample())
    whole = sorted(map(tuple, C.score_documents(docs, held_rows(), 4).fillna(-1).collect()))
    joined = sorted(map(tuple, C.score_documents(docs, held_rows(), 4, held_grams=30, held_tokens=3).fillna(-1).collect()))
    for a, b in zip(whole, joined, strict=True):
        assert a[:5] == b[:5] and all(math.isclose(x, y, rel_tol=1e-6) for x, y in zip(a[5:], b[5:], strict=True))


def test_stems_in_many_chunks(spark, make_docs, monkeypatch):
    docs = make_docs(sample())
    whole = sorted(map(tuple, C.score_documents(docs, held_rows(), 4).fillna(-1).collect()))
    for name, value in (("CHUNK", 7), ("SUMMED_GRAMS", 10), ("SUMMED_TOKENS", 5), ("PIECE_BYTES", 40)):
        monkeypatch.setattr(C, name, value)
    assert sorted(map(tuple, C.score_documents(docs, held_rows(), 4).fillna(-1).collect())) == whole


def test_nothing_learned_and_nothing_to_score(spark, make_docs):
    rows = C.score_documents(make_docs([(1, "ab c"), (2, None)]), F.lit(True)).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in rows} == {(0, 0)}
    assert math.isclose(next(r["score"] for r in rows if r["doc_id"] == 1), -5 * 8 * math.log10(2), rel_tol=1e-6)
    assert C.score_documents(make_docs([]), held_rows()).count() == 0
    with pytest.raises(ValueError):
        C.score_documents(make_docs([]), held_rows(), 7)


def test_counts_of_a_task_take_half_the_room():
    codes = np.array([3, 5, 1 << 50])
    for counts, width in (([1, 2, 3], 4), ([1, 2, 1 << 40], 8)):
        row = C._packed_row(0, codes, np.array(counts), np.array(counts), [], [], []).to_pylist()[0]
        assert len(row["n"]) == len(row["train"]) == 3 * width
        for got, want in zip(C._unpacked(row["codes"], row["train"], row["n"]), (codes, counts, counts), strict=True):
            assert got.tolist() == list(want)
    parts = [(codes, np.full(3, 3 << 30, np.uint32), np.full(3, 3 << 30, np.uint32))] * 2  # sums of several tasks are wider
    assert C._added(parts)[1].tolist() == [6 << 30] * 3


def test_texts_are_scored_a_few_at_a_time(spark, make_docs, monkeypatch):
    docs = make_docs(sample())
    whole = sorted(map(tuple, C.score_documents(docs, held_rows(), 4).fillna(-1).collect()))
    monkeypatch.setattr(C, "SCORED_BYTES", 50)
    assert sorted(map(tuple, C.score_documents(docs, held_rows(), 4).fillna(-1).collect())) == whole
    texts = pa.array([b"a" * 30, b"b" * 20, b"c", b"d" * 90, b"e"])
    assert list(C._pieces(texts, C.SCORED_BYTES)) == [(0, 2), (2, 1), (3, 1), (4, 1)]
