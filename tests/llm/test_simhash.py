"""SimHash groups against comparing all pairs."""

import random
import re

import numpy as np
import xxhash

from plumbline.llm import simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(nodes, most):
    """Smallest id per node by all pairs."""
    low = dict(nodes)
    parent = {i: i for i, _ in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in nodes:
        for j, b in nodes:
            if i < j and (a ^ b).bit_count() <= most:
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in low}


def test_every_word_is_covered():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 32, 300, dtype=np.uint64).astype(np.uint32)
    where, anchor = simhash.anchors(words)
    distance = np.bitwise_count(words[where] ^ anchor)
    assert distance.max() <= 2
    assert len(set(zip(where.tolist(), anchor.tolist(), strict=True))) == len(where)
    nearest = np.full(len(words), 9)
    np.minimum.at(nearest, where, distance)
    assert nearest.max() <= 1  # covering radius
    near = words ^ np.uint32((1 << 5) | (1 << 31))  # any two words two bits apart share an anchor
    for x, y in zip(words, near, strict=True):
        one, other = (set(simhash.anchors(np.array([v]))[1].tolist()) for v in (x, y))
        assert one & other


def test_links_equal_all_pairs(spark):
    random.seed(4)
    prints = set()
    for _ in range(60):
        base = random.getrandbits(64)
        prints.add(base)
        for _ in range(random.randint(0, 30)):
            base ^= sum(1 << b for b in random.sample(range(64), random.randint(1, 6)))
            prints.add(base)
    nodes = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in nodes]
    pairs = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp bigint"), 4).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in pairs)
    index = {s: i for i, s in enumerate(signed)}
    want = groups(list(enumerate(nodes)), 4)
    parent = list(range(len(nodes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in pairs:
        x, y = find(index[r.a]), find(index[r.b])
        parent[max(x, y)] = min(x, y)
    assert {i: find(i) for i in range(len(nodes))} == want


def odd_rows():
    random.seed(6)
    base = " ".join(random.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=400))
    rows = [(i, base + f" tail{i % 7}") for i in range(40)] + [(100, None), (101, ""), (102, " \t\n"), (103, "one two"), (104, "One  TWO"),
            (105, "é É ñ"), (106, "word " * 30_000)]
    return rows + [(200 + i, " ".join(random.choices("abcdefghij", k=50))) for i in range(30)]


def test_crowded_anchors_are_compared_in_blocks(spark, monkeypatch):
    """A third of all fingerprints lie around one word: its anchors are cut, and no link is lost."""
    monkeypatch.setattr(simhash, "ANCHOR_ROWS", 9)
    random.seed(6)
    base = random.getrandbits(64)
    prints = {base ^ sum(1 << b for b in random.sample(range(64), random.randint(0, 3))) for _ in range(150)}
    prints |= {random.getrandbits(64) for _ in range(300)}
    rows = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    found = simhash.links(spark.createDataFrame(rows, "fp bigint"), 4).collect()
    nodes = sorted((int(np.int64(v).view(np.uint64)), int(np.int64(v).view(np.uint64))) for (v,) in rows)
    parent = {i: i for i, _ in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in found:
        a, b = (int(np.int64(v).view(np.uint64)) for v in (r["a"], r["b"]))
        assert (a ^ b).bit_count() <= 4
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert {i: find(i) for i, _ in nodes} == groups(nodes, 4)


def test_documents(spark, make_docs):
    rows = odd_rows()
    got = simhash.near_duplicates(make_docs(rows + [rows[0]])).withColumn("hex", simhash.hex_of("fp")).collect()
    assert len(got) == len(rows) + 1
    prints = {i: brute_fingerprint(t) for i, t in rows}
    want = groups(list(prints.items()), 4)
    for r in got:
        assert int(r.hex, 16) == prints[r.id] and len(r.hex) == 16
        assert r.component_id == want[r.id]
    assert simhash.near_duplicates(make_docs(rows).limit(0)).count() == 0


def test_one_of_each_stays(spark, make_docs):
    rows = odd_rows()
    prints = {i: brute_fingerprint(t) for i, t in rows}
    want = sorted(set(groups(list(prints.items()), 4).values()))
    docs = make_docs(rows)
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == want
    again = simhash.keep_one_of_each(make_docs(rows + rows[:5] + [(None, "alone with no id"), (None, "alone with no id")]))
    assert sorted(r.doc_id for r in again.collect() if r.doc_id is not None) == want
    assert sum(r.doc_id is None for r in again.collect()) == 1
    assert simhash.keep_one_of_each(docs.limit(0)).count() == 0
