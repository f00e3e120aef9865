"""Minimax shards against a search over all groups."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from plumbline.llm import sharding


def smallest(sizes, shards):
    def feasible(capacity):
        used, filled = 1, 0
        for size in sizes:
            if size > capacity:
                return False
            if filled + size > capacity:
                used, filled = used + 1, 0
            filled += size
        return used <= shards
    low, high = 0, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if feasible(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize(("n", "shards", "crowded"), [(1, 1, False), (5, 24, False), (30, 3, True), (500, 24, False), (3000, 24, True), (800, 7, False)])
def test_capacity_is_the_smallest(spark, n, shards, crowded):
    random.seed(n)
    places = {((random.getrandbits(6) << 58) | i) - (1 << 63) if crowded else random.getrandbits(64) - (1 << 63) for i in range(n)}
    rows = [(p, random.randint(8, 3000) if random.random() < 0.9 else random.randint(8, 40_000)) for p in places]
    capacity, starts = sharding.minimax_cuts(spark.createDataFrame(rows, "place bigint, size bigint"), shards)
    order = sorted((p % (1 << 64), s) for p, s in rows)
    filled = Counter()
    for place, size in order:
        filled[sum(place >= s for s in starts)] += size
    assert capacity == smallest([s for _, s in order], shards) == max(filled.values())
    assert len(starts) == shards - 1


def check(rows, got, shards):
    assert len(got) == len(rows)
    by_shard, by_text, texts = defaultdict(list), defaultdict(set), defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    for r in got:
        text = texts[r.doc_id][0]
        assert r["size"] == len(text.encode()) + 8 and r.text_crc32 == zlib.crc32(text.encode())
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        by_shard[r.shard].append(r.slot)
        by_text[text].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert all(len(s) == 1 for s in by_text.values())


def test_documents(spark, make_docs):
    random.seed(2)
    rows = [(i, "x" * random.randint(0, 300) + str(i)) for i in range(400)] + [(1000, None), (1001, ""), (1002, "é" * 9000)]
    rows += [(2000 + i, "the hot text " * 10) for i in range(300)] + [(7, rows[7][1])] * 3
    check(rows, sharding.shard_documents(make_docs(rows), 24).collect(), 24)
    assert sharding.shard_documents(make_docs(rows).limit(0), 24).count() == 0
    check([(1, "one")], sharding.shard_documents(make_docs([(1, "one")]), 24).collect(), 24)


def test_heavy_texts_are_numbered_in_parts(spark, make_docs, monkeypatch):
    monkeypatch.setattr(sharding, "RUN_ROWS", 40)
    rows = [(i, "hot") for i in range(500)] + [(1000 + i, f"text {i}") for i in range(500)]
    check(rows, sharding.shard_documents(make_docs(rows), 5).collect(), 5)


def test_even_bytes(spark, make_docs):
    random.seed(5)
    rows = [(i, str(i) * random.randint(1, 100)) for i in range(4000)]
    sizes = Counter()
    for r in sharding.shard_documents(make_docs(rows), 24).collect():
        sizes[r.shard] += r["size"]
    assert len(sizes) == 24 and max(sizes.values()) <= 1.02 * sum(sizes.values()) / 24
