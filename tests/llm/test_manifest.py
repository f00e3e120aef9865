import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from plumbline.llm import manifest as M

def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row[0], "src0", row[2], len(row[1] or ""), text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(bottom):
    out = [bottom]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    order = {n: sorted(trees[n], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for n in names}
    built = {n: levels([leaf(r, r[1]) for r in order[n]]) for n in names}
    top = levels([built[n][-1][0] for n in names])
    out = []
    for number, n in enumerate(names):
        for i, r in enumerate(order[n]):
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            folded = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]) if changed else r[1])
            proof = []
            for tree, place in ((built[n], i), (top, number)):
                for level in tree[:-1]:
                    run, at = level[place // 8 * 8:place // 8 * 8 + 8], place % 8
                    proof += run[:at] + run[at + 1:]
                    folded, place = digest(*run[:at], folded, *run[at + 1:]), place // 8
            out.append((r[0], built[n][0][i], built[n][-1][0], top[-1][0], digest(*proof), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bits", [10, 2])
def test_rows_are_those_of_lists(spark, make_docs, monkeypatch, bits):
    monkeypatch.setattr(M, "BLOCK_BITS", bits)
    rows = [(i, f"Text {i} É", "en") for i in range(0, 1400, 7)] + [(i, "low" if i % 2 else "UP", "de") for i in range(65)]
    rows += [(i, "T" * i, f"l{i:02}") for i in range(12)] + [(5, None, None), (6, "", None), (None, "X", "en"), (9, "X" * 50_000, "fr"), (10, "ñ", "É")]
    rows += [(77, "Copy", "en")] * 20 + [(77, "Other", "en")]
    got = M.manifest(make_docs(rows), tampered())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("rows", [[(1, "A", "en")], [(1, "A", "en"), (2, "b", "en")], [(1, "A", "en"), (2, "b", None)], [(1, "a", None)]])
def test_small_trees(spark, make_docs, rows):
    assert sorted(map(tuple, M.manifest(make_docs(rows), tampered()).collect()), key=repr) == brute(rows)


def test_empty_table_and_settings(spark, make_docs):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    assert M.manifest(make_docs([]), tampered()).count() == 0
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before
