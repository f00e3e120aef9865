"""Decontamination against a search of every window at every place."""

import hashlib
import random
import re

from plumbline.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).update([] if item is None else [str(item)])
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def fixture():
    random.seed(8)
    vocabulary = "the of and Über straße naïve ab cd ef x1 2".split()
    items = [(i, " ".join(random.choices(vocabulary, k=n))) for i, n in enumerate([12, 10, 30, 3, 1, 10, 25, 0])]
    items += [(10, None), (11, items[0][1]), (None, "no id here"), (12, "!!"), (2, items[2][1])]
    docs = []
    for i in range(80):
        body = random.choices(vocabulary, k=random.randint(0, 60))
        if i % 3 == 0:
            inner = items[random.randrange(3)][1].split()
            body[5:5] = inner[random.randint(0, 3):]
        docs.append((i, random.choice([" ", " - ", "!\n"]).join(body).upper() if i % 5 == 0 else "  ".join(body)))
    return docs + [(100, None), (101, ""), (104, "said no ID here twice"), (105, "The of no id here " + items[2][1]), (102, "?"), (None, items[2][1]), (7, docs[7][1]), (103, ("the of " * 40_000) + items[2][1])], items


def test_documents(spark, make_docs, monkeypatch):
    docs, items = fixture()
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, window string")
    want = brute(docs, items)
    frame = make_docs(docs)
    assert sorted(map(tuple, decontamination.contamination(frame, bench).collect()), key=str) == want
    kept = decontamination.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    clean = sorted(str(w[0]) for w in want if not w[5])
    assert sorted(str(r.doc_id) for r in kept.collect()) == clean
    monkeypatch.setattr(decontamination, "BLOCK_WINDOWS", 15)  # several blocks
    assert sorted(map(tuple, decontamination.contamination(frame, bench).collect()), key=str) == want
    assert sorted(str(r.doc_id) for r in decontamination.drop_contaminated(frame, bench).collect()) == clean


def test_empty_tables(spark, make_docs):
    docs, items = fixture()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    assert decontamination.contamination(make_docs(docs).limit(0), bench).count() == 0
    rows = decontamination.contamination(make_docs(docs), bench.limit(0)).collect()
    assert len(rows) == len(docs) and not any(r.contaminated for r in rows)
    assert decontamination.drop_contaminated(make_docs(docs), bench.limit(0)).count() == len(docs)


def test_shift_tables_skip():
    search = decontamination.WuManber(4, {(1, 2, 3, 4): ["a"], (2, 3, 4, 5): ["b"]})
    assert search.shift[(3, 4)] == 0 and search.shift[(1, 2)] == 2
    assert [s for s, _ in search.find([9, 1, 2, 3, 4, 5, -1, 2, 3, 4, 5])] == [1, 2, 7]
