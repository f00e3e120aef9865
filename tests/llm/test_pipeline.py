"""The corpus pipeline against its stages by brute force, and its entry in the checks."""

import hashlib

import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from plumbline.llm import bpe, queries, simhash, surrogates
from test_decontamination import words
from test_simhash import groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage returns, written and read as the pipeline does."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(docs)
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
        out.append(docs)
    return out


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns(stages):
    assert all(s.columns == stages[0].columns and s.dtypes == stages[0].dtypes for s in stages[:-1])


def test_quality_keeps_the_good(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = by_id(stages[0]), by_id(stages[1])
    good = [i for i in before if labels.get(i) == 1]
    bad = [i for i in before if labels.get(i) == 0]
    assert sum(i in after for i in good) >= 0.98 * len(good)
    assert sum(i in after for i in bad) <= 0.3 * len(bad)


def test_near_duplicates(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    prints = [(i, simhash.fingerprint(r.text.encode())) for i, r in before.items()]
    assert set(after) == set(groups(prints, 4).values())
    assert all(after[i] == before[i] for i in after)


def test_decontamination(spark, stages):
    windows = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def clean(text):
        w = words(text)
        return not any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    before, after = by_id(stages[2]), by_id(stages[3])
    assert set(after) == {i for i, r in before.items() if clean(r.text)}


def test_private_data(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(after) == set(before)
    finder = surrogates.Finder()
    for i, r in before.items():
        entities = [e[3] for e in finder.entities(r.text)]
        assert not any(e in after[i].text for e in entities)
        assert after[i].n_chars == len(after[i].text) and (entities or after[i] == r)


def test_tokens(stages):
    ranks = bpe.load_vocabulary(queries.VOCABULARY).ranks
    library = tiktoken.Encoding("own", pat_str=queries.public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before, after = by_id(stages[4]), by_id(stages[5])
    assert set(after) == set(before)
    for i, r in before.items():
        ids = library.encode_ordinary(r.text)
        assert after[i].token_ids == ids and after[i].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, stages[-1].collect()))


def test_empty_and_odd_documents(spark, tmp_path):
    """Every stage takes nulls, empty texts, repeated rows and an empty table."""
    folder = str(tmp_path)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "mail a@b.org " * 5000, "en", "s", 9), (3, None, None, "s", 0)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, folder)
            assert got.count() <= docs.count()
            if name != "byte_bpe":
                assert got.dtypes == docs.dtypes


def test_entry_has_all_of_them():
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [n for n, _ in corpus_pipeline.STAGES] and set(queries.SQL) <= set(names)
