import pytest

#: Extra columns whose names the operators use inside.
EXTRA = ["id", "fp", "n", "key", "place", "shard", "slot", "size", "window", "hit", "items", "score", "body", "attempt", "made",
         "host", "path", "entropy", "root", "component_id", "n_words", "held_out", "quality", "toxic", "__id", "__text", "token_ids"]


@pytest.fixture
def make_docs(spark):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, lang)`` rows, with columns of clashing names."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) + tuple(["x"] * len(EXTRA)) for r in rows]
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint" + "".join(f", `{c}` string" for c in EXTRA)
        return spark.createDataFrame(full, schema)
    return make
