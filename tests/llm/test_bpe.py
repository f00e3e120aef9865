"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from plumbline.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load_vocabulary(PATH)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


ALPHABET = ["a", "the", " ", "\n", "\t", "\r\n", "é", "ß", "日本", "😀", "!!", "12", "²", "½", "\xa0", "\x1c", "\x85", "×", "ɏ", "'s", "'ll", "_", "кот", "́"]


def test_same_ids_as_the_library(vocabulary, library):
    random.seed(1)
    encoder = bpe.TextEncoder(vocabulary, PATTERN)
    texts = ["".join(random.choices(ALPHABET, k=random.randint(0, 50))) for _ in range(1500)] + ["", "a" * 5000, " " * 777, "<|endoftext|>"]
    for text, ids in zip(texts, encoder.ids_of(texts), strict=True):
        assert ids == library.encode_ordinary(text), text


def test_pieces_of_any_bytes(vocabulary):
    random.seed(2)
    encoder, library = bpe.PrefixEncoder(vocabulary), tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    pieces = sorted(bytes(random.choices(b"aabcdethin \xc3\xa9\xff", k=random.randint(1, 60))) for _ in range(1500))
    for piece, ids in zip(pieces, encoder.encode_sorted(pieces), strict=True):
        assert ids == library._core_bpe.encode_single_piece(piece)


def test_appends_and_edits_equal_encoding_anew(vocabulary):
    random.seed(3)
    encoder = bpe.PrefixEncoder(vocabulary)
    for _ in range(200):
        text = bytes(random.choices(b"abcdefgh  thein", k=random.randint(0, 300)))
        table = bpe.PrefixTable(encoder, text)
        i = random.randint(0, len(text))
        j = random.randint(i, len(text))
        new = bytes(random.choices(b"then ", k=random.randint(0, 9)))
        table.edit(i, j, new)
        table.append(b"xthe")
        want = text[:i] + new + text[j:] + b"xthe"
        assert table.piece == want
        assert table.last == encoder.last_tokens(want)
        assert bpe.decode(table.tokens(), vocabulary.bytes_of) == want


def test_documents(spark, make_docs, library):
    rows = [(1, "Hello the world"), (2, None), (3, ""), (1, "Hello the world"), (None, "été 日本 " * 3000), (5, "x" * 20_000)]
    docs = make_docs(rows)
    got = bpe.encode_documents(docs, PATH, PATTERN, ["doc_id", "lang"]).collect()
    assert len(got) == len(rows)
    want = {}
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        want[i] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256((text or "").encode()).hexdigest(), ids)
    for r in got:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.token_ids) == want[r.doc_id]
    assert bpe.encode_documents(docs.limit(0), PATH, PATTERN, ["doc_id"]).count() == 0
