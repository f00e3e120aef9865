"""Byte-level BPE by prefix dynamic programming.

Every prefix of a piece has one encoding, and so one last token. Storing that token
per prefix makes the encoding a walk backwards over the table, lets bytes be appended
without touching what is there, and confines the work after an edit to the bytes
around it. A token may end a prefix if it is compatible with the last token of the
prefix before it; compatibility of two tokens is decided by undoing their merges.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import bounded_batches, string

#: Pieces whose ids a Python worker remembers; beyond that it starts anew.
CACHE_PIECES = 800_000
#: Texts of a batch; the more are encoded at once, the more the new pieces share.
BATCH_TEXTS = 1024
NEVER = 1 << 40


class Vocabulary:
    """Ranks of byte strings, with the last merge that makes each token.

    A token that BPE never makes out of its own bytes has no place inside a longer
    piece; it stands only where a piece is exactly that token.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.inner: dict[bytes, int] = {}
        self.long: dict[bytes, set[int]] = {}  # last three bytes -> lengths of the tokens that end with them
        for token, rank in sorted(ranks.items(), key=lambda item: (len(item[0]), item[1])):
            if len(token) > 1:
                halves = self._last_merge(token)
                if halves is None:
                    continue
                self.halves[rank] = halves
                self.merged[halves] = rank
            self.inner[token] = rank
            if len(token) > 2:
                self.long.setdefault(token[-3:], set()).add(len(token))
        self.long = {end: tuple(sorted(sizes, reverse=True)) for end, sizes in self.long.items()}

    @classmethod
    def from_parts(cls, parts: dict) -> Vocabulary:
        """The same from its attributes, which is what a broadcast carries."""
        made = cls.__new__(cls)
        made.__dict__.update(parts)
        return made

    def _last_merge(self, token: bytes) -> tuple[int, int] | None:
        parts = [token[i:i + 1] for i in range(len(token))]
        if any(p not in self.ranks for p in parts):
            return None
        while len(parts) > 2:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], NEVER), i) for i in range(len(parts) - 1))
            if rank == NEVER:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]


def load_vocabulary(path: str) -> Vocabulary:
    """A rank file: one base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(line.split()[0]): int(line.split()[1]) for line in lines if line.strip()})


class PrefixEncoder:
    """Encodes pieces; remembers which pairs of tokens may stand side by side."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._fits: dict[tuple[int, int], bool] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE over the bytes of both tokens ends in just these two.

        The merges on both sides of the seam are undone, latest first. A pair that
        appears across the seam would have been merged if its rank comes before the
        last undone merge; at equal rank the leftmost goes first, so the seam wins
        against its right side only.
        """
        known = self._fits.get((left, right))
        if known is not None:
            return known
        key, voc, before, fits = (left, right), self.vocabulary, NEVER, True
        while True:
            if voc.merged.get((left, right), NEVER) < before:
                fits = False
                break
            a, b = voc.halves.get(left), voc.halves.get(right)
            if a is None and b is None:
                break
            if b is None or (a is not None and left > right):
                before, left = left, a[1]
            else:
                before, right = right + 1, b[0]
        if len(self._fits) > 2_000_000:
            self._fits.clear()
        self._fits[key] = fits
        return fits

    def last_tokens(self, piece: bytes, last: list[int] | None = None, stop=None) -> list[int]:
        """For each prefix its last token; ``last`` holds those of a shorter prefix and is extended.

        ``stop(last)`` may end the work early.
        """
        last = [] if last is None else last
        inner, long, fits, known = self.vocabulary.inner.get, self.vocabulary.long.get, self.compatible, self._fits.get
        for end in range(len(last) + 1, len(piece) + 1):
            token = None
            for size in long(piece[end - 3:end], ()) if end > 2 else ():
                if size > end:
                    continue
                token = inner(piece[end - size:end])
                if token is not None:
                    if size == end:
                        break
                    before = last[end - size - 1]
                    fit = known((before, token))
                    if fits(before, token) if fit is None else fit:
                        break
                    token = None
            if token is None and end > 1:
                token = inner(piece[end - 2:end])
                if token is not None and end > 2 and not fits(last[end - 3], token):
                    token = None
            if token is None:
                token = inner(piece[end - 1:end])
                if token is None:
                    raise ValueError("the vocabulary lacks a byte")
            last.append(token)
            if stop is not None and stop(last):
                break
        return last

    def tokens_of(self, piece: bytes, last: list[int]) -> list[int]:
        out, end, bytes_of = [], len(piece), self.vocabulary.bytes_of
        while end:
            out.append(last[end - 1])
            end -= len(bytes_of[out[-1]])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        return next(self.encode_sorted([piece]))

    def encode_sorted(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """Encodings of sorted pieces; what a piece shares with the one before it is not computed again."""
        before, last = b"", []
        for piece in pieces:
            whole = self.vocabulary.ranks.get(piece)
            if whole is not None:
                yield [whole]
                continue
            common, most = 0, min(len(before), len(piece))
            while common < most and before[common] == piece[common]:
                common += 1
            del last[common:]
            before = piece
            yield self.tokens_of(piece, self.last_tokens(piece, last))


class PrefixTable:
    """One piece under change: appends and edits reuse the stored last tokens."""

    def __init__(self, encoder: PrefixEncoder, piece: bytes = b""):
        self.encoder, self.piece, self.last = encoder, piece, encoder.last_tokens(piece)
        self.longest = max(map(len, encoder.vocabulary.inner))

    def append(self, more: bytes) -> None:
        self.piece += more
        self.encoder.last_tokens(self.piece, self.last)

    def edit(self, start: int, end: int, replacement: bytes) -> None:
        """Replace ``piece[start:end]``; work ends once the table agrees with the old one over a longest token."""
        old, tail, shift = self.last, len(self.piece) - end, len(replacement) - (end - start)
        piece = self.piece[:start] + replacement + self.piece[end:]
        first, run = len(piece) - tail, 0

        def settled(last: list[int]) -> bool:
            nonlocal run
            at = len(last)
            run = run + 1 if at > first and last[-1] == old[at - shift - 1] else 0
            return run >= self.longest

        last = self.encoder.last_tokens(piece, old[:start], settled)
        self.last, self.piece = last + old[len(last) - shift:], piece

    def tokens(self) -> list[int]:
        return self.encoder.tokens_of(self.piece, self.last)


#: Letters of the fast path; beyond ASCII all of À to ɏ but the signs of multiplication and division.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"


def _latin_pattern(pattern: str) -> str:
    """The pattern for texts of ASCII and Latin letters, with plain classes for the Unicode ones."""
    plain = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\t-\r 0-9{_LATIN}]")
    plain = plain.replace(r"\p{L}", f"[{_LATIN}]").replace(r"\p{N}", "[0-9]")
    return plain.replace(r"\s", r"[\t-\r ]").replace(r"\S", r"[^\t-\r ]")


class TextEncoder:
    """Splits texts by the pattern and encodes each match separately, remembering matches."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        self.encoder, self._find = PrefixEncoder(vocabulary), regex.compile(pattern).findall
        self._find_latin = re.compile(_latin_pattern(pattern)).findall
        self._is_latin = re.compile(rf"[\x00-\x1b -\x7f{_LATIN}]*").fullmatch
        self.known: dict[str, tuple[int, ...]] = {}

    def find(self, text: str) -> list[str]:
        return self._find_latin(text) if self._is_latin(text) else self._find(text)

    def ids_of(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text; what is new in all of them is encoded at once."""
        known = self.known
        if len(known) > CACHE_PIECES:
            known.clear()
        split = list(map(self.find, texts))
        found = [list(map(known.get, pieces)) for pieces in split]
        gaps = [None in got for got in found]
        new = {p for pieces, got, gap in zip(split, found, gaps, strict=True) if gap
               for p, ids in zip(pieces, got, strict=True) if ids is None}
        order = sorted((piece.encode("utf-8"), piece) for piece in new)
        for (_, piece), ids in zip(order, self.encoder.encode_sorted([p for p, _ in order]), strict=True):
            known[piece] = tuple(ids)
        for pieces, got, gap in zip(split, found, gaps, strict=True):
            yield list(chain.from_iterable(map(known.__getitem__, pieces) if gap else got))

    def ids(self, text: str) -> list[int]:
        return next(self.ids_of([text]))


def decode(ids: list[int], bytes_of: dict[int, bytes]) -> bytes:
    return b"".join(map(bytes_of.__getitem__, ids))


def encode_documents(docs: DataFrame, vocabulary_path: str, pattern: str, carry: list[str],
                     with_ids: bool = True, text: str = "text") -> DataFrame:
    """``carry`` columns, ``n_tokens``, the digests of the ids and of the decoded bytes, and ``token_ids``.

    A null text counts as empty; an empty text has no tokens. Repeated rows give
    repeated rows. Other columns are left out, so their names cannot clash. The
    vocabulary is broadcast: its size is that of the rank file, whatever the corpus.
    """
    spark = docs.sparkSession
    bounded_batches(spark, BATCH_TEXTS)
    shared = spark.sparkContext.broadcast(vars(load_vocabulary(vocabulary_path)))
    n = len(carry)
    plan = docs.select(*[F.col(f"`{c}`") for c in carry], string(text).alias("__text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema.fields[:n])
    schema = f"{fields}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary.from_parts(shared.value)
        encoder, bytes_of = TextEncoder(vocabulary, pattern), vocabulary.bytes_of
        decimal = {rank: str(rank) for rank in bytes_of}
        gc.disable()  # millions of small tuples without cycles
        for batch in batches:
            counts, digests, decoded, lists = [], [], [], []
            for ids in encoder.ids_of(batch.column(n).to_pylist()):
                counts.append(len(ids))
                digests.append(hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(decode(ids, bytes_of)).hexdigest())
                if with_ids:
                    lists.append(ids)
            columns = [*batch.columns[:n], pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                       pa.array(decoded, pa.string())]
            names = [*batch.schema.names[:n], "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        gc.enable()

    return plan.mapInArrow(run, schema)
