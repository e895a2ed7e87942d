"""Token ids of every text by a public byte-level BPE vocabulary.

A sentencepiece BPE model is serialised straight from the vocabulary: each token's bytes become a piece of byte-mapped
letters, its score is the negative rank, its place the rank, and normalisation is the identity. Merging the best scored
pair first is then merging the lowest rank first. Texts are split into pre-tokens, every different pre-token of a task is
encoded once by the model, and the ids of a batch are put together as arrays. Decoding maps back.
"""

from __future__ import annotations

import base64
import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary lies on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Different pre-tokens that a task keeps; beyond that it starts anew.
KEPT = 400_000
# The white space of Unicode, and the contractions that the vocabulary's pattern keeps together.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


@lru_cache
def pattern() -> re.Pattern:
    """The vocabulary's pre-token pattern with the classes of letters and numbers written out, which the plain engine matches several times faster."""
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))

    def of(kind: str) -> str:
        return "".join(re.escape(m[0][0]) + (("-" + re.escape(m[0][-1])) if len(m[0]) > 1 else "") for m in regex.finditer(rf"\p{{{kind}}}+", every))

    letters, numbers = of("L"), of("N")
    return re.compile(f"{CONTRACTIONS}| ?[{letters}]+| ?[{numbers}]+| ?[^{SPACES}{letters}{numbers}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")


@lru_cache
def byte_letters() -> str:
    """The letter that stands for each byte: itself where it is printable and no space, else the next free one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return "".join(chr(b) if b in plain else chr(next(spare)) for b in range(256))


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def model_bytes(ranks: list[bytes]) -> bytes:
    """A serialised sentencepiece model: the tokens by rank, and a piece for unknown letters (which can't occur) behind them."""
    table = byte_letters()
    normal, unknown, bpe = 1, 2, 2
    out = bytearray()
    for rank, token in enumerate(ranks):
        out += _field(1, _field(1, token.decode("latin-1").translate(table).encode()) + _field(2, -float(rank)) + _field(3, normal))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))
    none = (1 << 64) - 1  # -1
    trainer = _field(3, bpe) + _field(4, len(ranks) + 1) + _field(40, len(ranks)) + _field(41, none) + _field(42, none) + _field(43, none)
    identity = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, identity))


@lru_cache
def vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """The tokens' bytes by rank. Raises ValueError if the ranks aren't 0, 1, 2 and so on."""
    pairs = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, Path(path).read_bytes().splitlines()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError(f"{path} has gaps in its ranks")
    return [t for _, t in pairs]


class _Seen(dict):
    """Numbers pre-tokens in the order in which they are first met."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, token: str) -> int:
        self[token] = at = len(self)
        self.fresh.append(token)
        return at


class Encoder:
    """Encodes batches of texts to flat arrays of ids, or counts them."""

    def __init__(self, path: str = VOCABULARY) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(vocabulary(path)))
        self._find = pattern().findall
        self._clear()

    def _clear(self) -> None:
        self.seen = _Seen()
        self.ids = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)

    def _indices(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The pre-tokens of all texts as numbers, and how many each text has."""
        if len(self.seen) > KEPT:
            self._clear()
        number = self.seen.__getitem__
        parts, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            if text:
                found = self._find(text)
                counts[i] = len(found)
                parts.append(np.fromiter(map(number, found), np.int64, len(found)))
        if self.seen.fresh:
            table = byte_letters()
            new = self.model.encode([t.encode("utf-8").decode("latin-1").translate(table) for t in self.seen.fresh], num_threads=1)
            self.seen.fresh = []
            self.sizes = np.r_[self.sizes, np.fromiter(map(len, new), np.int64, len(new))]
            self.ids = np.r_[self.ids, np.fromiter((i for x in new for i in x), np.int32)]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64), counts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and how many each text has; none for null and empty texts."""
        at, counts = self._indices(texts)
        size = self.sizes[at]
        begins = np.cumsum(self.sizes) - self.sizes
        shift = np.repeat(begins[at] - (np.cumsum(size) - size), size)
        return self.ids[shift + np.arange(len(shift))], self._per_text(size, counts)

    def count(self, texts: list[str | None]) -> np.ndarray:
        at, counts = self._indices(texts)
        return self._per_text(self.sizes[at], counts)

    @staticmethod
    def _per_text(size: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.r_[0, np.cumsum(size)]
        ends = np.cumsum(counts)
        return total[ends] - total[ends - counts]


def decode(ids: list[int], path: str = VOCABULARY) -> str:
    """The text of the ids; ids of no token are refused by the list."""
    tokens = vocabulary(path)
    return b"".join(tokens[i] for i in ids).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


#: Texts are taken from a batch until they have so many characters together.
BATCH_CHARS = 4_000_000


def _slices(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of a bounded length together; a longer single text is a run of its own."""
    texts = column.to_pylist()
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and size + len(text or "") > BATCH_CHARS:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text or "")
    if first < len(texts):
        yield first, texts[first:]


def encoded(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """One row for each row of the frame: doc_id and ids, the token ids of the text, without special tokens.

    The strings of special tokens are ordinary text. Null and empty texts give an empty list, never null; lone
    surrogates can't occur in a column of strings. Repeated keys give repeated rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for at, texts in _slices(batch.column(1)):
                ids, sizes = encoder.encode(texts)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), lists], names=["doc_id", "ids"])

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """doc_id, tokens: how many ids encoded() gives; 0 for null and empty texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for at, texts in _slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(texts)), pa.array(encoder.count(texts))], names=["doc_id", "tokens"])

    return df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, tokens long")
