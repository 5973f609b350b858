"""Whole-corpus encoding with a public byte-level BPE vocabulary.

The vocabulary is serialised directly as a sentencepiece BPE model: each token's bytes
are mapped to printable characters, its score is the negative rank (so the lowest rank
merges first), normalisation is the identity. Texts are cut into pre-tokens, each
pre-token is encoded by the model; decoding maps ids back to bytes.

Defined cases: null and empty texts give an empty list; any other text, however long,
gives the ids of the whole text; strings that look like special tokens are ordinary
text. Repeated rows are encoded each for itself; other columns pass through.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from marrow.llm.vocab import BYTE_BPE_50K, PATTERN, byte_chars, read_ranks
from marrow.session import once, spread

#: Pre-tokens kept per Python worker; the store is emptied when full, which only costs time.
CACHE_ENTRIES = 300_000


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _blob(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def serialise_model(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose piece ids are the vocabulary's ids."""
    chars = byte_chars()
    by_id = {rank: token for token, rank in ranks.items()}
    size = max(by_id) + 1
    pieces = []
    for i in range(size):
        if i in by_id:
            text, kind = "".join(chars[b] for b in by_id[i]), 1
        else:
            text, kind = f"⁇{i}", 3
        body = _blob(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(i)) + _number(3, kind)
        pieces.append(_blob(1, body))
    pieces.append(_blob(1, _blob(1, "⁇unk".encode()) + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2)))
    none = (1 << 64) - 1  # -1 as a varint
    trainer = _number(3, 2) + _number(4, size + 1) + _number(40, size) + _number(41, none) + _number(42, none) + _number(43, none) + _blob(45, "⁇unk".encode())
    normalizer = _blob(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _blob(2, trainer) + _blob(3, normalizer)


class PieceEncoder:
    """Encodes texts with one model; made once per Python worker."""

    def __init__(self, model: bytes):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = regex.compile(PATTERN).findall
        self.table = dict(enumerate(byte_chars()))
        self.known: dict[str, list[int]] = {}

    def encode_many(self, texts: list[str | None]) -> list[list[int]]:
        cut = [self.find(t) if t else [] for t in texts]
        known = self.known
        new = list({p for pieces in cut for p in pieces if p not in known})
        if len(known) + len(new) > CACHE_ENTRIES:
            known.clear()
            new = list({p for pieces in cut for p in pieces})
        mapped = [p.encode().decode("latin-1").translate(self.table) for p in new]
        known.update(zip(new, self.model.encode(mapped, num_threads=1), strict=True))
        return [[i for p in pieces for i in known[p]] for pieces in cut]


def decode(ids: list[int], ranks: dict[bytes, int]) -> str:
    """Text of ids, by the inverse of the vocabulary."""
    by_id = {rank: token for token, rank in ranks.items()}
    return b"".join(by_id[i] for i in ids).decode()


def encode(df: DataFrame, text: str = "text", out: str = "ids", path: str = BYTE_BPE_50K) -> DataFrame:
    """``df`` with ``out``, the token ids of ``text``; no shuffle."""
    model = df.sparkSession.sparkContext.broadcast(serialise_model(read_ranks(path)))

    @F.pandas_udf(T.ArrayType(T.IntegerType(), False))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = once(model, PieceEncoder)
        for batch in batches:
            found: list = []
            texts = [t if isinstance(t, str) else None for t in batch]
            for k in range(0, len(texts), 64):  # few long texts at a time keep the piece lists small
                found += encoder.encode_many(texts[k : k + 64])
            yield pd.Series(found, dtype=object)

    return spread(df).withColumn(out, ids(F.col(f"`{text}`")))
