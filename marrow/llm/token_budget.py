"""Token counts per document and totals per slice under an existing BPE vocabulary.

Texts are cut into chunks at single spaces and line feeds, which pre-tokens never cross.
Distinct chunks that a worker has not met before are cut into pre-tokens, and those that
are no vocabulary entry are stored as flat symbol arrays. In rounds, all adjacent symbol
pairs are joined with the sorted table of merge ranks, each piece's lowest-ranked merge is
applied wherever it occurs in the piece, and pieces without a mergeable pair leave the
loop, until none is left. Documents then add up their chunks.

One scan, no shuffle: a worker keeps the counts of at most ``REMEMBER`` chunks, so a chunk
of nearly every document is counted once per worker, and nothing that grows with the corpus
is broadcast or gathered. Only the vocabulary and its merge table (bounded by the tokenizer
file) are broadcast. Totals are aggregated map-side from the labels carried along.

Defined cases: null and empty texts have 0 tokens; labels are stripped and compared
without case, null and blank labels are 'unknown'; repeated rows are counted as they
come; an empty table gives no rows; texts of any length are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from marrow.functions.text import pystrip
from marrow.llm.vocab import BYTE_BPE_50K, PATTERN, read_ranks
from marrow.session import once, spread

#: Chunks whose counts a Python worker keeps; they are dropped when more come, which only costs time.
REMEMBER = 400_000
#: Documents whose new chunks are counted together.
TOGETHER = 256
#: How a chunk's key begins: it opens a line, or it is a pre-token already; else a space precedes it.
_OPENS, _WHOLE = "\x00", "\x01"


class Chunker:
    """Cuts a text into keys whose token counts add up to those of the text."""

    def __init__(self) -> None:
        import regex

        self.pieces = regex.compile(PATTERN).findall

    @staticmethod
    def odd(text: str) -> bool:
        """Whether white space is anything but single spaces and one or two line feeds between other signs."""
        flat = text.replace("\n\n", "\n").replace("\n", " ")
        return flat.split() != flat.split(" ") or _OPENS in text or _WHOLE in text

    def keys(self, text: str) -> list[str]:
        if self.odd(text):
            return [_WHOLE + p for p in self.pieces(text)]
        lines = text.split("\n")
        out = [w for line in lines if line for w in (_OPENS + line).split(" ")]
        if len(lines) > 1:
            out += [_WHOLE + "\n"] * (len(lines) - 1)
        return out

    def cut(self, key: str) -> list[str]:
        if key[:1] == _WHOLE:
            return [key[1:]]
        return self.pieces(key[1:] if key[:1] == _OPENS else " " + key)


def merge_table(ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of mergeable pairs (left id, right id), and the id each merges to."""
    found = {}
    for token, merged in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                found[left << 32 | right] = merged
    codes = np.fromiter(found, np.int64, len(found))
    order = np.argsort(codes)
    return codes[order], np.fromiter(found.values(), np.int64, len(found))[order]


def merged_lengths(pieces: list[bytes], byte_ids: np.ndarray, codes: np.ndarray, merged: np.ndarray) -> np.ndarray:
    """Number of symbols each piece has left when no merge applies any more."""
    lengths = np.array([len(p) for p in pieces], np.int64)
    out = lengths.copy()
    symbols = byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
    owner = np.repeat(np.arange(len(pieces)), lengths)
    none = np.iinfo(np.int64).max
    while len(symbols) > 1:
        pair = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(codes, pair), len(codes) - 1)
        rank = np.where((codes[at] == pair) & (owner[:-1] == owner[1:]), merged[at], none)
        rank = np.append(rank, none)
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(owner))))
        going = best != none
        if not going.any():
            break
        hit = going & (rank == best)
        # of overlapping equal pairs every other one merges, from the left
        place = np.arange(len(hit))
        last_miss = np.maximum.accumulate(np.where(hit, -1, place))
        hit &= (place - last_miss) % 2 == 1
        symbols = np.where(hit, best, symbols)
        stays = ~np.append(False, hit[:-1])
        keep = going & stays
        out_now = np.bincount(owner[stays], minlength=len(pieces))
        touched = np.unique(owner[going])
        out[touched] = out_now[touched]
        symbols, owner = symbols[keep], owner[keep]
    return out


class TokenCounter:
    """Counts tokens of texts under one vocabulary; made once per Python worker."""

    def __init__(self, ranks: dict[bytes, int]):
        self.vocabulary = ranks
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.codes, self.merged = merge_table(ranks)
        self.chunker = Chunker()
        self.known: dict[str, int] = {}

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; 0 for null."""
        out: list[int] = []
        for at in range(0, len(texts), TOGETHER):
            keys = [self.chunker.keys(t) if t else [] for t in texts[at : at + TOGETHER]]
            distinct = set().union(*keys)
            if len(self.known) + len(distinct) > REMEMBER:
                self.known.clear()
            self._learn([k for k in distinct if k not in self.known])
            out += [sum(map(self.known.__getitem__, k)) for k in keys]
        return out

    def _learn(self, chunks: list[str]) -> None:
        cuts = [self.chunker.cut(k) for k in chunks]
        rare = list({p for pieces in cuts for p in pieces if p.encode() not in self.vocabulary})
        sizes = dict(zip(rare, merged_lengths([p.encode() for p in rare], self.byte_ids, self.codes, self.merged).tolist(), strict=True)) if rare else {}
        self.known |= {k: sum(sizes.get(p, 1) for p in pieces) for k, pieces in zip(chunks, cuts, strict=True)}


def count_tokens(df: DataFrame, keep: list[str], text: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """The columns ``keep`` and n_tokens of each row of ``df``."""
    shared = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    docs = spread(df.select(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("text")))
    kept = docs.columns[:-1]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = once(shared, TokenCounter)
        for batch in batches:
            yield batch[kept].assign(n_tokens=counter.count([t if isinstance(t, str) else None for t in batch["text"]]))

    schema = ", ".join(f"{c} {t}" for c, t in docs.dtypes[:-1])
    return docs.mapInPandas(count, f"{schema}, n_tokens long").toDF(*keep, "n_tokens")


def label(c: Column) -> Column:
    """Comparison form of a free label; null and blank are 'unknown'."""
    plain = F.lower(pystrip(c))
    return F.when(plain.isNull() | (plain == ""), F.lit("unknown")).otherwise(plain)


def totals(df: DataFrame, by: list[str], text: str = "text", path: str = BYTE_BPE_50K) -> DataFrame:
    """Documents, tokens and the most tokens of a document per slice of ``by``."""
    slices = df.select(*[label(F.col(f"`{c}`")).alias(c) for c in by], F.col(f"`{text}`").alias("_text"))
    return (
        count_tokens(slices, by, "_text", path)
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n_tokens").cast("bigint").alias("n_tokens"), F.max("n_tokens").alias("most_tokens"))
    )
