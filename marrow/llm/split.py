"""Splitting oversized texts at natural boundaries, with overlap.

For each size specification, texts over the limit (measured in code points or UTF-8
bytes inside the JVM, before any Python) are cut by lexical-cohesion segmentation:
sentences and lines are the units, the similarity of the word counts in a sliding block
before and after each boundary is taken, and within the window that a piece may end in
the boundary with the deepest valley wins; paragraph and line ends weigh more. Without
any such boundary the cut falls at white space, and without that at the limit, never
inside a code point or between CR and LF. Each piece after the first begins exactly
``overlap_size`` before the end of its predecessor (for bytes: at the nearest code point
that keeps the shared part within it).

Defined cases: null, empty and fitting texts give no pieces; blank texts over the limit
are cut like others; repeated rows are cut each for itself; an overlap that leaves no
room for progress is an error; specifications are a small table (``MAX_SPECS`` rows).
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marrow.operators.bounded import collect_bounded
from marrow.session import spread

MAX_SPECS = 1000
#: A piece ends in the last part of its window, so that pieces stay near the limit.
WINDOW = 0.5
#: Sentences on either side of a boundary whose words are compared.
BLOCK = 4
#: Boundaries whose similarity is computed at a time.
STRETCH = 256

_BOUNDARY = re.compile(r"\r?\n[ \t]*(?:\r?\n\s*)|\r\n?|\n|(?<=[.!?;:…。！？])[\"')\]]*\s+")
_WORD = re.compile(r"\w{3,}")
PIECES = "spec_id int, {key} {type}, piece_no int, start long, stop long, size long, text string"


def valleys(units: list[list[str]]) -> np.ndarray:
    """Depth of the similarity valley at each boundary between consecutive units.

    Unit-by-unit products of word counts are summed to blocks by prefix sums, a stretch of
    ``STRETCH`` units at a time, so any number of units needs bounded memory.
    """
    n = len(units)
    scores = np.zeros(n - 1)
    for at in range(0, n - 1, STRETCH):
        first, last = max(0, at - BLOCK + 1), min(n, at + STRETCH + BLOCK)
        ids: dict[str, int] = {}
        rows, cols = [], []
        for r, unit in enumerate(units[first:last]):
            for w in unit:
                rows.append(r)
                cols.append(ids.setdefault(w, len(ids)))
        bags = np.zeros((last - first, max(1, len(ids))), np.float32)
        np.add.at(bags, (rows, cols), 1)
        total = np.zeros((last - first + 1, last - first + 1))
        total[1:, 1:] = (bags @ bags.T).cumsum(0).cumsum(1)
        k = np.arange(at, min(n - 1, at + STRETCH)) - first + 1  # boundary after unit k - 1
        lo, hi = np.maximum(k - BLOCK, 0), np.minimum(k + BLOCK, last - first)

        def block(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, total: np.ndarray = total) -> np.ndarray:
            return total[b, d] - total[a, d] - total[b, c] + total[a, c]

        size = np.sqrt(block(lo, k, lo, k) * block(k, hi, k, hi))
        scores[at : at + len(k)] = np.where(size > 0, block(lo, k, k, hi) / np.maximum(size, 1e-9), 0)
    peaks = np.stack([np.concatenate([np.full(d, -1.0), scores[: len(scores) - d]]) for d in range(min(BLOCK, len(scores) - 1) + 1)]).max(0)
    after = np.stack([np.concatenate([scores[d:], np.full(d, -1.0)]) for d in range(min(BLOCK, len(scores) - 1) + 1)]).max(0)
    return peaks + after - 2 * scores


def boundaries(text: str) -> list[tuple[int, float]]:
    """(offset, depth) of every sentence, line and paragraph end; offsets start the next unit."""
    marks = []
    for m in _BOUNDARY.finditer(text):
        gap = m.group()
        lines = gap.count("\n") or gap.count("\r")
        marks.append((m.end(), 0.6 if lines > 1 else 0.25 if lines and text[m.start() - 1 : m.start()] in ".:!?" else 0.05 if lines else 0.15))
    marks = [x for x in marks if 0 < x[0] < len(text)]
    if not marks:
        return []
    edges = [0, *(at for at, _ in marks), len(text)]
    low = text.lower()
    low = low if len(low) == len(text) else text
    depth = valleys([_WORD.findall(low, a, b) for a, b in zip(edges, edges[1:], strict=False)])
    return [(at, weight + d) for (at, weight), d in zip(marks, depth.tolist(), strict=True)]


def byte_offsets(text: str) -> list[int]:
    """Offset in UTF-8 bytes of every code point, and of the end."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    width = 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
    return [0, *np.cumsum(width).tolist()]


def cut_points(text: str, max_size: int, overlap: int, in_bytes: bool, marks: list[tuple[int, float]] | None = None) -> list[tuple[int, int]]:
    """(start, stop) code point offsets of the pieces of ``text``; one piece if it fits."""
    at = (range(len(text) + 1) if text.isascii() else byte_offsets(text)) if in_bytes else range(len(text) + 1)
    total = at[-1]
    if total <= max_size:
        return [(0, len(text))]
    if overlap * 2 > max_size or max_size < 8:
        raise ValueError("overlap_size must be at most half of max_size, and max_size at least 8")
    marks = boundaries(text) if marks is None else marks
    offsets = [m[0] for m in marks]
    pieces, start = [], 0
    while True:
        if total - at[start] <= max_size:
            pieces.append((start, len(text)))
            return pieces
        last = bisect_right(at, at[start] + max_size) - 1
        # no earlier than half the window, and past the shared part with room to spare
        first = bisect_left(at, at[start] + max(int(max_size * WINDOW), overlap + 1))
        near = range(bisect_left(offsets, first), bisect_right(offsets, last))
        if near:
            stop = offsets[max(near, key=lambda i: (marks[i][1], offsets[i]))]
        else:
            stop = last
            for i in range(last, first - 1, -1):
                if text[i - 1].isspace() and not (text[i - 1] == "\r" and text[i : i + 1] == "\n"):
                    stop = i
                    break
            else:
                if text[stop - 1 : stop + 1] == "\r\n":
                    stop -= 1
        pieces.append((start, stop))
        # the next piece shares the last ``overlap`` units, whole code points within them
        start = bisect_left(at, at[stop] - overlap) if overlap else stop


def split(df: DataFrame, specs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Ordered pieces of every row larger than a specification's ``max_size``.

    Columns: spec_id, ``key``, piece_no (from 1), start, stop (code points), size (in the
    specification's unit), text.
    """
    rules = [(r["spec_id"], r["unit"].strip().lower(), r["max_size"], r["overlap_size"] or 0) for r in collect_bounded(specs.select("spec_id", "unit", "max_size", "overlap_size"), MAX_SPECS, "the table of sizes")]
    body = F.col(f"`{text}`")
    size = {"chars": F.char_length(body), "bytes": F.octet_length(body)}
    too_large = F.lit(False)
    for unit in {u for _, u, _, _ in rules}:
        if unit not in size:
            raise ValueError(f"unknown unit {unit!r}")
        too_large = too_large | (size[unit] > min(m for _, u, m, _ in rules if u == unit))
    kind = dict(df.dtypes)[key]
    # the size test needs whole texts once; rows that fit every limit never leave the JVM
    large = spread(df.select(*dict.fromkeys([key, text]))).select(F.col(f"`{key}`").alias("key"), body.alias("text")).where(body.isNotNull() & too_large)

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, value in zip(batch["key"], batch["text"], strict=True):
                rows = []
                marks = boundaries(value)
                for spec, unit, limit, overlap in rules:
                    cuts = cut_points(value, limit, overlap, unit == "bytes", marks)
                    if len(cuts) > 1:
                        for no, (a, b) in enumerate(cuts, 1):
                            part = value[a:b]
                            rows.append((spec, k, no, a, b, len(part.encode()) if unit == "bytes" else b - a, part))
                if rows:
                    yield pd.DataFrame(rows, columns=["spec_id", "key", "piece_no", "start", "stop", "size", "text"])

    return large.mapInPandas(pieces, PIECES.format(key="key", type=kind)).withColumnRenamed("key", key)


def oversized(df: DataFrame, specs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(spec_id, key) of every row that had to be split: each has exactly one second piece."""
    return split(df, specs, key, text).where("piece_no = 2").select("spec_id", key)


def rejoined(df: DataFrame, specs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(spec_id, ``key``, n_chars, digest, within_limit, in_order, shared): a check of ``split`` from its output alone.

    ``digest`` is the MD5 of the pieces put together without what they share; ``shared`` tells
    whether every piece but the first begins with the end of the one before, ``overlap_size``
    long, in bytes less what a code point does not fit in.
    """
    piece = F.struct("piece_no", "start", "stop", "size", "text")
    rules = F.broadcast(specs.select("spec_id", F.lower(F.trim("unit")).alias("unit"), "max_size", F.coalesce("overlap_size", F.lit(0)).alias("overlap_size")))
    whole = split(df, specs, key, text).groupBy("spec_id", key).agg(F.array_sort(F.collect_list(piece)).alias("p")).join(rules, "spec_id")
    pairs = F.arrays_zip(F.slice("p", 1, F.size("p") - 1).alias("a"), F.slice("p", 2, F.size("p") - 1).alias("b"))
    common = lambda x: F.substring(x["b"]["text"], 1, (x["a"]["stop"] - x["b"]["start"]).cast("int"))
    length = lambda t: F.when(F.col("unit") == "bytes", F.octet_length(t)).otherwise(F.char_length(t))
    least = F.col("overlap_size") - F.when(F.col("unit") == "bytes", 3).otherwise(0)
    joined = F.concat(F.get("p", F.lit(0))["text"], F.array_join(F.transform(pairs, lambda x: F.substring(x["b"]["text"], (x["a"]["stop"] - x["b"]["start"] + 1).cast("int"), 2**31 - 1)), ""))
    return whole.select(
        "spec_id",
        key,
        F.char_length(joined).cast("bigint").alias("n_chars"),
        F.md5(joined.cast("binary")).alias("digest"),
        F.forall("p", lambda x: (length(x["text"]) <= F.col("max_size")) & (length(x["text"]) == x["size"])).alias("within_limit"),
        F.forall(F.transform("p", lambda x, i: x["piece_no"] == i + 1), lambda x: x).alias("in_order"),
        F.forall(pairs, lambda x: F.endswith(x["a"]["text"], common(x)) & length(common(x)).between(least, F.col("overlap_size"))).alias("shared"),
    )
