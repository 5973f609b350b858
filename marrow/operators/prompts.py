"""Prompts: template, skeleton, few-shot block, token limits."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marrow.functions.bpe import BYTE_BPE_50K, available, encoding
from marrow.plans.fields import EXTRACTION

#: Marks in a template, and the most tokens of a report.
REPORT_MARK, SKELETON_MARK, SECTION = "<<report_text>>", "<<output_skeleton>>", "PATHOLOGY REPORT:"
MAX_REPORT_TOKENS = 7800
#: Fixed value: context of a locally served model unless another is asked for.
DEFAULT_CONTEXT = 4096
#: Fixed value: the sentence that leads the examples.
FEW_SHOT_HEAD = "---\n\nFEW-SHOT EXAMPLES (for reference only — do not copy, extract from the report below):\n\n"


class Tokenizer(Protocol):
    def count(self, text: str) -> int: ...

    def truncate(self, text: str, most: int) -> tuple[str, bool]: ...


class WordTokenizer:
    """Words, digits in threes, single signs: an approximation of BPE counts where no vocabulary is at hand."""

    pattern = re.compile(r"\s*(?:[^\W\d_]{1,6}|\d{1,3}|[^\w\s]|_)|\s+")

    def count(self, text: str) -> int:
        return sum(1 for _ in self.pattern.finditer(text))

    def truncate(self, text: str, most: int) -> tuple[str, bool]:
        end = 0
        for k, m in enumerate(self.pattern.finditer(text), 1):
            if k > most:
                return text[:end], True
            end = m.end()
        return text, False


class BpeTokenizer:
    """Tokens of a byte-level BPE vocabulary file, which each worker reads once by its path."""

    def __init__(self, path: str = BYTE_BPE_50K):
        self.path = path

    def _encoding(self):
        return encoding(self.path)

    def count(self, text: str) -> int:
        return len(self._encoding().encode_ordinary(text))

    def truncate(self, text: str, most: int) -> tuple[str, bool]:
        ids = self._encoding().encode_ordinary(text)
        return (text, False) if len(ids) <= most else (self._encoding().decode(ids[:most]), True)


def default_tokenizer() -> Tokenizer:
    """The BPE vocabulary where its file and library are at hand, else the approximation."""
    return BpeTokenizer() if available() else WordTokenizer()


def _empty(kind: T.DataType) -> object:
    return {f.name: _empty(f.dataType) for f in kind.fields} if isinstance(kind, T.StructType) else None


def null_skeleton() -> str:
    """The reply's schema as indented JSON with nulls."""
    return json.dumps(_empty(EXTRACTION), indent=2)


def few_shot_block(path: str) -> str:
    """Examples of a JSON lines file; numbers count blank lines too."""
    parts = []
    for i, line in enumerate(Path(path).read_text(encoding="utf-8").split("\n"), 1):
        if line.strip():
            record = json.loads(line)
            parts.append(f"## Example {i}\nReport:\n{record['text']}\n\nOutput:\n{json.dumps(record.get('ground_truth', {}), indent=2)}\n")
    return "\n---\n".join(parts)


def fill(text: Column, template: str, few_shot: str | None = None) -> Column:
    """The template with the report in it; few-shot examples go before every section mark, also one in the report."""
    template = template.replace(SKELETON_MARK, null_skeleton())
    prompt = F.replace(F.lit(template), F.lit(REPORT_MARK), text)
    if few_shot is not None:
        prompt = F.replace(prompt, F.lit(f"\n{SECTION}"), F.lit(f"\n{FEW_SHOT_HEAD}{few_shot}\n\n{SECTION}"))
    return prompt


def count_tokens(text: str, tokenizer: Tokenizer | None = None) -> Column:
    tokenizer = tokenizer or default_tokenizer()

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([tokenizer.count(t) if isinstance(t, str) else None for t in batch], dtype="Int64")

    return count(F.col(text))


def truncate(text: str, most: int = MAX_REPORT_TOKENS, tokenizer: Tokenizer | None = None) -> Column:
    """struct(text, truncated)."""
    tokenizer = tokenizer or default_tokenizer()

    @F.pandas_udf("text string, truncated boolean")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([tokenizer.truncate(t, most) if isinstance(t, str) else (None, False) for t in batch], columns=["text", "truncated"])

    return cut(F.col(text))


def build_prompts(records: DataFrame, template: str, few_shot: str | None = None, most: int = MAX_REPORT_TOKENS, tokenizer: Tokenizer | None = None) -> DataFrame:
    """``records`` with ``prompt`` and ``truncated``; reports that surely fit never leave the JVM.

    A token has at least one character, so a text of at most ``most`` characters fits.
    """
    sure = records.where(F.char_length("text") <= most).withColumns({"_text": F.col("text"), "truncated": F.lit(False)})
    rest = records.where(F.col("text").isNull() | (F.char_length("text") > most)).withColumn("_cut", truncate("text", most, tokenizer)).withColumns({"_text": F.col("_cut.text"), "truncated": F.col("_cut.truncated")}).drop("_cut")
    return sure.unionByName(rest).withColumn("prompt", fill(F.col("_text"), template, few_shot)).drop("_text")


def context_overflow(prompt_tokens: Column, model: str, num_ctx: int | None = None) -> Column:
    """Whether a locally served model's context is too small for the prompt."""
    if model.startswith("openai:"):
        return F.lit(False)
    return prompt_tokens > (num_ctx or DEFAULT_CONTEXT)


def version_of(path: str) -> str:
    """Version of a template by its file name, or the name itself."""
    stem = Path(path).stem
    found = re.search(r"_(v\d+\.\d+)$", stem)
    return found.group(1) if found else stem
