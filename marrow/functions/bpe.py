"""Vocabulary files of public byte-level BPE tokenizers, read by path and never copied."""

from __future__ import annotations

import base64
import importlib.util
import os
from functools import lru_cache
from pathlib import Path

#: Folder of the vocabulary files unless a caller names another one.
TOKENIZER_DIR = os.environ.get("MARROW_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE_50K = f"{TOKENIZER_DIR}/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-tokenization rule these vocabularies were built with.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, one base64 token and its rank per line."""
    out = {}
    for line in Path(path).read_bytes().splitlines():
        token, _, rank = line.partition(b" ")
        if rank:
            out[base64.b64decode(token)] = int(rank)
    return out


def available(path: str = BYTE_BPE_50K) -> bool:
    """Whether the vocabulary and the library that encodes with it are at hand."""
    return Path(path).is_file() and importlib.util.find_spec("tiktoken") is not None


@lru_cache(maxsize=2)
def encoding(path: str):
    """Encoder of a vocabulary file, made once per process; its strings for special tokens are ordinary text."""
    import tiktoken

    return tiktoken.Encoding(Path(path).stem, pat_str=PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
