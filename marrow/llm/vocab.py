"""Byte-level form of the vocabularies: a printable character for each byte."""

from __future__ import annotations

from functools import lru_cache

from marrow.functions.bpe import BYTE_BPE_50K, PATTERN, read_ranks

__all__ = ["BYTE_BPE_50K", "PATTERN", "byte_chars", "read_ranks"]


@lru_cache(maxsize=1)
def byte_chars() -> str:
    """A printable character for each byte 0 to 255; printable Latin-1 stands for itself."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    own = set(shown)
    return "".join(chr(b) if b in own else chr(next(rest)) for b in range(256))
