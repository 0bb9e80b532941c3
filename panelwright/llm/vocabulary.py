"""Vocabulary files of public tokenizers (the JSON form), read where they are needed."""

from __future__ import annotations

import json
from functools import lru_cache


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Bytes that print keep their code point, the others follow from 256 on in order.
    """
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in printing else chr(next(other)) for b in range(256)]


@lru_cache(maxsize=2)
def read(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def specials(spec: dict) -> dict[str, int]:
    """Strings that are one token wherever they stand in a text."""
    return {t["content"]: t["id"] for t in spec["added_tokens"]}
