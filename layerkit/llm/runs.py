"""Runs of letters (or of other classes of characters) of whole texts, in pieces of bounded size."""

from __future__ import annotations

import re
from collections.abc import Iterator

PIECE = 1 << 18     # characters searched at once; a longer run makes its piece longer
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def lower_ascii(text: str) -> str:
    """Only A-Z lower-cased (no byte of a longer UTF-8 sequence is a letter of ASCII)."""
    return text.encode().translate(_LOWER).decode()


def pieces(text: str, outside: re.Pattern, size: int = PIECE) -> Iterator[str]:
    """Consecutive parts of the text that are cut where ``outside`` (one character beyond every run) matches."""
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            cut = outside.search(text, end)
            end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end
