"""Public vocabulary files and the pattern that splits texts before the merges."""

from __future__ import annotations

import base64
import functools
import json
import re
from collections.abc import Callable
from pathlib import Path

import regex

# Entries each of a memo's two generations holds, and the longest piece it holds.
MEMO_ENTRIES = 300_000
MEMO_LENGTH = 64
# Up to here Python, its pattern module and the tokenizer libraries agree on every letter and number.
LAST_SHARED = "\u024f"


class Memo(dict):
    """Remembers ``work(piece)`` for short pieces in bounded memory.

    When it is full, its entries become the older generation, which is dropped
    at the next time; pieces asked for meanwhile are taken over.
    """

    def __init__(self, work: Callable, entries: int = MEMO_ENTRIES):
        super().__init__()
        self.work, self.entries, self.older = work, entries, {}

    def __missing__(self, piece):
        out = self.older.get(piece)
        if out is None:
            out = self.work(piece)
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[piece] = out
        return out


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


_WHITE = [chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
# White space that may stand before a blank. Looking for one character is much faster than looking for two.
_INSIDE_A_RUN = [(c, c + " ") for c in _WHITE if c != " "]


def cuts(text: str) -> tuple[str, list[str]] | None:
    """A text as its head and the pieces that follow one space each; None where that would cut a run of white space.

    The public pattern never matches across the border before the first space
    of a run, so head and pieces (with their space) can be taken separately.
    """
    for white, run in _INSIDE_A_RUN:
        if white in text and run in text:
            return None
    pieces = text.split(" ")
    # Two blanks leave an empty piece, one at either end too; a single blank may end the text.
    if text and "" in pieces and (not pieces[0] or pieces.index("") < len(pieces) - 1):
        return None
    return pieces.pop(0), pieces


@functools.cache
def splitter() -> regex.Pattern:
    import public_tokenizers

    return regex.compile(public_tokenizers.PATTERN)


@functools.cache
def rank_file(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from a file of base64 tokens and ranks."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge_file(path: str) -> dict:
    """The JSON of a tokenizer file."""
    return json.loads(Path(path).read_text(encoding="utf-8"))


@functools.cache
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]
