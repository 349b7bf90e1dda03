"""Word and n-gram hashes of many texts at once, in numpy.

A word's hash is the difference of two prefix sums of bytes times powers of an
odd base modulo 2**64, shifted back to position 0 by the inverse power, and
mixed with the word's length. Equal words have equal hashes wherever they
stand; no loop runs over words or bytes.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SPACE = np.zeros(256, bool)
SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes handled in one go; bounds the temporary arrays.
PORTION = 1 << 19

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        size = max(PORTION + 1, n)
        factors = np.full(size, BASE if kind == "up" else INVERSE, np.uint64)
        factors[0] = 1
        # Longer texts than a portion get their own table, which is not kept.
        made = np.multiply.accumulate(factors)
        if size > PORTION + 1:
            return made
        _powers[kind] = made
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (finaliser of a well-known generator)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spans(inside: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of true bytes; runs stop where a text stops."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(len(inside) + 1, bool)
    border[ends] = True
    before = np.empty(len(inside), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | border[:-1]))
    after = np.empty(len(inside), bool)
    after[-1], after[:-1] = False, inside[1:]
    stops = np.flatnonzero(inside & (~after | border[1:])) + 1
    return starts, stops


def hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``raw``."""
    prefix = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + U(1)) * _power("up", len(raw)), out=prefix[1:])
    plain = (prefix[stops] - prefix[starts]) * _power("down", len(raw) + 1)[starts]
    return mix(plain + (stops - starts).astype(np.uint64) * U(0xD6E8FEB86659FD93))


def block_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``raw``, from its blocks of eight bytes.

    Each block is mixed with its place before blocks are summed, so there is no
    polynomial whose periods could cancel; slower than ``hashes`` for long spans only.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = stops - starts
    n = (sizes + 7) >> 3
    first = np.cumsum(n) - n
    number = np.arange(int(n.sum())) - np.repeat(first, n)
    left = np.repeat(sizes, n) - 8 * number
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    # Eight bytes from any place on, as one number.
    windows = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    blocks = windows[np.repeat(starts, n) + 8 * number]
    short = left < 8
    blocks[short] &= (U(1) << (left[short].astype(np.uint64) * U(8))) - U(1)
    keys = mix((number.astype(np.uint64) + U(1)) * U(0x9E3779B97F4A7C15))
    mixed = mix(mix(blocks + keys) ^ keys)
    return mix(np.add.reduceat(mixed, first) + sizes.astype(np.uint64) * U(0xD6E8FEB86659FD93))


def normal_texts(raw: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The words of each text, ASCII letters lower-cased, with one blank between words."""
    inside = ~SPACE[raw]
    kept = inside.copy()
    if len(raw):
        # The first white space after a word becomes its blank.
        kept[1:] |= inside[:-1]
        begins = ends[1:-1][ends[1:-1] < len(raw)]
        kept[begins] = inside[begins]
    letters = np.where(inside, LOWER[raw], np.uint8(32))[kept].tobytes()
    at = np.concatenate([[0], np.cumsum(kept)])[ends].tolist()
    return [letters[a:b].rstrip(b" ") for a, b in zip(at[:-1], at[1:])]


def counts_by_text(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where each text's spans begin in ``starts`` (length + 1 numbers)."""
    return np.searchsorted(starts, ends, side="left")


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, texts not regarded."""
    size = max(0, len(h) - n + 1)
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total += h[k : k + size] * U(pow(0xA0761D6478BD642F, k + 1, 1 << 64))
    return mix(total + U(n))
