"""Byte-level BPE by monoid tree reduction.

The encodings of byte strings form a monoid: ``join`` makes the encoding of a
concatenation from two encodings. A piece is encoded by encoding its halves,
down to single bytes, and joining them up the tree. Decoding concatenates
token bytes up the same kind of tree.

Why a join may stop. A token sequence is the encoding of its bytes exactly if
every two neighbours are the encoding of their own bytes. Neighbours inside
either half, and inside the re-encoded window, meet this already; so only the
two borders of the window are tested. Where a border fails, the window grows
on that side and is encoded again; at worst it is the whole piece. A worker
remembers what two neighbours become and the encodings of short halves, both
in bounded memory.

A text is split by the public pattern; pieces do not influence each other.
Null texts encode to no tokens. Special tokens are never made.
"""

from __future__ import annotations

import functools
import heapq
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from agora.llm.vocabularies import LAST_SHARED, Memo, cuts, default_path, rank_file, splitter

RANKS = "byte_bpe_50k.tiktoken"
WINDOW_BYTES = 64
LEAF_TOKENS = 4096
NONE = 1 << 60  # the rank of a pair that is no token
# Neighbours a worker remembers, and encodings of halves of up to HALF_BYTES.
PAIRS = 300_000
HALVES = 200_000
HALF_BYTES = 8


class TreeCoder:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pairs: dict[tuple[int, int], list[int] | None] = {}
        self.halves: dict[bytes, list[int]] = {data: [rank] for data, rank in ranks.items() if len(data) == 1}
        self.letters = dict(self.halves)
        self.whole = Memo(self._pieces)
        self.after_space = Memo(self._after_space)

    def _after_space(self, cut: str) -> bytes:
        if cut.isalpha() and max(cut) <= LAST_SHARED:  # one match of the pattern
            return array("I", self.encode(b" " + cut.encode())).tobytes()
        return self._pieces(" " + cut)

    def _pieces(self, text: str) -> bytes:
        out = []
        for piece in splitter().findall(text):
            out += self.encode(piece.encode("utf-8", "surrogatepass"))
        return np.asarray(out, "<u4").tobytes()

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one piece; a piece that is a token is that token."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else self._tree(piece)

    def _tree(self, piece: bytes) -> list[int]:
        known = self.halves.get(piece)
        if known is not None:
            return known
        half = len(piece) // 2
        out = self.join(self._tree(piece[:half]), self._tree(piece[half:]))
        if len(piece) <= HALF_BYTES:
            if len(self.halves) >= HALVES:
                self.halves = dict(self.letters)
            self.halves[piece] = out
        return out

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of ``left`` followed by those of ``right``, both encodings themselves."""
        if not left or not right:
            return left + right
        window = self._met(left[-1], right[0])
        if window is None:
            return left + right
        i = j = 1
        while True:
            left_done = i == len(left) or self._met(left[-i - 1], window[0]) is None
            right_done = j == len(right) or self._met(window[-1], right[j]) is None
            if left_done and right_done:
                return left[: len(left) - i] + window + right[j:]
            i = i if left_done else min(len(left), 2 * i)
            j = j if right_done else min(len(right), 2 * j)
            tokens = left[len(left) - i :] + right[:j]
            window = self._merge(b"".join(map(self.tokens.__getitem__, tokens)))

    def _met(self, a: int, b: int) -> list[int] | None:
        """What two neighbours become when they are encoded as one; None if they stay."""
        try:
            return self.pairs[a, b]
        except KeyError:
            out = self._merge(self.tokens[a] + self.tokens[b])
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            out = self.pairs[a, b] = None if out == [a, b] else out
            return out

    def _merge(self, data: bytes) -> list[int]:
        """Merge the adjacent pair of lowest rank, the leftmost of equals, until none is left."""
        if len(data) > WINDOW_BYTES:
            return self._long(data)
        ranks, get = self.ranks, self.ranks.get
        parts = [data[k : k + 1] for k in range(len(data))]
        pairs = [get(data[k : k + 2], NONE) for k in range(len(data) - 1)]
        while pairs:
            best = min(pairs)
            if best == NONE:
                break
            k = pairs.index(best)
            here = parts[k] = parts[k] + parts.pop(k + 1)
            del pairs[k]
            if k < len(pairs):
                pairs[k] = get(here + parts[k + 1], NONE)
            if k:
                pairs[k - 1] = get(parts[k - 1] + here, NONE)
        return [ranks[p] for p in parts]

    def _long(self, data: bytes) -> list[int]:
        """The same for a grown window: starts instead of copies, pairs from a heap."""
        n, get = len(data), self.ranks.get
        stop = list(range(1, n + 1))  # where the part that starts here stops; 0: merged into another
        before = list(range(-1, n - 1))

        def pair(start: int) -> tuple[int, int, int] | None:
            middle = stop[start]
            if middle >= n:
                return None
            rank = get(data[start : stop[middle]])
            return None if rank is None else (rank, start, stop[middle])

        queue = [p for p in map(pair, range(n)) if p]
        heapq.heapify(queue)
        while queue:
            _, start, end = heapq.heappop(queue)
            middle = stop[start]
            if not middle or middle >= n or stop[middle] != end:
                continue
            stop[start], stop[middle] = end, 0
            if end < n:
                before[end] = start
            for at in (start, before[start]):
                if at >= 0 and (p := pair(at)):
                    heapq.heappush(queue, p)
        out, at = [], 0
        while at < n:
            out.append(self.ranks[data[at : stop[at]]])
            at = stop[at]
        return out

    def encode_text(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        parts = cuts(text)
        if parts is None:
            return b"".join(map(self.whole.__getitem__, splitter().findall(text)))
        return self.whole[parts[0]] + b"".join(map(self.after_space.__getitem__, parts[1]))

    def decode(self, ids: list[int]) -> bytes:
        """The bytes the ids stand for."""
        if len(ids) <= LEAF_TOKENS:
            return b"".join(map(self.tokens.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@functools.cache
def coder(path: str) -> TreeCoder:
    return TreeCoder(rank_file(path))


def encode(text: Column, path: str | None = None) -> Column:
    """Column with a text's ids as little-endian unsigned 32-bit integers (binary)."""
    path = path or default_path(RANKS)

    @F.arrow_udf("binary")
    def bpe_encode(texts: pa.Array) -> pa.Array:
        work = coder(path).encode_text
        return pa.array([work(t.as_py() or "") for t in texts], pa.binary())

    return bpe_encode(text)


def decode(ids: Column, path: str | None = None) -> Column:
    """Column with the bytes that packed ids stand for; null ids are empty."""
    path = path or default_path(RANKS)

    @F.arrow_udf("binary")
    def bpe_decode(packed: pa.Array) -> pa.Array:
        work = coder(path).decode
        return pa.array([work(np.frombuffer(p.as_py() or b"", "<u4").tolist()) for p in packed], pa.binary())

    return bpe_decode(ids)
