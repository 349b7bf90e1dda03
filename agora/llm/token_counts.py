"""Token counts: byte-pair merging with a heap and a linked list, no ids emitted.

A piece starts as a linked list of byte symbols. A heap holds its adjacent
pairs by rank and place; the lowest is popped and merged, its new neighbours
are pushed, and pairs that no longer exist are skipped. The count is the
number of symbols minus the number of merges.

Special strings of the file are one token each wherever they stand, as the
tokenizer library takes them by default. Null and empty texts count 0.
"""

from __future__ import annotations

import functools
import heapq

import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from agora.llm.vocabularies import LAST_SHARED, Memo, byte_letters, cuts, default_path, merge_file, splitter

MERGES = "byte_bpe_50k.json"


class Counter:
    """Counts the tokens of texts under one byte-level merge file."""

    def __init__(self, path: str):
        content = merge_file(path)
        flags = ["lstrip", "rstrip", "single_word"] + (["normalized"] if content["normalizer"] else [])
        if any(t.get(flag) for t in content["added_tokens"] for flag in flags):
            raise ValueError(f"{path}: added tokens that take in white space, or match whole words or normalised texts, are not counted")
        vocabulary = content["model"]["vocab"]
        self.symbols = [vocabulary[letter] for letter in byte_letters()]
        self.made, self.rank = [], {}  # by rank: the symbol a pair becomes; by pair of symbols (one number): its rank
        for rank, (a, b) in enumerate(content["model"]["merges"]):
            self.rank.setdefault(vocabulary[a] << 32 | vocabulary[b], rank)
            self.made.append(vocabulary[a + b])
        special = sorted((t["content"] for t in content["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.whole = Memo(self._pieces)
        self.after_space = Memo(self._after_space)

    def _after_space(self, cut: str) -> int:
        if cut.isalpha() and max(cut) <= LAST_SHARED:  # one match of the pattern
            return self.count_piece(b" " + cut.encode())
        return self._pieces(" " + cut)

    def _pieces(self, text: str) -> int:
        return sum(self.count_piece(piece.encode("utf-8", "surrogatepass")) for piece in splitter().findall(text))

    def count_piece(self, piece: bytes) -> int:
        get, made, n = self.rank.get, self.made, len(piece)
        symbol = [self.symbols[b] for b in piece]
        # Heap entries hold a rank and, in the low 40 bits, a place.
        queue = [
            rank << 40 | k
            for k in range(n - 1)
            if (rank := get(symbol[k] << 32 | symbol[k + 1])) is not None
        ]
        if not queue:
            return n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapq.heapify(queue)
        merged = 0
        while queue:
            top = heapq.heappop(queue)
            k, rank = top & 0xFFFFFFFFFF, top >> 40
            right, here = after[k], symbol[k]
            if here < 0 or right >= n or get(here << 32 | symbol[right]) != rank:
                continue
            here = symbol[k] = made[rank]
            symbol[right] = -1
            right = after[k] = after[right]
            merged += 1
            if right < n:
                before[right] = k
                if (rank := get(here << 32 | symbol[right])) is not None:
                    heapq.heappush(queue, rank << 40 | k)
            left = before[k]
            if left >= 0 and (rank := get(symbol[left] << 32 | here)) is not None:
                heapq.heappush(queue, rank << 40 | left)
        return n - merged

    def count(self, text: str) -> int:
        parts = self.special.split(text) if self.special else [text]
        return len(parts) - 1 + sum(map(self._part, parts))

    def _part(self, text: str) -> int:
        parts = cuts(text)
        if parts is None:
            return sum(map(self.whole.__getitem__, splitter().findall(text)))
        return self.whole[parts[0]] + sum(map(self.after_space.__getitem__, parts[1]))


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(text: Column, path: str | None = None) -> Column:
    """Column with the number of tokens of each whole text."""
    path = path or default_path(MERGES)

    @F.arrow_udf("long")
    def token_count(texts: pa.Array) -> pa.Array:
        work = counter(path).count
        return pa.array([work(t.as_py() or "") for t in texts], pa.int64())

    return token_count(text)
