"""Ids of whole texts by the tokenizers library, remembering the ids of recurring pieces.

Texts are cut where the tokenizer cannot look across: before a space that
begins a run of white space (byte-level files), or at white space (files that
drop it). The library's normaliser and merge model handle each cut that was not seen lately,
so the ids are the library's own. Texts with a special string go to the
library whole.
"""

from __future__ import annotations

import functools
import sys
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from agora.llm.vocabularies import LAST_SHARED, MEMO_ENTRIES, Memo, byte_letters, cuts, merge_file, splitter

# str.split() takes these for white space, the tokenizer does not.
_NO_SPACE = ("\x1c", "\x1d", "\x1e", "\x1f")
_MARKS = frozenset(".,;:!?")


class Ids:
    """Encodes texts under one tokenizer file; ids come as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are packed in the machine's order, which must be little-endian")
        self.tokenizer = Tokenizer.from_file(path)
        content = merge_file(path)
        first = content["pre_tokenizer"]
        steps = first.get("pretokenizers", [first])
        self.keeps_space = first["type"] == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"]
        drops_space = [s["type"] for s in steps] == ["Split", "ByteLevel"] and steps[0]["invert"]
        if not (self.keeps_space and content["normalizer"] is None or drops_space and not steps[1]["use_regex"]):
            raise ValueError(f"{path}: neither byte-level nor a file that drops white space")
        self.find = splitter().findall if self.keeps_space else regex.compile(steps[0]["pattern"]["Regex"]).findall
        self.normal = self.tokenizer.normalizer.normalize_str if content["normalizer"] else str
        self.lowers = not self.keeps_space and content["normalizer"]["type"] == "Sequence"
        self.merge = self.tokenizer.model.tokenize
        self.letters = dict(enumerate(byte_letters()))
        self.blank = self.letters[32]
        # Texts that hold one of these go to the library whole.
        self.whole_texts = [t["content"] for t in content["added_tokens"]] + ([] if self.keeps_space else list(_NO_SPACE))
        self.whole = Memo(self._cut, entries)
        self.after_space = Memo(self._after_space, entries)

    def _after_space(self, cut: str) -> bytes:
        if cut.isalpha() and cut.isascii() and self.keeps_space:  # most of the words not seen before
            return array("I", [t.id for t in self.merge(self.blank + cut)]).tobytes()
        return self._cut(" " + cut)

    def _cut(self, cut: str) -> bytes:
        if not cut.isascii() and max(cut) > LAST_SHARED:
            return array("I", self.tokenizer.encode(cut, add_special_tokens=False).ids).tobytes()
        # Up to LAST_SHARED every letter is composed, so normalising is lower-casing.
        text = cut.lower() if self.lowers else cut
        word = text[1:] if text[:1] == " " else text
        if not word.isalpha():
            # A word and one mark are two matches of the pattern.
            pieces = (text[:-1], text[-1]) if word[-1:] in _MARKS and word[:-1].isalpha() else self.find(text)
            if len(pieces) != 1:
                # Parts of a cut are mostly words and marks that were seen alone.
                return b"".join([self.after_space[p[1:]] if p[0] == " " else self.whole[p] for p in pieces])
            text = pieces[0]
        if not text.isascii():
            text = text.encode().decode("latin-1").translate(self.letters)
        elif word.isalpha():
            text = self.blank + word if text is not word else word
        else:
            text = text.translate(self.letters)
        return array("I", [t.id for t in self.merge(text)]).tobytes()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.whole_texts):
            return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if not self.keeps_space:
            return b"".join(map(self.whole.__getitem__, text.split()))
        parts = cuts(text)
        if parts is None:
            return b"".join(map(self.whole.__getitem__, self.find(text)))
        return self.whole[parts[0]] + b"".join(map(self.after_space.__getitem__, parts[1]))


@functools.cache
def ids_of(path: str, entries: int = MEMO_ENTRIES) -> Ids:
    return Ids(path, entries)


def token_ids(text: Column, path: str, end: int | None = None, entries: int = MEMO_ENTRIES) -> Column:
    """Column with the ids of each whole text, ``end`` after them; null is an empty text.

    ``entries`` bounds what a worker remembers, for jobs whose workers hold other things too.
    """
    tail = b"" if end is None else np.asarray([end], "<u4").tobytes()

    @F.arrow_udf("binary")
    def tokenizer_ids(texts: pa.Array) -> pa.Array:
        work = ids_of(path, entries).encode
        return pa.array([work(t.as_py() or "") + tail for t in texts], pa.binary())

    return tokenizer_ids(text)
