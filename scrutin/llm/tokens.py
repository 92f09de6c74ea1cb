"""Ids of whole texts from a tokenizer file, the same as the library's, with work shared between texts.

A tokenizer first cuts a text into pre-tokens and then treats each alone. Where it is certain that a cut
falls, the text can be parted before: the parts give the same ids as the whole. Parts repeat, so the ids
of a part are kept. Texts for which that certainty is missing (special strings, unusual white space) go to
the library whole.
"""

from __future__ import annotations

import os
import sys
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from scrutin.llm.workers import cache

#: Parts whose ids a worker keeps at least; parts not used among twice as many are forgotten. About 200 bytes each.
KEPT_PARTS = 400_000
_PUNCTUATION = frozenset(".,;:!?")
#: White space to Python but not to the library.
_CONTROLS = "\x1c\x1d\x1e\x1f"
#: Byte-level vocabularies write bytes that do not print as the characters from 256 on, in order.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_NAMES = {b: 256 + k for k, b in enumerate(sorted(set(range(256)) - _PRINTED))}
_SPACE = chr(_BYTE_NAMES[32])
_encoders: dict[str, Encoder] = cache()


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    found = array("I", ids)
    if found.itemsize != 4 or sys.byteorder != "little":
        return np.array(ids, dtype="<u4").tobytes()
    return found.tobytes()


class Unsure(Exception):
    """The part does not stand for itself."""


class _Parts(dict):
    """Ids of parts, encoded on first use. ``marks``: those of punctuation that ends a part."""

    def __init__(self, encode: Callable[[str], bytes], marks: _Parts | None = None):
        super().__init__()
        self.encode, self.marks = encode, self if marks is None else marks
        self.older: dict[str, bytes] = {}

    def __missing__(self, part: str) -> bytes:
        if len(self) >= KEPT_PARTS:
            self.older = dict(self)
            self.clear()
        found = self.older.get(part)
        if found is not None:
            self[part] = found
            return found
        # A pre-token never holds both a letter or digit and the punctuation after it. (Letters beyond
        # Latin-1 may become a letter and a mark when a tokenizer normalises them.)
        if part[-1:] in _PUNCTUATION and part[-2:-1].isalnum() and part[-2] < "\u0100":
            found = self[part[:-1]] + self.marks[part[-1]]
        else:
            found = self.encode(part)
        self[part] = found
        return found


class Encoder:
    """``ids(text)``: little-endian unsigned 32-bit ids, without added special tokens.

    A pre-tokenizer that drops white space parts texts at every white space; a byte-level one keeps it,
    and its texts are parted before each single space.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.drops_space = self.whole("a b") == self.whole("a") + self.whole("b")
        self.lowers = self.whole("A") == self.whole("a")
        self.model = self.tokenizer.model
        self.first = _Parts(self._letters)
        self.parts = self.first if self.drops_space else _Parts(self._spaced, self.first)

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _letters(self, part: str, space: str = "") -> bytes:
        """A part; letters up to Latin-1 are one pre-token, which is the model's alone."""
        if not part.isalpha():
            return self.whole(space + part)
        if part.isascii():
            # ASCII letters are written as themselves.
            named = (_SPACE if space else "") + (part.lower() if self.lowers else part)
        elif max(part) > "\u00ff":
            return self.whole(space + part)
        else:
            named = (space + (part.lower() if self.lowers else part)).encode().decode("latin-1").translate(_BYTE_NAMES)
        return packed([t.id for t in self.model.tokenize(named)])

    def _spaced(self, part: str) -> bytes:
        """A part that follows a space, or begins with the line feed before it."""
        if part == "\n" or not part or (part[0].isspace() and part[0] != "\n") or part[1:2].isspace():
            raise Unsure(part)
        return self.first["\n"] + self._letters(part[1:]) if part[0] == "\n" else self._letters(part, " ")

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if any(c in text for c in _CONTROLS) or any(s in text for s in self.special):
            return self.whole(text)
        if self.drops_space:
            return b"".join(map(self.parts.__getitem__, text.split()))
        head, *rest = text.replace("\n", " \n").split(" ")
        try:
            return (self.first[head] if head else b"") + b"".join(map(self.parts.__getitem__, rest))
        except Unsure:
            return self.whole(text)


def encoder(name: str) -> Encoder:
    """The encoder of a tokenizer file, one per worker until another step runs there; ``name`` is a path or a name in the public set."""
    if name not in _encoders:
        _encoders[name] = Encoder(name if os.path.sep in name else public_tokenizers.path(name))
    return _encoders[name]
