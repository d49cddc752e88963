"""Exact tokenizer encoding through a bounded cache of text units.

A text is cut only at places where the tokenizer's own splitting must restart, so the ids of the
whole are the ids of the parts in a row.  Each distinct part is encoded by the tokenizers library
and kept; a full cache keeps its older half.

Byte-level model: its pattern lets white space only begin a match or fill it, and the added token
holds none, so a match always starts at white space that follows something else, and at what
follows a single line feed.  Word model: white space is dropped, ASCII case does not matter.
A unit of plain letters, perhaps with ASCII marks behind them, is one or two matches, which go straight
to the library's BPE model; any other unit goes through its whole pipeline.
"""

from __future__ import annotations

import os
import re
from struct import pack

import numpy as np

# The characters that the tokenizers' patterns count as white space (fixed values).
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_UNIT = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# A text without these is lines of words with one space between them.
_ODD = ["  ", " \n", "\n ", "\n\n", *(c for c in SPACE if c not in " \n")]
_PLAIN = re.compile("( ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-/:-@\\[-`{-~]*)")
MAX_UNITS = 1_000_000
_LOADED: dict[tuple | str, object] = {}


def load_tokenizer(path: str):
    """The tokenizer at ``path`` without padding and truncation, loaded once per process."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        tok.no_padding()
        tok.no_truncation()
        _LOADED[path] = tok
    return _LOADED[path]


def byte_letters() -> list[str]:
    """The letter by which a byte-level vocabulary writes each byte: itself where it prints."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    for i, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + i)
    return [letters[b] for b in range(256)]


def unit_encoder(path: str, kind: str):
    """The process-wide encoder of a vocabulary file; ``kind``: "byte" or "word"."""
    key = (path, kind)
    if key not in _LOADED:
        _LOADED[key] = {"byte": ByteUnits, "word": WordUnits}[kind](load_tokenizer(path))
    return _LOADED[key]


class _Known(dict):
    """Unit -> its ids as bytes; an absent unit is encoded by ``learn`` and kept."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, unit):
        ids = self[unit] = self.learn(unit)
        return ids

    def thin(self) -> None:
        """Keep the older half: frequent units are met early.  The other half follows the texts."""
        for _ in range(len(self) - len(self) // 2):
            self.popitem()


class _Units:
    def __init__(self, tok, max_units: int = MAX_UNITS):
        self.tok, self.max_units = tok, max_units
        self.dtype = np.dtype("<u2" if tok.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.formats = [f"<{n}{'H' if self.dtype.itemsize == 2 else 'I'}" for n in range(64)]
        self.table = dict(enumerate(byte_letters()))
        self.caches: list[_Known] = []

    def _letters(self, text: str) -> str:
        if text.isascii():  # letters and marks stand for themselves
            return text.replace(" ", self.table[32])
        return text.encode("utf-8").decode("latin-1").translate(self.table)

    def learn(self, text: str) -> bytes:
        """Ids of one unit, by the library."""
        if plain := _PLAIN.fullmatch(text):
            tokens = self.tok.model.tokenize(self._letters(plain[1]))
            if plain[2]:
                tokens = tokens + self.tok.model.tokenize(plain[2])
            ids = [t.id for t in tokens]
        else:
            ids = self.tok.encode(text, add_special_tokens=False).ids
        if len(ids) < len(self.formats):
            return pack(self.formats[len(ids)], *ids)
        return np.array(ids, dtype=self.dtype).tobytes()

    def encode(self, texts) -> list[bytes]:
        """Ids of every text as little-endian unsigned integers of ``dtype``."""
        out = []
        for text in texts:
            out.append(self.one(text))
            self.trim()
        return out

    def trim(self) -> None:
        """Keep the caches within their bound."""
        if sum(map(len, self.caches)) > self.max_units:
            for cache in self.caches:
                cache.thin()


class ByteUnits(_Units):
    """Units of a byte-level model: one cache by their text, one by their text after a space."""

    def __init__(self, tok, max_units: int = MAX_UNITS):
        super().__init__(tok, max_units)
        self.known = _Known(self.learn)
        self.spaced = _Known(lambda unit: self.learn(" " + unit))
        self.caches = [self.known, self.spaced]

    def one(self, text: str) -> bytes:
        if not text or text[0] in " \n" or text[-1] in " \n" or any(map(text.__contains__, _ODD)):
            return b"".join(map(self.known.__getitem__, _UNIT.findall(text)))
        some = self.spaced.__getitem__
        lines = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            lines.append(b"".join([self.known[first], *map(some, rest)]))
        return self.known["\n"].join(lines)


class WordUnits(_Units):
    """Units of a model that drops white space and lower-cases: ASCII-space separated words."""

    def __init__(self, tok, max_units: int = MAX_UNITS):
        super().__init__(tok, max_units)
        self.known = _Known(lambda unit: self.learn(self._lower(unit.decode("utf-8"))))
        self.caches = [self.known]

    @staticmethod
    def _lower(unit: str) -> str:
        return unit.lower() if _PLAIN.fullmatch(unit) else unit

    def one(self, text: str) -> bytes:
        # A text with an added token's opening keeps its case: added tokens are matched as written.
        raw = text.encode("utf-8")
        return b"".join(map(self.known.__getitem__, (raw if b"<|" in raw else raw.lower()).split()))
