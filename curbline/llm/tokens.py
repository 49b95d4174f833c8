"""Token ids by a public tokenizer file, many times faster than text by text.

Both tokenizers cut a text before they merge, and never across the places used here, so pieces between
those places are encoded once and remembered. Texts where the cut is not certain are encoded whole.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from array import array

from .runtime import kept_in_worker

_ODD = "\x1c\x1d\x1e\x1f"
#: Stands where a text is cut, as texts that have it are not.
_BORDER = "\x1f"
_GAPS = re.compile(r"\s\s")
_PIECES = re.compile(r"\s*\S+|\s+")
_LETTERS = "".join(map(re.escape, (c for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == "L" and c != "İ")))
#: Pieces of these letters, ASCII digits and signs fall into runs, whatever else the tokenizer cuts at.
_SIGNS = "".join(map(re.escape, (c for c in map(chr, range(0x21, 0x7f)) if not c.isalnum() and c != "'")))
#: Longer pieces are not remembered.
_LONG = 64
_RUNS = re.compile(f" ?(?:[{_LETTERS}]+|[0-9]+|[{_SIGNS}]+)")
_WORD = re.compile(f" ?[{_LETTERS}]+")


def _odd(text: str) -> bool:
    return any(c in text for c in _ODD)


def _has_wide_gaps(text: str) -> bool:
    """Whether two white spaces stand side by side. Without the rarer ones, finding the pairs is faster than the pattern."""
    if not text.isascii() or any(c in text for c in "\t\r\x0b\x0c"):
        return bool(_GAPS.search(text))
    return "  " in text or "\n" in text and (" \n" in text or "\n " in text or "\n\n" in text)


def packed(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def byte_letters() -> dict[int, str]:
    """The letter that stands for a byte in these vocabularies: itself where it prints, else the next from 256 on."""
    printed = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
    hidden = [b for b in range(256) if b not in set(printed)]
    return {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Memory(dict):
    """Computes what it does not hold yet. It holds two generations of about ``room`` bytes, so what was met lately stays."""

    def __init__(self, compute, room: int):
        super().__init__()
        self.compute, self.room, self.used, self.before = compute, room, 0, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= _LONG:
            self[key] = value
            self.used += len(key) + len(value) + 160
            if self.used > self.room:
                self.before, self.used = dict(self), 0
                self.clear()
        return value


class Encoder:
    """``Encoder(path)(texts)``: one bytes object of little-endian 32-bit ids per text.

    ``room`` bounds the bytes that are remembered (twice as much in all), not the result. Null is an empty text. Without ``special`` the strings of special tokens
    are plain text.
    """

    def __init__(self, path: str, room: int = 160 << 20, special: bool = True):
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = not special
        self.model = self.whole.model
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()] if special else []
        self.spaced = self.whole.encode("a b", add_special_tokens=False).tokens[1][0] == "Ġ"
        self.cut = self._spaced if self.spaced else self._words
        self.letters = {chr(b): c for b, c in byte_letters().items()}
        self.pieces = _Memory(self.piece, room)

    def _words(self, text: str) -> list[str] | None:
        """White space yields no id: the pieces are the words."""
        return None if _odd(text) else text.split()

    def _spaced(self, text: str) -> list[str] | None:
        """A run of white space belongs to what follows it: cut where white space begins."""
        if _odd(text) or any(s in text for s in self.special):
            return None
        if _has_wide_gaps(text):
            return _PIECES.findall(text)
        # Single gaps: the second form is as right and much faster. Other gaps stay inside a piece.
        pieces = text.replace(" ", _BORDER + " ").replace("\n", _BORDER + "\n").split(_BORDER)
        return pieces if pieces[0] else pieces[1:]

    def _encoded(self, text: str) -> bytes:
        return packed(self.whole.encode(text, add_special_tokens=False).ids)

    def piece(self, piece: str) -> bytes:
        """Pieces share their runs ("the", "the,", "the."), which are remembered like pieces."""
        if _WORD.fullmatch(piece):
            return self._word(piece)
        runs = _RUNS.findall(piece)
        if len(runs) < 2 or sum(map(len, runs)) != len(piece) or "<" in piece and any(s in piece for s in self.special):
            return self._encoded(piece)
        return b"".join(map(self.pieces.__getitem__, runs))

    def _word(self, run: str) -> bytes:
        """Runs of Latin letters need no more than case, byte letters and the merges of the model."""
        if not self.spaced:
            run = run.lower()
        if run.isascii():
            run = run.replace(" ", "Ġ")
        else:
            run = "".join(map(self.letters.__getitem__, run.encode().decode("latin-1")))
        return packed([t.id for t in self.model.tokenize(run)])

    def __call__(self, texts) -> list[bytes]:
        get, out = self.pieces.__getitem__, []
        for text in texts:
            pieces = self.cut(text) if text else []
            out.append(self._encoded(text) if pieces is None else b"".join(map(get, pieces)))
        return out


_encoders: dict[str, Encoder] = kept_in_worker.setdefault("encoders", {})


def encoder(path: str) -> Encoder:
    """One per worker process, so that what it remembers outlives a task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def default_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
