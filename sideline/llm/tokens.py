"""Byte-level BPE ids by the ``tokenizers`` library, with a bounded cache of words.

The vocabulary file is a parameter; by default the installed package of
public vocabularies gives its place.  Files are never copied.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np

from sideline.llm.common import keep_one

#: Pieces, and words with the space in front of them, remembered by one Python worker (about 45 MB when full; a dict of 350 thousand takes twice the table).
PIECES, WORDS = 40_000, 300_000
#: Characters of a text split at once, so that the list of its pieces stays small.
SPAN = 1 << 16
#: Below this character the splitting pattern is the same in every Unicode version.
_KNOWN = "ɐ"
#: A space where the pattern always splits: behind something else than white space, in front of a letter.
_EDGE = re.compile(r"(?<=[!-~]) (?=[A-Za-z])")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[int, str]:
    """The letter by which byte-level vocabularies write each byte: itself where printable, else the next free one from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def known_pattern() -> re.Pattern:
    """The vocabulary's splitting pattern for texts below ``_KNOWN``, with its classes spelled out for the ``re`` module, which takes half the time.

    Alternatives that cannot begin alike may stand in any order; the most frequent comes first.
    """
    import regex

    known = [chr(c) for c in range(ord(_KNOWN))]
    letter, number, space = ("".join(re.escape(c) for c in known if regex.fullmatch(kind, c)) for kind in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(rf" ?[{letter}]+|'(?:[stmd]|re|ve|ll)| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+")


class Kept(dict):
    """What ``make`` gives for a key, made when first asked for; at most ``limit`` are remembered."""

    def __init__(self, make: Callable[[str], bytes], limit: int):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, key: str) -> bytes:
        made = self._make(key)
        if len(self) < self._limit:
            self[key] = made
        return made


def _spans(text: str) -> Iterator[tuple[int, int]]:
    """(from, to) of parts of a text that the pattern never splits across, about ``SPAN`` characters each."""
    first = 0
    while first < len(text):
        edge = _EDGE.search(text, first + SPAN)
        last = edge.start() if edge else len(text)
        yield first, last
        first = last


class ByteBpe:
    """``encode(text)``: the ids of a text as bytes of ``dtype`` (of the machine's order, little-endian on all common ones).

    Texts are split by the vocabulary's own pattern and each distinct piece is
    encoded once, as far as they are remembered.  Texts with letters beyond
    the Latin blocks go through the library's encoder as a whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._whole.encode_special_tokens = True
        self._tokenize = self._whole.model.tokenize
        self.dtype = np.dtype("<u2" if self._whole.get_vocab_size() <= 1 << 16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self._letters = byte_letters()
        self._split = known_pattern().findall
        self._piece = Kept(self._of_piece, PIECES).__getitem__
        self._behind = Kept(self._of_word, WORDS).__getitem__

    def _of_piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            written = piece.replace(" ", self._letters[32])
        else:
            written = piece.encode().decode("latin-1").translate(self._letters)
        return array(self._code, [t.id for t in self._tokenize(written)]).tobytes()

    def _of_word(self, piece: str) -> bytes:
        """The ids of a piece: words behind a space are many and remembered here alone, other pieces are few."""
        return self._of_piece(piece) if piece[1:].isalpha() and piece[0] == " " else self._piece(piece)

    def encode(self, text: str) -> bytes:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            if max(text) >= _KNOWN:
                return array(self._code, self._whole.encode(text, add_special_tokens=False).ids).tobytes()
        if len(text) <= SPAN:
            return b"".join(map(self._behind, self._split(text)))
        return b"".join(b"".join(map(self._behind, self._split(text, a, b))) for a, b in _spans(text))


def encoder(path: str | None = None) -> ByteBpe:
    """One encoder for each vocabulary and Python worker."""
    path = path or default_vocabulary()
    return keep_one("bpe", path, lambda: ByteBpe(path))
