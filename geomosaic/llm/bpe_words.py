"""Token ids of texts by way of their pieces, for the tokenizers of this package.

A text is cut into pieces that are merged each for itself. The ids of a piece are worked out once
and remembered as bytes; the ids of a text are the joined bytes of its pieces.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
from array import array
from collections.abc import Callable, Iterable

import regex
from tokenizers import Tokenizer

#: Beyond these characters the library's Unicode tables may be newer or older than ours.
_COVERED = 0x500


def covered(kind: str, end: int = _COVERED) -> str:
    """The characters of a Unicode class below ``end``, as ranges of a character class."""
    codes = [c for c in range(end) if regex.match(kind, chr(c))]
    runs = [[c for _, c in run] for _, run in itertools.groupby(enumerate(codes), lambda x: x[1] - x[0])]
    return "".join(f"\\u{run[0]:04x}-\\u{run[-1]:04x}" for run in runs)


_L, _N, _S = (covered(kind) for kind in (r"\p{L}", r"\p{N}", r"\s"))
#: How the byte-level tokenizer cuts a text (fixed rule), for covered characters. Contractions come before the
#: punctuation that they could also be; other branches never start at the same place.
_PIECES = re.compile(
    f" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_S}{_L}{_N}]+| ?[{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
)
_BEYOND = re.compile(f"[^\\u0000-\\u{_COVERED - 1:04x}]")


class Remembered(dict):
    """What ``make`` (many pieces to many values) says of pieces, remembered up to a number of pieces."""

    def __init__(self, make: Callable[[list], Iterable], limit: int = 200_000):
        super().__init__()
        self.make, self.limit = make, limit

    def learn(self, cuts: list[list]) -> None:
        """See that all pieces of these texts are known."""
        pieces = set().union(*cuts)
        new = [p for p in pieces if p not in self]
        if len(self) + len(new) > self.limit:
            self.clear()
            new = list(pieces)
        self.update(zip(new, self.make(new), strict=True))


def _byte_signs() -> list[str]:
    """The printable character that stands for each byte in the vocabulary of a byte-level tokenizer."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


BYTE_SIGNS = _byte_signs()


@functools.cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizer's file; a worker makes them once."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    vocab, added = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
    byte_of = {s: b for b, s in enumerate(BYTE_SIGNS)}
    tokens = [b""] * (max([*vocab.values(), *added.values()]) + 1)
    for token, number in vocab.items():
        tokens[number] = bytes(byte_of[s] for s in token)
    for token, number in added.items():
        tokens[number] = token.encode()
    return tokens


@functools.cache
def byte_tokenizer(path: str) -> ByteTokenizer:
    """The tokenizer of a file, which a worker makes once."""
    return ByteTokenizer(path)


class ByteTokenizer:
    """The byte-level tokenizer of a file: cutting, and exact merging of one piece."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.added = {t.content: number for number, t in self.tokenizer.get_added_tokens_decoder().items()}
        self._added = re.compile("|".join(map(re.escape, self.added))) if self.added else None
        self._signs = str.maketrans(dict(enumerate(BYTE_SIGNS)))

    def cut(self, text: str) -> list[str | int]:
        """Pieces of a text; an added token is its id."""
        if self._added is None or "<" not in text or not self._added.search(text):
            return self._cut(text)
        pieces: list[str | int] = []
        at = 0
        for found in self._added.finditer(text):
            pieces += self._cut(text[at : found.start()])
            pieces.append(self.added[found.group()])
            at = found.end()
        return pieces + self._cut(text[at:])

    def _cut(self, text: str) -> list[str]:
        if not _BEYOND.search(text):
            return _PIECES.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def merge(self, piece: str | int) -> bytes:
        """The ids of a piece by the tokenizer's own merges, as unsigned 32-bit integers."""
        if isinstance(piece, int):
            return array("I", [piece]).tobytes()
        signs = piece.encode().decode("latin-1").translate(self._signs)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(signs)]).tobytes()
