"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once.

The library splits a text into pre-tokens before it merges anything, so a text may be cut where
no pre-token can reach across and its parts encoded alone. The cuts used here:

- byte-level vocabularies: before a single space or around a single line feed between
  characters that are not white space; the pattern lets a space lead the next word only;
- word vocabularies, which drop white space: at spaces and line feeds.

Texts with white space in runs or at their ends, or with the marks of special tokens, are
encoded whole (byte-level) or in parts that hold the mark (word). Words made of letters only go
to the vocabulary's own model, with trailing signs cut off.
"""

from __future__ import annotations

import os
import re
import string
from array import array
from collections.abc import Callable

import numpy as np

#: White space at an end or in a run, for pieces without the space that leads them.
_SPACES = re.compile(r"^\s|\s$|\s\s")
#: ASCII signs that form one pre-token after a word; not the apostrophe, which may start a suffix.
_SIGNS = string.punctuation.replace("'", "")
#: Distinct pieces kept by one worker process; beyond it the half learnt last is forgotten before
#: the next text, at a cost in time only: frequent pieces are met early.
MOST_PIECES = 400_000


def _byte_letters() -> dict[int, str]:
    """Letters that stand for bytes in byte-level vocabularies (fixed by their format)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Run(Exception):
    """White space that pre-tokens may reach across a cut."""


class _Pieces(dict):
    """Ids of pieces; one that is not there is learnt when it is asked for."""

    def __init__(self, learn: Callable[[str], bytes]):
        self.learn = learn

    def __missing__(self, piece: str) -> bytes:
        found = self[piece] = self.learn(piece)
        return found


class Encoder:
    """``ids(text)``: little-endian unsigned 32-bit ids as bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.words = bool(self.model.end_of_word_suffix)
        self.letters = _byte_letters()
        self.pieces = _Pieces(self._learn)

    def size(self) -> int:
        return self.whole.get_vocab_size()

    def library(self, texts: list[str]) -> list[bytes]:
        found = self.whole.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _word(self, piece: str) -> bytes:
        if piece.isascii():
            mapped = "Ġ" + piece[1:] if piece[0] == " " else piece
        else:
            mapped = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [x.id for x in self.model.tokenize(mapped)]).tobytes()

    def _plain(self, piece: str) -> str | None:
        """The piece as the model reads it, if it is one pre-token of plain letters."""
        if not piece:
            return None
        if self.words:
            return piece.lower() if piece.isalpha() and (piece.isascii() or max(piece) < "Ā") else None
        return piece if piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()) else None

    def _learn(self, piece: str) -> bytes:
        if (word := self._plain(piece)) is not None:
            return self._word(word) if word == piece else self.pieces[word]
        body = piece.rstrip(_SIGNS)
        if body != piece and self._plain(body) is not None:
            return self.pieces[body] + self.pieces[piece[len(body) :]]
        # A cut at white space that has more beside it leaves an empty piece, or space at an end of one.
        if not self.words and piece != "\n" and (not (bare := piece.removeprefix(" ")) or _SPACES.search(bare)):
            raise _Run
        return self.library([piece])[0]

    def _cut(self, text: str) -> list[str] | None:
        if self.words:
            return text.replace("\n", " ").split(" ")
        if "\0" in text or "<|" in text:
            return None
        return text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        cut = self._cut(text)
        if cut is None:
            return self.library([text])[0]
        if len(self.pieces) > MOST_PIECES:
            for piece in list(self.pieces)[MOST_PIECES // 2 :]:
                del self.pieces[piece]
        try:
            return b"".join(map(self.pieces.__getitem__, cut))
        except _Run:
            return self.library([text])[0]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This process's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
