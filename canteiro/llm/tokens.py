"""Token ids of whole texts by a byte-level BPE file, for use inside tasks.

A byte-level BPE never merges across the start of a run of white space. A text cut at its single spaces and line
breaks therefore gives the same ids piece by piece, and a piece that was met before needs no second encoding. Pieces
beside other white space are not safe to cut; a text that has one is encoded as a whole.
"""

from __future__ import annotations

import re
from array import array
from codecs import charmap_decode
from operator import itemgetter

import numpy as np

ID_TYPE = np.dtype("<u4")
# pieces kept by one worker, some 200 bytes each; the later half is forgotten beyond it, ids do not depend on it. A dict
# of 700,000 pieces or more would double its table.
MEMO_PIECES = 690_000

# a word of Latin letters, then marks: one or two pre-tokens, which the model can take without the pre-tokenizer
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]+")
_MARKS = ".,;:!?%#$&*"
# ids of runs of marks up to this length are kept
_KEPT_MARKS = 3


def _byte_characters() -> str:
    """The printable characters that stand for the bytes in a byte-level vocabulary."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(byte if byte in printable else next(others)) for byte in range(256))


_BYTE_CHARACTERS = _byte_characters()

_ENCODERS: dict[str, "PieceEncoder"] = {}


class _Pieces(dict):
    """Ids of each piece met so far; a missing piece is encoded when it is asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self._tokenize = tokenizer.model.tokenize
        self._encode = tokenizer.encode
        self.newline = self.whole("\n")
        # a mark that a special token holds is left to the tokenizer
        special = "".join(token.content for token in tokenizer.get_added_tokens_decoder().values())
        self._marks = "".join(mark for mark in _MARKS if mark not in special)
        self._ends: dict[str, bytes] = {}

    def forget(self, kept: int) -> None:
        """Keep the pieces met first, which are those met most; the table does not grow by that."""
        while len(self) > kept:
            self.popitem()

    def _model_ids(self, characters: str) -> bytes:
        return array("I", [token.id for token in self._tokenize(characters)]).tobytes()

    def whole(self, text: str) -> bytes:
        return np.array(self._encode(text, add_special_tokens=False).ids, dtype=ID_TYPE).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():
            self[piece] = ids = self._model_ids("\u0120" + piece)
            return ids
        after_break = piece[:1] == "\n"
        core = piece[1:] if after_break else piece
        if not core or core[0].isspace() or core[-1].isspace():
            raise _NotSafe
        word = core.rstrip(self._marks)
        if word.isascii():
            plain, mapped = word.isalpha(), word
        else:
            plain, mapped = _LATIN.fullmatch(word), charmap_decode(word.encode(), "strict", _BYTE_CHARACTERS)[0]
        if plain:
            # a word that stands in the memo without its marks, or after a space, is not encoded again
            ids = None if after_break else self.get(word)
            if ids is None:
                ids = self._model_ids(mapped if after_break else "\u0120" + mapped)
            if len(word) < len(core):
                marks = core[len(word) :]
                ends = self._ends.get(marks)
                if ends is None:
                    ends = self._model_ids(marks)
                    if len(marks) <= _KEPT_MARKS:
                        self._ends[marks] = ends
                ids += ends
        else:
            ids = self.whole(core if after_break else " " + core)
        self[piece] = ids = self.newline + ids if after_break else ids
        return ids


class _NotSafe(Exception):
    """A piece stands beside other white space than one space or line break."""


class PieceEncoder:
    """Ids of texts as bytes (unsigned 32-bit, little-endian), exactly those of the tokenizer file."""

    def __init__(self, path: str, memo_pieces: int = MEMO_PIECES):
        from tokenizers import Tokenizer

        self._memo = _Pieces(Tokenizer.from_file(path))
        self._limit = memo_pieces
        self.whole = self._memo.whole

    def encode(self, text: str | None) -> bytes:
        """Ids of a text; none for NULL and for the empty text."""
        if not text:
            return b""
        body = text.rstrip(" \t\r\n")
        # a line break opens its piece: "a b\nc" is cut as "a", " b", "\nc", the first one after a made-up break
        pieces = ("\n" + body).replace("\n", " \n").split(" ")[1:]
        if len(self._memo) > self._limit:
            self._memo.forget(self._limit // 2)
        try:
            found = itemgetter(*pieces)(self._memo)
            ids = (b"".join(found) if len(pieces) > 1 else found)[len(self._memo.newline) :]
        except _NotSafe:
            return self.whole(text)
        return ids + self.whole(text[len(body) :]) if len(body) < len(text) else ids


def encoder(path: str) -> PieceEncoder:
    """The worker's encoder of a file; its memo serves all tasks of the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
