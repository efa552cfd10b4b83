"""Token ids of whole texts by a public tokenizer file, with a memo of pieces.

Both vocabularies cut a text at white space before they merge, so a text's ids
are the ids of its pieces one after another.  A piece is encoded by the
``tokenizers`` library and kept in a dictionary, which is emptied when it is
full; the words in it (pieces without the marks after them) stay for one more
round.  Pieces of more than ``LONG`` characters are never kept, so a worker
holds a bounded number of bounded pieces whatever the texts are.  This changes
speed only.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

#: Pieces that are kept, and characters of the longest one.
MEMO, LONG = 1_000_000, 64
_WS = "\t-\r \x85\xa0  -     　"
#: What a byte-level vocabulary takes as one run: a word with the blank before it, or white space.
_PIECE = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
_ODD = re.compile(f"[{_WS.replace(' ', '').replace(chr(9) + '-' + chr(13), chr(9) + chr(11) + chr(12) + chr(13))}]")


_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f"
#: A word of Latin letters (but for the dotted capital I, whose lower case is two characters), then ASCII marks: the vocabularies cut it just there.
_SIMPLE = re.compile(f"([{_LETTERS}]+)([!-&(-/:-@[-`{{-~]*)")


def _byte_letters() -> dict:
    """The byte-level alphabet: visible Latin-1 bytes stand for themselves, the others follow from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


_ALPHABET = _byte_letters()


class _Memo(dict):
    """Ids of pieces, each read with ``prefix`` before it."""

    def __init__(self, tokenizer, prefix: str, fold: bool):
        super().__init__()
        self.tokenizer, self.model, self.prefix, self.fold = tokenizer, tokenizer.model, prefix, fold
        self.mark = prefix.translate(_ALPHABET)
        self.cores, self.old_cores, self.tails = {}, {}, {}

    def _encode(self, text: str) -> bytes:
        return array("H", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > LONG:
            return self._encode(self.prefix + piece if piece[:1] != "\n" else piece)
        if len(self) >= MEMO:
            self.clear()
            self.old_cores, self.cores, self.tails = self.cores, {}, {}
        ids = self[piece] = self._ids(piece)
        return ids

    def _ids(self, piece: str) -> bytes:
        line = piece[:1] == "\n" and self.prefix == " "  # a new line, then a word without a blank before it
        m = _SIMPLE.fullmatch(piece, 1 if line else 0)
        if m is None:
            return self._encode(self.prefix + piece if piece[:1] != "\n" else piece)
        word, tail = m.groups()
        key = "\n" + word if line else word
        ids = self.cores.get(key) or self.old_cores.get(key)
        if ids is None:  # straight from the library's merge model
            w = word.lower() if self.fold else word
            w = w if w.isascii() else w.encode().decode("latin-1").translate(_ALPHABET)
            ids = array("H", [t.id for t in self.model.tokenize(w if line else self.mark + w)]).tobytes()
            if line:
                ids = self._tail("\n") + ids
        self.cores[key] = ids
        return ids + self._tail(tail) if tail else ids

    def _tail(self, tail: str) -> bytes:
        if tail not in self.tails:
            self.tails[tail] = self._encode(tail)
        return self.tails[tail]


class Encoder:
    """``encode(texts)``: little-endian 16-bit ids of each text, ``end`` appended."""

    def __init__(self, path: str, end: int = 1):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        if t.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.words_only = type(t.normalizer).__name__ == "Sequence"  # lower case, white space dropped
        self.plain, self.spaced, self.raw = _Memo(t, "", True), _Memo(t, " ", False), _Memo(t, "", False)
        self.end = np.array([end], "<u2").tobytes()

    def one(self, text: str) -> bytes:
        if self.words_only:
            pieces, memo, first = text.replace("\n", " ").split(" "), self.plain, b""
        elif not text:
            return self.end
        elif ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0] in " \n" or text[-1] in " \n"
              or _ODD.search(text)):
            pieces, memo, first = _PIECE.findall(text), self.raw, b""
        else:
            pieces, memo = text.replace("\n", " \n").split(" "), self.spaced
            first = self.raw[pieces.pop(0)]
        return first + b"".join(map(memo.__getitem__, pieces)) + self.end

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.one(t) for t in texts]


_encoders: dict = {}


def encoder(path: str) -> Encoder:
    """One encoder a worker process, so that later tasks find its memo filled."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
