"""Token ids of whole texts with a byte-level BPE vocabulary of the ``tokenizers`` library.

The library spends most of its time on words it has merged before.  ``WordEncoder`` cuts a
text where the vocabulary's own splitting rule always cuts (before a space that follows a
non-space, and around a line feed between non-spaces), asks the library's model for every
piece it has not seen, and keeps the answer.  A text with adjacent white space, or with the
string of a token added to the vocabulary, goes through the library whole.  Ids are the same as ``Tokenizer.encode`` gives (tested).
"""

from __future__ import annotations

import re
import sys
from array import array

import numpy as np

CACHE_WORDS = 1_200_000  # kept per Python worker; beyond it the cache starts anew

_RUN = re.compile(r"\s\s|^\s")
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?[^\s\w]+|\n")


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes bytes as printable letters: printable ones as themselves, the
    others as the code points from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


class _Words(dict):
    """Piece -> bytes of its ids; asks the encoder for what is missing."""

    def __init__(self, ask):
        super().__init__()
        self.ask = ask

    def __missing__(self, piece: str) -> bytes:
        found = self[piece] = self.ask(piece)
        return found


class WordEncoder:
    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.whole = re.compile("|".join([_RUN.pattern, *added]))
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype, self.code = (np.dtype("<u2"), "H") if small else (np.dtype("<u4"), "I")
        self.letters = _byte_letters()
        self.limit = cache_words
        self.first = _Words(self._piece)                          # pieces at the start of a line
        self.spaced = _Words(lambda piece: self._piece(" " + piece))  # pieces after a space
        self.model = self.tokenizer.model

    def _bytes(self, ids) -> bytes:
        a = array(self.code, ids)
        if sys.byteorder != "little":
            a.byteswap()
        return a.tobytes()

    def _piece(self, piece: str) -> bytes:
        if "'" not in piece:
            cut = _PIECE.findall(piece)
            if "".join(cut) == piece:  # words of the splitting rule: straight to the model
                return self._bytes([t.id for word in cut for t in self.model.tokenize(
                    word.encode().decode("latin-1").translate(self.letters))])
        return self._bytes(self.tokenizer.encode(piece, add_special_tokens=False).ids)

    def encode(self, text: str) -> np.ndarray:
        """All ids of the text, as the smallest unsigned type that holds the vocabulary."""
        if not text:
            return np.empty(0, self.dtype)
        if self.whole.search(text):
            return np.frombuffer(self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids), self.dtype)
        if len(self.spaced) + len(self.first) > self.limit:
            self.spaced.clear()
            self.first.clear()
        out = []
        for line in text.split("\n"):
            head, *rest = line.split(" ")
            out.append(self.first[head])
            out += map(self.spaced.__getitem__, rest)
            out.append(self.first["\n"])
        out.pop()
        return np.frombuffer(b"".join(out), self.dtype)


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder of a vocabulary file, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
