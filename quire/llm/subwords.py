"""Byte-level BPE ids from the tokenizers library, with a cache of its pre-tokens.

Merges never cross a pre-token, so a text's ids are those of its pre-tokens in order.  Texts of
common characters are split here, by the pattern the vocabulary was made with, and only
pre-tokens not seen before go to the library's model; every other text goes to it whole.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

from tokenizers import Tokenizer

#: Pre-tokens that a worker remembers.
CACHED = 600_000
#: Letters, digits and white space among the characters split here.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿĀ-ſ", "0-9²³¹¼½¾", r" \t\n\r\x0b\x0c"
_OTHER = re.compile("[^\t\n\x0b\x0c\r\x20-\x7e\xa1-\xffĀ-ſ‐-‧]")
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")


def _byte_letters() -> str:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(spare)) for b in range(256))


_LETTERS = _byte_letters()


def in_model(model, piece: str) -> bytes:
    """Ids of one pre-token."""
    spelt = f"Ġ{piece[1:]}" if piece[0] == " " and piece.isascii() and piece[1:].isalnum() else piece.encode().decode("latin-1").translate(_LETTERS)
    return array("I", [t.id for t in model.tokenize(spelt)]).tobytes()


class Pieces(dict):
    """Ids of pre-tokens, worked out by the library's model when first asked for."""

    def __init__(self, model, older: dict[str, bytes]):
        self.model, self.older = model, older

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = in_model(self.model, piece)
        self[piece] = ids
        return ids


_ONE = re.compile(f"[{_L}]+")


class Encoder:
    def __init__(self, path: str, plain: bool = False):
        """plain: the strings of special tokens are ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism here
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        self.added = [] if plain else [t.content for t in self.library.get_added_tokens_decoder().values()]
        #: Pieces met lately; it knows those met in the spell before.
        self.pieces = Pieces(self.library.model, {})

    def tokens(self, piece: str) -> bytes:
        return in_model(self.pieces.model, piece)

    def word(self, word: str) -> bytes:
        """Ids of a word with a space before it; nothing is remembered."""
        if _ONE.fullmatch(word):
            return self.tokens(f" {word}")
        text = f" {word}"
        if _OTHER.search(text) or any(a in text for a in self.added):
            return self.whole([text])[0]
        return b"".join(map(self.tokens, _SPLIT.findall(text)))

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for t in texts:
            if _OTHER.search(t) or any(a in t for a in self.added):
                out += self.whole([t])
                continue
            if len(self.pieces) > CACHED:
                self.pieces = Pieces(self.library.model, dict(self.pieces))
            out.append(b"".join(map(self.pieces.__getitem__, _SPLIT.findall(t))))
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str, plain: bool = False) -> Encoder:
    """One encoder for each vocabulary in a worker process."""
    return Encoder(path, plain)
