"""Token ids of whole texts with the tokenizers library.

A byte-level BPE file splits a text with a fixed pattern and merges inside each
piece only, so the ids of a text are the ids of its pieces in order. Prose
repeats its pieces: the library's model merges a distinct piece once, and a bounded
cache per worker keeps the ids; pieces that came a second time stay longer. The cached path is taken only where the
pattern is certain to split as the library does: plain ASCII and Latin
characters, no special token in the text, and a tokenizer file with exactly that
split. Everything else goes to the library as a whole text.
"""

from __future__ import annotations

import functools
import json
import os
import re
from array import array

import numpy as np

from .common import keeps

#: Pieces kept per worker: seen again, and seen once. A full part starts anew.
CACHE_HOT, CACHE_NEW = 250_000, 300_000
#: Letters and numbers among the characters that the cached path accepts.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾"
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-¬®-ſ]*")
#: Fixed value: the split of byte-level BPE files of this kind, on these characters.
_PIECES = re.compile(rf" ?[{_L}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")


def _byte_chars() -> dict[int, int]:
    """The character of each byte in byte-level vocabularies: visible Latin-1
    characters stand for themselves, the other bytes for those from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + n for n, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()
_SPACE = chr(_BYTE_CHARS[32])


class Encoder:
    """``ids(text)``: the ids as a numpy array of unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        pre = self.tokenizer.pre_tokenizer
        self.split = (isinstance(self.tokenizer.model, BPE) and self.tokenizer.normalizer is None and isinstance(pre, ByteLevel)
                      and not pre.add_prefix_space and json.loads(pre.__getstate__()).get("use_regex", True))
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.merge = _PIECES.findall, self.tokenizer.model.tokenize
        self.hot: dict[str, bytes] = {}
        self.new: dict[str, bytes] = {}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if not self.split or not _PLAIN.fullmatch(text) or any(s in text for s in self.special):
            return self.whole(text)
        pieces = self.pieces(text)
        found = list(map(self.hot.get, pieces))
        if None in found:
            self._complete(pieces, found)
        return np.frombuffer(b"".join(found), np.uint32)

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece by the library's model, which needs no second split."""
        if piece.isascii() and piece.isprintable():
            chars = piece.replace(" ", _SPACE)
        else:
            chars = piece.encode().decode("latin-1").translate(_BYTE_CHARS)
        return array("I", [t.id for t in self.merge(chars)]).tobytes()

    def _complete(self, pieces: list[str], found: list[bytes | None]) -> None:
        """Fill in the pieces that the hot part does not know."""
        if len(self.hot) > CACHE_HOT:
            self.hot.clear()
        if len(self.new) > CACHE_NEW:
            self.new.clear()
        at = [i for i, f in enumerate(found) if f is None]
        unknown = [p for p in dict.fromkeys(pieces[i] for i in at) if p not in self.new]
        first = {p: self._piece(p) for p in unknown}
        for i in at:
            p = pieces[i]
            ids = first.get(p)
            if ids is None:
                ids = self.hot[p] = self.new[p]
            found[i] = ids
        self.new.update(first)


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    keeps("encoder", encoder.cache_clear)
    return Encoder(path)
