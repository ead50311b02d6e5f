"""Token ids of whole texts, as a public byte-level tokenizer gives them.

Such a tokenizer splits a text into words, numbers, signs and white space, and
merges within each piece alone, so a piece met before need not be encoded
again. Where Python's character classes may differ from the
tokenizer's, or a special token may stand, the whole text goes through it.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np

TOKENIZER = "byte_bpe_50k.json"
END = b"\0\0\0\0"
ID = np.dtype("<u4")

# A piece longer than this is not worth remembering; so many are.
_LONGEST = 40
_CACHED = 250_000
_WHOLE = re.compile(
    "[\x1c-\x1f\x85\xb2\xb3\xb9\xbc-\xbeɐ-‏ -\U0010ffff]|<\\|"
)
# The letters among the signs that _WHOLE leaves; of digits it leaves 0-9.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_PIECE = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s0-9{_LETTERS}]+|\s+(?!\S)|\s+"
)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _byte_signs() -> dict[int, str]:
    """The sign that stands for each byte: itself where printable, else from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Cache(dict):
    """Results by key; long keys are not kept.

    A full cache becomes the older one, from which keys in use come back.
    """

    def __init__(self, make) -> None:
        super().__init__()
        self.make, self.older = make, {}

    def bound(self) -> None:
        if len(self) > _CACHED:
            self.older = dict(self)
            self.clear()

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= _LONGEST:
            self[key] = value
        return value

    def of(self, keys: list[str]):
        return map(self.__getitem__, keys)


class Encoder:
    """Encodes with the tokenizers library; one for each worker process."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.signs = _byte_signs()
        self.ids = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.pieces = _Cache(self._piece)

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, ID).tobytes() for x in found]

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            # Of these only the blank has another sign.
            shown = piece.replace(" ", self.signs[32])
        else:
            shown = piece.encode().decode("latin-1").translate(self.signs)
        ids = self.ids
        return b"".join([ids[t.id] for t in self.merge(shown)])

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, with the end id 0."""
        out = [END] * len(texts)
        whole = []
        self.pieces.bound()
        for i, text in enumerate(texts):
            if not text:
                continue
            if _WHOLE.search(text):
                whole.append(i)
            else:
                out[i] = b"".join([*self.pieces.of(_PIECE.findall(text)), END])
        for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
            out[i] = ids + END
        return out
