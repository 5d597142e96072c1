"""Encoding with a public tokenizer file: whole texts, with the encodings of words kept between texts."""

from __future__ import annotations

import os
import re
import struct

from tarn.llm.common import HELD
from tarn.llm.kernels import batches_of

CACHE = 500_000
#: punctuation that always stands apart from letters, and words of lower-case a-z and Latin-1 letters
_TAIL = b".,;:!?%*#$&|+"
_PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte inside a byte-level vocabulary: printable Latin-1 as is, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts under a word BPE whose words end at white space.

    White space and case of A-Z do not matter to this vocabulary, so a text is the sequence of its pieces between
    ASCII white space, and every distinct piece is encoded once by the library. Texts that may hold a special token
    are encoded whole. The store of pieces is emptied when it holds ``CACHE`` pieces.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = str.maketrans(_byte_letters())
        self.lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
        self.known: dict[bytes, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def _word(self, word: bytes) -> bytes:
        return self._packed([t.id for t in self.tokenizer.model.tokenize(word.decode("latin-1").translate(self.letters))])

    def _learn(self, pieces: set[bytes]) -> None:
        known, rest = self.known, []
        for piece in pieces:
            word = piece.rstrip(_TAIL)
            if not (word.isalpha() or _PLAIN.fullmatch(word)):
                rest.append(piece)
                continue
            ids = known.get(word) or known.setdefault(word, self._word(word))
            if len(word) < len(piece):
                tail = piece[len(word):]
                if tail not in known:
                    known[tail] = self._packed(self.tokenizer.encode(tail.decode(), add_special_tokens=False).ids)
                known[piece] = ids + known[tail]
        for piece, e in zip(rest, self.tokenizer.encode_batch([p.decode() for p in rest], add_special_tokens=False)):
            known[piece] = self._packed(e.ids)

    def encode(self, bodies: list[bytes | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; about a megabyte of text is in hand at a time."""
        return [ids for part in batches_of([len(b or b"") for b in bodies], 1 << 20) for ids in self._encode(bodies[part])]

    def _encode(self, bodies: list[bytes | None]) -> list[bytes]:
        pieces = [[] if b is None or b"<|" in b else b.translate(self.lower).split() for b in bodies]
        if len(self.known) > CACHE:
            self.known.clear()
        known = self.known
        self._learn(set().union(*pieces) - known.keys())
        out = [b"".join(map(known.__getitem__, p)) for p in pieces]
        for i, b in enumerate(bodies):
            if b is not None and b"<|" in b:
                out[i] = self._packed(self.tokenizer.encode(b.decode(), add_special_tokens=False).ids)
        return out


_ENCODERS: dict[str, Encoder] = {}
HELD.append(_ENCODERS.clear)


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def word_bpe() -> str:
    """Place of the public word BPE on this machine; a parameter of everything that encodes."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
