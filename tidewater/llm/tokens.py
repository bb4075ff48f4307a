"""Token ids of whole texts by a public tokenizer, word by word.

The vocabulary's normaliser and pre-tokeniser never look across white space,
so a text's ids are the ids of its white-space chunks one after another, and
those of a text of ASCII and Latin letters without apostrophes the ids of its
words, digits and runs of symbols. Each is encoded by the tokenizers library once per worker and
then looked up; that is what makes a corpus of repeating words cheap. The tables of known
chunks and words are bounded and only a matter of speed.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np

from tidewater.llm.common import worker_cache

VOCABULARY = "word_bpe_49k.json"
MAX_CHUNKS = 150_000      # known chunks per worker
MAX_PIECES = 250_000      # known words per worker
MAX_CHUNK_CHARS = 64      # longer chunks aren't remembered

# what the pre-tokeniser makes of lower-case ASCII without apostrophes
_PIECES = re.compile(r"[a-z]+|[0-9]|[^\sa-z0-9]+")
_TRAILING = ".,;:!?"
# letters below are their own NFC form, and a simple lower case away from the normaliser's
_BEYOND_LATIN = "\u0180"
_TWO_LOWER = "\u0130"
# letters from 128 to there, and what isn't one of them or ASCII
_LETTERS = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_OTHER = re.compile(rf"[^\x00-\x7f{_LETTERS}]")
_LATIN_PIECES = re.compile(rf"[a-z{_LETTERS}]+|[0-9]|[^\sa-z0-9{_LETTERS}]+")
# control characters that Python, but not the tokenizer, takes for white space
_NOT_SPACE = "\x1c\x1d\x1e\x1f"


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next one from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(other)) for b in range(256)]


_SYMBOLS = _byte_symbols()


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Known(dict):
    """Remembers what ``make`` gives, the newer half when it is full."""

    def __init__(self, make, most: int) -> None:
        super().__init__()
        self._make, self._most, self._older = make, most // 2, {}

    def __missing__(self, key: str) -> bytes:
        out = self._older.get(key)
        if out is None:
            out = self._make(key)
        if len(key) <= MAX_CHUNK_CHARS:
            if len(self) >= self._most:
                self._older = dict(self)
                self.clear()
            self[key] = out
        return out


class WordEncoder:
    """Encodes texts to little-endian unsigned 32-bit ids, without special tokens."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._pieces = _Known(self._piece, MAX_PIECES)
        self._chunks = _Known(self._chunk, MAX_CHUNKS)

    def _library(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        """A lower-case word of Latin letters goes straight to the model, as the bytes' symbols."""
        if piece.isalpha() and (piece.isascii() or max(piece) < _BEYOND_LATIN):
            if not piece.isascii():
                piece = "".join([_SYMBOLS[b] for b in piece.encode()])
            ids = [t.id for t in self._model.tokenize(piece)]
            return struct.pack(f"<{len(ids)}I", *ids)
        return self._library(piece)

    def _chunk(self, chunk: str) -> bytes:
        if len(chunk) > MAX_CHUNK_CHARS or "'" in chunk or "<|" in chunk:
            return self._library(chunk)
        known = self._pieces
        if max(chunk) < _BEYOND_LATIN and _TWO_LOWER not in chunk:
            low = chunk.lower()
            if low.isalpha():
                return known[low]
            if low[-1] in _TRAILING and low[:-1].isalpha():
                return known[low[:-1]] + known[low[-1]]
            if low.isascii():
                return b"".join([known[p] for p in _PIECES.findall(low)])
        return self._library(chunk)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(c in text for c in _NOT_SPACE):
            return self._library(text)
        if "'" not in text and "<|" not in text and (text.isascii() or not _OTHER.search(text)):
            # fewer than chunks, which differ by case and by what stands beside a word
            return b"".join(map(self._pieces.__getitem__, _LATIN_PIECES.findall(text.lower())))
        return b"".join(map(self._chunks.__getitem__, text.split()))


@worker_cache
@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """This worker's encoder; it outlives a task."""
    return WordEncoder(path)


def encode_batch(path: str, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after another, each closed by ``end_id``; and their bounds."""
    enc = encoder(path)
    end = np.uint32(end_id).tobytes()
    parts, sizes = [], []
    for t in texts:
        ids = enc.encode(t)
        parts += (ids, end)
        sizes.append(len(ids) // 4 + 1)
    return np.frombuffer(b"".join(parts), "<u4"), np.r_[0, np.cumsum(np.array(sizes, np.int64))]
