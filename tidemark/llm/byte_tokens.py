"""Ids of whole texts by a byte-level BPE file of the tokenizers library."""

from __future__ import annotations

import functools

import numpy as np

from .units import ASCII_WHITE, WIDE_WHITE, WordIds, by_size

#: Characters that are given to the library at once; it is slower with longer texts.
CALL = 1 << 13
_WHITE = frozenset(ASCII_WHITE + WIDE_WHITE)


def _shown(white: str) -> str:
    """How byte-level vocabularies write a character of one byte that can't be printed."""
    return chr(256 + ord(white)) if ord(white) <= 32 else white


class ByteTokens(WordIds):
    """Ids as Tokenizer.encode(text, add_special_tokens=False) gives them.

    New units are encoded by the library as one joined text, in which a token that begins with white
    space begins a unit; a line feed stands before a unit without white space. Pieces of white space
    alone are encoded one by one. A text that holds the string of a special token is encoded whole.
    """

    def __init__(self, path: str, most: int = 300_000):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
        from tokenizers import Tokenizer

        super().__init__(True, most)
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        vocabulary, white = self.library.get_vocab(), tuple(map(_shown, ASCII_WHITE))
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(white)]] = True

    def splits(self, text: str) -> bool:
        return super().splits(text) and not any(s in text for s in self.special)

    def text_ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of words that begin with a white space of one byte, end otherwise and hold no other one."""
        ids = self.text_ids("".join(words))
        starts = np.flatnonzero(self.opens[ids]).tolist()
        raw = ids.tobytes()
        return [raw[4 * a : 4 * b] for a, b, _ in zip(starts, [*starts[1:], len(ids)], words, strict=True)]

    def new_units(self, units: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(units)
        words = [k for k, u in enumerate(units) if u[-1] not in _WHITE]
        bare = [units[k][0] not in _WHITE for k in words]
        some = by_size(["\n" + units[k] if b else units[k] for k, b in zip(words, bare)], CALL)
        for k, b, x in zip(words, bare, (x for part in some for x in self._joined(part))):
            out[k] = x[4:] if b else x
        for k in set(range(len(units))).difference(words):
            out[k] = self.text_ids(units[k]).tobytes()
        return out


@functools.lru_cache(maxsize=2)
def byte_tokens(path: str) -> ByteTokens:
    """One for each Python worker, which keeps it from task to task."""
    return ByteTokens(path)
