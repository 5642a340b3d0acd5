"""Ids of whole texts by way of their distinct pieces.

The byte-level pattern cuts a run of white space between other characters before its last one, and
before the run if it is longer, and it cuts where letters, digits and marks meet. Texts are cut
at such places into units, by one pass of NumPy over the bytes of many texts; the ids of a text are
those of its units in order. Units are made distinct in Arrow, only distinct ones that a worker doesn't
remember are encoded, and NumPy gathers the ids of all places. Texts with white space beyond
ASCII, and all texts under another pattern, are encoded as a whole.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa

#: White space as Unicode and the Rust libraries define it (fixed values): of one byte, and of more.
ASCII_WHITE = "".join(map(chr, [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]))
WIDE_WHITE = "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_wide = re.compile(f"[{WIDE_WHITE}]").search
#: Kinds of bytes. Nothing is known of those of longer characters but that they aren't white space.
_LONG, _LETTER, _DIGIT, _WHITE, _MARK = range(5)
_KIND = np.array([_LONG if b > 127 else _LETTER if chr(b).isalpha() else _DIGIT if chr(b).isdigit() else _WHITE if chr(b) in ASCII_WHITE else _MARK for b in range(256)], "u1")


class Recent:
    """A bounded memory of two generations: when the newer is full, what was not asked for since it began goes."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most, {}, {}

    def values(self, keys: list, make) -> list:
        """The value of each of the distinct keys; make(keys) gives those that aren't known."""
        out = list(map(self.new.get, keys))
        gaps = [k for k, v in enumerate(out) if v is None]
        if len(self.new) + len(gaps) > self.most:
            self.new, self.old = {}, self.new
        if self.old:
            for k in gaps:
                if (v := self.old.get(keys[k])) is not None:
                    out[k] = self.new[keys[k]] = v
            gaps = [k for k in gaps if out[k] is None]
        lacking = [keys[k] for k in gaps]
        for k, key, v in zip(gaps, lacking, make(lacking)):
            out[k] = self.new[key] = v
        return out


def starts_of_units(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places where units begin in the bytes of texts that begin at `starts`, these included."""
    kind = _KIND[raw]
    white = kind == _WHITE
    cut = np.zeros(len(raw) + 1, bool)
    before, here = kind[:-1], kind[1:]
    known = (before == _LETTER) | (before == _DIGIT)
    # a mark after letters or digits; letters and digits after another kind, but for what may be a contraction
    cut[1:-1] = known & (here == _MARK) | (here != before) & ((here == _LETTER) | (here == _DIGIT)) & (known | (before == _MARK) & (raw[:-1] != ord("'")))
    # white space: the first of a run, and the last one if something follows
    edge = np.zeros(len(raw) + 1, bool)
    edge[starts] = True
    edge[-1] = True
    first, last = white.copy(), white.copy()
    first[1:] &= ~white[:-1] | edge[1:-1]
    last[:-1] &= ~white[1:] & ~edge[1:-1]
    last[-1:] = False
    cut[:-1] |= first | last
    cut[starts] = True
    return np.flatnonzero(cut[:-1])


class WordIds:
    """Base of encoders: a subclass encodes distinct units, and whole texts.

    by_words: whether the pattern is the one that this way of cutting belongs to. most: how many units
    a worker remembers in a generation, at about 200 bytes each; forgetting changes no result.
    """

    def __init__(self, by_words: bool, most: int):
        self.by_words, self.known = by_words, Recent(most)

    def new_units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit as little-endian uint32."""
        raise NotImplementedError

    def text_ids(self, text: str) -> np.ndarray:
        """uint32 ids of a text, encoded as a whole."""
        raise NotImplementedError

    def splits(self, text: str) -> bool:
        return self.by_words and (text.isascii() or not _wide(text))

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        apart = [self.splits(x) for x in texts]
        by_units = iter(self._by_units([x for x, by in zip(texts, apart) if by]))
        return [next(by_units) if by else self.text_ids(x) for x, by in zip(texts, apart)]

    def _by_units(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        coded = [x.encode() for x in texts]
        raw = np.frombuffer(b"".join(coded), "u1")
        lengths = np.fromiter(map(len, coded), "i8", len(coded))
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        if not len(raw):
            return [np.zeros(0, "<u4")] * len(texts)
        heads = starts_of_units(raw, bounds[:-1][lengths > 0])
        offsets = np.append(heads, len(raw)).astype("i4")
        values = pa.StringArray.from_buffers(len(heads), pa.py_buffer(offsets), pa.py_buffer(raw))
        distinct = values.dictionary_encode()
        known = self.known.values(distinct.dictionary.to_numpy(zero_copy_only=False).tolist(), self.new_units)
        flat = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), "i8", len(known)) // 4
        starts = np.cumsum(sizes) - sizes
        at = distinct.indices.to_numpy()
        n = sizes[at]
        ends = np.cumsum(n)
        places = np.repeat(starts[at] - (ends - n), n)
        places += np.arange(len(places))
        ids = flat[places]
        places = np.concatenate([[0], ends])[np.searchsorted(heads, bounds)].tolist()
        return [ids[a:b] for a, b in zip(places, places[1:])]


class PieceIds(WordIds):
    """An encoder of pieces, the matches of the pattern, that remembers pieces as well."""

    def __init__(self, pattern: str, most: int, pieces: int):
        import public_tokenizers
        import regex

        super().__init__(pattern == public_tokenizers.PATTERN, most)
        self.matches, self.pieces = regex.compile(pattern).findall, Recent(pieces)

    def new_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian uint32."""
        raise NotImplementedError

    def _encoded(self, cut: list[list[str]]) -> list[bytes]:
        distinct = list({p for pieces in cut for p in pieces})
        ids = dict(zip(distinct, self.pieces.values(distinct, self.new_pieces)))
        return [b"".join([ids[p] for p in pieces]) for pieces in cut]

    def new_units(self, units: list[str]) -> list[bytes]:
        return self._encoded([[u] if (u[1:] if u[0] == " " else u).isalpha() and u.isascii() else self.matches(u) for u in units])

    def text_ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self._encoded([self.matches(text)])[0], "<u4")


def u32(ids) -> bytes:
    return array("I", ids).tobytes()


def by_size(texts, most: int = 1 << 22):
    """Lists of texts of about `most` characters, in order; a longer text stands alone."""
    some, n = [], 0
    for x in texts:
        some.append(x)
        n += len(x)
        if n >= most:
            yield some
            some, n = [], 0
    if some:
        yield some
