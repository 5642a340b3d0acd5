"""Byte-level BPE by dynamic programming over prefixes.

For each prefix of a piece there is exactly one token that can end its encoding: the one whose
pair with the last token of the rest's encoding is one that merging by ranks also leaves apart.
The table of these last tokens is all that is stored. Reading it backwards gives the ids;
appending bytes only adds entries; after an edit only entries from the edit on change.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import id_and_text
from .units import PieceIds, by_size, u32


class PrefixTable:
    """Last tokens of the prefixes of one byte string under a vocabulary."""

    def __init__(self, vocabulary: "Vocabulary", data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def append(self, more: bytes) -> None:
        """As if the string had been given with `more` at its end."""
        self.data += more
        ranks, longest, fits, last, data = self.vocabulary.ranks, self.vocabulary.longest, self.vocabulary.fits, self.last, self.data
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(max(0, end - longest), end):
                token = ranks.get(data[start:end])
                if token is not None and (start == 0 or fits(last[start - 1], token)):
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end}")

    def edit(self, start: int, end: int, new: bytes) -> None:
        """Replaces data[start:end]; entries before the edit stay, the rest is found again."""
        rest = new + self.data[end:]
        self.data = self.data[:start]
        del self.last[start:]
        self.append(rest)

    def ids(self) -> list[int]:
        out, at, sizes = [], len(self.last), self.vocabulary.sizes
        while at:
            out.append(self.last[at - 1])
            at -= sizes[out[-1]]
        return out[::-1]


class Vocabulary:
    """Ranks of byte strings, in which every single byte has one."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.bytes_of[i] = raw
        self.sizes = [len(b) for b in self.bytes_of]
        self.longest = max(self.sizes)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self._fits: dict[int, bool] = {}

    @classmethod
    def read(cls, path: str) -> "Vocabulary":
        with open(path, "rb") as f:
            return cls({base64.b64decode(raw): int(i) for raw, i in map(bytes.split, f)})

    def split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one, None for a single byte or one that no merge makes."""
        if token not in self.halves:
            raw = self.bytes_of[token]
            parts = [raw[k : k + 1] for k in range(len(raw))]
            while len(parts) > 2:
                rank, at = min((self.ranks.get(parts[k] + parts[k + 1], len(self.sizes)), k) for k in range(len(parts) - 1))
                if rank >= token:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            self.halves[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.halves[token]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging by ranks leaves the bytes of both as just these two tokens."""
        key = left << 32 | right
        known = self._fits.get(key)
        if known is None:
            if len(self._fits) >= 400_000:
                self._fits.clear()
            known = self._fits[key] = self._apart(left, right)
        return known

    def _spine(self, token: int, side: int) -> list[int]:
        """What stands at one edge of the token while it is merged, from its byte on."""
        out = [token]
        while (halves := self.split(out[-1])) is not None:
            out.append(halves[side])
        return out[::-1]

    def reachable(self, token: int) -> bool:
        return self.sizes[token] == 1 or self.split(token) is not None

    def _apart(self, left: int, right: int) -> bool:
        """Follows both edges of the border through the merges, which come in order of rank.

        Two neighbours across the border merge when both stand there and the rank of their join
        comes before the next merge of either; of equal ranks the leftmost pair merges first.
        """
        if not (self.reachable(left) and self.reachable(right)):
            return False
        lefts, rights, never = self._spine(left, 1), self._spine(right, 0), len(self.sizes)
        i = j = 0
        while True:
            a, b = lefts[i], rights[j]
            a_ends = lefts[i + 1] if i + 1 < len(lefts) else never
            b_ends = rights[j + 1] if j + 1 < len(rights) else never
            rank = self.ranks.get(self.bytes_of[a] + self.bytes_of[b])
            if rank is not None:
                rank = max(rank, a if i else -1, b if j else -1)
                if rank < a_ends and rank <= b_ends:
                    return False
            if a_ends == never and b_ends == never:
                return True
            if a_ends <= b_ends:
                i += 1
            else:
                j += 1

    def encode_piece(self, data: bytes) -> list[int]:
        """A piece that is a token is that token; any other is read off its prefix table."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else PrefixTable(self, data).ids()

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixTokens(PieceIds):
    """Ids of texts, each match of the pattern encoded separately."""

    def __init__(self, path: str, pattern: str):
        super().__init__(pattern, most=350_000, pieces=250_000)
        self.vocabulary = Vocabulary.read(path)
        self.decimal = [str(i) for i in range(len(self.vocabulary.sizes))]

    def new_pieces(self, pieces: list[str]) -> list[bytes]:
        return [u32(self.vocabulary.encode_piece(p.encode())) for p in pieces]


@functools.lru_cache(maxsize=2)
def prefix_tokens(path: str, pattern: str) -> PrefixTokens:
    """One for each Python worker, which keeps it from task to task."""
    return PrefixTokens(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian uint32 of each whole text.

    A null text is empty and has no ids; null and repeated ids stay; no row is dropped, and
    nothing moves between tasks, so skew in any column does not matter.
    """

    def ids(batches):
        tokens = prefix_tokens(path, pattern)
        for batch in batches:
            out = [x for texts in by_size(batch["text"].to_pylist()) for x in tokens.encode_many(texts)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([len(x) for x in out], pa.int64()), pa.array([x.tobytes() for x in out], pa.binary())], names=["doc_id", "n_tokens", "ids"]
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(ids, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, data, text_ids): the bytes that the ids stand for and the ids in decimal, comma-joined."""

    def data(batches):
        tokens = prefix_tokens(path, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                ids = [np.frombuffer(x.as_buffer(), "<u4").tolist() if x.is_valid else [] for x in part["ids"]]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array([tokens.vocabulary.decode(x) for x in ids], pa.binary()), pa.array([",".join(map(tokens.decimal.__getitem__, x)) for x in ids], pa.large_string()).cast(pa.string())],
                    names=["doc_id", "data", "text_ids"],
                )

    rows = encoded.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{ids_col}`").alias("ids"))
    return rows.mapInArrow(data, "doc_id long, data binary, text_ids string")


def round_trips(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): each text encoded, its ids decoded again.

    Both in one pass, so ids never leave the worker. ids_sha256 is of the decimal ids, comma-joined.
    Nulls and repeats as in encode().
    """

    def digests(batches):
        tokens = prefix_tokens(path, pattern)
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch in batches:
            doc_ids = iter(batch["doc_id"].to_pylist())
            for texts in by_size((t.as_py() for t in batch["text"])):
                out = []
                for encoded in tokens.encode_many(texts):
                    ids = encoded.tolist()
                    out.append((next(doc_ids), len(ids), sha(",".join(map(tokens.decimal.__getitem__, ids)).encode()), sha(tokens.vocabulary.decode(ids))))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.string(), pa.string()))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_and_text(docs, id_col, text_col).mapInArrow(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
