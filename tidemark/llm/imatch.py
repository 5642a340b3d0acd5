"""I-Match fingerprints with randomised lexicons.

The lexicon holds the terms whose share of documents lies in a band (that is, whose inverse
document frequency does). Each of LEXICONS random subsets of it keeps a term by a hash; a document's
fingerprint has, for each subset, a hash of its sorted distinct terms in there. As at most
(mean distinct terms a document) / low terms can stand in a share `low` of the documents, the
lexicon has a bound that does not grow with the corpus.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import order_id, written

#: Band of the share of documents with a term; subsets, by the share of the lexicon that they keep.
LOW, HIGH, LEXICONS, SHARES = 0.001, 0.25, 32, (1 / 16, 1 / 64, 1 / 256, 1 / 1024)
_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_SPLIT = bytes(range(256)).translate(_BYTES)


def terms(text: str) -> np.ndarray:
    """Sorted distinct hashes of the text's lower-cased words."""
    words = set(text.lower().encode().translate(_SPLIT).split())
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words)))


def document_counts(docs: DataFrame, text_col: str = "text", most: int = 1 << 19) -> DataFrame:
    """(term, n): the number of documents with each term, over all of them.

    Tasks sum what they see, in memory bounded by `most` terms, before anything is shuffled.
    """

    def counts(batches):
        held, size = [], 0

        def summed():
            term, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(term.view("i8")), pa.array(n.astype("i8"))], names=["term", "n"])

        for batch in batches:
            for text in batch["text"]:
                held.append(terms(text.as_py() or ""))
                size += len(held[-1])
                if size >= 8 * most:
                    yield summed()
                    held, size = [], 0
        if size:
            yield summed()

    parts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(counts, "term long, n long")
    return parts.groupBy("term").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> np.ndarray:
    """Sorted hashes of the terms in the band; the bound is that of the module's text."""
    total = docs.select(F.lit(1)).count()
    if not total:
        return np.zeros(0, "u8")
    band = document_counts(docs, text_col).where((F.col("n") >= max(2.0, low * total)) & (F.col("n") <= max(2.0, high * total)))
    return np.sort(np.array([r[0] for r in band.select("term").toLocalIterator()], "i8").view("u8"))


def subset_hashes(own: np.ndarray, known: np.ndarray, salts: np.ndarray) -> np.ndarray:
    """A hash of the document's terms in each subset, 0 for none of them.

    They are 32-bit numbers. The last entry stands for all terms of a document that has none in the
    lexicon.
    """
    at = np.searchsorted(known, own)
    kept = own[known[np.minimum(at, len(known) - 1)] == own] if len(known) else own[:0]
    out = np.zeros(LEXICONS + 1, "u4")
    if not len(kept):
        out[-1] = xxhash.xxh32_intdigest(own.tobytes()) if len(own) else 0
        return out
    for k in range(LEXICONS):
        mixed = (kept ^ salts[k]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        part = kept[(mixed >> np.uint64(40)) < np.uint64(SHARES[k % len(SHARES)] * (1 << 24))]
        if len(part):
            out[k] = xxhash.xxh32_intdigest(part.tobytes())
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal hashes among subsets in which either document has a term; 1 for two empty ones."""
    used = (a != 0) | (b != 0)
    return float((a == b)[used].mean()) if used.any() else 1.0


def _salts() -> np.ndarray:
    return np.random.Generator(np.random.PCG64(77)).integers(0, 1 << 63, LEXICONS, dtype="u8")


def fingerprints(docs: DataFrame, known: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; equal texts have equal ones. A null text is empty."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    @F.arrow_udf("string")
    def fingerprint(texts: pa.Array) -> pa.Array:
        salts = _salts()
        return pa.array([subset_hashes(terms(t.as_py() or ""), shared.value, salts).tobytes().hex() for t in texts], pa.string())

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), fingerprint(F.col(f"`{text_col}`")).alias("fingerprint"))


_ROW = "part int, role int, doc_id long, text string, n_chars long, edited_sha256 string, own binary, edited binary, near_edited double, near_next double"
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
#: A finished document; the last of a partition, still without its next one; a copy of the first.
_DONE, _LAST, _FIRST = 0, 1, 2


def edit_likeness(docs: DataFrame, known: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document is the one with the next smaller id (of equal ids by text; nulls come last),
    after the last the first; a single document is its own next one. The last half of the code points
    gives way to the next document's first ones. Rows are dealt by ranges of ids and, where many share an
    id or have none, of how their texts begin; each task reads its documents in order, one at a time and
    as a whole; only the ends of the partitions meet in a second step. A null text is empty; equal texts have equal
    fingerprints, and an empty one is wholly like another. An empty table gives no row.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(known)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("k", order_id("doc_id")).repartitionByRange(F.desc("k"), F.substring("text", 1, 64)).sortWithinPartitions(F.desc("k"), "text").select("doc_id", "text")

    def compared(part, doc_id, text, own, next_text, next_own, salts):
        half = len(text) // 2
        edited = text[: len(text) - half] + next_text[:half]
        changed = subset_hashes(terms(edited), shared.value, salts)
        return (part, _DONE, doc_id, None, len(text), hashlib.sha256(edited.encode()).hexdigest(), own.tobytes(), changed.tobytes(), likeness(own, changed), likeness(own, next_own))

    def batch_of(out):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)

    def inner(batches):
        part, salts, before, out = TaskContext.get().partitionId(), _salts(), None, []
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = text.as_py()
                own = subset_hashes(terms(text), shared.value, salts)
                if before is None:
                    out.append((part, _FIRST, doc_id, text, None, None, own.tobytes(), None, None, None))
                else:
                    out.append(compared(part, *before, text, own, salts))
                before = doc_id, text, own
                if len(out) >= 1024:
                    yield batch_of(out)
                    out = []
        if before is not None:
            out.append((part, _LAST, before[0], before[1], None, None, before[2].tobytes(), None, None, None))
            yield batch_of(out)

    table = written(rows.mapInArrow(inner, _ROW), "edits", compression="zstd")
    parts = sorted(r[0] for r in table.where(F.col("role") == _FIRST).select("part").collect())  # one a partition
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next int")
    firsts = table.where(F.col("role") == _FIRST).select(F.col("part").alias("next"), F.col("text").alias("next_text"), F.col("own").alias("next_own"))
    open_rows = table.where(F.col("role") == _LAST).select("part", "doc_id", "text", "own").join(F.broadcast(follows), "part").join(firsts, "next")

    def outer(batches):
        salts = _salts()
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                own, next_own = (np.frombuffer(r[c], "u4") for c in ("own", "next_own"))
                out.append(compared(r["part"], r["doc_id"], r["text"], own, r["next_text"], next_own, salts))
            if out:
                yield batch_of(out)

    whole = table.where(F.col("role") == _DONE).unionByName(open_rows.mapInArrow(outer, _ROW))
    return whole.select("doc_id", "n_chars", "edited_sha256", F.lower(F.hex("own")).alias("fingerprint"), F.lower(F.hex("edited")).alias("edited_fingerprint"), "near_edited", "near_next")
