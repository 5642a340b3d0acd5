"""Removal of passages that stand in an earlier document, by content-defined chunks.

A gear rolling hash over the last 16 bytes cuts UTF-8 text where its top bits are zero, and where no such
place is near, at its least value there; so cuts move with their content, in monotonous text as well,
and an insertion shifts none but its own. Chunks are compared by digest and length. A chunk repeats
if an earlier document has it: one with a smaller id, or of equal ids with a smaller text hash. Runs
of repeated chunks of at least MIN_WORDS words are removed, shrunk to whole words. First occurrences
stay. A chunk is some five words long, so of a longer passage a few words may be left at its ends.
"""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import order_id

#: Chunk bytes at least, mean beyond that, at most; words in a run that is removed.
MIN_CHUNK, MEAN_BITS, MAX_CHUNK, MIN_WORDS = 16, 4, 96, 25
#: Documents' bytes of which a task compares chunks before it hands them on.
LOCAL_BYTES = 24 << 20
_GEAR = np.random.Generator(np.random.PCG64(20240607)).integers(0, 1 << 16, 256, dtype="u2")
_SPACES = b" \t\n\r\x0b\x0c"
#: First bytes of characters of scripts that mostly don't part words by spaces; two of them count as a word.
_DENSE = bytes(range(0xE3, 0xEE))


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks, the last one at the end; never within a character."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n] if n else []
    raw = np.frombuffer(data, "u1")
    h = _GEAR[raw]
    for step in (1, 2, 4, 8):
        h[step:] += h[:-step] << np.uint16(step)
    h[:-1][(raw[1:] & 0xC0) == 0x80] = 0xFFFF
    ends = np.flatnonzero(h[: n - 1] < (1 << (16 - MEAN_BITS))) + 1
    out, last = [], 0
    for end in [*ends.tolist(), n]:
        while end - last > MAX_CHUNK:
            last += MIN_CHUNK + int(h[last + MIN_CHUNK - 1 : last + MAX_CHUNK].argmin())
            out.append(last)
        if end - last >= MIN_CHUNK or end == n > last:
            out.append(end)
            last = end
    return out


def _chunk_rows(batches):
    """A row for each chunk of a document: (digest, doc, tie, at, e_doc, e_tie), at being start << 10 | length.

    Within LOCAL_BYTES of documents only the first document with a chunk hands it on to be compared;
    the others already know an earlier document, (e_doc, e_tie). So a chunk that stands in a third of all
    documents gives one row to compare for each such block.
    """
    docs, ties, digests, ats, owner = array("q"), array("q"), array("Q"), array("q"), array("i")

    def rows():
        d, k, at = np.array(digests, "u8").view("i8"), np.array(owner, "i4"), np.array(ats, "i8")
        doc, tie = np.array(docs, "i8"), np.array(ties, "i8")
        order = np.lexsort((tie[k], doc[k], d))
        d, k, at = d[order], k[order], at[order]
        first = k[np.maximum.accumulate(np.where(np.append(True, d[1:] != d[:-1]), np.arange(len(d)), 0))]
        new = (doc[first] == doc[k]) & (tie[first] == tie[k])
        for a in range(0, len(d), 1 << 18):
            p = slice(a, a + (1 << 18))
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[p]), pa.array(doc[k[p]]), pa.array(tie[k[p]]), pa.array(at[p]), pa.array(doc[first[p]], mask=new[p]), pa.array(tie[first[p]], mask=new[p])],
                names=["digest", "doc", "tie", "at", "e_doc", "e_tie"],
            )

    size = 0
    for batch in batches:
        for doc, tie, text in zip(batch["doc"].to_pylist(), batch["tie"].to_pylist(), batch["text"]):
            data = text.as_buffer().to_pybytes() if text.is_valid else b""
            start, k = 0, len(docs)
            for end in cut_points(data):
                digests.append(xxhash.xxh3_64_intdigest(data[start:end], end - start))
                ats.append(start << 10 | end - start)
                owner.append(k)
                start = end
            docs.append(doc)
            ties.append(tie)
            size += len(data)
            if size >= LOCAL_BYTES and owner:
                yield from rows()
                docs, ties, digests, ats, owner, size = array("q"), array("q"), array("Q"), array("q"), array("i"), 0
    if owner:
        yield from rows()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    return order_id(F.col(f"`{id_col}`").cast("long")), F.xxhash64(F.col(f"`{text_col}`"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, tie, marks): for documents with repeated chunks, where these are and the earliest document.

    A mark is (start << 10 | length, document). tie is a hash of the text, by which texts with one id,
    or without one, are told apart and ordered.
    """
    doc, tie = _keyed(docs, id_col, text_col)
    chunks = docs.select(doc.alias("doc"), tie.alias("tie"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        _chunk_rows, "digest long, doc long, tie long, at long, e_doc long, e_tie long"
    )
    # What already knows an earlier document needs no comparison; its salt spreads it.
    salt = F.when(F.col("e_doc").isNull(), F.lit(0)).otherwise(F.xxhash64("doc", "tie", "at"))
    own = F.struct(F.coalesce("e_doc", "doc").alias("doc"), F.coalesce("e_tie", "tie").alias("tie"))
    first = F.min(own).over(Window.partitionBy("digest", "salt"))
    found = chunks.withColumn("salt", salt).withColumn("first", first).where(F.col("first") < F.struct("doc", "tie"))
    return found.groupBy("doc", "tie").agg(F.collect_list(F.struct("at", F.col("first.doc").alias("first"))).alias("marks"))


def words_in(data: bytes) -> int:
    """Words parted by white space; in scripts without spaces two characters count as a word."""
    return len(data.split()) + (len(data) - len(data.translate(None, _DENSE))) // 2


def cut_out(data: bytes, marks: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int, int]]]:
    """The text without its repeated runs, and these as byte spans with the earliest document of their first chunk."""
    runs: list[list[int]] = []
    for at, first in sorted(marks):
        start, end = at >> 10, (at >> 10) + (at & 1023)
        if runs and runs[-1][1] >= start:
            runs[-1][1] = max(end, runs[-1][1])
        else:
            runs.append([start, end, first])
    out, spans, kept = [], [], 0
    for start, end, first in runs:
        while 0 < start < end and data[start - 1] not in _SPACES and data[start] not in _DENSE:
            start += 1
        while start < end < len(data) and data[end] not in _SPACES and data[end] not in _DENSE:
            end -= 1
        if start < end and words_in(data[start:end]) >= MIN_WORDS:
            out.append(data[kept:start])
            spans.append((start, end, first))
            kept = end
    return b"".join([*out, data[kept:]]), spans


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", spans_col: str = "removed_spans") -> DataFrame:
    """docs with repeated passages cut from the text, and spans_col: array of (start, end, first_doc).

    Spans are UTF-8 byte offsets in the given text; first_doc is a document that has the passage.
    Every row and column stays (a column named spans_col is replaced); a null text stays null and an
    empty one empty. Null ids count as earliest; among rows of one id, or without one, the text's hash
    decides which is earlier, and rows that repeat id and text get the same result each. A text of any
    length is cut as a whole. An empty table gives no row.
    """
    doc, tie = _keyed(docs, id_col, text_col)
    marks = repeated(docs, id_col, text_col).select(F.struct("doc", "tie").alias("__tm_key"), F.col("marks").alias("__tm_marks"))

    @F.arrow_udf("struct<text:string,spans:array<struct<start:int,end:int,first_doc:long>>>")
    def cut(texts: pa.Array, marks: pa.Array) -> pa.Array:
        out = []
        for text, found in zip(texts, marks.to_pylist()):
            if not found or not text.is_valid:
                out.append({"text": text.as_py(), "spans": []})
                continue
            kept, spans = cut_out(text.as_buffer().to_pybytes(), [(m["at"], m["first"]) for m in found])
            out.append({"text": kept.decode(), "spans": [{"start": a, "end": b, "first_doc": f} for a, b, f in spans]})
        return pa.array(out, pa.struct([("text", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("first_doc", pa.int64())])))]))

    own = docs.withColumn("__tm_key", F.struct(doc.alias("doc"), tie.alias("tie")))
    joined = own.join(marks, "__tm_key", "left").withColumn("__tm_cut", cut(F.col(f"`{text_col}`"), F.col("__tm_marks")))
    columns = [F.col("__tm_cut.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c != spans_col]
    return joined.select(*columns, F.col("__tm_cut.spans").alias(spans_col))
