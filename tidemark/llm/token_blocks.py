"""Token ids of a corpus in binary files of patched frame-of-reference blocks.

A store is a folder of Parquet files whose rows are frames. A frame holds whole documents in
ascending id order (a null id first, equal ids by text) and at least FRAME ids, if its shard
has as many. Its payload, little-endian:

    magic 'TMB1', u32: documents, ids, blocks, exceptions
    i64 document ids; u8 1 where the id is null; u32 ids of each document
    per block of 128 ids: u32 minimum, u8 width, u32 start of its packed words, u32 end of its exceptions
    u64 packed words: each block's ids less its minimum, the low `width` bits, 64 values to `width` words
    u8 positions in the block, u32 high bits of each exception

A block's width is that of its value at the PERCENTILE place, so that rare large ids don't widen
the block but stand in its exception list. The starts let a reader unpack any block alone.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import id_and_text
from .byte_tokens import byte_tokens
from .units import by_size

MAGIC, BLOCK, PERCENTILE, FRAME = b"TMB1", 128, 0.9, 1 << 18
#: An index entry: minimum, width, start of the packed words, end of the exceptions.
INDEX = np.dtype([("low", "<u4"), ("width", "u1"), ("start", "<u4"), ("end", "<u4")])
FRAME_SCHEMA = "shard int, frame int, shard_start long, n_docs int, n_ids long, payload binary"


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """values: (n, 64) uint64 below 2**width; n x width words."""
    out, columns = np.zeros((width, len(values)), "<u8"), np.ascontiguousarray(values.T)
    for k in range(64):
        word, shift = divmod(k * width, 64)
        out[word] |= columns[k] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= columns[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T)


def _unpacked(words: np.ndarray, width: int) -> np.ndarray:
    columns, mask = np.ascontiguousarray(words.T), np.uint64((1 << width) - 1)
    out = np.empty((64, len(words)), "<u8")
    for k in range(64):
        word, shift = divmod(k * width, 64)
        out[k] = columns[word] >> np.uint64(shift)
        if shift + width > 64:
            out[k] |= columns[word + 1] << np.uint64(64 - shift)
        out[k] &= mask
    return np.ascontiguousarray(out.T)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value, 0 of 0."""
    return np.frexp(values.astype("f8"))[1].astype("u1")


def encode_frame(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    """The payload of these documents; documents without ids and frames without documents included."""
    flat = np.concatenate(ids).astype("<u4") if ids else np.zeros(0, "<u4")
    n = -(-len(flat) // BLOCK)
    blocks = np.pad(flat, (0, n * BLOCK - len(flat)), mode="edge" if len(flat) else "constant").reshape(n, BLOCK)
    low = blocks.min(1) if n else np.zeros(0, "<u4")
    above = (blocks - low[:, None]).astype("<u8")
    at = min(BLOCK - 1, int(np.ceil(PERCENTILE * BLOCK)) - 1)
    widths = np.maximum(1, _widths(np.partition(above, at, axis=1)[:, at])) if n else np.zeros(0, "u1")
    high = above >> widths[:, None].astype("<u8")
    rows, places = np.nonzero(high)
    starts = np.concatenate([[0], np.cumsum(widths.astype("<u4") * (BLOCK // 64))])[:-1].astype("<u4") if n else np.zeros(0, "<u4")
    words = np.empty(int(widths.sum(dtype="<u4")) * (BLOCK // 64), "<u8")
    kept = above & ((np.uint64(1) << widths[:, None].astype("<u8")) - np.uint64(1))
    for w in np.unique(widths).tolist():
        own = np.flatnonzero(widths == w)
        span = w * (BLOCK // 64)
        words[(starts[own].astype("i8")[:, None] + np.arange(span)).ravel()] = _packed(kept[own].reshape(-1, 64), w).ravel()
    index = np.empty(n, INDEX)
    index["low"], index["width"], index["start"], index["end"] = low, widths, starts, np.searchsorted(rows, np.arange(n), "right")
    return b"".join((
        MAGIC, struct.pack("<4I", len(doc_ids), len(flat), n, len(rows)),
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(), bytes(d is None for d in doc_ids),
        np.array([len(x) for x in ids], "<u4").tobytes(), index.tobytes(), words.tobytes(), places.astype("u1").tobytes(), high[rows, places].astype("<u4").tobytes(),
    ))


def decode_frame(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, the number of ids of each, all ids as uint32."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token frame")
    n_docs, n_ids, n, n_patches = struct.unpack_from("<4I", payload, 4)
    at = 20

    def take(count: int, kind) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(payload, kind, count, at)
        at += out.nbytes
        return out

    docs, null, sizes = take(n_docs, "<i8"), take(n_docs, "u1"), take(n_docs, "<u4")
    index = take(n, INDEX)
    widths = index["width"]
    words = take(int(widths.sum(dtype="<u4")) * (BLOCK // 64), "<u8")
    places, high = take(n_patches, "u1"), take(n_patches, "<u4")
    values = np.empty((n, BLOCK), "<u8")
    for w in np.unique(widths).tolist():
        own = np.flatnonzero(widths == w)
        span = w * (BLOCK // 64)
        own_words = words[index["start"][own].astype("i8")[:, None] + np.arange(span)]
        values[own] = _unpacked(own_words.reshape(-1, w), w).reshape(-1, BLOCK)
    rows = np.searchsorted(index["end"], np.arange(n_patches), "right")
    values[rows, places] |= high.astype("<u8") << widths[rows].astype("<u8")
    flat = (values + index["low"][:, None]).astype("<u4").ravel()[:n_ids]
    return [None if z else d for d, z in zip(docs.tolist(), null.tolist())], sizes, flat


def decode_block(payload: bytes, k: int) -> np.ndarray:
    """The ids of block k alone, as uint32: only its index entry, its packed words and its exceptions are unpacked."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token frame")
    n_docs, n_ids, n, n_patches = struct.unpack_from("<4I", payload, 4)
    if not 0 <= k < n:
        raise IndexError(k)
    at = 20 + 13 * n_docs
    index = np.frombuffer(payload, INDEX, n, at)
    low, width, start, end = (int(x) for x in index[k].tolist())
    at += index.nbytes
    n_words = int(index["start"][-1]) + int(index["width"][-1]) * (BLOCK // 64)
    values = _unpacked(np.frombuffer(payload, "<u8", width * (BLOCK // 64), at + 8 * start).reshape(-1, width), width).ravel()
    at += 8 * n_words
    first = int(index["end"][k - 1]) if k else 0
    places = np.frombuffer(payload, "u1", end - first, at + first)
    high = np.frombuffer(payload, "<u4", end - first, at + n_patches + 4 * first)
    values[places] |= high.astype("<u8") << np.uint64(width)
    return (values + np.uint64(low)).astype("<u4")[: n_ids - k * BLOCK]


def write_token_store(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes every whole text (null: empty) by the tokenizers file and writes the store.

    end_id, if any, follows the ids of each document. The rows are dealt by id ranges, so a
    shard is a range of ids and shards ascend; a hot source or group of copies spreads over all, and
    rows of one id, or without one, are dealt by how their texts begin.
    Each task writes its shard through Spark's committer, so a lost task is simply run again.
    Repeated ids are kept as documents of their own; an empty table gives a store without frames.
    """

    def frames(batches):
        shard, frame, start = TaskContext.get().partitionId(), 0, 0
        tokens, names, ids, size = byte_tokens(tokenizer), [], [], 0
        end = np.array([] if end_id is None else [end_id], "<u4")

        def row():
            return pa.RecordBatch.from_pylist([{"shard": shard, "frame": frame, "shard_start": start, "n_docs": len(names), "n_ids": size, "payload": encode_frame(names, ids)}], schema=schema)

        schema = pa.schema([("shard", pa.int32()), ("frame", pa.int32()), ("shard_start", pa.int64()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            doc_ids = iter(batch["doc_id"].to_pylist())
            for texts in by_size(batch["text"].to_pylist()):
                for x in tokens.encode_many(texts):
                    names.append(next(doc_ids))
                    ids.append(np.concatenate([x, end]))
                    size += len(ids[-1])
                    if size >= FRAME:
                        yield row()
                        frame, start, names, ids, size = frame + 1, start + size, [], [], 0
        if names:
            yield row()

    # beginnings of texts part the rows of a hot id, or of null ids
    rows = id_and_text(docs, id_col, text_col).repartitionByRange("doc_id", F.substring("text", 1, 64)).sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(frames, FRAME_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_store(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids as little-endian uint32, start the ids before them.

    Shards' totals, a number for each, are summed on the driver; nothing else is gathered.
    """
    store = spark.read.schema(FRAME_SCHEMA).parquet(path)
    totals = store.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()
    bases, base = [], 0
    for t in totals:
        bases.append((t["shard"], base))
        base += t["n"]
    bases = spark.createDataFrame(bases, "shard int, base long")

    def documents(batches):
        for batch in batches:
            for first, base, payload in zip(batch["shard_start"].to_pylist(), batch["base"].to_pylist(), batch["payload"]):
                names, sizes, flat = decode_frame(payload.as_buffer().to_pybytes())
                ends = np.cumsum(sizes, dtype="i8")
                starts, raw = ends - sizes, flat.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names, pa.int64()), pa.array(starts + first + base, pa.int64()), pa.array(sizes, pa.int64()),
                        pa.array([raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return store.select("shard", "shard_start", "payload").join(F.broadcast(bases), "shard").mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")
