"""Best-fit-decreasing packing of whole documents into windows of a fixed length.

Piece lengths are whole numbers up to the window, so all pieces of one length are alike to the
packing. It therefore runs on the counts of each length, however many documents there are, and
yields a plan of runs: pieces of length s with ranks lo to hi go to windows from `seq` on. The
pieces themselves never leave the executors.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._common import id_and_text, written
from .byte_tokens import byte_tokens
from .units import by_size

PIECES = "doc_id long, start long, length int, doc_tokens long, ids binary, task int, place long"
PLAN = "p_length int, lo long, hi long, seq long, each long, at long"


class _Tightest:
    """A segment tree over remaining capacities; find(s): the least one, from s on, of an open window."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, capacity: int, is_open: bool) -> None:
        k = self.size + capacity
        self.open[k] = is_open
        while k > 1:
            k //= 2
            now = self.open[2 * k] or self.open[2 * k + 1]
            if self.open[k] == now:
                return
            self.open[k] = now

    def find(self, s: int) -> int | None:
        k = self.size + s
        if self.open[k]:
            return s
        while k > 1:  # up, to the first right neighbour that holds an open one
            if k % 2 == 0 and self.open[k + 1]:
                k += 1
                break
            k //= 2
        else:
            return None
        while k < self.size:
            k = 2 * k if self.open[2 * k] else 2 * k + 1
        return k - self.size


def plan(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts of piece lengths.

    Rows (length, lo, hi, seq, each, at): the piece of rank r, lo <= r < hi, goes to window
    seq + (r - lo) div each, at offset at + (r - lo) mod each * length. As a window that takes a
    piece is then the tightest for the next one of that length, it takes as many as fit.
    """
    tree, runs, out, windows = _Tightest(window), {}, [], 0

    def put(capacity: int, seq: int, n: int) -> None:
        if n and capacity:
            runs.setdefault(capacity, deque()).append((seq, n))
            tree.set(capacity, True)

    for s in sorted(counts, reverse=True):
        rank, left = 0, counts[s]
        while left:
            if (r := tree.find(s)) is None:
                r, seq, n = window, windows, -(-left // (window // s))
                windows += n
            else:
                seq, n = runs[r].popleft()
                if not runs[r]:
                    tree.set(r, False)
            each = r // s
            full = min(n, left // each)
            if full:
                out.append((s, rank, rank + full * each, seq, each, window - r))
                put(r - each * s, seq, full)
                rank, left = rank + full * each, left - full * each
            if left and full < n:  # fewer than `each` remain for one more window
                out.append((s, rank, rank + left, seq + full, each, window - r))
                put(r - left * s, seq + full, 1)
                rank, left, full = rank + left, 0, full + 1
            if full < n:
                runs.setdefault(r, deque()).appendleft((seq + full, n - full))
                tree.set(r, True)
    return out


def pieces(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids, task, place): documents cut into full windows and a rest.

    place counts the pieces of one length within a task. The result is a table in the shared
    folder, so both are fixed for good.
    """

    def cut(batches):
        task, tokens, seen = TaskContext.get().partitionId(), byte_tokens(tokenizer), {}
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids = iter(batch["doc_id"].to_pylist())
            for texts in by_size(batch["text"].to_pylist()):
                rows = []
                for x in tokens.encode_many(texts):
                    doc_id, raw = next(doc_ids), x.tobytes() + end
                    total = len(raw) // 4
                    for a in range(0, total, window):
                        n = min(window, total - a)
                        seen[n] = seen.get(n, -1) + 1
                        rows.append((doc_id, a, n, total, raw[4 * a : 4 * (a + n)], task, seen[n]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    names = ["doc_id", "start", "length", "doc_tokens", "ids", "task", "place"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
    return written(id_and_text(docs, id_col, text_col).mapInArrow(cut, PIECES), "pieces", compression="zstd")


def placed(table: DataFrame, window: int = 2048) -> DataFrame:
    """Adds sequence_id and offset to a table with (length, task, place).

    What the driver gathers is a count for each length, at most `window` rows. The plan that is
    broadcast depends on those alone.
    """
    spark = table.sparkSession
    counts = table.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(F.col("task").alias("f_task"), F.col("length").alias("f_length"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("f_rank"))
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = spark.createDataFrame(plan(total, window), PLAN)
    ranked = table.join(firsts, (F.col("task") == F.col("f_task")) & (F.col("length") == F.col("f_length"))).withColumn("f_rank", F.col("f_rank") + F.col("place"))
    at = ranked.join(F.broadcast(steps), (F.col("length") == F.col("p_length")) & (F.col("f_rank") >= F.col("lo")) & (F.col("f_rank") < F.col("hi")))
    nth = F.col("f_rank") - F.col("lo")
    return at.select(
        *[F.col(c) for c in table.columns if c not in ("task", "place")],
        (F.col("seq") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + nth % F.col("each") * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int | None = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents' pieces with their ids and their place: (doc_id, start, length, doc_tokens, ids, sequence_id, offset).

    A null text is empty, a null id stays null, rows with one id are documents of their own; a
    document without any id (empty text, no end id) has no piece; an empty table gives no row.
    """
    return placed(pieces(docs, tokenizer, window, end_id, id_col, text_col), window)


def sequences(packed: DataFrame, window: int = 2048, pad_id: int = 0) -> DataFrame:
    """One row a sequence: its padded ids and the parts it holds, at most `window` of them."""
    whole = packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids"))).alias("parts")
    )
    pad = np.array([pad_id], "<u4").tobytes()

    def joined(batches):
        for batch in batches:
            ids = [b"".join([p["ids"] for p in parts]) for parts in batch["parts"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["sequence_id"], pa.array([len(x) // 4 for x in ids], pa.int32()), pa.array([x + pad * (window - len(x) // 4) for x in ids], pa.binary()), batch["documents"]],
                names=["sequence_id", "n_tokens", "ids", "documents"],
            )

    kept = "array<struct<offset:bigint,doc_id:bigint,start:bigint,length:int>>"
    whole = whole.withColumn("documents", F.transform("parts", lambda p: F.struct(p["offset"].alias("offset"), p["doc_id"].alias("doc_id"), p["start"].alias("start"), p["length"].alias("length"))))
    return whole.mapInArrow(joined, f"sequence_id long, n_tokens int, ids binary, documents {kept}")
