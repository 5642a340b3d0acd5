"""Shared plumbing: scratch tables in the cluster's shared folder, and text columns."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null document id where an order is needed: nulls sort before every id. A document of this very id,
#: the least there is, counts as one without an id.
NULL_ID = -(2**63)

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only where the session names none (single-machine tests) is one made here.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; it is removed when the driver ends."""
    path = f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}/{name}"
    if not _made:
        atexit.register(_remove_all)
    _made.append((spark, path.rsplit("/", 1)[0]))
    return path


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _remove_all() -> None:
    for spark, path in _made:
        try:
            _remove(spark, path)
        except Exception:  # the session has ended; its folder goes with the cluster
            return


#: With it, shuffle files go when the query that made them ends, not when the driver collects garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """df as a table in the shared folder: computed once, and not lost with an executor."""
    spark = df.sparkSession
    path, before = scratch_path(spark, name), spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.tm_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Removes tables of written() that nothing reads any more."""
    for t in tables:
        _remove(t.sparkSession, t.tm_path)


def scratch_mark() -> int:
    """A mark for dropped_since()."""
    return len(_made)


def dropped_since(mark: int, *keep: DataFrame) -> None:
    """Removes all tables that were written since the mark but those to keep; nothing may read them any more."""
    kept = {t.tm_path.rsplit("/", 1)[0] for t in keep}
    for spark, path in _made[mark:]:
        if path not in kept:
            _remove(spark, path)
    _made[mark:] = [m for m in _made[mark:] if m[1] in kept]


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), a null text as the empty one; other columns can't clash."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )


def row_key(text: str | Column = "text") -> Column:
    """Tells rows that share a document id apart by their text."""
    return F.xxhash64(text)


def order_id(col: str | Column = "doc_id") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(NULL_ID))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
