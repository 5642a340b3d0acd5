"""Tables that are kept between runs: replaced, merged, swapped, and read from where a run left off."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def ensure(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at path; an empty one of that schema is made if there is none."""
    if not exists(spark, path):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def swap(df: DataFrame, path: str, least_rows: int = 0) -> int:
    """Writes beside path, counts what was written, and only then takes the old table's place."""
    spark = df.sparkSession
    new = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    df.write.parquet(new)
    n = spark.read.parquet(new).count()
    fs, fresh = _fs(spark, new)
    if n < least_rows:
        fs.delete(fresh, True)
        raise ValueError(f"{n} rows were written, {least_rows} are wanted")
    # the old table is moved aside and goes last, so at every moment one of both is whole
    _, old = _fs(spark, path)
    _, aside = _fs(spark, f"{new}-old")
    there = fs.exists(old)
    if there and not fs.rename(old, aside):
        raise OSError(f"could not move {path} aside")
    if not fs.rename(fresh, old):
        if there:
            fs.rename(aside, old)
        raise OSError(f"could not move {new} to {path}")
    if there:
        fs.delete(aside, True)
    spark.catalog.refreshByPath(path)
    return n


@contextmanager
def locked(spark: SparkSession, path: str):
    """Holds a lock file while a run works, so that a second run of the same kind fails at once.

    A run that is killed leaves it; whoever knows that none works any more removes the file.
    """
    fs, where = _fs(spark, path)
    if not fs.createNewFile(where):
        raise BlockingIOError(f"another run holds {path}")
    try:
        yield
    finally:
        fs.delete(where, False)


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, where = _fs(spark, path)
        fs.delete(where, True)


def since(rows: DataFrame, state: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """Rows later than the state's mark of that key; all without one."""
    mark = state.where(F.col("key") == key).agg(F.max("at").alias("mark"))
    return rows.join(F.broadcast(mark)).where(F.col("mark").isNull() | (F.col(ts) > F.col("mark"))).drop("mark")


def marked(state: DataFrame, rows: DataFrame, key: str, ts: str = "ts") -> DataFrame:
    """The state with the key's mark at the latest row; an empty batch leaves it."""
    new = rows.agg(F.max(ts).alias("at")).where("at IS NOT NULL").select(F.lit(key).alias("key"), "at")
    return state.unionByName(new).groupBy("key").agg(F.max("at").alias("at"))


def stamped(cache: DataFrame, rows: DataFrame, columns: dict) -> DataFrame:
    """The cache with the rows' hashes set to these columns; other columns of known hashes stay."""
    new = rows.select("command_hash").distinct().withColumns({f"n_{c}": F.lit(v) for c, v in columns.items()} | {"n_there": F.lit(True)})
    both = cache.join(new, "command_hash", "full_outer")
    return both.select("command_hash", *[F.when(F.col("n_there"), F.col(f"n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in cache.columns if c != "command_hash"])
