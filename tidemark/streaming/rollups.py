"""Incremental paths: the same rollups over a stream of event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def event_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)


def session_counts(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Counts by session, complete for events that are at most `late` behind."""
    return events.withWatermark("ts", late).groupBy("session_id").agg(
        F.count("*").alias("events"), F.count_if(F.col("action") == "command.input").alias("command_count"), F.count_if(F.col("action") == "login.success").alias("login_success_count"), F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts")
    )


def daily_counts(events: DataFrame, key: str, late: str = "1 day") -> DataFrame:
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 day"), key).agg(F.count("*").alias("n"))


def new_commands(events: DataFrame, late: str = "1 day") -> DataFrame:
    """Each normalised command when it is first seen within the watermark."""
    hashed = events.withColumn("command_hash", T.hash16(T.normalised(F.col("command_line"))))
    return hashed.withWatermark("ts", late).dropDuplicatesWithinWatermark(["command_hash"])


def upsert_table(stream: DataFrame, path: str, key: str, checkpoint: str) -> None:
    """Keeps a table of the latest row of each key: a stream in update mode replaces what its batches have anew.

    State lives as long as the stream's watermark says; the table is swapped as a whole, so a batch that
    is run again leaves it the same.
    """
    from ..operators import findings, store

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        stored = spark.read.parquet(path) if store.exists(spark, path) else batch.limit(0)
        store.swap(findings.replaced(stored, batch, key), path)

    q = stream.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def roll_up_closed(stream: DataFrame, events_path: str, path: str, checkpoint: str, closing: str = "session.closed") -> None:
    """Whenever sessions close, rolls them up anew from all their stored events and keeps them by session id.

    A batch only says which sessions have ended; late events of a session count when it closes, and a
    batch that is run again gives the same rows.
    """
    from ..operators import findings, rollups, scans, store

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        closed = scans.closed_sessions(batch, closing)
        rolled = rollups.sessions(scans.events_of(spark.read.parquet(events_path), closed))
        stored = spark.read.parquet(path) if store.exists(spark, path) else rolled.limit(0)
        store.swap(findings.replaced(stored, rolled, "session_id"), path)

    ended = stream.where(F.col("action") == closing)
    ended.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_batches(stream: DataFrame, merge, checkpoint: str) -> None:
    """Hands each micro-batch to merge(batch, batch_id), which must be idempotent by batch_id."""
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
