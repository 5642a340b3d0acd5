"""State of the intel worker: its queue, what providers have cost, and when one is left alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUEUE = "kind string, value string, priority double, enqueued_at timestamp, attempts int, error string"
STATE = "provider string, day date, spent int, failures int, open_until timestamp"


def enqueued(stored: DataFrame, artifacts: DataFrame, as_of: Column) -> DataFrame:
    """The queue with these (kind, value, priority): their priority and time are refreshed, attempts stay."""
    new = artifacts.groupBy("kind", "value").agg(F.max("priority").alias("n_priority"))
    both = stored.join(new, ["kind", "value"], "full_outer")
    fresh = F.col("n_priority").isNotNull()
    return both.select(
        "kind", "value", F.coalesce("n_priority", "priority").alias("priority"), F.when(fresh, as_of).otherwise(F.col("enqueued_at")).alias("enqueued_at"),
        F.coalesce("attempts", F.lit(0)).alias("attempts"), F.col("error"),
    )


def done(stored: DataFrame, finished: DataFrame) -> DataFrame:
    """The queue without what is finished."""
    return stored.join(finished.select("kind", "value").distinct(), ["kind", "value"], "left_anti")


def failed(stored: DataFrame, errors: DataFrame) -> DataFrame:
    """The queue with one attempt more, and the error, where (kind, value, error) tells of one."""
    e = errors.groupBy("kind", "value").agg(F.max("error").alias("n_error"))
    both = stored.join(e, ["kind", "value"], "left")
    bad = F.col("n_error").isNotNull()
    return both.select("kind", "value", "priority", "enqueued_at", (F.col("attempts") + bad.cast("int")).alias("attempts"), F.coalesce("n_error", "error").alias("error"))


def selected(queue: DataFrame, kinds: list[str], top: int) -> DataFrame:
    """The most urgent entries over all kinds that a provider handles."""
    return queue.where(F.col("kind").isin(*kinds)).orderBy(F.desc("priority"), "kind", "value").limit(top)


def charged(state: DataFrame, calls: DataFrame, as_of: Column, most_failures: int = 3, rest_minutes: int = 30) -> DataFrame:
    """Providers' state after calls (provider, ok, ts), in order of time.

    Each call is charged to its day. A success resets the failures; with most_failures in a row the
    breaker opens for a while.
    """
    day = F.to_date(as_of)
    order = Window.partitionBy("provider").orderBy(F.desc("ts"))
    tail = calls.withColumn("place", F.row_number().over(order))
    last_ok = tail.where("ok").groupBy("provider").agg(F.min("place").alias("ok_place"))
    new = tail.join(last_ok, "provider", "left").groupBy("provider").agg(
        F.count_if(F.to_date("ts") == day).cast("int").alias("n"), F.max(F.col("ok_place").isNotNull()).alias("reset"),
        F.count_if(~F.col("ok") & (F.col("ok_place").isNull() | (F.col("place") < F.col("ok_place")))).cast("int").alias("bad"),
    )
    both = state.join(new, "provider", "full_outer")
    today = F.when(F.col("day") == day, F.coalesce("spent", F.lit(0))).otherwise(F.lit(0))
    failures = F.when(F.col("n").isNull(), F.coalesce("failures", F.lit(0))).otherwise(F.when(F.col("reset"), F.lit(0)).otherwise(F.coalesce("failures", F.lit(0))) + F.col("bad"))
    rest = as_of + F.make_dt_interval(mins=F.lit(rest_minutes))
    return both.select("provider", day.alias("day"), (today + F.coalesce("n", F.lit(0))).alias("spent"), failures.alias("failures"), F.when((failures >= most_failures) & F.col("n").isNotNull(), rest).otherwise(F.col("open_until")).alias("open_until"))


def left_of(budgets: DataFrame, state: DataFrame, as_of: Column) -> DataFrame:
    """(provider, remaining): calls that today's budget still has, 0 while the breaker is open, null without a budget."""
    spent = F.when(F.col("day") == F.to_date(as_of), F.col("spent")).otherwise(F.lit(0))
    both = budgets.join(state, "provider", "left")
    remaining = F.greatest(F.col("budget") - F.coalesce(spent, F.lit(0)), F.lit(0))
    return both.select("provider", F.when(F.col("open_until") > as_of, F.lit(0)).otherwise(remaining).alias("remaining"))


def due(artifacts: DataFrame, blocks: DataFrame, provider: str, as_of: Column) -> DataFrame:
    """Artifacts without an answer of the provider that still holds."""
    fresh = blocks.where((F.col("provider") == provider) & (F.col("ttl_expires_at") > as_of)).select("kind", "value")
    return artifacts.join(fresh, ["kind", "value"], "left_anti")


def summary(consensus: DataFrame) -> DataFrame:
    """(kind, value, malicious, confidence, n_malicious): what rollups show of a verdict; derived or missing verdicts are null."""
    shown = ~F.coalesce(F.col("derived"), F.lit(False)) & F.col("malicious").isNotNull()
    pick = lambda c: F.when(shown, F.col(c)).alias(c)
    return consensus.select("kind", "value", pick("malicious"), pick("confidence"), pick("n_malicious"))
