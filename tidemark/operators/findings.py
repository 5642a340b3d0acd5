"""Ranked findings, whose analyst state outlives re-runs, and keyed updates of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vectors as V

STATUSES = ("new", "triaged", "confirmed", "dismissed")
KINDS = ("playbook", "campaign")
#: A stored finding.
STORED = "finding_id string, kind string, value string, score double, status string, status_history array<struct<ts:timestamp,from:string,to:string,note:string>>, first_seen_at timestamp, last_seen_at timestamp"


def playbook_findings(sessions: DataFrame) -> DataFrame:
    """One finding a playbook: sessions, distinct addresses, times, mean novelty, top intent. Outliers are none."""
    known = sessions.where(F.col("playbook_id").isNotNull() & (F.coalesce(F.col("cluster_id"), F.lit("")) != "outlier"))
    out = known.groupBy("playbook_id").agg(
        F.count("*").alias("n_sessions"), F.countDistinct("source_ip").alias("n_ips"), F.min("start_ts").alias("first_seen_at"), F.max("start_ts").alias("last_seen_at"), F.avg("mean_novelty_score").alias("novelty")
    )
    score = V.playbook_score(F.col("n_sessions"), F.coalesce("novelty", F.lit(0.0)))
    return out.select(T.finding_id("playbook", F.col("playbook_id")).alias("finding_id"), F.lit("playbook").alias("kind"), F.col("playbook_id").alias("value"), F.round(score, 6).alias("score"), "n_sessions", "n_ips", "first_seen_at", "last_seen_at")


def campaign_findings(campaigns: DataFrame) -> DataFrame:
    score = V.campaign_score(F.col("ip_count"), F.col("session_count"))
    return campaigns.select(T.finding_id("campaign", F.col("campaign_id")).alias("finding_id"), F.lit("campaign").alias("kind"), F.col("campaign_id").alias("value"), F.round(score, 6).alias("score"), F.col("session_count").alias("n_sessions"), F.col("ip_count").alias("n_ips"), F.col("first_seen").alias("first_seen_at"), F.col("last_seen").alias("last_seen_at"))


def upsert(stored: DataFrame, mined: DataFrame) -> DataFrame:
    """Mined findings with the stored status, history and first time; stored ones that weren't mined again stay."""
    s = stored.select("finding_id", *[F.col(c).alias(f"s_{c}") for c in stored.columns if c != "finding_id"])
    both = mined.join(s, "finding_id", "full_outer")
    history = F.coalesce("s_status_history", F.array().cast(dict(stored.dtypes)["status_history"]))
    pick = lambda c: F.coalesce(c, f"s_{c}").alias(c)
    return both.select(
        "finding_id", pick("kind"), pick("value"), pick("score"), F.coalesce("s_status", F.lit("new")).alias("status"), history.alias("status_history"),
        F.coalesce("s_first_seen_at", "first_seen_at").alias("first_seen_at"), pick("last_seen_at"),
    )


def set_status(findings: DataFrame, changes: DataFrame, as_of: Column) -> DataFrame:
    """Applies (finding_id, to_status, note); an equal status changes nothing, an unknown one is an error."""
    c = changes.select("finding_id", F.when(F.col("to_status").isin(*STATUSES), F.col("to_status")).otherwise(F.raise_error(F.concat(F.lit("unknown status: "), F.col("to_status")))).alias("to_status"), "note")
    both = findings.join(c, "finding_id", "left")
    moves = F.col("to_status").isNotNull() & (F.col("to_status") != F.col("status"))
    step = F.struct(as_of.alias("ts"), F.col("status").alias("from"), F.col("to_status").alias("to"), F.col("note").alias("note"))
    history = F.when(moves, F.array_append("status_history", step.cast(dict(findings.dtypes)["status_history"][6:-1]))).otherwise(F.col("status_history"))
    return both.withColumns({"status_history": history, "status": F.when(moves, F.col("to_status")).otherwise(F.col("status"))}).drop("to_status", "note")


def page(findings: DataFrame, statuses: list[str] | None = None, kinds: list[str] | None = None, offset: int = 0, size: int = 50) -> DataFrame:
    """Findings by score: new ones by default, all with an empty list."""
    wanted = ["new"] if statuses is None else statuses
    if bad := [s for s in wanted if s not in STATUSES] + [k for k in kinds or () if k not in KINDS]:
        raise ValueError(f"unknown: {bad}")
    out = findings.where(F.col("status").isin(*wanted)) if wanted else findings
    out = out.where(F.col("kind").isin(*kinds)) if kinds else out
    return out.orderBy(F.desc("score"), "finding_id").offset(offset).limit(min(max(size, 1), 500))


def patched(table: DataFrame, patch: DataFrame, key: str, clear: tuple[str, ...] = ()) -> DataFrame:
    """table with the patch's columns where it has a row of that key; there `clear` columns become null."""
    p = patch.select(key, *[F.col(c).alias(f"p_{c}") for c in patch.columns if c != key], F.lit(True).alias("p__there"))
    both, there = table.join(p, key, "left"), F.coalesce(F.col("p__there"), F.lit(False))
    return both.select(*[F.when(there, F.col(f"p_{c}")).otherwise(F.col(c)).alias(c) if c in patch.columns and c != key else F.when(~there, F.col(c)).alias(c) if c in clear else F.col(c) for c in table.columns])


def replaced(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """table with rows in place of those of the same key."""
    return table.join(rows.select(key), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def swap_partition(df: DataFrame, path: str, by: str) -> None:
    """Replaces the partitions that df has and leaves the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
