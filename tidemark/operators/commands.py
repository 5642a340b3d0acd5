"""The command layer: deduplication, incremental counts, siblings by TF-IDF, triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import text as T


def with_hash(events: DataFrame, config: Config = DEFAULT) -> DataFrame:
    return events.withColumn("command_text", T.normalised(F.col("command_line"), config.command_chars)).withColumn("command_hash", T.hash16(F.col("command_text")))


def dedup(events: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One row a normalised command: counts, distinct sessions and addresses, first and last time."""
    hashed = with_hash(events.where(F.coalesce(F.col("command_line"), F.lit("")) != ""), config)
    over = T.truncated(F.col("command_line"), config.command_chars)
    # a row for each session and address first; the text is a grouping key, so it moves once and is never expanded
    per = hashed.groupBy("command_hash", "command_text", "session_id", "source_ip").agg(
        F.max(over).alias("over"), F.count("*").alias("n"), F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen")
    )
    sums = per.groupBy("command_hash", F.col("command_text").alias("command_line")).agg(
        F.max("over").alias("truncated"), F.sum("n").alias("occurrence_count"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )
    each = lambda c, name: per.where(F.col(c).isNotNull()).select("command_hash", c).distinct().groupBy("command_hash").agg(F.count("*").alias(name))
    out = sums.join(each("session_id", "unique_sessions"), "command_hash", "left").join(each("source_ip", "unique_source_ips"), "command_hash", "left")
    none = F.lit(0).cast("long")
    return out.select(
        "command_hash", "command_line", "truncated", "occurrence_count", F.coalesce("unique_sessions", none).alias("unique_sessions"),
        F.coalesce("unique_source_ips", none).alias("unique_source_ips"), "first_seen", "last_seen",
    )


def merge_counts(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored commands with a batch's added: counts add up, times widen, distinct counts stay as they were stored."""
    s, b = stored.alias("s"), batch.alias("b")
    both = s.join(b, "command_hash", "full_outer")
    pick = lambda c: F.coalesce(F.col(f"s.{c}"), F.col(f"b.{c}")).alias(c)
    total = F.coalesce(F.col("s.occurrence_count"), F.lit(0)) + F.coalesce(F.col("b.occurrence_count"), F.lit(0))
    return both.select(
        "command_hash", pick("command_line"), total.alias("occurrence_count"), pick("unique_sessions"), pick("unique_source_ips"),
        F.least("s.first_seen", "b.first_seen").alias("first_seen"), F.greatest("s.last_seen", "b.last_seen").alias("last_seen"),
    )


def siblings(events: DataFrame, sample: int = DEFAULT.sample_sessions, top: int = DEFAULT.top_siblings, item: str = "command_line", session: str = "session_id") -> DataFrame:
    """(anchor, sibling, tf, df, score, rank): what stands in the same sessions, by TF-IDF.

    Of each anchor the `sample` sessions with most of its events count. The pairs come from a join
    of at most sample sessions for each anchor with the sessions' distinct items.
    """
    counts = events.groupBy(session, item).agg(F.count("*").alias("n"))
    sessions = counts.agg(F.countDistinct(session)).first()[0]
    df = counts.groupBy(item).agg(F.count("*").alias("df"))
    busiest = Window.partitionBy(item).orderBy(F.desc("n"), F.col(session))
    taken = counts.withColumn("place", F.row_number().over(busiest)).where(F.col("place") <= sample).select(F.col(session), F.col(item).alias("anchor"))
    within = Window.partitionBy("anchor").orderBy(F.desc("events"), F.col(item))
    pairs = taken.join(counts, session).where(F.col("anchor") != F.col(item)).groupBy("anchor", item).agg(F.count("*").alias("tf"), F.sum("n").alias("events"))
    pairs = pairs.withColumn("bucket", F.row_number().over(within)).where(F.col("bucket") <= max(5 * top, 20))
    score = F.col("tf") * (F.log(F.lit(sessions + 1.0)) - F.log(F.col("df") + 1.0))
    ranked = Window.partitionBy("anchor").orderBy(F.desc("score"), F.desc("tf"), F.col(item))
    out = pairs.join(df, item).withColumn("score", F.round(score, 6)).withColumn("rank", F.row_number().over(ranked).cast("long")).where(F.col("rank") <= top)
    return out.select("anchor", F.col(item).alias("sibling"), "tf", "df", "score", "rank")


RUNTIME_REASONS = ("budget_exhausted", "cloud_parse_failed", "cloud_failed", "sample")


def triage_reasons(command: Column, confidence: Column, novelty: Column | None = None, failed: Column | None = None, config: Config = DEFAULT) -> Column:
    """Ordered reason codes of the rules that fire."""
    none = F.lit(None).cast("string")
    novel = F.lit(False) if novelty is None else (novelty >= config.novel_at) & (confidence >= config.novel_confidence)
    rate = int(config.sample_rate * (1 << 24))
    sampled = F.conv(F.substring(T.full_hash(command), 17, 6), 16, 10).cast("int") < rate  # by the text, so a re-run samples the same
    checks = [
        F.when(F.lit(False) if failed is None else failed, F.lit("local_failed")),
        F.when(confidence <= config.low_confidence, F.lit(f"low_confidence<={config.low_confidence}")),
        F.when(T.longest_base64(command) >= config.base64_run, F.lit("base64_blob")),
        F.when(T.has_ipv4(command), F.lit("ip_literal")),
        F.when(T.has_rare_tld(command, config.suspicious_tlds), F.lit("rare_tld")),
        F.when(novel, F.lit("novel_embedding")),
        *([F.when(sampled, F.lit("sample"))] if rate else []),
    ]
    return F.array_distinct(F.array_compact(F.array(*[F.coalesce(c, none) for c in checks])))


def gateable(reasons: Column) -> Column:
    """All reasons are a model's doubt; none at all is not."""
    doubt = lambda r: r.startswith("low_confidence") | r.startswith("novel_embedding") | r.startswith("sample")
    return (F.size(reasons) > 0) & F.forall(reasons, doubt)


def intel_skip(reasons: Column, intel: Column) -> Column:
    """The reason to skip the cloud for array<struct(override, malicious, n_malicious)>, null to go on."""
    known = F.size(intel) > 0
    clean = F.forall(intel, lambda v: v["override"] == "authoritative_clean")
    commodity = F.forall(intel, lambda v: v["malicious"] & (v["n_malicious"] >= 2))
    return F.when(known & clean, F.lit("intel_skip_authoritative_clean")).when(known & commodity & gateable(reasons), F.lit("intel_skip_commodity_consensus"))


def retriaged(stored: Column, fired: Column) -> Column:
    """Rules' reasons anew, of the stored ones those that only a run can give."""
    kept = F.filter(F.coalesce(stored, F.array().cast("array<string>")), lambda r: r.isin(*RUNTIME_REASONS))
    return F.array_sort(F.array_union(kept, fired))


def stale(commands: DataFrame, live_hash: str) -> DataFrame:
    """What was enriched under another configuration, with the reason."""
    why = F.when(F.col("llm_config_hash").isNull(), F.lit("legacy")).when(F.col("llm_config_hash") != live_hash, F.lit("changed"))
    return commands.withColumn("stale", why).where(F.col("stale").isNotNull())


def escalations(commands: DataFrame, cost: str, budget: float) -> DataFrame:
    """The most novel commands first while their summed cost stays within the budget.

    More than budget / least cost of them can't be paid, so only that many are ranked and summed.
    """
    least = commands.agg(F.min(cost)).first()[0]
    if not least or least <= 0:
        raise ValueError("costs must be positive")
    order = [F.desc("novelty_score"), F.col("command_hash")]
    payable = commands.orderBy(*order).limit(int(budget / least) + 1)
    summed = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return payable.withColumn("spent", F.sum(cost).over(summed)).where(F.col("spent") <= budget)
