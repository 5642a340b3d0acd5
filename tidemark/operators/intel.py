"""Reputation of addresses and URLs: discovery, ranking, provider lookups, merging, consensus."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import network as N
from ..functions import vectors as V
from ..functions import verdicts as R


def indicator_counts(commands: DataFrame, kind: str, canonical: Callable[[Column], Column]) -> DataFrame:
    """(value, n): canonical indicators of one type with the number of commands that hold them."""
    hit = commands.select("command_hash", F.explode("indicators").alias("i")).where(F.col("i.type") == kind)
    return hit.select("command_hash", canonical(F.coalesce("i.ip", "i.url", "i.domain", "i.file_hash")).alias("value")).where("value IS NOT NULL").distinct().groupBy("value").agg(F.count("*").alias("n"))


def queue(artifacts: DataFrame, as_of: Column, limit: int, base: float = DEFAULT.centrality_base, never: DataFrame | None = None, config: Config = DEFAULT) -> DataFrame:
    """The most urgent artifacts (kind, value, novelty, confidence, n, last_seen), without addresses in the `never` networks."""
    rows = artifacts
    if never is not None:
        inside = N.in_ranges(rows.where("kind = 'ip'").select(F.col("value").alias("ip")).distinct(), never).select(F.col("ip").alias("value")).distinct()
        rows = rows.join(inside, "value", "left_anti")
    age = F.greatest(F.lit(0.0), (F.unix_micros(as_of) - F.unix_micros("last_seen")) / 3.6e9)
    p = V.priority(F.col("novelty"), F.col("confidence"), V.centrality(F.col("n"), base), age, config.priority_weights, config.half_life_hours)
    return rows.withColumn("priority", F.round(p, 6)).orderBy(F.desc("priority"), "kind", "value").limit(limit)


@dataclass(frozen=True)
class Provider:
    """A source of verdicts: what it handles, how long an answer holds, calls a day, and how it answers.

    answer(artifacts) gives (kind, value, verdict). Offline it is a join with a table of responses; a
    live client would be a mapInArrow behind the same signature.
    """

    name: str
    kinds: tuple[str, ...]
    ttl_days: int
    budget: int | None
    answer: Callable[[DataFrame], DataFrame]


def listed(feed: DataFrame, verdict: Column, key: str = "ip") -> Callable[[DataFrame], DataFrame]:
    """A provider that is a list: what stands in it has the verdict."""
    return lambda artifacts: artifacts.join(feed.select(F.col(key).alias("value")).distinct(), "value").select("kind", "value", verdict.alias("verdict"))


def refreshed(artifacts: DataFrame, providers: list[Provider], as_of: Column) -> DataFrame:
    """(kind, value, provider, verdict, fetched_at, ttl_expires_at) of every provider's answers within its budget."""
    out = None
    for p in providers:
        asked = artifacts.where(F.col("kind").isin(*p.kinds))
        if p.budget is not None:
            asked = asked.orderBy(F.desc("priority"), "kind", "value").limit(p.budget)
        got = p.answer(asked).select("kind", "value", F.lit(p.name).alias("provider"), "verdict", as_of.alias("fetched_at"), (as_of + F.expr(f"INTERVAL {p.ttl_days} DAYS")).alias("ttl_expires_at"))
        out = got if out is None else out.unionByName(got)
    return out


def merged(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """Provider blocks by artifact: a newer block takes the older one's place."""
    both = stored.unionByName(fetched)
    return both.groupBy("kind", "value", "provider").agg(F.max_by(F.struct("verdict", "fetched_at", "ttl_expires_at"), "fetched_at").alias("b")).select("kind", "value", "provider", "b.*")


def judged(blocks: DataFrame) -> DataFrame:
    """(kind, value, consensus) over an artifact's provider blocks, in provider order."""
    votes = F.transform(F.array_sort(F.collect_list(F.struct("provider", "verdict"))), lambda x: x["verdict"])
    return blocks.groupBy("kind", "value").agg(votes.alias("votes")).select("kind", "value", R.consensus(F.col("votes")).alias("consensus"))


def reapplied(blocks: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Blocks with verdicts worked out anew by today's rules; providers without a rule keep theirs."""
    verdict = F.col("verdict")
    for name, rule in rules.items():
        verdict = F.when(F.col("provider") == name, rule).otherwise(verdict)
    return blocks.withColumn("verdict", verdict)


def consensus_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    b, a = before.select("kind", "value", F.col("consensus.malicious").alias("was")), after.select("kind", "value", F.col("consensus.malicious").alias("now"))
    return b.join(a, ["kind", "value"]).groupBy("kind").agg(F.count_if(F.col("was") != F.col("now")).alias("changed"), F.count("*").alias("n"))


def attributed(rows: DataFrame, verdicts: DataFrame, ip_col: str = "source_ip") -> DataFrame:
    """rows with their address's verdict; no document is null, which is not the same as not malicious."""
    v = verdicts.where("kind = 'ip'").select(F.col("value").alias(ip_col), F.col("consensus").alias("source_ip_intel"))
    return rows.join(v, ip_col, "left")


def artifact_pane(blocks: DataFrame, rollup: DataFrame) -> DataFrame:
    """Intel and rollup of each address side by side, whichever there is."""
    left = judged(blocks.where("kind = 'ip'")).select(F.col("value").alias("ip"), "consensus")
    right = rollup.withColumn("ip", N.canonical_ip(F.col("source_ip")))
    return left.join(right, "ip", "full_outer")


def url_pane(urls: DataFrame, verdicts: DataFrame, commands: DataFrame) -> DataFrame:
    """Each URL with its own verdict, that of its literal host, and the number of commands that name it."""
    of = lambda kind, key, name: verdicts.where(F.col("kind") == kind).select(F.col("value").alias(key), F.col("consensus").alias(name))
    base = urls.select("url", N.canonical_url(F.col("url")).alias("canonical"), N.host_ip(F.col("url")).alias("host"))
    named = indicator_counts(commands, "url", N.canonical_url).select(F.col("value").alias("canonical"), F.col("n").alias("commands"))
    return base.join(of("url", "canonical", "url_intel"), "canonical", "left").join(of("ip", "host", "host_intel"), "host", "left").join(named, "canonical", "left")


def spend(calls: DataFrame, tokens_in: float = 3.0, tokens_out: float = 15.0) -> DataFrame:
    """(day, usd) of calls (ts, n_in, n_out) at prices for a million tokens."""
    cost = (F.col("n_in") * tokens_in + F.col("n_out") * tokens_out) / 1e6
    return calls.groupBy(F.to_date("ts").alias("day")).agg(F.round(F.sum(cost), 6).alias("usd"))


def depth(queued: DataFrame) -> DataFrame:
    return queued.groupBy("kind").agg(F.count("*").alias("n"))
