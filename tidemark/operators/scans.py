"""Which rows a run takes up: closed sessions, windows of time, and what is to be done again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .commands import with_hash


def closed_sessions(events: DataFrame, action: str = "session.closed") -> DataFrame:
    """(session_id, closed_at) of sessions that have ended."""
    return events.where(F.col("action") == action).groupBy("session_id").agg(F.max("ts").alias("closed_at"))


def events_of(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """All events of the given sessions."""
    return events.join(sessions.select("session_id").distinct(), "session_id", "left_semi")


def commands_of_sessions(events: DataFrame) -> DataFrame:
    """(session_id, command_hash, n) of the commands that sessions ran."""
    hashed = with_hash(events.where((F.col("action") == "command.input") & F.col("command_line").isNotNull()))
    return hashed.groupBy("session_id", "command_hash").agg(F.count("*").alias("n"))


def in_window(rows: DataFrame, ts: str, as_of: Column, days: int | None) -> DataFrame:
    """Rows since the start of the day that many days before; all rows without a number."""
    if days is None:
        return rows
    return rows.where(F.col(ts) >= F.date_trunc("day", as_of - F.make_dt_interval(F.lit(days))))


def novel_local(commands: DataFrame, at: float, low: int, high: int) -> DataFrame:
    """Locally enriched commands that are novel and of middling confidence, the most novel first."""
    hit = (F.col("provider") == "local") & (F.col("novelty_score") >= at) & F.col("confidence").between(low, high)
    return commands.where(hit).orderBy(F.desc("novelty_score"), "command_hash")


def to_embed_again(commands: DataFrame) -> DataFrame:
    return commands.where(F.col("embedding").isNotNull())


def to_enrich_again(commands: DataFrame) -> DataFrame:
    return commands.where(F.col("command_line").isNotNull())


def to_triage_again(commands: DataFrame, as_of: Column, days: int | None = None, ts: str = "last_seen") -> DataFrame:
    return in_window(to_enrich_again(commands), ts, as_of, days)


def all_have_intel(wanted: DataFrame, known: DataFrame, key: str = "command_hash", ip: str = "source_ip") -> DataFrame:
    """(key, complete): whether every address of a key has intel; the gate is open only then."""
    have = known.select(F.col(ip), F.lit(1).alias("have")).distinct()
    return wanted.select(key, ip).distinct().join(have, ip, "left").groupBy(key).agg((F.count("*") == F.count("have")).alias("complete"))


def without_rules(reasons: Column, rules: list[str]) -> Column:
    """Reasons without those of the rules; a rule may carry a threshold behind its name."""
    return F.filter(reasons, lambda r: ~F.regexp_extract(r, r"^([a-z0-9_]+)", 1).isin(*rules))


def set_reasons(reasons: Column) -> Column:
    """Null instead of no reason, as it is stored."""
    return F.when(F.size(reasons) > 0, reasons)
