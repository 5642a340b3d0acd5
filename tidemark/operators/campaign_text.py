"""Names, reasons and narratives of what was mined, and what a model's judgement falls back to."""

from __future__ import annotations

import hashlib
import json
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: What a comparison of two clusters may conclude (fixed values); the first of each pair serves where nothing else fits.
PAIR_VERDICTS = ("marginal_split", "accept_split")


def behaviour_name(playbook_names: Column, shown: int = 3) -> Column:
    """The first names joined, with how many more there are."""
    more = F.size(playbook_names) - shown
    return F.concat(F.array_join(F.slice(playbook_names, 1, shown), " + "), F.when(more > 0, F.concat(F.lit(" and "), more.cast("string"), F.lit(" more"))).otherwise(F.lit("")))


def behaviour_reason(ips: Column, playbooks: Column) -> Column:
    return F.format_string("%d addresses each ran the same %d playbooks", ips, playbooks)


def finding_narrative(kind: Column, sessions: Column, ips: Column) -> Column:
    return F.format_string("%s of %d sessions from %d addresses", F.initcap(kind), sessions, ips)


def closed_verdict(value: Column) -> Column:
    """The verdict if it is one of the known, else the first."""
    plain = F.lower(F.trim(value))
    return F.when(plain.isin(*PAIR_VERDICTS), plain).otherwise(F.lit(PAIR_VERDICTS[0]))


def local_fallback(intent: Column, confidence: Column, techniques: Column) -> Column:
    """What stands for an enrichment that is missing: unknown, 1, none."""
    return F.struct(F.coalesce(intent, F.lit("unknown")).alias("intent"), F.coalesce(confidence, F.lit(1)).alias("confidence"), F.coalesce(techniques, F.array().cast("array<string>")).alias("techniques"))


def cluster_text(sessions: Column, commands: Column, most_sessions: int = 5, most_commands: int = 15) -> Column:
    """What a model reads of a cluster: some session ids and commands."""
    return F.concat(F.lit("sessions: "), F.array_join(F.slice(sessions, 1, most_sessions), ", "), F.lit("\ncommands:\n"), F.array_join(F.slice(commands, 1, most_commands), "\n"))


def fingerprint(value: object) -> str:
    """16 hex digits that tell configurations apart, whatever the order of their keys."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:16]


def file_fingerprint(*paths: str) -> str:
    """The same over the contents of files; one that is missing counts as empty."""
    return fingerprint([Path(p).read_bytes().hex() if Path(p).is_file() else "" for p in paths])


def technique_counts(commands: DataFrame) -> DataFrame:
    """(technique, n): how many commands show each technique."""
    return commands.select(F.explode("techniques").alias("technique")).groupBy("technique").agg(F.count("*").alias("n"))


def deny_token(token: Column) -> Column:
    """A token as the list of denied ones has it; null if it can't be one."""
    plain = F.lower(F.trim(token))
    return F.when((F.length(plain) > 0) & (F.length(plain) <= 64) & ~plain.rlike(r"""[\s"'`\\]"""), plain)


def denied(stored: DataFrame, add: DataFrame | None = None, remove: DataFrame | None = None) -> DataFrame:
    """The list (token, rationale) with tokens added or replaced, and others removed."""
    from .findings import replaced

    clean = lambda df: df.withColumn("token", deny_token(F.col("token"))).where("token IS NOT NULL")
    out = stored if add is None else replaced(stored, clean(add).dropDuplicates(["token"]), "token")
    return out if remove is None else out.join(clean(remove.select("token")), "token", "left_anti")


def renamed_playbooks(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Sessions or centroids with new names (cluster_id, playbook_name) of their clusters."""
    new = names.groupBy("cluster_id").agg(F.min("playbook_name").alias("new_name"))
    return rows.join(new, "cluster_id", "left").withColumn("playbook_name", F.coalesce(T.clean_name(F.col("new_name")), F.col("playbook_name"))).drop("new_name")
