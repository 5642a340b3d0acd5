"""Text for models and names from them. Models are functions of DataFrames with offline stand-ins."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Intents that an enrichment may have (fixed values).
INTENTS = (
    "reconnaissance", "initial_access", "execution", "persistence", "privilege_escalation", "defense_evasion", "credential_access", "discovery",
    "lateral_movement", "collection", "command_and_control", "exfiltration", "impact", "cryptomining", "benign", "unknown",
)


def embed_text(command: Column, intent: Column, description: Column, siblings: Column) -> Column:
    """What stands for a command before the embedding model."""
    line = lambda name, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{name}: "), value))
    return F.concat_ws("\n", line("command", command), line("intent", intent), line("description", description), line("seen with", F.array_join(F.coalesce(siblings, F.array().cast("array<string>")), " | ")))


def prompt(template: str, **parts: Column) -> Column:
    """The template with {name} put in; an empty part reads (none)."""
    out = F.lit(template)
    for name, value in parts.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(F.nullif(value, F.lit("")), F.lit("(none)")))
    return out


def rule_based(commands: DataFrame) -> DataFrame:
    """The offline enrichment: intent by what the line calls, confidence by how clear that is."""
    c = F.col("command_line")
    intent = (
        F.when(c.rlike(r"(?i)\b(wget|curl|tftp|ftpget)\b"), F.lit("execution")).when(c.rlike(r"(?i)\b(crontab|systemctl|rc\.local|authorized_keys)\b"), F.lit("persistence"))
        .when(c.rlike(r"(?i)\b(passwd|shadow|chpasswd)\b"), F.lit("credential_access")).when(c.rlike(r"(?i)\b(rm\s+-rf|history\s+-c|unset\s+HISTFILE)\b"), F.lit("defense_evasion"))
        .when(c.rlike(r"(?i)\b(uname|whoami|id|cat\s+/proc|lscpu|nproc|free|w)\b"), F.lit("reconnaissance")).otherwise(F.lit("unknown"))
    )
    return commands.withColumns({"intent": intent, "confidence": F.when(intent == "unknown", 3).otherwise(7)})


def hashed_embedding(size: int = 64, n: int = 3) -> Callable[[Column], Column]:
    """The offline embedding: signed counts of hashed character n-grams, unit length."""

    def embed(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            v, t = np.zeros(size), f" {text or ''} "
            for k in range(len(t) - n + 1):
                h = int.from_bytes(hashlib.blake2b(t[k : k + n].encode(), digest_size=8).digest(), "little")
                v[h % size] += 1 if h >> 63 else -1
            norm = np.linalg.norm(v)
            out.append((v / norm if norm else v).tolist())
        return pa.array(out, pa.list_(pa.float64()))

    return lambda text: F.arrow_udf(embed, "array<double>")(text)


def validated(reply: Column, known_ids: Column) -> Column:
    """A model's JSON reply as struct(intent, confidence, techniques): closed intents, known ids, 1 to 10; null if it is no JSON."""
    r = F.from_json(T.without_thoughts(reply), "intent string, confidence string, techniques array<string>")
    intent = F.when(F.lower(F.trim(r["intent"])).isin(*INTENTS), F.lower(F.trim(r["intent"]))).otherwise(F.lit("unknown"))
    ids = T.mitre_ids(F.coalesce(r["techniques"], F.array().cast("array<string>")), known_ids)
    return F.when(r["intent"].isNotNull() | r["confidence"].isNotNull(), F.struct(intent.alias("intent"), T.coerced_confidence(r["confidence"]).alias("confidence"), ids.alias("techniques"), (F.size(F.coalesce(r["techniques"], F.array().cast("array<string>"))) - F.size(ids)).alias("dropped")))


def asked_again(rows: DataFrame, ask: Callable[[DataFrame], DataFrame], known_ids: Column, tries: int = 3, key: str = "command_hash") -> DataFrame:
    """(key, enrichment, tries): replies of a model, asked again with the bad reply as feedback until they are JSON.

    ask(rows with feedback) gives (key, reply). What stays bad after the last try has a null enrichment.
    """
    out, todo = None, rows.withColumn("feedback", F.lit(None).cast("string"))
    for n in range(1, tries + 1):
        judged = ask(todo).select(key, "reply", validated(F.col("reply"), known_ids).alias("enrichment"))
        good = judged.where(F.col("enrichment").isNotNull() | F.lit(n == tries)).select(key, "enrichment", F.lit(n).alias("tries"))
        out = good if out is None else out.unionByName(good)
        bad = judged.where(F.col("enrichment").isNull()).select(key, F.col("reply").alias("feedback"))
        todo = rows.join(bad, key)
    return out


def unembedded(commands: DataFrame, cache: DataFrame, live_hash: str) -> DataFrame:
    """Commands whose embedding isn't of the live configuration."""
    return commands.join(cache.where(F.col("embed_config_hash") == live_hash).select("command_hash"), "command_hash", "left_anti")


def collisions(current: DataFrame, earlier: DataFrame) -> DataFrame:
    """(key, renamable, frozen): names, trimmed and lower-cased, that several playbooks share and at least one of this run bears."""
    tag = lambda df, now: df.select("playbook_id", F.lower(F.trim("playbook_name")).alias("key"), F.lit(now).alias("now"))
    older = earlier.join(current.select("playbook_id"), "playbook_id", "left_anti")
    both = tag(current, True).unionByName(tag(older, False)).where("key <> ''")
    groups = both.groupBy("key").agg(F.count_if("now").alias("renamable"), F.count_if(~F.col("now")).alias("frozen"))
    return groups.where((F.col("renamable") >= 1) & (F.col("renamable") + F.col("frozen") > 1))


def newest_names(runs: DataFrame) -> DataFrame:
    """(playbook_id, playbook_name, samples) over runs: the newest name wins, samples are united."""
    newest = runs.groupBy("playbook_id").agg(F.max_by("playbook_name", F.struct("ts", "playbook_name")).alias("playbook_name"))
    each = runs.select("playbook_id", F.explode("samples").alias("sample")).distinct()  # before they are collected
    united = each.groupBy("playbook_id").agg(F.array_sort(F.collect_list("sample")).alias("samples"))
    return newest.join(united, "playbook_id", "left").select("playbook_id", "playbook_name", F.coalesce("samples", F.array().cast("array<string>")).alias("samples"))


def default_name(top_commands: Column, intent: Column) -> Column:
    """The offline name of a playbook: its intent and its two leading commands."""
    heads = F.transform(F.slice(top_commands, 1, 2), lambda c: F.regexp_extract(c, r"(\S+)", 1))
    return T.clean_name(F.concat_ws(" ", F.initcap(F.translate(intent, "_", " ")), F.array_join(heads, " ")))


def disambiguated(rows: DataFrame, key: str = "playbook_name", by: str = "playbook_id") -> DataFrame:
    """Names that several playbooks share, each with the end of its own id."""
    n = rows.groupBy(F.lower(F.trim(key)).alias("k")).agg(F.count("*").alias("n"))
    both = rows.withColumn("k", F.lower(F.trim(key))).join(n, "k")
    return both.withColumn(key, F.when(F.col("n") > 1, F.concat(F.trim(key), F.lit(" "), F.right(by, F.lit(4)))).otherwise(F.trim(key))).drop("k", "n")
