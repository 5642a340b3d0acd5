"""Verdicts of reputation sources as structs, and their consensus. A null vote is no opinion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VERDICT = "struct<malicious:boolean,label:string,confidence:int,tags:array<string>,authoritative_clean:boolean,evidence_direct:boolean>"


def verdict(malicious=None, label=None, confidence=None, tags=None, clean=False, direct=False) -> Column:
    lit = lambda x, t: (x if isinstance(x, Column) else F.lit(x)).cast(t)
    no_tags = F.array().cast("array<string>")
    return F.struct(
        lit(malicious, "boolean").alias("malicious"), lit(label, "string").alias("label"), lit(confidence, "int").alias("confidence"),
        (no_tags if tags is None else tags).alias("tags"), lit(clean, "boolean").alias("authoritative_clean"), lit(direct, "boolean").alias("evidence_direct"),
    )


def abuse(score: Column, reports: Column, usage: Column, whitelisted: Column) -> Column:
    """Community reports: a white list wins, a score from 50 on votes, less only informs."""
    plain = F.lower(F.translate(usage, " /", "__"))
    used = F.when(F.trim(F.coalesce(usage, F.lit(""))) != "", F.array(F.concat(F.lit("abuseipdb_usage:"), plain))).otherwise(F.array().cast("array<string>"))
    first = lambda tag: F.concat(F.array(tag), used)
    sure = F.least(F.greatest(5 + F.bround((score - 50) / 10.0, 0), F.lit(5.0)), F.lit(10.0))
    return (
        F.when(score.isNull(), verdict())
        .when(F.coalesce(whitelisted, F.lit(False)), verdict(False, "abuseipdb_whitelisted", 8, first(F.lit("abuseipdb_whitelisted")), clean=True))
        .when(score >= 50, verdict(True, "abuseipdb_high", sure, first(F.concat(F.lit("abuseipdb_score_"), score.cast("string")))))
        .when(F.coalesce(reports, F.lit(0)) > 0, verdict(None, "abuseipdb_low", None, first(F.concat(F.lit("abuseipdb_low_score_"), score.cast("string")))))
        .otherwise(verdict(tags=used))
    )


def noise(classification: Column, is_noise: Column, riot: Column, name: Column) -> Column:
    """A scanner watch: malicious, benign, suspicious, known-good infrastructure, noise, in this order."""
    c, who = F.lower(F.trim(F.coalesce(classification, F.lit("")))), F.trim(F.coalesce(name, F.lit("")))
    tags = lambda kind: F.filter(F.array(F.lit(f"greynoise_{kind}"), who), lambda t: t != "")
    out = lambda kind, vote, sure, **more: verdict(vote, f"greynoise_{kind}", sure, tags(kind), **more)
    return (
        F.when(c == "malicious", out("malicious", True, 9, direct=True))
        .when(c == "benign", out("benign", False, 8, clean=True))
        .when(c == "suspicious", out("suspicious", None, 5))
        .when(F.coalesce(riot, F.lit(False)), out("riot", False, 8, clean=True))
        .when(F.coalesce(is_noise, F.lit(False)), out("noise", None, 6))
        .otherwise(verdict())
    )


#: What a feed writes where it has nothing (fixed values).
EMPTY = ("", "none", "null")


def _plain(value: Column) -> Column:
    """Trimmed and lower-cased; null instead of nothing."""
    text = F.lower(F.trim(value))
    return F.when(~text.isin(*EMPTY), text)


def threat_entries(entries: Column) -> Column:
    """Verdict of array<struct(confidence_level, threat_type, malware, malware_alias)>.

    The entry with the highest level speaks, of equal ones the first. From 50 on it votes, with 5 to 10; less
    only informs. Entries are the community's, so they are no direct evidence.
    """
    known = F.coalesce(entries, F.array().cast("array<struct<confidence_level:int,threat_type:string,malware:string,malware_alias:string>>"))
    ranked = F.transform(known, lambda e, k: F.struct(F.coalesce(e["confidence_level"], F.lit(0)).alias("level"), (-k).alias("place"), _plain(e["threat_type"]).alias("kind"), _plain(e["malware"]).alias("malware"), _plain(e["malware_alias"]).alias("alias")))
    best = F.array_max(ranked)
    sure = F.least(F.greatest(5 + F.bround((best["level"] - 50) / 10.0, 0), F.lit(5.0)), F.lit(10.0))
    kind_tag = F.when(best["kind"].isNotNull(), F.concat(F.lit("threatfox_type_"), F.translate(best["kind"], " ", "_")))
    tags = F.array_distinct(F.array_compact(F.array(F.lit("threatfox_match"), kind_tag, best["malware"], best["alias"])))
    high = verdict(True, F.coalesce(F.concat(F.lit("threatfox_"), best["kind"]), F.lit("threatfox_match")), sure, tags)
    low = verdict(None, "threatfox_low", None, F.array_compact(F.array(F.lit("threatfox_low_confidence"), best["malware"])))
    return F.when(F.size(known) == 0, verdict()).when(best["level"] < 50, low).otherwise(high)


def listed_url(there: Column, threat: Column, tags: Column) -> Column:
    """Verdict of a URL list's row: what stands there is malicious with 9; tags that say nothing go."""
    kind = _plain(threat)
    own = F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda t: _plain(t))
    kind_tag = F.when(kind.isNotNull() & (kind != "unknown"), F.concat(F.lit("urlhaus_threat_"), kind))
    all_tags = F.array_compact(F.concat(F.array(F.lit("urlhaus_match"), kind_tag), own))
    hit = verdict(True, F.concat(F.lit("urlhaus_"), F.coalesce(kind, F.lit("unknown"))), 9, all_tags)
    return F.when(F.coalesce(there, F.lit(False)), hit).otherwise(verdict())


def url_variants(url: Column) -> Column:
    """The forms under which a list may have a URL: as it is, and with its last slash the other way."""
    other = F.when(url.endswith("/"), F.left(url, F.length(url) - 1)).otherwise(F.concat(url, F.lit("/")))
    return F.array(url, other)


def reports_confidence(reports: Column) -> Column:
    """4 + 1.2 log10(reports), halves to even, from 4 to 10; 1 without reports."""
    n = reports.cast("double")
    return F.when(n <= 0, 1).otherwise(F.least(F.greatest(F.bround(4 + 1.2 * F.log10(n), 0), F.lit(4.0)), F.lit(10.0))).cast("int")


def consensus(verdicts: Column) -> Column:
    """struct(malicious, label, override, tags, n_malicious, n_with_data, rarity, confidence_max) of array<VERDICT>.

    Direct evidence wins over all; an authoritative all-clear over other votes; else any vote
    counts. The label is the first of the votes that decided, or else of all.
    """
    bad = F.filter(verdicts, lambda v: F.coalesce(v["malicious"], F.lit(False)))
    direct, clean = F.filter(bad, lambda v: v["evidence_direct"]), F.filter(verdicts, lambda v: v["authoritative_clean"])
    known = F.filter(verdicts, lambda v: v["label"].isNotNull() | v["malicious"].isNotNull())
    first = lambda vs: F.get(F.filter(F.transform(vs, lambda v: v["label"]), lambda x: x.isNotNull() & (x != "")), F.lit(0))
    n, total = F.size(known), F.size(verdicts)
    deciding = F.when(F.size(direct) > 0, first(direct)).when(F.size(clean) > 0, first(clean)).otherwise(first(bad))
    return F.struct(
        F.when(F.size(direct) > 0, True).when(F.size(clean) > 0, False).otherwise(F.size(bad) > 0).alias("malicious"),
        F.coalesce(deciding, first(verdicts), F.lit("unknown")).alias("label"),
        F.when(F.size(direct) > 0, F.lit("direct_malicious")).when(F.size(clean) > 0, F.lit("authoritative_clean")).otherwise(F.lit("")).alias("override"),
        F.array_distinct(F.flatten(F.transform(verdicts, lambda v: v["tags"]))).alias("tags"), F.size(bad).alias("n_malicious"), n.alias("n_with_data"),
        F.when(total == 0, F.lit(1.0)).otherwise((total - n) / F.greatest(total, F.lit(1))).alias("rarity"),
        F.array_max(F.transform(verdicts, lambda v: v["confidence"])).alias("confidence_max"),
    )
