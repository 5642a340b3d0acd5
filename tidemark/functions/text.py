"""Command text: normal form, digests, identifiers, patterns of triage and artifact extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT
from . import network as N

# Patterns whose matches decide ids and reasons, so they must be these.
#: What separates words, as Python's str.split sees it.
SPACES = r"(?U)[\s\x1c-\x1f]+"
URL = r"(?i)https?://[A-Za-z0-9._\-]+(?:\:\d+)?(?:/[A-Za-z0-9._\-/?=&%+~:]*)?"
SSH_KEY = r"ssh-(?:rsa|dss|ed25519|ecdsa-[A-Za-z0-9-]+)\s+[A-Za-z0-9+/=]{40,}"
HEX = r"(?:[A-Fa-f0-9]{64}|[A-Fa-f0-9]{40}|[A-Fa-f0-9]{32})"
HASH_PREFIX = rf"(?i)\b(?:sha256|sha1|md5)[:=]({HEX})\b"
HASH_TOOL = r"(?i)\b(?:sha256sum|sha512sum|sha384sum|sha224sum|sha1sum|md5sum|shasum|certutil|openssl\s+dgst|gpg\s+--print-md)\b"
HASH_BARE = rf"\b({HEX})\b"
BASE64 = r"([A-Za-z0-9+/=]{40,})"
IPV4 = r"(?<![0-9])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])"
TLD = r"(?i)(?:://|\b(?:wget|curl|nslookup|dig|host|ping|nc|ncat|ssh|scp|sftp|tftp|telnet|ftp)\b[^|;&\n]*?\b)[a-z0-9-]+\.([a-z]{2,24})\b"


def collapsed(command: Column) -> Column:
    """Without outer white space, inner runs as one blank."""
    return F.trim(F.regexp_replace(command, SPACES, " "))


def normalised(command: Column, most: int = DEFAULT.command_chars) -> Column:
    return F.substring(collapsed(command), 1, most)


def truncated(command: Column, most: int = DEFAULT.command_chars) -> Column:
    return F.length(collapsed(command)) > most


def full_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def hash16(text: Column) -> Column:
    return F.substring(F.sha2(text, 256), 1, 16)


def content_id(prefix: str, members: Column, by: str = "\n") -> Column:
    """An id that depends only on which members there are."""
    return F.concat(F.lit(prefix), hash16(F.array_join(F.array_sort(F.array_distinct(members)), by)))


def playbook_id(members: Column) -> Column:
    return content_id("sescl-", members)


def campaign_id(members: Column) -> Column:
    """The id of a behaviour campaign, by its set of playbooks."""
    return content_id("cmp-beh-", members, "|")


def finding_id(kind: str, value: Column) -> Column:
    return F.concat(F.lit({"playbook": "find-pla-", "campaign": "find-cam-"}[kind]), hash16(F.concat(F.lit(kind + ":"), value)))


def credential(user: Column, password: Column) -> Column:
    """user:password, either side may be empty; null if both are."""
    pair = F.concat(F.coalesce(user, F.lit("")), F.lit(":"), F.coalesce(password, F.lit("")))
    return F.when(pair != ":", pair)


def credential_bin(pair: Column, bins: int = DEFAULT.credential_bins) -> Column:
    """The first eight digest bytes, big-endian, modulo bins."""
    return (F.conv(hash16(pair), 16, 10).cast("decimal(20,0)") % bins).cast("int")


def longest_base64(text: Column) -> Column:
    """Length of the longest base64-like run with upper, lower and digit; null without one."""
    runs = F.filter(F.regexp_extract_all(text, F.lit(BASE64), 1), lambda r: r.rlike("[A-Z]") & r.rlike("[a-z]") & r.rlike("[0-9]"))
    return F.array_max(F.transform(runs, F.length))


def has_ipv4(text: Column) -> Column:
    return text.rlike(IPV4)


def has_rare_tld(text: Column, tlds: tuple[str, ...] = DEFAULT.suspicious_tlds) -> Column:
    """Whether a host of such a domain is fetched. The whole pattern is only tried on texts that have its end."""
    found = F.transform(F.regexp_extract_all(text, F.lit(TLD), 1), F.lower)
    hit = F.arrays_overlap(found, F.array(*[F.lit(t) for t in tlds]))
    return F.when(text.rlike(rf"(?i)[a-z0-9-]\.(?:{'|'.join(tlds)})\b"), hit).otherwise(F.when(text.isNotNull(), F.lit(False)))


def artifacts(text: Column) -> Column:
    """array<struct<kind,value>>: URLs, SSH keys (type and 32 characters of the body), hashes in context; distinct."""
    as_kind = lambda kind, values: F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))
    keys = F.transform(F.regexp_extract_all(text, F.lit(f"({SSH_KEY})"), 1), lambda k: F.concat(F.regexp_extract(k, r"^(\S+)", 1), F.lit(" "), F.substring(F.regexp_extract(k, r"\s(\S+)$", 1), 1, 32)))
    named = F.transform(F.regexp_extract_all(text, F.lit(HASH_PREFIX), 1), F.lower)
    bare = F.when(text.rlike(HASH_TOOL), F.transform(F.regexp_extract_all(text, F.lit(HASH_BARE), 1), F.lower)).otherwise(F.array().cast("array<string>"))
    urls = F.regexp_extract_all(text, F.lit(f"({URL})"), 1)
    return F.array_distinct(F.concat(as_kind("url", urls), as_kind("ssh_key", keys), as_kind("hash", F.array_union(named, bare))))


def validated_iocs(urls: Column, hashes: Column, command: Column) -> Column:
    """array<struct<kind,value>> of a model's URLs and hashes that stand up: whole URLs; hex digests in a command with a digest tool."""
    none = F.array().cast("array<string>")
    pair = lambda kind: lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value"))
    good_urls = F.filter(F.transform(F.coalesce(urls, none), lambda u: F.trim(u)), lambda u: u.rlike(f"^(?:{URL})$"))
    good_hashes = F.when(command.rlike(HASH_TOOL), F.filter(F.transform(F.coalesce(hashes, none), lambda h: F.lower(F.trim(h))), lambda h: h.rlike(f"^{HEX}$"))).otherwise(none)
    return F.array_distinct(F.concat(F.transform(good_urls, pair("url")), F.transform(good_hashes, pair("hash"))))


def listed_iocs(kind: str, values: Column) -> Column:
    """A model's list of ips, hashes, domains, urls or files, cleaned, without what can't be one; order and repeats stay."""
    own = F.coalesce(values, F.array().cast("array<string>"))
    stripped = F.transform(own, lambda v: F.trim(v))
    if kind == "ips":
        bare = F.transform(stripped, lambda v: F.regexp_replace(F.regexp_replace(v, r"\.+$", ""), r"^[\[\]]+|[\[\]]+$", ""))
        return F.filter(bare, N.is_ip)
    if kind == "hashes":
        return F.filter(F.transform(stripped, F.lower), lambda v: v.rlike(f"^{HEX}$"))
    if kind == "domains":
        lower = F.transform(stripped, lambda v: F.lower(F.regexp_replace(v, r"\.+$", "")))
        return F.filter(lower, lambda v: v.rlike(r"^(?:[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?\.)+[a-z]{2,63}$"))
    if kind == "urls":
        return F.filter(stripped, has_url_scheme)
    if kind == "files":
        return F.filter(stripped, lambda v: ~v.contains(" ") & v.rlike(r"(?U)[\p{L}\p{N}]"))
    raise ValueError(f"unknown kind of indicator: {kind}")


def has_url_scheme(value: Column) -> Column:
    return value.rlike(r"(?i)^(?:https?|ftps?|tftp)://.")


def clean_name(name: Column, words: int = 5) -> Column:
    """Without outer quotes and a last dot, at most so many words."""
    plain = F.regexp_replace(F.trim(name), r"""^["'`]+|["'`]+$""", "")
    plain = F.regexp_replace(plain, r"\.+$", "")
    return F.array_join(F.slice(F.filter(F.split(plain, r"\s+"), lambda w: w != ""), 1, words), " ")


def without_thoughts(reply: Column) -> Column:
    """A model's reply without <think> blocks and code fences."""
    plain = F.regexp_replace(reply, r"(?is)<think>.*?</think>", "")
    return F.trim(F.regexp_replace(F.trim(plain), r"(?is)^```[a-z]*\s*|\s*```$", ""))


def label(text: Column, most: int = 80) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most), F.lit("…"))).otherwise(text)


def mitre_ids(raw: Column, known: Column) -> Column:
    """Upper-cased, stripped ids that are known, each once."""
    return F.array_distinct(F.filter(F.transform(raw, lambda x: F.upper(F.trim(x))), lambda x: F.array_contains(known, x)))


def coerced_confidence(value: Column) -> Column:
    """1 to 10 from text: a fraction up to 1 counts tenths, halves go to even, what is no number gives 1."""
    number = value.cast("string").try_cast("double")
    whole = value.cast("string").rlike(r"^\s*[+-]?\d+\s*$")
    scaled = F.when((number >= 0) & (number <= 1) & ~whole, number * 10).otherwise(number)
    return F.coalesce(F.least(F.greatest(F.bround(scaled, 0), F.lit(1.0)), F.lit(10.0)), F.lit(1.0)).cast("int")


def age_hours(seen: Column, as_of: Column) -> Column:
    """Hours from the time, a text in ISO form, to as_of; never below 0, null for a bad one."""
    micros = F.unix_micros(F.try_to_timestamp(seen.cast("string")))
    return F.when(micros.isNotNull(), F.greatest(F.lit(0.0), (F.unix_micros(as_of) - micros) / 3.6e9))
