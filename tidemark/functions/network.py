"""Canonical forms of addresses, domains, URLs and hashes, and address ranges."""

from __future__ import annotations

import ipaddress

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: IPv4 ranges that are not public (fixed values).
NOT_PUBLIC = (
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12", "192.0.0.0/29", "192.0.0.170/31", "192.0.2.0/24",
    "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4",
)


def ipv4_number(ip: Column) -> Column:
    """The address as a number; null unless four decimal parts up to 255 without leading zeros."""
    parts = F.split(ip, r"\.")
    good = ip.rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.(?!$)|$)){4}$")
    number = sum((F.get(parts, F.lit(k)).try_cast("long") * (1 << (24 - 8 * k)) for k in range(1, 4)), F.get(parts, F.lit(0)).try_cast("long") * (1 << 24))
    return F.when(good, number)


def is_ip(value: Column) -> Column:
    """Whether the text is an IPv4 or IPv6 address, public or not; a plain expression, so it works within arrays."""
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    v4 = rf"(?:{octet}\.){{3}}{octet}"
    group = "[0-9A-Fa-f]{1,4}"
    plain = F.regexp_replace(value, f":{v4}$", ":0:0")  # an embedded IPv4 address stands for two groups
    whole = plain.rlike(f"^(?:{group}:){{7}}{group}$")
    groups = F.length(F.regexp_replace(F.regexp_replace(plain, group, "g"), ":", ""))
    short = plain.rlike(f"^(?:{group}(?::{group})*)?::(?:{group}(?::{group})*)?$") & (groups <= 7)
    return value.rlike(f"^{v4}$") | whole | short


def _bounds(cidr: str) -> tuple[int, int]:
    net = ipaddress.ip_network(cidr, strict=False)
    return int(net.network_address), int(net.broadcast_address)


def canonical_ipv4(ip: Column) -> Column:
    """The trimmed address if it is public IPv4, else null."""
    plain = F.trim(ip)
    number = ipv4_number(plain)
    inner = F.lit(False)
    for cidr in NOT_PUBLIC:
        low, high = _bounds(cidr)
        inner = inner | number.between(low, high)
    return F.when(number.isNotNull() & ~inner, plain)


def canonical_ip(ip: Column) -> Column:
    """Public IPv4 or IPv6 in its short form; IPv6 is left to Arrow batches of the ipaddress module."""

    def short(values: pa.Array) -> pa.Array:
        out = []
        for v in values.to_pylist():
            try:
                a = ipaddress.IPv6Address((v or "").strip())
                out.append(None if a.is_private or a.is_loopback or a.is_link_local or a.is_multicast or a.is_reserved or a.is_unspecified else str(a))
            except ValueError:
                out.append(None)
        return pa.array(out, pa.string())

    return F.coalesce(canonical_ipv4(ip), F.when(ip.contains(":"), F.arrow_udf(short, "string")(ip)))


def canonical_domain(domain: Column) -> Column:
    plain = F.regexp_replace(F.lower(F.trim(domain)), r"\.$", "")
    good = (F.length(plain) <= 253) & plain.rlike(r"^[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?(\.[a-z0-9]([a-z0-9-]{0,61}[a-z0-9])?)+$")
    return F.when(good, plain)


def canonical_hash(value: Column) -> Column:
    plain = F.lower(F.trim(value))
    return F.when(plain.rlike("^([a-f0-9]{64}|[a-f0-9]{40}|[a-f0-9]{32})$"), plain)


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, without ports 80 and 443, query and fragment; null for other schemes."""
    plain = F.trim(url)
    scheme = F.lower(F.regexp_extract(plain, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    host = F.lower(F.regexp_extract(plain, r"^[^:]+://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1))
    port = F.regexp_extract(plain, r"^[^:]+://(?:[^/?#@]*@)?(?:\[[^\]]*\]|[^/?#:]*):([0-9]+)", 1)
    path = F.regexp_extract(plain, r"^[^:]+://[^/?#]*(/[^?#]*)", 1)
    at = F.when((port == "") | port.isin("80", "443"), F.lit("")).otherwise(F.concat(F.lit(":"), port))
    whole = F.concat(scheme, F.lit("://"), host, at, F.when(path == "", F.lit("/")).otherwise(path))
    return F.when(scheme.isin("http", "https", "ftp", "tftp") & (host != ""), whole)


def url_parts(url: Column) -> Column:
    """struct(scheme, domain, port, path, query, fragment, extension)."""
    pick = lambda pattern: F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))
    path = pick(r"^[^:]+://[^/?#]*(/[^?#]*)")
    return F.struct(
        pick(r"^([A-Za-z][A-Za-z0-9+.-]*)://").alias("scheme"), pick(r"^[^:]+://(?:[^/?#@]*@)?([^/?#:]*)").alias("domain"),
        pick(r"^[^:]+://[^/?#]*:([0-9]+)").try_cast("int").alias("port"), path.alias("path"), pick(r"\?([^#]*)").alias("query"), pick(r"#(.*)$").alias("fragment"),
        F.nullif(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1), F.lit("")).alias("extension"),
    )


def host_ip(url: Column) -> Column:
    """The URL's host if it is a literal public IPv4 address."""
    return canonical_ipv4(F.regexp_extract(url, r"^[^:]+://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def basename(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"([^/]+)$", 1), F.lit(""))


def network_type(ip: Column) -> Column:
    return F.when(ip.isNull(), None).when(ip.contains(":"), F.lit("ipv6")).otherwise(F.lit("ipv4"))


def ranges(cidrs: DataFrame, cidr_col: str = "cidr") -> DataFrame:
    """Adds low, high and the /8 blocks that a range touches to IPv4 networks or single addresses."""
    base = F.element_at(F.split(cidr_col, "/"), 1)
    bits = F.coalesce(F.get(F.split(cidr_col, "/"), F.lit(1)).try_cast("int"), F.lit(32))
    size = F.pow(F.lit(2.0), 32 - bits).cast("long")
    low = F.floor(ipv4_number(base) / size).cast("long") * size
    high = low + size - 1
    return cidrs.withColumns({"low": low, "high": high}).withColumn("slash8", F.explode(F.sequence(F.shiftright("low", 24), F.shiftright("high", 24))))


def in_ranges(rows: DataFrame, cidrs: DataFrame, ip_col: str = "ip", cidr_col: str = "cidr") -> DataFrame:
    """rows joined with each network that holds their address: an equi-join on the /8, then the bounds."""
    number = ipv4_number(F.col(ip_col))
    left = rows.withColumn("n", number).withColumn("slash8", F.shiftright("n", 24))
    return left.join(ranges(cidrs, cidr_col), "slash8").where(F.col("n").between(F.col("low"), F.col("high"))).drop("n", "slash8", "low", "high")
