"""The ingest projection of web-honeypot lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import network as N

FIELDS = """time string, sip string, dip string, dport string, method string, url string, version string, useragent string, body string,
headers map<string,string>, signature_id struct<max_score:string,rules:array<string>>, response_id struct<comment:string,id:string>"""
KNOWN = ("time", "sip", "dip", "dport", "method", "url", "version", "useragent", "body", "headers", "signature_id", "response_id")


def header(headers: Column, name: str) -> Column:
    """A header by its name in any case."""
    hit = F.filter(F.map_entries(headers), lambda e: F.lower(e["key"]) == name)
    return F.get(hit, F.lit(0))["value"]


def agent(raw: Column) -> Column:
    """A user agent given as text or as a JSON list, of which the first counts; null if empty."""
    first = F.when(raw.startswith("["), F.get(F.from_json(raw, "array<string>"), F.lit(0))).otherwise(raw)
    return F.nullif(F.trim(first), F.lit(""))


def agent_name(agent: Column) -> Column:
    return F.when(agent.rlike("(?i)curl/"), "curl").when(agent.rlike("(?i)wget/"), "Wget").when(agent.rlike("(?i)python-requests|aiohttp|urllib"), "Python").when(agent.rlike("(?i)zgrab|masscan|nmap"), "scanner").when(agent.rlike("Firefox/"), "Firefox").when(agent.rlike("Chrome/"), "Chrome").when(agent.isNotNull(), "Other")


def project(lines: DataFrame, column: str = "value") -> DataFrame:
    """Requests: method, URL, host and port (of the request, else of the host header, else of the URL), agent, body, signature, leftover fields."""
    m = F.from_json(column, FIELDS)
    rest = F.map_filter(F.from_json(column, "map<string,string>"), lambda k, _: ~k.isin(*KNOWN))
    host = header(F.col("m.headers"), "host")
    url = F.col("m.url")
    full = url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://")
    parts = N.url_parts(F.when(full, url).otherwise(F.concat(F.lit("http://x"), url)))
    host_port = F.regexp_extract(host, r":([0-9]+)$", 1).try_cast("int")
    method = F.upper("m.method")
    body = F.nullif(F.col("m.body"), F.lit(""))
    return lines.select(F.col(column).alias("original"), m.alias("m"), rest.alias("unmapped")).select(
        F.try_to_timestamp("m.time").alias("ts"), F.col("m.sip").alias("source_ip"), F.col("m.dip").alias("destination_ip"), N.network_type(F.col("m.sip")).alias("network_type"),
        F.coalesce(F.col("m.dport").try_cast("int"), host_port, F.when(full, parts["port"])).alias("destination_port"), method.alias("method"), F.regexp_replace(F.col("m.version"), "(?i)^HTTP/", "").alias("http_version"),
        F.coalesce(F.nullif(F.regexp_replace(host, ":[0-9]+$", ""), F.lit("")), F.when(full, parts["domain"])).alias("domain"), parts["path"].alias("path"), parts["query"].alias("query"), parts["extension"].alias("extension"),
        agent(F.col("m.useragent")).alias("user_agent"), agent_name(agent(F.col("m.useragent"))).alias("agent_name"), body.alias("body"), F.octet_length(body).alias("body_bytes"), F.concat_ws(" ", method, url).alias("message"),
        F.col("m.signature_id.max_score").try_cast("int").alias("max_score"), F.col("m.signature_id.rules").alias("rules"), F.when(F.size("unmapped") > 0, F.col("unmapped")).alias("unmapped"),
        F.when(F.size("unmapped") > 0, F.array(F.lit("unmapped_fields"))).otherwise(F.array().cast("array<string>")).alias("tags"),
    )
