"""Reputation feeds: text lists, JSON with or without a wrapper, commented CSV, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ip_list(spark: SparkSession, path: str) -> DataFrame:
    """One address a line; blank lines and comments go."""
    line = F.trim(F.col("value"))
    return spark.read.text(path).select(line.alias("ip")).where((F.col("ip") != "") & ~F.col("ip").startswith("#")).distinct()


def netset(spark: SparkSession, path: str) -> DataFrame:
    """Addresses and networks of a mixed list: (cidr, is_network)."""
    return ip_list(spark, path).select(F.col("ip").alias("cidr"), F.col("ip").contains("/").alias("is_network"))


def json_rows(spark: SparkSession, path: str, schema: str, wrappers: tuple[str, ...] = ("data", "ips", "results")) -> DataFrame:
    """Rows of a JSON file that holds a list or an object with the list under one of the wrappers."""
    raw = spark.read.text(path, wholetext=True)
    as_list = F.from_json("value", f"array<struct<{schema}>>")
    wrapped = F.from_json("value", "struct<" + ",".join(f"{w}:array<struct<{schema}>>" for w in wrappers) + ">")
    plain = F.when(F.ltrim("value").startswith("["), as_list)
    return raw.select(F.explode(F.coalesce(plain, *[wrapped[w] for w in wrappers])).alias("r")).select("r.*")


def variant_rows(spark: SparkSession, path: str, names: dict[str, tuple[str, ...]], wrappers: tuple[str, ...] = ("data", "ips", "results")) -> DataFrame:
    """JSON rows whose fields go by several names: {"ip": ("source", "ip", "sourceip")} takes the first that is there."""
    keys = list(dict.fromkeys(k for some in names.values() for k in some))
    rows = json_rows(spark, path, ",".join(f"`{k}`:string" for k in keys), wrappers)
    return rows.select(*[F.coalesce(*[F.nullif(F.trim(F.col(f"`{k}`")), F.lit("")) for k in some]).alias(name) for name, some in names.items()])


def header_in_comments(spark: SparkSession, path: str, must: str = "url") -> list[str]:
    """The names in the last comment line that looks like a header: identifiers parted by commas, one of them `must`."""
    comment = F.regexp_replace(F.trim("value"), r"^#+\s*|\"", "")
    shaped = comment.rlike(r"^[A-Za-z_][A-Za-z0-9_]*(\s*,\s*[A-Za-z_][A-Za-z0-9_]*)+$") & F.array_contains(F.split(comment, r"\s*,\s*"), must)
    lines = spark.read.text(path).where(F.col("value").startswith("#")).select(comment.alias("line"), F.monotonically_increasing_id().alias("at")).where(shaped)
    found = lines.agg(F.max_by("line", "at")).first()[0]
    if found is None:
        raise ValueError(f"no header with {must} in the comments of {path}")
    return [c.strip() for c in found.split(",")]


def commented_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Rows of a CSV whose header stands in a comment, where it is looked for if it isn't given; ragged rows go."""
    columns = columns or header_in_comments(spark, path)
    rows = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#"))
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = rows.select(F.from_csv("value", ", ".join(f"`{c}` string" for c in [*columns, "_bad"]), options).alias("r")).select("r.*")
    return parsed.where(F.col("_bad").isNull()).drop("_bad")


def fresh(snapshots: DataFrame, as_of, max_age_hours: float) -> DataFrame:
    """Feed rows fetched within the age."""
    return snapshots.where((F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros("fetched_at")) <= max_age_hours * 3.6e9)


#: Fields of a client's key exchange and their names here (fixed values).
CLIENT = {
    "hassh": "hassh", "hasshAlgorithms": "hassh_algorithms", "kexAlgs": "kex_algorithms", "keyAlgs": "key_algorithms",
    "encCS": "enc_cs", "macCS": "mac_cs", "compCS": "comp_cs", "langCS": "lang_cs",
}


def raw_log(spark: SparkSession, path: str) -> DataFrame:
    """Honeypot log lines as raw events; lines that are no JSON are tagged, not lost."""
    fields = "eventid string, timestamp string, src_ip string, src_port string, dst_ip string, dst_port string, session string, protocol string, username string, password string, input string, version string, url string, destfile string, shasum string, duration double, message string, sensor string, hassh string, hasshAlgorithms string, kexAlgs array<string>, keyAlgs array<string>, encCS array<string>, macCS array<string>, compCS array<string>, langCS array<string>"
    return project_log(spark.read.text(path), "value", fields)


def project_log(lines: DataFrame, column: str, fields: str) -> DataFrame:
    """The ingest projection: renames, types, constants, decision table, related values."""
    from ..functions import network as N

    m = F.from_json(column, fields)
    action = F.concat(F.lit(""), F.col("m.eventid"))
    starts = lambda p: F.col("m.eventid").startswith(p)
    group = (
        F.when(starts("cowrie.login."), F.lit("authentication"))
        .when(action.isin("cowrie.session.connect", "cowrie.session.closed", "cowrie.client.version", "cowrie.client.kex"), F.lit("network"))
        .when(action.isin("cowrie.command.input", "cowrie.command.failed", "cowrie.command.success"), F.lit("process"))
        .when(action.isin("cowrie.session.file_download", "cowrie.session.file_upload", "cowrie.session.file_download.failed"), F.lit("file"))
        .when(starts("cowrie.direct-tcpip"), F.lit("intrusion_detection"))
    )
    kind = (
        F.when(starts("cowrie.login."), F.lit("start")).when(action == "cowrie.session.connect", F.lit("connection")).when(action == "cowrie.session.closed", F.lit("end"))
        .when(group == "file", F.lit("creation")).when(group.isNotNull(), F.lit("info"))
    )
    outcome = F.when(action == "cowrie.login.failed", F.lit("failure")).when(action.isin("cowrie.login.success", "cowrie.session.connect", "cowrie.session.closed"), F.lit("success"))
    related = lambda *c: F.array_distinct(F.array_compact(F.array(*[F.col(x) for x in c])))
    client = [F.col(f"m.{c}").alias(name) for c, name in CLIENT.items() if f"{c} " in fields]
    bad = F.col("m.eventid").isNull() & F.col("m.session").isNull()
    return lines.select(F.col(column).alias("original"), m.alias("m")).select(
        F.try_to_timestamp("m.timestamp").alias("ts"), action.alias("action"), group.alias("category"), kind.alias("type"), outcome.alias("outcome"),
        F.col("m.src_ip").alias("source_ip"), F.col("m.src_port").try_cast("int").alias("source_port"), F.col("m.dst_ip").alias("destination_ip"), F.col("m.dst_port").try_cast("int").alias("destination_port"),
        F.col("m.protocol").alias("protocol"), F.col("m.session").alias("session_id"), F.col("m.username").alias("user_name"), F.col("m.password").alias("password"),
        F.nullif(F.col("m.input"), F.lit("")).alias("command_line"), F.col("m.version").alias("user_agent"), N.basename(F.col("m.destfile")).alias("file_name"), N.url_parts(F.col("m.url")).alias("url"),
        (F.col("m.duration") * 1e9).cast("long").alias("duration_ns"), N.network_type(F.col("m.src_ip")).alias("network_type"),
        related("m.src_ip", "m.dst_ip").alias("related_ip"), related("m.username").alias("related_user"), related("m.shasum").alias("related_hash"),
        F.lit("event").alias("event_kind"), F.when(bad, F.array(F.lit("parse_failure"))).otherwise(F.array().cast("array<string>")).alias("tags"), "original", *client,
    )
