"""Known facts about shell commands: dictionaries, what of the corpus they cover, texts for prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import shell
from .rollups import least_members

#: Systems in the order in which a page is taken (fixed values).
SYSTEMS = ("linux", "common", "osx", "windows", "android")


def dictionary(curated: DataFrame, pages: DataFrame) -> DataFrame:
    """(command, description, flags, by_os, source): curated entries over page entries."""
    c, p = curated.select("command", "description", "flags"), pages.select("command", "by_os")
    both = c.join(p, "command", "full_outer")
    source = F.when(F.col("description").isNotNull() & F.col("by_os").isNotNull(), "both").when(F.col("description").isNotNull(), "curated").otherwise("tldr")
    return both.withColumn("source", source)


def token_counts(commands: DataFrame, denied: DataFrame) -> DataFrame:
    """(token, n, lines) of commands that lines call, by their occurrences, with at most three lines each."""
    calls = commands.select("command_line", "occurrence_count", F.explode(shell.commands(F.col("command_line"))).alias("c")).select("command_line", "occurrence_count", F.col("c.command").alias("token")).distinct()
    lines = least_members(calls, "token", "command_line", 3, "lines")
    return calls.groupBy("token").agg(F.sum("occurrence_count").alias("n")).join(lines, "token").join(denied.select(F.lower("token").alias("token"), F.lit(True).alias("denied")), "token", "left")


def coverage(counts: DataFrame, known: DataFrame, cap: int = 200) -> DataFrame:
    """Tokens by how well they are known, the most frequent first."""
    k = known.select(F.col("command").alias("token"), "source")
    bucket = F.when(F.col("denied"), "denied").when(F.col("source").isNull(), "needs_def").when(F.col("source") == "tldr", "tldr_only").otherwise("curated")
    return counts.join(k, "token", "left").select("token", "n", "lines", bucket.alias("bucket")).orderBy(F.desc("n"), "token").limit(cap)


def block(commands: DataFrame, known: DataFrame, denied: DataFrame, most: int = 6000) -> DataFrame:
    """(command_line, block): a paragraph on each command that the line calls, cut at a line break."""
    calls = commands.select("command_line", F.posexplode(shell.commands(F.col("command_line"))).alias("at", "c")).select("command_line", "at", F.col("c.command").alias("command"), F.col("c.flags").alias("used"))
    calls = calls.join(denied.select(F.lower("token").alias("command")), "command", "left_anti").join(known, "command")
    flags = F.transform(F.filter("used", lambda f: F.col("flags")[f].isNotNull()), lambda f: F.concat(F.lit("  "), f, F.lit(": "), F.col("flags")[f]))
    page = F.coalesce(*[F.col("by_os")[s] for s in SYSTEMS])
    text = F.concat_ws("\n", F.concat(F.col("command"), F.lit(": "), F.coalesce("description", page)), F.nullif(F.array_join(flags, "\n"), F.lit("")))
    whole = calls.groupBy("command_line").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", text.alias("text")))), lambda x: x["text"]), "\n").alias("block"))
    cut = F.regexp_extract(F.substring("block", 1, most), r"(?s)\A(.*)\n", 1)
    return whole.withColumn("block", F.when(F.length("block") > most, cut).otherwise(F.col("block")))


def stix_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id, kind) of tactics and techniques in a STIX bundle, without revoked and deprecated ones."""
    fields = "type string, revoked boolean, x_mitre_deprecated boolean, external_references array<struct<source_name:string,external_id:string>>"
    objects = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"objects array<struct<{', '.join(x.replace(' ', ':', 1) for x in fields.split(', '))}>>")["objects"]).alias("o")).select("o.*")
    live = objects.where(~F.coalesce("revoked", F.lit(False)) & ~F.coalesce("x_mitre_deprecated", F.lit(False)))
    ids = live.select(F.explode("external_references").alias("r")).where("r.source_name = 'mitre-attack'").select(F.col("r.external_id").alias("id"))
    kind = F.when(F.col("id").rlike(r"^TA\d{4}$"), "tactic").when(F.col("id").rlike(r"^T\d{4}(\.\d{3})?$"), "technique")
    return ids.select("id", kind.alias("kind")).where("kind IS NOT NULL").distinct()


def page_summary(markdown: Column, most: int = 2000) -> Column:
    """Summary and example lines of a help page, cut at a word."""
    lines = F.transform(F.split(markdown, "\n"), lambda x: F.trim(x))
    kept = F.filter(lines, lambda x: x.startswith(">") | x.startswith("- ") | x.startswith("`"))
    plain = F.array_join(F.transform(kept, lambda x: F.trim(F.regexp_replace(x, "^[>-]|`", ""))), "\n")
    return F.when(F.length(plain) > most, F.regexp_extract(F.substring(plain, 1, most), r"(?s)\A(.*)\s", 1)).otherwise(plain)
