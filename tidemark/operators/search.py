"""Free-text search over commands, playbooks, campaigns and clusters, merged by score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import clustering
from .naming import disambiguated

#: What a whole word that matches adds, beside 1 for the text as a part.
WORD_WEIGHT = 2.0


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def score(text: Column, query: str) -> Column:
    """1 if the query is a part of the text, whatever its case, plus WORD_WEIGHT for each of its words that is one of the text's.

    Every character of the query stands for itself; there are no wild cards.
    """
    part = F.contains(F.lower(F.coalesce(text, F.lit(""))), F.lower(F.lit(query)))
    words = F.size(F.array_intersect(tokens(text), tokens(F.lit(query))))
    return part.cast("double") + WORD_WEIGHT * words


def hits(rows: DataFrame, kind: str, id_col: str, fields: list[str], query: str) -> DataFrame:
    """(kind, id, title, score): rows of one source that match in some field, the best field counting."""
    best = F.greatest(*[score(F.col(c), query) for c in fields], F.lit(0.0))
    return rows.select(F.lit(kind).alias("kind"), F.col(id_col).cast("string").alias("id"), F.col(fields[0]).alias("title"), best.alias("score")).where("score > 0")


def with_prefix(rows: DataFrame, column: str, prefix: str) -> DataFrame:
    return rows.where(F.col(column).startswith(prefix))


def search(query: str, commands: DataFrame, playbooks: DataFrame, campaigns: DataFrame, clusters: DataFrame, size: int = 20) -> DataFrame:
    """The best hits over all four sources; a thing that several rows stand for counts once.

    commands: (command_hash, command_line, description); playbooks: (run_id, ts, playbook_id, playbook_name),
    of which the latest run counts and equal names get a suffix; campaigns: (campaign_id, name, rationale);
    clusters: (run_id, ts, cluster_id, label), the latest run again.
    """
    books = disambiguated(clustering.latest_run(playbooks).dropDuplicates(["playbook_id"]))
    found = (
        hits(commands, "command", "command_hash", ["command_line", "description"], query)
        .unionByName(hits(books, "playbook", "playbook_id", ["playbook_name"], query))
        .unionByName(hits(campaigns, "campaign", "campaign_id", ["name", "rationale"], query))
        .unionByName(hits(clustering.latest_run(clusters), "cluster", "cluster_id", ["label"], query))
    )
    best = Window.partitionBy("kind", "id").orderBy(F.desc("score"), "title")
    once = found.withColumn("place", F.row_number().over(best)).where("place = 1").drop("place")
    return once.orderBy(F.desc("score"), "kind", "id").limit(size)
