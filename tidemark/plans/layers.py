"""The whole pipeline as one function of event tables, and its command line.

    python -m tidemark.plans.layers SOURCE TARGET
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import text as T
from ..functions import vectors as V
from ..operators import clustering, commands, findings, mining, naming, rollups, store


@dataclass(frozen=True)
class Models:
    """What answers for language and embedding models."""

    enrich: Callable[[DataFrame], DataFrame] = naming.rule_based
    embed: Callable = naming.hashed_embedding()


def command_layer(events: DataFrame, models: Models = Models(), config: Config = DEFAULT) -> DataFrame:
    """Deduplicated commands with intent, confidence, embedding, cluster, novelty and triage reasons."""
    rows = models.enrich(commands.dedup(events, config)).withColumn("embedding", models.embed(F.col("command_line")))
    rows = with_clusters(rows, "command")
    novelty = clustering.novelty(rows, centroids_of(rows), "command_hash").withColumnRenamed("novelty", "novelty_score")
    rows = rows.join(novelty, "command_hash")
    return rows.withColumn("triage_reasons", commands.triage_reasons(F.col("command_line"), F.col("confidence"), F.col("novelty_score"), config=config))


def session_layer(events: DataFrame, command_rows: DataFrame) -> DataFrame:
    """Sessions with the weighted pool of their distinct commands' embeddings, their intent, novelty and confidence.

    Novelty is that of the session's commands, its mean and its maximum.
    """
    base = rollups.sessions(events)
    runs = commands.with_hash(events.where("action = 'command.input'")).select("session_id", "command_hash").distinct()
    known = runs.join(command_rows.select("command_hash", "embedding", "occurrence_count", "intent", "confidence", "novelty_score"), "command_hash")
    pooled = V.mean_pool(known.withColumn("w", V.pool_weight(F.col("occurrence_count"))), "session_id", weight="w")
    top = rollups.dominant(known, "session_id", "intent", 1).select("session_id", F.col("intent").alias("dominant_intent"))
    scores = rollups.command_scores(known)
    return base.join(pooled, "session_id", "left").join(top, "session_id", "left").join(scores, "session_id", "left")


def with_clusters(rows: DataFrame, layer: str) -> DataFrame:
    """rows with cluster_id; the density clustering takes the layer's distinct vectors with their numbers."""
    vectors = rows.where("embedding IS NOT NULL").groupBy("embedding").agg(F.count("*").alias("n")).withColumns({"layer": F.lit(layer), "id": F.xxhash64("embedding")})
    labels = clustering.density_clusters(vectors, "layer", weight="n").select("id", "cluster_id")
    return rows.withColumn("id", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding"))).join(labels, "id", "left").drop("id")


def centroids_of(rows: DataFrame) -> DataFrame:
    return V.centroids(rows.where(F.col("cluster_id").isNotNull() & (F.col("cluster_id") != clustering.OUTLIER)))


def clustered(sessions: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Sessions with cluster_id and playbook_id."""
    rows = with_clusters(sessions, "session")
    inner = rows.where(F.col("cluster_id").isNotNull() & (F.col("cluster_id") != clustering.OUTLIER))
    groups = clustering.merged(centroids_of(rows), config.merge_similarity, config.merge_slack)
    books = groups.join(clustering.playbooks(inner, groups), "group_id").select("cluster_id", "playbook_id")
    return rows.join(books, "cluster_id", "left")


def session_artifacts(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """(session_id, source_ip, kind, value, start_ts, end_ts): what the sessions' commands name."""
    texts = events.where("action = 'command.input'")
    found = texts.select("session_id", "source_ip", F.explode(T.artifacts(F.col("command_line"))).alias("a")).select("session_id", "source_ip", "a.kind", "a.value").distinct()
    return found.join(sessions.select("session_id", "start_ts", "end_ts"), "session_id")


def mined_findings(sessions: DataFrame, *campaigns: DataFrame) -> DataFrame:
    """Findings of playbooks and of campaigns of every kind."""
    out = findings.playbook_findings(sessions)
    for c in campaigns:
        out = out.unionByName(findings.campaign_findings(c))
    return out


def run_all(spark: SparkSession, events: DataFrame, target: str, models: Models = Models(), config: Config = DEFAULT, run_id: str | None = None) -> dict[str, DataFrame]:
    """Every layer, each written below target and read again for the next.

    With a run_id, layers that a run of that id has finished are read instead of made anew, so an
    interrupted run goes on where it stopped. Findings keep the status and history that target has.
    """

    def keep(make: Callable[[], DataFrame], name: str) -> DataFrame:
        path, done = f"{target}/{name}", f"{target}/_done/{run_id}/{name}"
        if run_id is None or not store.exists(spark, done):
            store.swap(make(), path)
            if run_id is not None:
                spark.range(1).write.mode("overwrite").parquet(done)
        return spark.read.parquet(path)

    def all_findings() -> DataFrame:
        mined, path = mined_findings(out["sessions"], out["behaviour"], out["infrastructure"]), f"{target}/findings"
        stored = spark.read.parquet(path) if store.exists(spark, path) else spark.createDataFrame([], findings.STORED)
        return findings.upsert(stored, mined)

    out: dict[str, DataFrame] = {}
    out["commands"] = keep(lambda: command_layer(events, models, config), "commands")
    out["session_rollup"] = keep(lambda: session_layer(events, out["commands"]), "session_rollup")
    out["sessions"] = keep(lambda: clustered(out["session_rollup"], config), "sessions")
    out["addresses"] = keep(lambda: rollups.addresses(out["sessions"]), "addresses")
    out["behaviour"] = keep(lambda: mining.behaviour_campaigns(out["sessions"], config.itemset_support), "behaviour")
    out["infrastructure"] = keep(lambda: mining.infrastructure_campaigns(session_artifacts(events, out["session_rollup"]), config.infra_sessions, config.infra_ips), "infrastructure")
    out["findings"] = keep(all_findings, "findings")
    return out


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--run-id", help="layers that a run of this id has finished are not made again")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    for name, df in run_all(spark, spark.read.parquet(args.source), args.target, run_id=args.run_id).items():
        print(name, df.count())


if __name__ == "__main__":
    main()
