"""Panels: details of a playbook, largest clusters, counts by status, top commands, what belongs to what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import clustering
from .rollups import dominant, top_keys


def overview(sessions: DataFrame) -> DataFrame:
    return sessions.agg(F.count("*").alias("sessions"), F.count_if(F.col("command_count") > 0).alias("with_commands"), F.countDistinct("source_ip").alias("addresses"))


def failed_sessions(total: Column, successful: Column) -> Column:
    return F.greatest(F.coalesce(total, F.lit(0)) - F.coalesce(successful, F.lit(0)), F.lit(0))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n) of each table."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def counts_by(findings: DataFrame, column: str) -> DataFrame:
    """(column, n): findings by status or by kind."""
    return findings.groupBy(column).agg(F.count("*").alias("n"))


def top_commands(events: DataFrame, sessions: DataFrame, top: int = 10, item: str = "command_line") -> DataFrame:
    """(item, n): the commands with most events in the given sessions."""
    own = events.where(F.col(item).isNotNull()).join(sessions.select("session_id").distinct(), "session_id", "left_semi")
    return top_keys(own, item, top)


def playbook_totals(sessions: DataFrame, as_of: Column) -> DataFrame:
    """One row for each playbook: sessions, addresses, times, sessions of the last 24 hours and of the 24 before."""
    hours = lambda n: as_of - F.make_dt_interval(hours=F.lit(n))
    ts = F.col("start_ts")
    return sessions.where("playbook_id IS NOT NULL").groupBy("playbook_id").agg(
        F.count("*").alias("n_sessions"), F.countDistinct("source_ip").alias("n_ips"), F.min("start_ts").alias("first_seen"), F.max("start_ts").alias("last_seen"),
        F.count_if((ts > hours(24)) & (ts <= as_of)).alias("last_24h"), F.count_if((ts > hours(48)) & (ts <= hours(24))).alias("prior_24h"),
    )


def playbook_top(sessions: DataFrame, column: str, top: int, missing: str | None = None) -> DataFrame:
    """(playbook_id, column, n, rank): each playbook's most frequent countries, networks or intents."""
    rows = sessions.where("playbook_id IS NOT NULL")
    rows = rows.withColumn(column, F.coalesce(column, F.lit(missing))) if missing else rows
    return dominant(rows, "playbook_id", column, top)


def playbook_commands(events: DataFrame, sessions: DataFrame, largest: int = 20, top: int = 5, chars: int = 120) -> DataFrame:
    """(playbook_id, command_line, n, rank): top commands of each playbook's largest sessions, cut to so many characters."""
    order = Window.partitionBy("playbook_id").orderBy(F.desc("command_count"), "session_id")
    taken = sessions.where("playbook_id IS NOT NULL").withColumn("place", F.row_number().over(order)).where(F.col("place") <= largest).select("playbook_id", "session_id")
    rows = events.where("action = 'command.input'").join(taken, "session_id").withColumn("command_line", F.substring("command_line", 1, chars))
    return dominant(rows, "playbook_id", "command_line", top)


def top_clusters(rows: DataFrame, cluster: str, item: str, top: int = 10) -> DataFrame:
    """(cluster, n, item): the largest clusters with their dominant intent; outliers are none."""
    inner = rows.where(F.col(cluster).isNotNull() & (F.col(cluster).cast("string") != clustering.OUTLIER))
    best = dominant(inner, cluster, item, 1).select(cluster, item)
    return top_keys(inner, cluster, top).join(best, cluster, "left").orderBy(F.desc("n"), cluster)


def address_clusters(addresses: DataFrame, sessions: DataFrame, top: int = 10) -> DataFrame:
    """(cluster_id, n, n_playbooks): the largest clusters of addresses and how many playbooks their addresses run."""
    inner = addresses.where(F.col("cluster_id").isNotNull() & (F.col("cluster_id") != clustering.OUTLIER))
    largest = top_keys(inner, "cluster_id", top)
    held = inner.join(largest.select("cluster_id"), "cluster_id", "left_semi").select("cluster_id", "source_ip")
    breadth = held.join(sessions.where("playbook_id IS NOT NULL").select("source_ip", "playbook_id").distinct(), "source_ip")
    n = breadth.groupBy("cluster_id").agg(F.countDistinct("playbook_id").alias("n_playbooks"))
    return largest.join(n, "cluster_id", "left").select("cluster_id", "n", F.coalesce("n_playbooks", F.lit(0).cast("long")).alias("n_playbooks"))


def playbooks_of(sessions: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """(source_ip, playbook_id, n, and playbook_name): the playbooks that each address runs."""
    out = sessions.where("playbook_id IS NOT NULL").groupBy("source_ip", "playbook_id").agg(F.count("*").alias("n"))
    return out if names is None else out.join(names.select("playbook_id", "playbook_name").dropDuplicates(["playbook_id"]), "playbook_id", "left")


def addresses_of(sessions: DataFrame) -> DataFrame:
    """(playbook_id, n_ips, n_sessions)."""
    return sessions.where("playbook_id IS NOT NULL").groupBy("playbook_id").agg(F.countDistinct("source_ip").alias("n_ips"), F.count("*").alias("n_sessions"))


def book_of_cluster(clusters: DataFrame) -> DataFrame:
    """(cluster_id, playbook_id, playbook_name) in the latest run, the first by playbook id."""
    order = Window.partitionBy("cluster_id").orderBy("playbook_id")
    rows = clustering.latest_run(clusters).where("playbook_id IS NOT NULL")
    return rows.withColumn("place", F.row_number().over(order)).where("place = 1").select("cluster_id", "playbook_id", "playbook_name")


def hydrated(ids: DataFrame, table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The ids with these columns of their rows; unknown ids stay, with nulls."""
    return ids.select(key).distinct().join(table.select(key, *columns).dropDuplicates([key]), key, "left")


def campaign_list(campaigns: DataFrame, top: int = 50) -> DataFrame:
    return campaigns.orderBy(F.desc("session_count"), "campaign_id").limit(top)


def nearer_centroid(commands: DataFrame, a: list[float], b: list[float]) -> DataFrame:
    """(command_line, to_a, to_b): commands by how much better one of two centroids fits; commands without a vector last."""
    from ..functions import vectors as V

    at = lambda v: F.when(F.col("embedding").isNotNull(), F.round(V.cosine(F.col("embedding"), F.array(*[F.lit(float(x)) for x in v])), 6))
    out = commands.select("command_line", at(a).alias("to_a"), at(b).alias("to_b"))
    return out.orderBy(F.desc_nulls_last(F.abs(F.col("to_a") - F.col("to_b"))), "command_line")


def daily_of_largest(rows: DataFrame, key: str, as_of: str, top: int = 30, days: int = 14, ts: str = "ts") -> DataFrame:
    """(key, day, n) of the largest keys only, with a row for each of the last days."""
    from .rollups import daily

    largest = top_keys(rows, key, top).select(key)
    return daily(rows.join(largest, key, "left_semi"), key, as_of, days, ts)


def cluster_places(addresses: DataFrame, column: str, top: int = 5) -> DataFrame:
    """(cluster_id, column, n, rank): the most frequent countries or networks of each cluster of addresses."""
    inner = addresses.where(F.col("cluster_id").isNotNull() & (F.col("cluster_id") != clustering.OUTLIER))
    return dominant(inner, "cluster_id", column, top)


def metrics(sessions: DataFrame) -> DataFrame:
    """One row: sessions, those with commands, outliers, and intrusions (a login and a command)."""
    intrusion = (F.col("login_success_count") > 0) & (F.col("command_count") > 0)
    return sessions.agg(F.count("*").alias("total"), F.count_if(F.col("command_count") > 0).alias("with_commands"), F.count_if(F.col("cluster_id") == clustering.OUTLIER).alias("outliers"), F.count_if(intrusion).alias("intrusions"))


def over_time(sessions: DataFrame, unit: str = "day") -> DataFrame:
    return sessions.groupBy(F.date_trunc(unit, "start_ts").alias("at")).agg(F.count("*").alias("n"))


def shares(rows: DataFrame, column: str, missing: str = "unknown") -> DataFrame:
    """(column, n, share) of each value."""
    n = rows.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(missing)).alias(column)).agg(F.count("*").alias("n"))
    return n.join(F.broadcast(n.agg(F.sum("n").alias("all")))).select(column, "n", F.round(F.col("n") / F.col("all"), 6).alias("share"))


def most_novel(sessions: DataFrame, top: int = 15) -> DataFrame:
    return sessions.orderBy(F.desc_nulls_last("mean_novelty_score"), "session_id").limit(top)


def cluster_list(sessions: DataFrame) -> DataFrame:
    """(cluster_id, n, place): clusters as a timeline lists them, `none` late and outliers last."""
    named = F.coalesce(F.col("cluster_id"), F.lit("none"))
    counts = sessions.groupBy(named.alias("cluster_id")).agg(F.count("*").alias("n"))
    late = F.when(F.col("cluster_id") == clustering.OUTLIER, 2).when(F.col("cluster_id") == "none", 1).otherwise(0)
    return counts.withColumn("place", F.row_number().over(Window.orderBy(late, F.length("cluster_id"), "cluster_id")))  # a row a cluster


def discovered(artifacts: DataFrame) -> DataFrame:
    """(kind, n): distinct artifacts of each kind."""
    return artifacts.select("kind", "value").distinct().groupBy("kind").agg(F.count("*").alias("n"))


def overrides(judged: DataFrame) -> DataFrame:
    """(override, n): by what rule verdicts were decided."""
    return judged.groupBy("override").agg(F.count("*").alias("n"))


def pair_members(runs: DataFrame, a: str, b: str, most: int = 200) -> DataFrame:
    """Members with an embedding of two clusters in the latest run, at most so many of each, by id."""
    rows = clustering.latest_run(runs).where(F.col("cluster_id").isin(a, b) & F.col("embedding").isNotNull())
    order = Window.partitionBy("cluster_id").orderBy("id")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).drop("place")
