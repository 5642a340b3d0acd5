"""Scalar blocks that stand beside an embedding when rows of a layer are clustered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, Config
from ..functions import vectors as V
from . import clustering
from .rollups import top_keys


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def command_scalars(commands: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(command_hash, command_line, scalars) with f_occurrence, f_ips and f_reuse."""
    reuse = F.least(F.col("unique_sessions") / F.col("occurrence_count"), F.lit(1.0)) * config.scalar_weight
    return commands.select(
        "command_hash", "command_line", V.scaled_log(F.col("occurrence_count"), config.occurrence_base).alias("f_occurrence"),
        V.scaled_log(F.col("unique_source_ips"), config.ips_base).alias("f_ips"), reuse.alias("f_reuse"),
    )


def session_scalars(sessions: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """(session_id, f_commands, f_unique, login_success_rate)."""
    rate = share(F.col("login_success_count"), F.col("login_success_count") + F.col("login_fail_count"))
    return sessions.select(
        "session_id", V.scaled_log(F.col("command_count"), config.session_commands_base).alias("f_commands"),
        V.scaled_log(F.col("unique_commands"), config.session_commands_base).alias("f_unique"), rate.alias("login_success_rate"),
    )


def address_scalars(addresses: DataFrame, intel: DataFrame | None = None, config: Config = DEFAULT) -> DataFrame:
    """(source_ip, f_sessions, f_duration, f_success, intel_confidence, intel_malicious); without intel 0 and false."""
    out = addresses.select(
        "source_ip", V.scaled_log(F.col("total_sessions"), config.ip_sessions_base).alias("f_sessions"),
        V.scaled_log(F.col("mean_session_duration_s"), config.ip_duration_base).alias("f_duration"), share(F.col("successful_sessions"), F.col("total_sessions")).alias("f_success"),
    )
    if intel is None:
        return out.withColumns({"intel_confidence": F.lit(0.0), "intel_malicious": F.lit(False)})
    known = intel.select("source_ip", (F.col("confidence") / 10.0).alias("c"), F.col("malicious").alias("m"))
    return out.join(known, "source_ip", "left").withColumns({"intel_confidence": F.coalesce("c", F.lit(0.0)), "intel_malicious": F.coalesce("m", F.lit(False))}).drop("c", "m")


def one_hot(rows: DataFrame, key: str, top: int) -> DataFrame:
    """rows with key_hot: a vector with a place for each of the most frequent values and a last one for all others."""
    best = [r[key] for r in top_keys(rows, key, top).collect()]  # at most `top` values
    other = ~F.coalesce(F.col(key).isin(*best), F.lit(False)) if best else F.lit(True)
    return rows.withColumn(f"{key}_hot", F.array(*[F.coalesce((F.col(key) == v), F.lit(False)).cast("int") for v in best], other.cast("int")))


def spread(rows: DataFrame, group: str, value: str) -> DataFrame:
    """(group, mean, std): the sample deviation, 0 for a single row."""
    return rows.groupBy(group).agg(F.round(F.avg(value), 6).alias("mean"), F.round(F.coalesce(F.stddev_samp(value), F.lit(0.0)), 6).alias("std"))


def block(embedding: Column, *scalars: Column) -> Column:
    """The unit embedding followed by the scalars."""
    return F.concat(V.l2_normalised(embedding), F.array(*[F.coalesce(s.cast("double"), F.lit(0.0)) for s in scalars]))


def clustered_layer(rows: DataFrame, layer: str, id_col: str, scalars: list[str], min_cluster_size: int = 3) -> DataFrame:
    """(id, cluster_id) of one layer (commands, sessions, addresses) by its embeddings with their scalar block."""
    blocks = rows.where(F.col("embedding").isNotNull()).select(F.lit(layer).alias("layer"), F.col(id_col).alias("id"), block(F.col("embedding"), *map(F.col, scalars)).alias("embedding"))
    return clustering.density_clusters(blocks, "layer", min_cluster_size, unit=False).select(F.col("id").alias(id_col), "cluster_id")


def run_summary(labels: DataFrame) -> DataFrame:
    """One row: documents, clusters and outliers of a run."""
    inner = F.when(F.col("cluster_id") != clustering.OUTLIER, F.col("cluster_id"))
    return labels.agg(F.count("*").alias("documents"), F.countDistinct(inner).alias("clusters"), F.count_if(F.col("cluster_id") == clustering.OUTLIER).alias("outliers"))
