"""Views of the driver's tables in the shape of the domain, in Spark and, as SQL, for comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ACTIONS = {"signup": "login.success", "error": "login.failed", "purchase": "file_download", "click": "command.input", "view": "command.input"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(table(spark, sf_dir, "events"))


def as_events(raw: DataFrame) -> DataFrame:
    """Raw events: one user is one source address, a user's day one session; works on streams too."""
    action = F.create_map(*[F.lit(x) for pair in ACTIONS.items() for x in pair])[F.col("event_type")]
    k = F.get_json_object("props", "$.k")
    return raw.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("user_id").cast("string").alias("source_ip"),
        F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMdd")).alias("session_id"),
        "event_type", action.alias("action"), F.concat("event_type", F.lit(" k="), k).alias("command_line"), F.col("value"), k.cast("int").alias("k"),
    )


EV = """ev AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) AS source_ip, user_id || '-' || strftime(ts, '%Y%m%d') AS session_id, event_type,
    CASE event_type WHEN 'signup' THEN 'login.success' WHEN 'error' THEN 'login.failed' WHEN 'purchase' THEN 'file_download' ELSE 'command.input' END AS action,
    event_type || ' k=' || json_extract_string(props, '$.k') AS command_line, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session vectors: (id, embedding, cluster_id)."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("cluster_id"))


VEC = """vec AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS embedding, CAST(label AS VARCHAR) AS cluster_id FROM embeddings)"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Command texts: a document is a session's command, its source the address."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("session_id"), F.col("source").alias("source_ip"), F.col("text").alias("command_line"))


def bags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions: a customer is an address, a part's brand a playbook."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(F.col("o_custkey").alias("source_ip"), F.col("p_brand").alias("playbook_id")).distinct()


BAG = """bag AS (SELECT DISTINCT o_custkey AS source_ip, p_brand AS playbook_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""
