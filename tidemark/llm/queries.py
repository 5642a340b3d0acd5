"""The subpackage's queries, each over its whole table, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import identifiers, imatch, packing, prefix_bpe, severity, shingle_join, substrings, token_blocks, url_rules, vector_passes
from ._common import NULL_ID, scratch_path, table

#: (verdict, host, path)
URL_RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def op1_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_blocks.write_token_store(table(spark, sf_dir, "documents"), path, _vocabulary("byte_bpe_50k.json"), end_id=2)
    return token_blocks.read_token_store(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.round_trips(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_multi_50k.tiktoken"), _pattern())


def page_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page is bad if the document of its number is labelled so, or if its own content has unwanted words."""
    given = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("long").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"))
    return given.unionByName(url_rules.content_labels(table(spark, sf_dir, "pages")))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge(table(spark, sf_dir, "pages"), page_labels(spark, sf_dir), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.dedup(docs).select("doc_id", "text", F.size("removed_spans").cast("long").alias("n_removed"), "removed_spans")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"), 2048, end_id=1)
    digest = cut.select("doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("ids_crc32"), "task", "place")
    return packing.placed(digest, 2048).withColumn("length", F.col("length").cast("long"))


def op6_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = severity.fit(docs, severity.grades_of(table(spark, sf_dir, "labels")))
    return severity.score(docs, model).drop("text")


def op7_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identifiers.found(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_of = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{identifiers.KINDS[k]}")
    doc_id = F.when(F.col("doc") != NULL_ID, F.col("doc")).alias("doc_id")
    return found.select(doc_id, *[n_of(k) for k in range(4)], F.sha2(identifiers.joined(F.col("base")), 256).alias("base_sha256"), identifiers.joined(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op8_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return imatch.edit_likeness(docs, imatch.lexicon(docs))


def op9_vector_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_passes.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.public_ids(shingle_join.similar(table(spark, sf_dir, "documents").select("doc_id", "text")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_blocks, op2_prefix_bpe, op3_url_rules, op4_substrings, op5_packing, op6_severity, op7_identifiers, op8_imatch, op9_vector_passes, op10_shingle_join)}


#: Components by walking all links; `link` has (a, b) in both directions, `node` has (id).
_WALK = """walk AS (SELECT id, id AS reach FROM node UNION SELECT w.id, l.b FROM walk w JOIN link l ON l.a = w.reach),
least AS (SELECT id, min(reach) AS component_id FROM walk GROUP BY 1)"""

OP9_SQL = f"""WITH RECURSIVE v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), node AS (SELECT id FROM v),
link AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id <> y.id AND list_cosine_similarity(x.e, y.e) >= 0.95), {_WALK}
SELECT id AS vec_id, (SELECT count(*) FROM link WHERE a = id) AS n_links, component_id, component_id = id AS kept FROM least"""

OP10_SQL = rf"""WITH RECURSIVE words AS (SELECT doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(generate_series(1, greatest(1, len(w) - 4)), lambda k: array_to_string(w[k:k + 4], ' '))) END AS s FROM words),
node AS (SELECT id FROM sets), one AS (SELECT id, len(s) AS n, unnest(s) AS x FROM sets),
link AS (SELECT p.id AS a, q.id AS b FROM one p JOIN one q ON p.x = q.x AND p.id <> q.id GROUP BY p.id, q.id, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))), {_WALK}
SELECT id AS doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM sets JOIN least USING (id)"""


def oracle_sql() -> dict[str, str]:
    return {"op9_vector_passes": OP9_SQL, "op10_shingle_join": OP10_SQL}
