"""Normal forms by kind of indicator, and the engine's expressions as functions of Spark SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import network as N
from . import text as T

#: How each kind of indicator is brought to one form; null for what can't be one.
CANONICAL: dict[str, Callable[[Column], Column]] = {
    "ip": N.canonical_ip,
    "url": N.canonical_url,
    "domain": N.canonical_domain,
    "hash": N.canonical_hash,
}


def canonical(kind: Column, value: Column) -> Column:
    """The value in its kind's form; kinds without one give null."""
    out = F.lit(None).cast("string")
    for name, form in CANONICAL.items():
        out = F.when(kind == name, form(value)).otherwise(out)
    return out


#: Bodies of SQL functions of one text `x`; they are plain expressions, so the optimizer sees through them.
SQL_FUNCTIONS = {
    "tm_normalised": ("STRING", r"substring(trim(regexp_replace(x, '(?U)[\\s\\x1c-\\x1f]+', ' ')), 1, 4000)"),
    "tm_hash16": ("STRING", "substring(sha2(x, 256), 1, 16)"),
    "tm_label": ("STRING", "CASE WHEN length(x) > 80 THEN concat(substring(x, 1, 80), '…') ELSE x END"),
}


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to the session's SQL for as long as it lasts; their names."""
    for name, (kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x STRING) RETURNS {kind} RETURN {body}")
    return list(SQL_FUNCTIONS)
