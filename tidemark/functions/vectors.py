"""Vector arithmetic on array columns, and the weights and scores that the layers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def l2_normalised(v: Column) -> Column:
    n = norm(v)
    return F.transform(v, lambda x: x / F.when(n == 0, F.lit(1.0)).otherwise(n))


def cosine(a: Column, b: Column) -> Column:
    both = norm(a) * norm(b)
    return F.coalesce(F.when(both > 0, dot(a, b) / both), F.lit(0.0))


def pool_weight(occurrences: Column, total: float = DEFAULT.pool_documents) -> Column:
    """ln((total + 1) / (occurrences + 1)), occurrences held between 1 and total."""
    held = F.least(F.greatest(F.coalesce(occurrences.cast("double"), F.lit(1.0)), F.lit(1.0)), F.lit(total))
    return F.log((F.lit(total) + 1) / (held + 1))


def mean_pool(rows: DataFrame, key: str, vector: str = "embedding", weight: str | None = None) -> DataFrame:
    """(key, embedding): the unit mean of the keys' unit vectors; zero vectors and weights are skipped.

    Sums are taken by position, so partial aggregation runs on the map side and no vector list of a
    key is ever held.
    """
    n, w = norm(F.col(vector)), F.col(weight).cast("double") if weight else F.lit(1.0)
    parts = rows.select(F.col(key), F.when((n > 0) & (w > 0), w / n).alias("w"), F.posexplode(vector).alias("at", "x"))
    sums = parts.groupBy(key, "at").agg(F.coalesce(F.sum(F.col("w") * F.col("x")), F.lit(0.0)).alias("x"))
    whole = sums.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("v"))
    return whole.select(key, l2_normalised(F.col("v")).alias("embedding"))


def centroids(rows: DataFrame, key: str = "cluster_id", vector: str = "embedding") -> DataFrame:
    """(key, centroid, size): plain means, not normalised."""
    parts = rows.select(key, F.posexplode(vector).alias("at", "x")).groupBy(key, "at").agg(F.avg("x").alias("x"), F.count("*").alias("n"))
    return parts.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("centroid"), F.max("n").alias("size"))


def scaled_log(x: Column, base: float, weight: float = DEFAULT.scalar_weight) -> Column:
    """ln(1 + x) as a share of ln(1 + base), held between 0 and 1, times weight."""
    share = F.log1p(x.cast("double")) / F.log1p(F.lit(float(base)))
    return F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * weight


def or_default(x: Column, default: float) -> Column:
    """The value, or the default for null and 0."""
    return F.when(F.coalesce(x, F.lit(0)) == 0, F.lit(default)).otherwise(x)


def centrality(n: Column, base: float = DEFAULT.centrality_base) -> Column:
    return F.least(F.greatest(F.log1p(n.cast("double")) / F.log1p(F.lit(float(base))), F.lit(0.0)), F.lit(1.0))


def priority(novelty: Column, confidence: Column, central: Column, age: Column, weights=DEFAULT.priority_weights, half_life: float = DEFAULT.half_life_hours) -> Column:
    """What is missing adds nothing."""
    a, b, c, d = weights
    sure = F.when(confidence.isNotNull(), 1 - confidence / 10.0)
    fresh = F.when(age.isNotNull(), F.pow(F.lit(2.0), -age / half_life))
    return sum((w * F.coalesce(x, F.lit(0.0)) for w, x in ((b, sure), (c, central), (d, fresh))), a * F.coalesce(novelty, F.lit(0.0)))


def playbook_score(n: Column, novelty: Column) -> Column:
    return F.log1p(n.cast("double")) * (novelty + 0.01)


def campaign_score(ips: Column, sessions: Column) -> Column:
    return F.log1p(ips.cast("double")) * F.log1p(sessions.cast("double"))
