"""Toxicity as ordered severity grades: a cumulative-link (proportional-odds) regression.

P(grade > k) = sigmoid(w.x - cut_k): one weight for each word, shared by all grades, and ordered
cut points. x marks which words of the model's vocabulary a text has. The fit takes a bounded
sample of labelled documents; scoring reads every text and moves nothing between tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import id_and_text
from .units import by_size

_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def words(text: str) -> set[bytes]:
    """Distinct lower-cased words; ASCII digits and marks part them."""
    return set(text.lower().encode().translate(_LETTERS).split())


@dataclass
class OrdinalModel:
    weights: dict[bytes, float]
    cuts: list[float]  # ascending, one below each grade but the lowest

    def evidence(self, text: str) -> float:
        """The summed weights of the text's known words."""
        return float(sum([self.weights[w] for w in words(text) & self.weights.keys()]))

    def above(self, evidence: float) -> np.ndarray:
        """P(grade > k) for each k."""
        return 1 / (1 + np.exp(np.clip(np.array(self.cuts) - evidence, -60, 60)))


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, n_features: int, penalty: float = 0.005, steps: int = 1500) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending cut points that maximise the penalised likelihood, by scaled gradient steps."""
    n_cuts = int(grades.max()) if len(grades) else 0
    shares = np.array([np.clip((grades > k).mean(), 1e-3, 1 - 1e-3) for k in range(n_cuts)])
    cuts = np.maximum.accumulate(-np.log(shares / (1 - shares))) + 1e-3 * np.arange(n_cuts)
    weights = np.zeros(n_features)
    if not n_cuts or not n_features:
        return weights, cuts
    flat = np.array([f for r in rows for f in r], int)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    params, m, v = np.concatenate([weights, cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))]), 0.0, 0.0
    for t in range(1, steps + 1):
        weights, cuts = params[:n_features], np.cumsum(np.concatenate([params[n_features : n_features + 1], np.exp(params[n_features + 1 :])]))
        score = np.bincount(owner, weights[flat], len(rows))
        low = np.concatenate([[-60.0], cuts])[grades] - score  # the grade lies between two cut points
        high = np.concatenate([cuts, [60.0]])[grades] - score
        s_low, s_high = 1 / (1 + np.exp(-np.clip(low, -60, 60))), 1 / (1 + np.exp(-np.clip(high, -60, 60)))
        p = np.maximum(s_high - s_low, 1e-12)
        d_low, d_high = s_low * (1 - s_low) / p, s_high * (1 - s_high) / p
        by_score = d_low - d_high  # of the log-likelihood
        g_weights = np.bincount(flat, by_score[owner], n_features) - penalty * weights
        g_cuts = np.array([d_high[grades == k].sum() - d_low[grades == k + 1].sum() for k in range(n_cuts)])
        tail = np.cumsum(g_cuts[::-1])[::-1]
        g = np.concatenate([g_weights, tail[:1], tail[1:] * np.exp(params[n_features + 1 :])]) / len(rows)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        params = params + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-10)
    weights, cuts = params[:n_features], np.cumsum(np.concatenate([params[n_features : n_features + 1], np.exp(params[n_features + 1 :])]))
    return weights, cuts


def fit(docs: DataFrame, grades: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 20_000, features: int = 2_000, min_docs: int = 5, min_z: float = 5.0) -> OrdinalModel | None:
    """Fits to at most `sample` labelled documents, those with the least hashed ids; None without any.

    grades: (doc_id, grade int from 0 up); rows with a null are left out. Near copies would teach
    the model their subject, so of documents that share a minimum of hashed five-word shingles one
    stays. A word is a feature if it stands in min_docs documents and its share of grades above 0
    differs by min_z standard errors; the `features` strongest are taken.
    """
    chosen = grades.where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("grade").cast("int").alias("grade"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def described(batches):
        for batch in batches:
            at = 0
            for texts in by_size((t.as_py() for t in batch["text"]), 1 << 20):
                own = batch.slice(at, len(texts))
                at += len(texts)
                lows = [[], [], []]
                for text in texts:
                    row = text.lower().split()
                    grams = [" ".join(row[k : k + 5]) for k in range(max(1, len(row) - 4))]
                    for k, low in enumerate(lows):
                        low.append(min(xxhash.xxh3_64_intdigest(g, k) for g in grams) >> 1)
                seen = pa.array((sorted(words(x)) for x in texts), pa.list_(pa.binary()))
                yield pa.RecordBatch.from_arrays([own["doc_id"], own["grade"], seen, *[pa.array(x, pa.int64()) for x in lows]], names=["doc_id", "grade", "words", "a", "b", "c"])

    rows = id_and_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id").select("doc_id", "grade", "text")
    rows = rows.mapInArrow(described, "doc_id long, grade int, words array<binary>, a long, b long, c long")
    rows = rows.groupBy("a").agg(F.min_by(F.struct("grade", "words", "b", "c"), "doc_id").alias("r"), F.min("doc_id").alias("doc_id")).select("doc_id", "r.*")
    rows = rows.groupBy("b").agg(F.min_by(F.struct("grade", "words", "c"), "doc_id").alias("r"), F.min("doc_id").alias("doc_id")).select("doc_id", "r.*")
    rows = rows.groupBy("c").agg(F.min_by(F.struct("grade", "words"), "doc_id").alias("r"), F.min("doc_id").alias("doc_id")).select("doc_id", "r.*").cache()
    try:
        n, bad = rows.agg(F.count("*"), F.coalesce(F.sum((F.col("grade") > 0).cast("long")), F.lit(0))).first()
        if not n:
            return None
        share = min(max(bad / n, 1e-6), 1 - 1e-6)
        counts = rows.select("grade", F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"), F.sum((F.col("grade") > 0).cast("long")).alias("bad"))
        z = (F.col("bad") - F.col("n") * share) / F.sqrt(F.col("n") * share * (1 - share))
        top = counts.where(F.col("n") >= min_docs).withColumn("z", F.abs(z)).where(F.col("z") >= min_z).orderBy(F.desc("z"), "word").limit(features).collect()
        names = [bytes(r["word"]) for r in top]
        known = F.array(*[F.lit(w) for w in names]).cast("array<binary>")
        held = F.array_intersect("words", known)
        sparse = rows.select("grade", held.alias("held")).collect()
    finally:
        rows.unpersist()
    index = {w: k for k, w in enumerate(names)}
    weights, cuts = fit_ordinal([[index[bytes(w)] for w in r["held"]] for r in sparse], np.array([r["grade"] for r in sparse]), len(names))
    return OrdinalModel(dict(zip(names, weights.tolist())), cuts.tolist())


def score(docs: DataFrame, model: OrdinalModel | None, text_col: str = "text", least: float = 0.2) -> DataFrame:
    """docs with expected_severity, severity (the likeliest count of cut points passed) and toxic.

    A text is toxic if P(grade > 0) >= least and its words speak for it, so that a share of toxic
    documents above `least` alone condemns none.
    A null or empty text has the severity of a text without known words. Without a model, or with
    one grade only, the severity is 0. Columns of these names are replaced. Every row stays, repeated
    ones with the same result each; ids play no part. A text of any length is read as a whole, one
    at a time. A probability that equals `least` counts as toxic. An empty table gives no row.
    """

    @F.arrow_udf("struct<expected:double,grade:int,toxic:boolean>")
    def severity(texts: pa.Array) -> pa.Array:
        evidence = [model.evidence(text.as_py() or "") if model else 0.0 for text in texts]
        above = [model.above(x) if model else np.zeros(0) for x in evidence]
        return pa.StructArray.from_arrays(
            [pa.array([float(a.sum()) for a in above], pa.float64()), pa.array([int((a >= 0.5).sum()) for a in above], pa.int32()), pa.array([bool(x > 0 and len(a) and a[0] >= least) for x, a in zip(evidence, above)], pa.bool_())],
            names=["expected", "grade", "toxic"],
        )

    scored = docs.withColumn("__tm_s", severity(F.col(f"`{text_col}`")))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("expected_severity", "severity", "toxic")]
    return scored.select(*own, F.col("__tm_s.expected").alias("expected_severity"), F.col("__tm_s.grade").alias("severity"), F.col("__tm_s.toxic").alias("toxic"))


def grades_of(labels: DataFrame) -> DataFrame:
    """Grades from 0/1 labels: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    toxic, quality = F.col("toxic"), F.col("quality")
    return labels.select("doc_id", F.when(toxic >= 1, F.when(quality == 0, 2).otherwise(1)).when(toxic == 0, 0).cast("int").alias("grade"))
