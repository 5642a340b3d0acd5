"""The corpus pipeline: toxic documents go, one document of each near-duplicate group stays, repeated
passages and personal data are cut out of the texts, and the rest is packed into training sequences.

Every stage takes the columns of documents and leaves others aside, whatever their names. A null
text counts as empty but stays null until it is packed; null ids stay null; an empty table gives
no row; texts of any length are worked on as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import identifiers, packing, severity, shingle_join, substrings
from tidemark.llm._common import dropped_since, scratch_mark, table, written
from tidemark.llm.queries import _vocabulary

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars as the text now has them."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model doesn't call toxic; the model is fitted to the labelled ones among them.

    Repeated rows stay or go together; without labels, or with one grade only, all stay.
    """
    model = severity.fit(docs, severity.grades_of(table(spark, sf_dir, "labels")))
    return severity.score(docs.select(*COLUMNS), model).where(~F.col("toxic")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id, of equal ids the least by text hash.

    Rows that repeat as a whole come once. Documents without words are nobody's copies and stay, as do
    unrelated texts under one id or without an id.
    """
    return shingle_join.one_of_each(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; documents stay, even if nothing is left of them.

    Earlier is the smaller id, of equal or missing ids the smaller text hash; rows that repeat id and
    text are cut alike.
    """
    return _documents(substrings.dedup(docs.select(*COLUMNS)))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with their identifiers masked by kind; where spans overlap, the one that starts first counts.

    All documents stay; rows that repeat are masked alike.
    """
    return _documents(identifiers.mask(docs.select(*COLUMNS)))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 ids with the parts of documents that they hold; an end id follows each document.

    A document without text is its end id alone; rows that repeat are packed each.
    """
    return packing.sequences(packing.pack(docs, _vocabulary("byte_bpe_50k.json"), 2048, end_id=1), 2048, pad_id=50256)


STAGES = [
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("personal data", personal_data),
    ("packing", sequences),
]

#: Stages fit a model and join by similarity, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; what a stage has put aside goes when its result is written."""
    docs, start = table(spark, sf_dir, "documents"), scratch_mark()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        dropped_since(start, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
