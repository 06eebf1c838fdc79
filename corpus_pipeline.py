"""A training corpus from the documents table, stage by stage.

Each stage takes all rows its predecessor kept and returns the columns of
``documents``; the last one returns packed pieces.  Rejected documents,
further copies and contaminated documents go; personal data is replaced in the
text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import stored, table
from millrace.llm.decontaminate import decontaminate
from millrace.llm.neardup import deduplicate
from millrace.llm.packing import pack
from millrace.llm.pii import redact
from millrace.llm.quality import classify, fit


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps, their columns as they are (null and
    empty texts as its docstring says; an empty table stays empty)."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    # the other columns stand apart, so none of them can clash with the classifier's own
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("text", "lang")]).alias("doc"), "text", "lang")
    kept = classify(model, rows).where("kept")
    return kept.select(*[F.col(c) if c in ("text", "lang") else F.col("doc").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: the first row (null and blank texts
    are alone in theirs; repeated rows are copies)."""
    return deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (null and empty texts hold none; without
    items all stay)."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind, ``n_chars`` adjusted (a null
    text stays null)."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of at most 1024 (a null text is empty:
    its end token alone)."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal_data),
    ("packing", packing),
]

# No stage but decontamination can be written in SQL; the tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
