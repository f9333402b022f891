"""Documents to packed training sequences, stage by stage.

Each stage takes what the one before has kept, and all but the last return the columns
of documents: quality rules, quality classifier, near-duplicates, personal data, packing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.packing import pack_documents
from orderlake.llm.quality_cnn import add_scores, fitted
from orderlake.llm.quality_rules import apply_rules
from orderlake.llm.simhash import simhash_components
from orderlake.llm.surrogates import replace_entities
from orderlake.llm.tables import read_table, written

#: Key of the surrogates; a real run brings a secret of its own.
SURROGATE_KEY = "orderlake"


def _with_text(docs: DataFrame, columns: list[str], text: Column, changed: Column) -> DataFrame:
    """``columns`` with another text where it changed, and ``n_chars`` following it."""
    new = {"text": text, "n_chars": F.length(text).cast("bigint")}
    return docs.select(
        *[
            F.when(changed, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c)
            for c in columns
        ]
    )


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that failed."""
    judged = apply_rules(docs).filter("kept")
    return _with_text(judged, docs.columns, F.col("clean_text"), F.col("n_lines_removed") > 0)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts.

    It is fitted to the documents table, where the labels are: few of the documents it
    has to learn to reject are left in ``docs``.
    """
    net = fitted(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return add_scores(docs, net).filter("predicted = 1").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the smallest id, then the first row.

    Rows get a number of their own, so that one row of each class stays even where ids
    are null or repeat; an id beats a null.
    """
    numbered = written(docs.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_place"))
    classes = simhash_components(numbered.select(order.alias("row"), "text"), id_col="row")
    kept = classes.filter("row = component_id").select(F.col("row._place").alias("_place"))
    return numbered.join(kept, "_place", "left_semi").select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates in place of personal data."""
    changed = replace_entities(docs, SURROGATE_KEY)
    return _with_text(changed, docs.columns, F.col("text"), F.col("n_entities") > 0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequence and place of every piece of every document."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: No SQL: the classifier, fingerprints and packing have no counterpart there.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
