"""A corpus pipeline over ``documents``: five stages, each applying one operator to all that the one before kept.

Every stage is written as Parquet below the shared checkpoint folder and read
again as the input of the next, so a lost executor costs no more than a stage's
own tasks; a stage's own intermediate tables, and its input if a stage wrote it,
are removed then. All stages but the last return the columns of ``documents``.

Defined cases: null, empty and letterless texts go in the first stage; rows with
a null doc_id stay like any other; of repeated rows one stays; texts of any
length are read whole; an empty table gives no rows; extra columns pass through
to the last stage, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedlens.llm import common, exact_dedup, language, packing, quality, simhash


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language cannot be told, go."""
    return language.keep_identified(docs)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below its threshold go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space the longest, then the smallest doc_id, stays."""
    return exact_dedup.keep_distinct(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the document with the smallest doc_id stays."""
    return simhash.keep_one_of_each(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into windows of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("language ID", identify_language), ("quality classifier", classify_quality),
          ("exact dedup", drop_exact_copies), ("SimHash near-dedup", drop_near_copies), ("packing", pack_windows)]

#: Language models, kernel features, SimHash and BPE have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.documents(spark, sf_dir)
    folder = common.work_dir(spark, "corpus-pipeline")
    for n, (_, stage) in enumerate(STAGES[:-1]):
        with common.intermediate_tables(spark):
            docs = common.written(stage(spark, docs, sf_dir), f"{folder}/{n}")
        common.removed(spark, f"{folder}/{n - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)
