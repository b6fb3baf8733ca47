"""A training corpus from the table documents: filter, deduplicate, decontaminate, pack.

All stages but the last return whole rows of docs, whatever other columns there are, and judge every row of an id by
its own text. An empty table stays empty. Null texts are read as empty; what that means is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barloom.llm.common import stored
from barloom.llm.decontam import clean_rows
from barloom.llm.exact_dedup import kept_rows
from barloom.llm.jaccard_join import one_of_each
from barloom.llm.packing import pack
from barloom.llm.quality import accepted


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. Null and empty texts are scored as texts without words; without usable labels all stay."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts, that with the smallest doc_id; null texts equal empty ones. Of repeated rows one stays."""
    return kept_rows(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, that with the smallest doc_id; texts without words stay. Rows of one id stay together if any does."""
    return one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks. Null and empty texts stay; an empty benchmark removes nothing."""
    return clean_rows(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, by sequence. A null or empty text is its end id; repeated rows and ids are packed row by row."""
    return pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: SQL can't express a classifier or a tokenizer: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "_"))
    return docs
