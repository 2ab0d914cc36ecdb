"""A corpus from documents: language ID, exact dedup, n-gram Jaccard join, suffix dedup, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and all but the last
return the columns of ``docs``. Null or empty texts: the language stage rejects them, as it rejects texts without a
letter and texts far from every learned language; rows with a null doc_id pass the near-duplicate stages untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chunkspark.llm.common import documents, stored
from chunkspark.llm.exact_dedup import exact_keep
from chunkspark.llm.jaccard_join import jaccard_classes
from chunkspark.llm.language_id import accepted, fit, held_out
from chunkspark.llm.packing import pack_documents, vocabulary_path
from chunkspark.llm.suffix_dedup import deduplicated
from chunkspark.plans.registry import query


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from ``docs`` itself; those rejected go."""
    return accepted(docs, fit(docs.filter(~held_out())))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact_keep(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest doc_id."""
    gone = jaccard_classes(docs).filter(F.col("class_id") != F.col("doc_id")).select(F.col("doc_id").alias("_gone")).distinct()
    named = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    at = named[f"_c{docs.columns.index('doc_id')}"].cast("long")
    return named.join(gone, at == gone["_gone"], "left_anti").toDF(*docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that an earlier text holds in a string of 100; ``n_chars`` follows the text."""
    left = deduplicated(docs)
    if "n_chars" not in docs.columns:
        return left
    counted = F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return left.select(*[counted.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boundary records of full sequences."""
    return pack_documents(docs, vocabulary_path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id), ("exact_dedup", exact_dedup), ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup), ("packing", packing),
]

#: Near copies, languages and token ids have no SQL form.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
