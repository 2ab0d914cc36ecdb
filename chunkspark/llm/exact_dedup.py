"""Exact deduplication by skew-safe combining (DataFrame operations only).

1. Each task folds the equal texts it reads (the partial half of an aggregation).
2. What is left of a digest meets per (digest, salt). A digest with few rows has one salt; one with
   ``HOT`` rows or more has ``salts``, by reading task, so its copies spread over as many tasks.
3. The winners of the salts, at most ``salts`` rows a text, are combined per digest.

Hot digests are found by counting; at most ``HOT_LIST`` can be hot, so their list may be broadcast.
So a text that is not hot is shuffled once.

Every grouping has the whole text among its keys next to the digest, so two texts
are one group only when they are identical; the digest merely places them. The
decisions return to the rows by digest. A digest that holds several texts (which a
weak digest shows, SHA-256 does not) is matched by digest and whole text.

Null texts count as empty. A null doc_id is never larger than another; a group of
only null ids keeps one of its rows. Rows repeated with the same doc_id and text
are one group's members, and one of those that tie on the largest doc_id is kept.
Further columns, whatever their names, neither take part nor clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chunkspark.llm.common import documents, stored
from chunkspark.plans.registry import query

SALTS = 16
HOT, HOT_LIST = 1_000, 10_000


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _rows(docs: DataFrame, doc_id: str, text: str, digest: Callable[[Column], Column]) -> DataFrame:
    held = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{doc_id}`").alias("_id"), held.alias("_text")).withColumn("_digest", digest(F.col("_text")))


def _hot(rows: DataFrame) -> DataFrame:
    """Digests with many rows: ``HOT`` at least, and so many that no more than ``HOT_LIST`` can have them."""
    least = max(HOT, -(-rows.count() // HOT_LIST))
    found = rows.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).select("_digest").collect()
    return rows.sparkSession.createDataFrame(found, rows.select("_digest").schema)


def _combined(rows: DataFrame, partial: list[Column], final: list[Column], salts: int, between=lambda df: df) -> DataFrame:
    """``rows`` (_digest, _text, ...) aggregated per text; ``partial`` and ``final`` bear the same names."""
    hot = F.broadcast(_hot(rows))
    cold = rows.join(hot, "_digest", "left_anti").groupBy("_digest", "_text").agg(*partial)
    salted = (
        rows.join(hot, "_digest", "left_semi").withColumn("_salt", F.pmod(F.hash(F.spark_partition_id()), F.lit(salts)))
        .groupBy("_digest", "_salt", "_text").agg(*partial).drop("_salt")
    )
    return cold.unionByName(between(salted).groupBy("_digest", "_text").agg(*final))


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, digest, keep_id, group_size, kept."""
    rows = _rows(docs, doc_id, text, digest)
    def grouped(some: DataFrame) -> DataFrame:
        return _combined(some, [F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")],
                         [F.max("_keep").alias("_keep"), F.sum("_size").alias("_size")], salts)

    groups = stored(grouped(rows).select("_digest", "_keep", "_size"), "exact-groups").groupBy("_digest").agg(
        F.max("_keep").alias("_keep"), F.max("_size").alias("_size"), F.count(F.lit(1)).alias("_texts"))
    narrow = ["_id", "_digest", "_keep", "_size"]
    joined = rows.select("_id", "_digest").join(groups.filter("_texts = 1"), "_digest").select(*narrow)
    several = groups.filter("_texts > 1").select("_digest")
    if not several.isEmpty():
        shared = rows.join(several, "_digest", "left_semi")
        joined = joined.unionByName(shared.join(grouped(shared), ["_digest", "_text"]).select(*narrow))
    # Equal candidates: repeated rows. The window sees only rows that hold the largest id.
    best = joined.filter(F.col("_id").eqNullSafe(F.col("_keep"))).withColumn(
        "_turn", F.row_number().over(Window.partitionBy("_digest", "_keep", "_size").orderBy("_id")))
    rest = joined.filter(~F.col("_id").eqNullSafe(F.col("_keep"))).withColumn("_turn", F.lit(0))
    return best.unionByName(rest).select(
        F.col("_id").alias("doc_id"), F.col("_digest").alias("digest"), F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"), (F.col("_turn") == 1).alias("kept"),
    )


def exact_keep(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               digest: Callable[[Column], Column] = sha256, salts: int = SALTS) -> DataFrame:
    """The whole rows that stay, one per distinct text, all columns as they came."""
    named = docs.toDF(*[f"_c{i}" for i in range(len(docs.columns))])
    at = {name: f"_c{i}" for i, name in enumerate(docs.columns)}
    held = F.coalesce(F.col(at[text]).cast("string"), F.lit(""))
    ranked = F.struct(F.col(at[doc_id]).alias("_id"), *[F.col(c) for c in named.columns if c != at[text]],
                      F.col(at[text]).isNull().alias("_null"))
    best = F.max_by("_row", "_rank")
    order = F.struct(F.col("_row._id").isNotNull().alias("a"), F.col("_row._id").alias("b"))
    rows = named.select(held.alias("_text"), ranked.alias("_row")).withColumn("_rank", order).withColumn("_digest", digest(F.col("_text")))
    kept = _combined(rows, [best.alias("_row")], [best.alias("_row")], salts, lambda df: df.withColumn("_rank", order))
    back = [
        (F.when(F.col("_row._null"), F.lit(None).cast(docs.schema[name].dataType)).otherwise(F.col("_text").cast(docs.schema[name].dataType))
         if at[name] == at[text] else F.col(f"_row.{at[name]}")).alias(name)
        for name in docs.columns
    ]
    return kept.select(*back)


@query("op6_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
""")
def op6_exact_dedup(spark, sf_dir):
    found = exact_groups(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
