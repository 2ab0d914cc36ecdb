"""What a table or a query returns, and which tables there are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chunkspark.functions.types import column_bytes, type_class, value_width
from chunkspark.sources.results import quote_name

_DESCRIPTION = "position int, name string, type_class string, width int"


def schema_of(spark: SparkSession, source):
    """Schema of a DataFrame, a table name or a query text; no job runs."""
    if isinstance(source, DataFrame):
        return source.schema
    if spark.catalog.tableExists(quote_name(source)):
        return spark.table(quote_name(source)).schema
    return spark.sql(source).schema


def describe_schema(spark: SparkSession, source) -> DataFrame:
    """Position, name, type class and byte width of every column."""
    fields = schema_of(spark, source)
    rows = [(i, f.name, type_class(f), value_width(f)) for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, _DESCRIPTION)


def column_sizes(df: DataFrame) -> DataFrame:
    """describe_schema with the chunk bytes each column takes over all rows."""
    described = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("name"),
            F.lit(type_class(f)).alias("type_class"),
            F.lit(value_width(f)).alias("width"),
            F.coalesce(F.sum(column_bytes(f)), F.lit(0).cast("long")).alias("stored_bytes"),
        )
        for i, f in enumerate(df.schema)
    ]
    return df.agg(F.array(*described).alias("columns")).select(F.inline("columns"))


def list_tables(spark: SparkSession) -> DataFrame:
    """Names of the tables and views of the session."""
    return spark.sql("SHOW TABLES").select(F.col("tableName").alias("table_name"))


def table_row_counts(spark: SparkSession, names) -> DataFrame:
    """Listed tables among ``names`` with their rows."""
    listed = list_tables(spark)
    counts = [
        spark.table(quote_name(n))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    counted = counts[0]
    for more in counts[1:]:
        counted = counted.unionByName(more)
    return counted.join(listed.distinct(), "table_name", "left_semi")
