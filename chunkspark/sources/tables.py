"""Load and change tables, and tell how many rows that touched.

A load counts in the pass that writes. A change counts first, on the columns of
its condition only, and leaves the table alone when nothing is to be changed.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from chunkspark.functions.types import quoted
from chunkspark.operators.partition import PARTITION_ID, ROW_NO, ROW_POS, PartitionSpec, frozen_rows
from chunkspark.operators.positions import with_row_pos
from chunkspark.sources.positional import map_positional
from chunkspark.session import shared_dir
from chunkspark.sources.results import quote_name, remove_folder


def load_table(df: DataFrame, table: str, columns=None) -> int:
    """Append rows by named columns and tell how many; columns not named get the
    default of the table."""
    names = list(columns or df.columns)
    listed = ", ".join(quote_name(n) for n in names)
    seen = Observation()
    counted = df.select(*[quoted(n) for n in names]).observe(seen, F.count(F.lit(1)).alias("n"))
    df.sparkSession.sql(
        f"INSERT INTO {quote_name(table)} ({listed}) SELECT * FROM {{rows}}", rows=counted
    )
    try:
        return seen.get["n"]
    except Py4JJavaError:
        # An input the optimizer finds empty takes the observation away with it.
        return df.count()


def load_mapped(records: DataFrame, table: str, schema: T.StructType, treat_zero_len_as_null: bool = True) -> int:
    """Append positional records, computing the target values from the fields."""
    return load_table(map_positional(records, schema, treat_zero_len_as_null), table)


def insert_rows(spark: SparkSession, table: str, rows) -> int:
    """Append the rows of a DataFrame or a query text; returns their number."""
    df = spark.sql(rows) if isinstance(rows, str) else rows
    return load_table(df, table)


def _holds(predicate) -> Column:
    """Predicate with unknown as false."""
    condition = F.expr(predicate) if isinstance(predicate, str) else predicate
    return F.coalesce(condition, F.lit(False))


def without_rows(df: DataFrame, predicate) -> DataFrame:
    return df.filter(~_holds(predicate))


def with_updates(df: DataFrame, values: dict, predicate) -> DataFrame:
    """Rows with the ``values`` columns replaced where the predicate holds; all
    values are computed from the row as it was."""
    hit = _holds(predicate)
    new = {
        name: F.when(hit, (F.expr(v) if isinstance(v, str) else v).cast(df.schema[name].dataType)).otherwise(quoted(name))
        for name, v in values.items()
    }
    return df.withColumns(new)


def delete_where(spark: SparkSession, table: str, predicate) -> int:
    """Remove the rows the predicate holds for; returns their number."""
    return _change(spark, table, predicate, lambda rows: without_rows(rows, predicate), ())


def update_where(spark: SparkSession, table: str, values: dict, predicate) -> int:
    """Change the rows the predicate holds for; returns their number."""
    return _change(spark, table, predicate, lambda rows: with_updates(rows, values, predicate), tuple(values))


def _change(spark: SparkSession, table: str, predicate, change, changed: tuple[str, ...]) -> int:
    """Apply ``change`` to a table. File tables have no UPDATE or DELETE, so content is written anew: of a
    table with partition columns only the partitions that hold a hit, of any other all of it."""
    finish_change(spark, table)
    rows = spark.table(quote_name(table))
    layout = _layout(spark, table)
    folders = layout["partitions"]
    if not folders:
        hits = rows.filter(_holds(predicate)).count()
        if hits:
            _replace(spark, table, change(rows), layout)
        return hits
    # One row per partition of the table that holds a hit.
    held = rows.groupBy(*[quoted(c) for c in folders]).agg(F.count_if(_holds(predicate)).alias("_hits")).filter("_hits > 0")
    held = frozen_rows(held).drop(ROW_NO)
    hits = held.agg(F.sum("_hits")).first()[0] or 0
    if hits and set(folders) & set(changed):
        # Rows move between partitions, so all of them are written anew.
        _write_over(spark, table, change(rows), "static", None)
    elif hits:
        touched = held.select(*[quoted(c) for c in folders])
        some = rows.join(touched, reduce(Column.__and__, [rows[c].eqNullSafe(touched[c]) for c in folders]), "left_semi")
        _write_over(spark, table, change(some), "dynamic", touched)
    return hits


# Table property that names the change under way: its mode and the folder of its rows.
UNDER_WAY = "chunkspark.change"


def _write_over(spark: SparkSession, table: str, coming: DataFrame, mode: str, touched: DataFrame | None) -> None:
    """Put ``coming`` in the place of partitions of a table: all of them (static) or the ``touched`` ones. All new rows are
    written aside and noted in the table's properties before any old one goes, so ``finish_change`` can do it again."""
    folder = f"{shared_dir(spark)}/changes/{uuid.uuid4().hex}"
    coming.write.parquet(f"{folder}/rows")
    if touched is not None:
        touched.write.parquet(f"{folder}/touched")
    spark.sql(f"ALTER TABLE {quote_name(table)} SET TBLPROPERTIES ('{UNDER_WAY}' = '{mode} {folder}')")
    finish_change(spark, table)


def finish_change(spark: SparkSession, table: str) -> bool:
    """Finish the change of a partitioned table that a lost session left under way; tells whether there was one. Every later change
    does this first. Doing it twice does no harm, as it writes the same rows to the same partitions."""
    told = spark.sql(f"SHOW TBLPROPERTIES {quote_name(table)}").collect()
    mode, _, folder = next((r["value"] for r in told if r["key"] == UNDER_WAY), "").partition(" ")
    if not folder:
        return False
    schema = spark.table(quote_name(table)).schema
    coming = spark.read.schema(schema).parquet(f"{folder}/rows")
    with _overwriting(spark, mode):
        coming.write.mode("overwrite").insertInto(quote_name(table))
    if mode == "dynamic":
        # Partitions that lost all their rows are not among those written.
        folders = _layout(spark, table)["partitions"]
        touched = spark.read.schema(T.StructType([schema[c] for c in folders])).parquet(f"{folder}/touched")
        kept = coming.select(*[quoted(c) for c in folders])
        emptied = touched.join(kept, reduce(Column.__and__, [touched[c].eqNullSafe(kept[c]) for c in folders]), "left_anti")
        for r in emptied.toLocalIterator():
            spec = ", ".join(f"{quote_name(c)} = {_literal(r[c])}" for c in folders)
            spark.sql(f"ALTER TABLE {quote_name(table)} DROP IF EXISTS PARTITION ({spec})")
    spark.sql(f"ALTER TABLE {quote_name(table)} UNSET TBLPROPERTIES ('{UNDER_WAY}')")
    remove_folder(spark, folder)
    return True


@contextmanager
def _overwriting(spark: SparkSession, mode: str):
    """``dynamic``: overwriting a table replaces the partitions that are written and no others; ``static``: all of them."""
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, mode)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _literal(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _layout(spark: SparkSession, table: str) -> dict:
    """Place and layout of a table, from the catalog."""
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(table)}").collect()}
    columns = spark.catalog.listColumns(quote_name(table))
    listed = lambda name: [c.strip("` ") for c in told.get(name, "[]").strip("[]").split(",") if c.strip("` ")]
    return {
        "partitions": [c.name for c in columns if c.isPartition],
        "buckets": int(told.get("Num Buckets", 0)), "bucketed": listed("Bucket Columns"), "sorted": listed("Sort Columns"),
        "path": told["Location"], "managed": told.get("Type") == "MANAGED",
        "own": OWNED in told.get("Table Properties", ""),
    }


# Table property of tables whose folder a change made.
OWNED = "chunkspark.rewritten"


def _replace(spark: SparkSession, table: str, rows: DataFrame, layout: dict) -> None:
    """Put ``rows`` in the place of ``table``, which has no partition columns, in the same buckets. They are written in full under a
    name and a folder that nobody has. One step of the catalog then points the table to that folder, so at any time it has
    its old rows or its new ones; a session lost before leaves a table ``<table>__<mark>``, one lost after an old folder."""
    mark = uuid.uuid4().hex[:12]
    coming, path = _beside(table, mark), layout["path"].rstrip("/")
    folder = f"{path.rpartition('__')[0] if layout['own'] else path}__{mark}"
    writer = rows.write.format("parquet").mode("errorifexists").option("path", folder)
    if layout["buckets"]:
        writer = writer.bucketBy(layout["buckets"], *layout["bucketed"])
        writer = writer.sortBy(*layout["sorted"]) if layout["sorted"] else writer
    writer.saveAsTable(quote_name(coming))
    spark.sql(f"ALTER TABLE {quote_name(table)} SET LOCATION '{folder}'")
    spark.sql(f"ALTER TABLE {quote_name(table)} SET TBLPROPERTIES ('{OWNED}' = 'true')")
    spark.catalog.refreshTable(quote_name(table))
    # The name goes, its folder is the table's now.
    spark.sql(f"DROP TABLE {quote_name(coming)}")
    # A folder that somebody named is not deleted; one that the catalog or an earlier change made is.
    if layout["managed"] or layout["own"]:
        remove_folder(spark, path)


def _beside(table: str, mark: str) -> str:
    return f"{table}__{mark}"


def create_table(spark: SparkSession, name: str, columns: str, path: str | None = None) -> None:
    """Create an empty table from a DDL column list, defaults included."""
    spark.sql(f"CREATE TABLE {quote_name(name)} ({columns}) USING parquet {_location(path)}")


def create_table_as(spark: SparkSession, name: str, sql: str, path: str | None = None) -> None:
    spark.sql(f"CREATE TABLE {quote_name(name)} USING parquet {_location(path)} AS {sql}")


def _location(path: str | None) -> str:
    return f"LOCATION '{path}'" if path else ""


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quote_name(name)}")


def with_row_key(
    df: DataFrame, order=(), name: str = "row_key", start: int = 1, task_bytes: int = PartitionSpec.task_bytes,
) -> DataFrame:
    """Number rows from ``start`` in the given order. Past ``task_bytes`` the rows
    are ordered over many tasks and numbered by per-task counts."""
    located = with_row_pos(df, PartitionSpec(1, (), tuple(order), None, task_bytes))
    return located.withColumn(name, F.col(ROW_POS) + start).drop(PARTITION_ID, ROW_POS)
