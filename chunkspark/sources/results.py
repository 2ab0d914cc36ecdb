"""Query results: run, snapshot, store, read back, drop."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from chunkspark.functions.types import quoted
from chunkspark.operators.chunks import pack_chunks
from chunkspark.operators.partition import (
    PARTITION_ID, ROW_POS, PartitionSpec, accounted_bytes, add_partition_id, check_names, partitions_fit, place, sort_columns,
    spec_sort_key, union_of,
)
from chunkspark.operators.positions import with_row_pos
from chunkspark.session import checkpointed

STORED_HERE = "chunkspark.stored"
SNAPSHOT, STORED, IN_PLACE = "snapshot", "stored", "in_place"
# Nothing reads a bucket's files in one order, so a task may store less of it than it may hold.
SHARES = 4


def run_query(spark: SparkSession, sql: str) -> DataFrame:
    """Rows of any SQL text, unsplit."""
    return spark.sql(sql)


def _rows_of(spark: SparkSession, query) -> DataFrame:
    return query if isinstance(query, DataFrame) else spark.sql(query)


def _laid_out(df: DataFrame, spec: PartitionSpec, chunk_bytes: int | None) -> DataFrame:
    return pack_chunks(df, spec, chunk_bytes) if chunk_bytes else with_row_pos(df, spec)


def snapshot_result(spark, name: str, query, spec: PartitionSpec, chunk_bytes: int | None = None) -> DataFrame:
    """Freeze a result, split and positioned, as view ``name`` of this session."""
    frozen = checkpointed(_laid_out(_rows_of(spark, query), spec, chunk_bytes))
    frozen.createOrReplaceTempView(quote_name(name))
    return frozen


def materialize_result(
    spark, name: str, query, spec: PartitionSpec, chunk_bytes: int | None = None,
    path: str | None = None, layout: str = "partitioned",
) -> DataFrame:
    """Store a result as table ``name`` for any number of passes.

    ``partitioned`` keeps a folder per partition, with positions and, given
    ``chunk_bytes``, chunks. ``bucketed`` keeps ``spec.partitions`` buckets of the
    partition columns, for later in-place reads that join or group on them.
    """
    rows = _rows_of(spark, query)
    if layout == "partitioned":
        writer = _laid_out(rows, spec, chunk_bytes).write.partitionBy(PARTITION_ID)
    elif layout == "bucketed":
        if not spec.by:
            raise ValueError("a bucketed result needs partition columns")
        by = list(spec.by)
        bucket = F.pmod(F.hash(*[quoted(c) for c in by]), F.lit(spec.partitions)).cast("long")
        # One file per bucket while buckets are small; others get a file for each share, sorted by a task of its own.
        share = max(1, spec.task_bytes // SHARES)
        if partitions_fit(rows.withColumn(PARTITION_ID, bucket), share):
            rows = rows.repartition(spec.partitions, *[quoted(c) for c in by])
        else:
            rows = _salted(check_names(rows), bucket, share)
        order = spec_sort_key(rows, spec)
        writer = rows.write.bucketBy(spec.partitions, by[0], *by[1:]).sortBy(order[0], *order[1:])
    else:
        raise ValueError(f"unknown layout {layout}")
    if path:
        writer = writer.option("path", path)
    writer.mode("overwrite").format("parquet").saveAsTable(quote_name(name))
    if path:
        spark.sql(f"ALTER TABLE {quote_name(name)} SET TBLPROPERTIES ('{STORED_HERE}' = 'true')")
    return spark.table(quote_name(name))


def _salted(rows: DataFrame, bucket, share: int) -> DataFrame:
    """Rows in one task per bucket and ``share`` bytes of it. Tasks are numbered along the buckets, for a hash would put several shares into one."""
    numbered = rows.withColumn(PARTITION_ID, bucket)
    needed = F.ceil(F.sum(accounted_bytes(numbered)) / share).cast("int")
    sizes = numbered.groupBy(PARTITION_ID).agg(needed.alias("_used"))
    # One row per bucket.
    through = F.sum("_used").over(Window.orderBy(PARTITION_ID)).cast("int")
    sizes = sizes.withColumn("_first", through - F.col("_used"))
    tasks = sizes.agg(F.sum("_used")).first()[0]
    dealt = numbered.join(sizes, PARTITION_ID)
    # By a hash of a row's number, as keys that come round in turn would meet few of the shares.
    task = F.col("_first") + F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_used")).cast("int")
    return dealt.withColumn("_pos", task).repartitionById(tasks, F.col("_pos")).select(*[quoted(c) for c in rows.columns])


def drop_result(spark: SparkSession, name: str, mode: str) -> None:
    """Release a result; an in-place read holds nothing."""
    if mode == SNAPSHOT:
        spark.catalog.dropTempView(name)
    elif mode == STORED:
        told = {}
        if spark.catalog.tableExists(quote_name(name)):
            told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(name)}").collect()}
        spark.sql(f"DROP TABLE IF EXISTS {quote_name(name)}")
        # The folder of a result stored under a path of its own is not the catalog's to delete.
        if STORED_HERE in told.get("Table Properties", ""):
            remove_folder(spark, told["Location"])
    elif mode != IN_PLACE:
        raise ValueError(f"unknown mode {mode}")


def remove_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def quote_name(name: str) -> str:
    """Quoted name; dots part database and table."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def read_partitions(df: DataFrame, partitions, order=None) -> DataFrame:
    """Rows of the listed partitions, in partition order and ``order`` (default
    stored position). A stored table reads only their folders."""
    wanted = df.filter(quoted(PARTITION_ID).isin(list(partitions)))
    return wanted.orderBy(PARTITION_ID, *[quoted(c) for c in (order or [ROW_POS])])


def read_partition(df: DataFrame, partition: int, order=None) -> DataFrame:
    return read_partitions(df, [partition], order)


def read_owned(
    df: DataFrame, workers: int, worker: int, consumers: int = 1, consumer: int = 0, order=None,
) -> DataFrame:
    """One consumer's share of a result: partition p belongs to worker ``p % workers`` and there to consumer
    ``(p div workers) % consumers``. A stored table reads only the folders of the share."""
    if not (0 <= worker < workers and 0 <= consumer < consumers):
        raise ValueError("worker and consumer must be below their numbers")
    number = quoted(PARTITION_ID)
    own = (F.pmod(number, F.lit(workers)) == worker) & (F.pmod(F.floor(number / workers), F.lit(consumers)) == consumer)
    return df.filter(own).orderBy(PARTITION_ID, *[quoted(c) for c in (order or [ROW_POS])])


def choose_mode(spark: SparkSession, table: str, spec: PartitionSpec, many_passes: bool = False) -> str:
    """How to read a table split by ``spec``, from its catalog entry alone: in place when its buckets are the
    partitions and its files are sorted as asked, else stored for many passes and a snapshot for one."""
    columns = {c.name for c in spark.catalog.listColumns(quote_name(table)) if c.isBucket}
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(table)}").collect()}
    listed = [c.strip("` ") for c in told.get("Sort Columns", "[]").strip("[]").split(",") if c.strip("` ")]
    fits = columns and columns <= set(spec.by) and int(told.get("Num Buckets", 0)) == spec.partitions
    if fits and list(spec.order) == listed[: len(spec.order)]:
        return IN_PLACE
    return STORED if many_passes else SNAPSHOT


def read_auto(spark: SparkSession, name: str, table: str, spec: PartitionSpec, many_passes: bool = False, path: str | None = None) -> DataFrame:
    """``table`` split by ``spec``, in the mode ``choose_mode`` finds; a result that is kept is called ``name``."""
    mode = choose_mode(spark, table, spec, many_passes)
    if mode == IN_PLACE:
        buckets = [c.name for c in spark.catalog.listColumns(quote_name(table)) if c.isBucket]
        return read_in_place(spark, spark.table(quote_name(table)), spec, bucketed_by=buckets)
    rows = spark.table(quote_name(table))
    return materialize_result(spark, name, rows, spec, path=path) if mode == STORED else snapshot_result(spark, name, rows, spec)


def read_in_place(
    spark, query, spec: PartitionSpec, partition: int | None = None, bucketed_by=None,
) -> DataFrame:
    """Rows of a query over its source with ``partition_id``, nothing copied.

    Without an order the number is a projection of the scan. With an order rows are
    placed as usual, unless the source is bucketed by columns within ``spec.by``
    into as many buckets: then its own buckets are the partitions and only a sort
    is added. Of such a source one ``partition`` is read from the files of its bucket alone.
    """
    rows = _rows_of(spark, query)
    buckets = tuple(bucketed_by or ())
    if buckets and not set(buckets) <= set(spec.by):
        raise ValueError("bucket columns must be among the partition columns")
    if buckets:
        number = F.pmod(F.hash(*[quoted(c) for c in buckets]), F.lit(spec.partitions)).cast("long")
        numbered = rows.withColumn(PARTITION_ID, number)
    else:
        numbered = add_partition_id(rows, spec)
    if partition is not None:
        numbered = numbered.filter(quoted(PARTITION_ID) == partition)
        numbered = _bucket_files(numbered, partition) if buckets else numbered
    if not spec.order:
        return numbered
    order = spec_sort_key(numbered, spec)
    if buckets and partitions_fit(numbered, spec.task_bytes):
        # Without this setting the scan drops its buckets after the shuffle that
        # relied on them has been removed, and keys end up in several tasks.
        if spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") != "false":
            raise RuntimeError("set spark.sql.sources.bucketing.autoBucketedScan.enabled to false")
        numbered = numbered.repartition(spec.partitions, *[quoted(c) for c in buckets])
        return numbered.sortWithinPartitions(PARTITION_ID, *sort_columns(numbered, order))
    return union_of([part.df for part in place(numbered, spec)])


# Fixed value: the place of the bucket number in the names of a bucketed table's files.
BUCKET_IN_NAME = r"_(\d+)(?:\..*)?$"


def _bucket_files(rows: DataFrame, bucket: int) -> DataFrame:
    """Rows of files whose name says this bucket, or none. A condition on a file's name is applied to the list of files,
    so others are not opened."""
    told = F.regexp_extract(F.col("_metadata.file_name"), BUCKET_IN_NAME, 1)
    try:
        return rows.filter((told == "") | (told.cast("int") == bucket))
    except AnalysisException:
        # The files cannot be told any more, say behind a join; the rows are filtered all the same.
        return rows
