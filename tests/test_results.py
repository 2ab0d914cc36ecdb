import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from chunkspark import (
    PartitionSpec, affinity_violations, choose_mode, chunk_index, column_sizes, compare_passes, describe_schema, drop_result,
    list_tables, materialize_result, read_auto, read_in_place, read_owned, read_partition, read_partitions, run_query,
    snapshot_result,
)
from chunkspark.sources.results import IN_PLACE, SNAPSHOT, STORED
from chunkspark.session import shared_dir

SPEC = PartitionSpec(4, ("i1",), ("i1", "d1"), "row_id")


@pytest.fixture(autouse=True)
def view(small):
    small.createOrReplaceTempView("small")



def test_run_query_returns_every_row(spark):
    assert run_query(spark, "SELECT * FROM small WHERE row_id = -1 OR true").count() == 14
    with pytest.raises(Exception, match="no_such_function"):
        run_query(spark, "SELECT no_such_function(1)")


def test_snapshot_does_not_follow_its_source(spark):
    frozen = snapshot_result(spark, "frozen", "SELECT *, rand() AS r FROM small", SPEC, 200)
    assert compare_passes(chunk_index(frozen), chunk_index(spark.table("frozen"))).first() == (0, 0)
    assert spark.table("frozen").exceptAll(frozen).count() == 0
    drop_result(spark, "frozen", SNAPSHOT)
    assert not spark.catalog.tableExists("frozen")


def test_snapshot_lives_in_the_shared_folder(spark):
    plan = snapshot_result(spark, "shared", "SELECT * FROM small", SPEC)._jdf.queryExecution().logical().toString()
    assert "LogicalRDD" in plan
    folder = shared_dir(spark).removeprefix("file:")
    assert any(name.startswith("rdd-") for name in os.listdir(folder))
    drop_result(spark, "shared", SNAPSHOT)


def test_snapshot_under_an_odd_name(spark):
    snapshot_result(spark, "small'test", "SELECT * FROM small", SPEC)
    assert run_query(spark, "SELECT * FROM `small'test`").count() == 14
    drop_result(spark, "small'test", SNAPSHOT)
    assert not spark.catalog.tableExists("`small'test`")


def test_stored_result(spark):
    name, path = "stored_small", f"{shared_dir(spark)}/test-stored"
    stored = materialize_result(spark, name, "SELECT * FROM small", SPEC, 200, path=path)
    numbers = sorted(r[0] for r in stored.select("partition_id").distinct().collect())
    assert sorted(d for d in os.listdir(path.removeprefix("file:")) if d.startswith("partition_id=")) == [
        f"partition_id={n}" for n in numbers
    ]
    rows = read_partitions(stored, numbers).collect()
    assert [(r.partition_id, r.row_pos) for r in rows] == sorted((r.partition_id, r.row_pos) for r in rows)
    assert len(rows) == 14
    one = read_partition(stored, numbers[0], ["row_id"]).collect()
    assert [r.row_id for r in one] == sorted(r.row_id for r in rows if r.partition_id == numbers[0])
    plan = read_partition(stored, numbers[0])._jdf.queryExecution().executedPlan().toString()
    assert "partition_id" in plan[plan.index("PartitionFilters"):].split("]")[0]
    drop_result(spark, name, STORED)
    assert not spark.catalog.tableExists(name)


def test_dropping_nothing(spark):
    drop_result(spark, "whatever", IN_PLACE)
    with pytest.raises(ValueError):
        drop_result(spark, "whatever", "elsewhere")


def test_in_place_without_order_moves_nothing(small, spark):
    rows = read_in_place(spark, small, PartitionSpec(4, ("i1",)))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert rows.count() == 14 and affinity_violations(rows, ["i1"]).count() == 0
    assert sum(read_in_place(spark, small, PartitionSpec(4, ("i1",)), p).count() for p in range(4)) == 14


@pytest.fixture(scope="module")
def bucketed(spark):
    """Several files in every bucket."""
    rows = spark.range(5_000).select((F.col("id") % 613).alias("k"), "id", F.lit("v").alias("t")).repartition(6)
    path = f"{shared_dir(spark)}/test-bucketed"
    rows.write.bucketBy(8, "k").sortBy("k").mode("overwrite").option("path", path).saveAsTable("bucketed_rows")
    return "SELECT * FROM bucketed_rows"


@pytest.mark.parametrize("task_bytes", [1 << 30, 5_000])
def test_in_place_over_buckets(spark, bucketed, task_bytes):
    spec = PartitionSpec(8, ("k", "id"), ("k", "id"), "id", task_bytes)
    rows = read_in_place(spark, bucketed, spec, bucketed_by=["k"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" in plan) == (task_bytes == 5_000)
    assert rows.count() == 5_000 and affinity_violations(rows, ["k"]).count() == 0
    if task_bytes > 5_000:
        tasks = rows.withColumn("partition_id", F.spark_partition_id())
        assert affinity_violations(tasks, ["k"]).count() == 0
        pairs = rows.select("partition_id", F.spark_partition_id().alias("t")).distinct().collect()
        assert len(pairs) == len({p.partition_id for p in pairs}) == len({p.t for p in pairs})


def test_in_place_needs_the_bucketed_scan(spark, bucketed):
    name = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spec = PartitionSpec(8, ("k",), ("id",), "id")
    spark.conf.set(name, "true")
    try:
        with pytest.raises(RuntimeError, match="autoBucketedScan"):
            read_in_place(spark, bucketed, spec, bucketed_by=["k"])
    finally:
        spark.conf.set(name, "false")
    with pytest.raises(ValueError):
        read_in_place(spark, bucketed, PartitionSpec(8, ("t",), ("id",), "id"), bucketed_by=["k"])


def test_grouping_a_bucketed_result_needs_no_shuffle(spark):
    path = f"{shared_dir(spark)}/test-by-bucket"
    stored = materialize_result(spark, "by_bucket", "SELECT * FROM small", SPEC, path=path, layout="bucketed")
    plan = stored.groupBy("i1").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and stored.count() == 14
    drop_result(spark, "by_bucket", STORED)


def test_describe_schema(spark):
    rows = describe_schema(spark, "SELECT row_id, t1, d1, CAST(i1 AS INT) AS `a?` FROM small").orderBy("position").collect()
    assert [tuple(r) for r in rows] == [
        (0, "row_id", "Int64", 8), (1, "t1", "Variable", 0), (2, "d1", "Double", 8), (3, "a?", "Int32", 4),
    ]
    assert describe_schema(spark, "small").count() == 6
    long_name = "очень_длинное_имя_" * 7
    assert describe_schema(spark, f"SELECT 1.5D AS `{long_name}`").first().name == long_name


def test_column_sizes(small):
    rows = {r.name: r.stored_bytes for r in column_sizes(small).collect()}
    assert rows["i1"] == 14 * 8
    assert rows["t1"] == 14 * 16 + sum(len(r.t1 or "") for r in small.collect())


def test_list_tables(spark):
    assert "small" in {r.table_name for r in list_tables(spark).collect()}


def test_odd_column_names(spark):
    rows = spark.createDataFrame([(1, "x", None), (2, "y", None)], "`col_0_]` int, `col_1_]` string, `col[` date")
    from chunkspark import decode_table, encode_table, pack_chunks
    spec = PartitionSpec(2, ("col_1_]",), ("col[",), "col_0_]")
    assert pack_chunks(rows, spec, 100).count() == 2
    assert decode_table(encode_table(rows), rows.schema).exceptAll(rows).count() == 0
    dotted = spark.createDataFrame([(1.0, 2.0, 3.0)], "`a?` double, `b.` double, `c$` double")
    assert pack_chunks(dotted, PartitionSpec(2, ("b.",), ("a?",)), 100).select("`c$`", "`a?`", "`b.`").first() == (3.0, 1.0, 2.0)


def test_owners_read_their_folders_only(spark, view):
    path = f"{shared_dir(spark)}/owned"
    stored = materialize_result(spark, "owned_rows", "SELECT * FROM small", PartitionSpec(6, ("i1", "t1"), (), "row_id"), path=path)
    everything = set()
    for worker in range(2):
        for consumer in range(2):
            share = read_owned(stored, 2, worker, 2, consumer)
            rows = share.collect()
            assert all(r.partition_id % 2 == worker and r.partition_id // 2 % 2 == consumer for r in rows)
            everything |= {r.row_id for r in rows}
            assert "PartitionFilters: [" in share._jdf.queryExecution().explainString(
                spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert everything == set(range(1, 15))
    with pytest.raises(ValueError):
        read_owned(stored, 2, 2)
    drop_result(spark, "owned_rows", STORED)
    assert not os.path.exists(path)


def test_mode_follows_the_layout(spark, view):
    spark.sql("SELECT * FROM small").write.bucketBy(4, "i1").sortBy("i1", "row_id").mode("overwrite").saveAsTable("mode_rows")
    try:
        fitting = PartitionSpec(4, ("i1", "t1"), ("i1",), "row_id")
        assert choose_mode(spark, "mode_rows", fitting) == IN_PLACE
        assert choose_mode(spark, "mode_rows", replace(fitting, partitions=5)) == SNAPSHOT
        assert choose_mode(spark, "mode_rows", replace(fitting, order=("row_id",)), many_passes=True) == STORED
        assert choose_mode(spark, "mode_rows", replace(fitting, by=("t1",))) == SNAPSHOT
        got = read_auto(spark, "unused", "mode_rows", fitting)
        assert sorted(r.row_id for r in got.collect()) == list(range(1, 15))
    finally:
        spark.sql("DROP TABLE mode_rows")


def opened_files(df):
    """Files that the scans of an executed plan opened."""
    def count(plan):
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return count(plan.executedPlan())
        if "QueryStage" in kind:
            return count(plan.plan())
        own = plan.metrics().apply("numFiles").value() if kind == "FileSourceScanExec" else 0
        return own + sum(count(plan.children().apply(i)) for i in range(plan.children().size()))

    df.collect()
    return count(df._jdf.queryExecution().executedPlan())


def test_one_bucket_opens_its_files_only(spark, tmp_path):
    spec = PartitionSpec(8, ("k",), ("k", "id"), "id")
    rows = spark.range(0, 400, 1, 3).selectExpr("id", "id % 50 AS k")
    rows.write.bucketBy(8, "k").sortBy("id").option("path", f"{tmp_path}/b").saveAsTable("one_bucket")
    try:
        whole = opened_files(spark.table("one_bucket"))
        seen = []
        for part in range(8):
            for source in (spark.table("one_bucket"), spark.sql("SELECT * FROM one_bucket WHERE id >= 0")):
                got = read_in_place(spark, source, spec, part, bucketed_by=["k"])
                assert opened_files(got) <= 3 < whole
            seen += [r.id for r in got.collect()]
        assert sorted(seen) == list(range(400))
        # Files without a bucket in their names are all read, and a source without files is filtered.
        rows.write.parquet(f"{tmp_path}/plain")
        for source in (spark.read.parquet(f"{tmp_path}/plain"), rows.distinct(), spark.table("one_bucket").groupBy("k").agg(F.max("id").alias("id"))):
            got = read_in_place(spark, source, PartitionSpec(8, ("k",)), 2, bucketed_by=["k"])
            want = source.filter(F.pmod(F.hash("k"), F.lit(8)) == 2)
            assert got.count() == want.count() > 0
    finally:
        spark.sql("DROP TABLE one_bucket")


def test_a_task_stores_one_share_of_one_bucket(spark):
    from chunkspark.sources.results import _salted
    rows = spark.range(6_000).select("id", (F.col("id") % 50).alias("k"), F.lit("v").alias("t"))
    bucket = F.pmod(F.hash("k"), F.lit(8)).cast("long")
    # 33 bytes a row, so 60 rows a share.
    dealt = _salted(rows, bucket, 60 * 33).select("id", bucket.alias("b"), F.spark_partition_id().alias("task"))
    told = dealt.groupBy("task").agg(F.countDistinct("b").alias("buckets"), F.count(F.lit(1)).alias("n")).collect()
    assert len(told) >= 100 and all(r.buckets == 1 and r.n <= 120 for r in told), told
    assert sorted(r.id for r in dealt.collect()) == list(range(6_000))


def test_large_buckets_are_stored_in_shares(spark):
    path = f"{shared_dir(spark)}/test-shares"
    rows = spark.range(3_000).select("id", (F.col("id") % 40).alias("k"), F.lit("v").alias("t"))
    spec = PartitionSpec(4, ("k",), ("k",), "id", task_bytes=40_000)
    stored = materialize_result(spark, "in_shares", rows, spec, path=path, layout="bucketed")
    files = {r.f: r.n for r in stored.groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert max(files.values()) * 33 <= 20_000 and sum(files.values()) == 3_000
    assert sorted(r.id for r in stored.collect()) == list(range(3_000))
