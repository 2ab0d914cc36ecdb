import hashlib
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from chunkspark import (
    PartitionSpec, add_partition_id, affinity_violations, node_report, partition_report, partition_result,
    pack_chunks, route_report, sort_key, with_row_pos, with_routes,
)
from chunkspark.operators import partition as partition_module
from chunkspark.operators.partition import accounted_bytes, place


def test_sort_key_adds_the_key_once():
    assert sort_key(["a", "b"], "k") == ["a", "b", "k"]
    assert sort_key(["a", "k"], "k") == ["a", "k"]
    assert sort_key([], "k") == ["k"]
    assert sort_key(["b"], None, ["a", "b", "c"]) == ["b", "a", "c"]


def test_spec_refuses_no_partitions():
    with pytest.raises(ValueError):
        PartitionSpec(0)


def test_number_is_the_hash_of_the_key_text(spark):
    df = spark.createDataFrame([(7, "a|b\\"), (None, None)], "k long, t string")
    got = {r.k: r.partition_id for r in add_partition_id(df, PartitionSpec(97, ("k", "t"))).collect()}
    for key, text in ((7, "7|a\\|b\\\\"), (None, "\\N|\\N")):
        assert got[key] == int(hashlib.md5(text.encode()).hexdigest()[:8], 16) % 97


def test_equal_values_share_a_partition(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1e300,), (1e300,), (float("nan"),), (float("nan"),)], "d double")
    rows = add_partition_id(df, PartitionSpec(1000, ("d",)))
    assert affinity_violations(rows, ["d"]).count() == 0


def test_separator_in_text_does_not_merge_keys(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "x string, y string")
    ids = [r.partition_id for r in add_partition_id(df, PartitionSpec(2**31, ("x", "y"))).collect()]
    assert len(set(ids)) == 2


@pytest.mark.parametrize("by", [(), ("i1",), ("i1", "d1")])
@pytest.mark.parametrize("task_bytes", [1 << 30, 200])
def test_rows_are_kept_and_keys_stay_together(small, by, task_bytes):
    spec = PartitionSpec(5, by, ("i1", "d1"), "row_id", task_bytes)
    got = partition_result(small, spec)
    assert sorted(r.row_id for r in got.collect()) == list(range(1, 15))
    if by:
        assert affinity_violations(got, by).count() == 0


def test_one_task_holds_whole_partitions_and_sorts_them(small):
    spec = PartitionSpec(4, ("i1",), ("i1", "d1"), "row_id")
    rows = partition_result(small, spec).withColumn("task", F.spark_partition_id()).collect()
    for number in {r.partition_id for r in rows}:
        mine = [r for r in rows if r.partition_id == number]
        assert len({r.task for r in mine}) == 1
        keys = [(r.i1 is not None, r.i1 or 0, r.d1 or 0.0) for r in mine]
        assert keys == sorted(keys)


def test_a_hot_key_runs_in_many_tasks(spark):
    hot = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    spec = PartitionSpec(4, ("k",), ("k",), "id", task_bytes=8_000)
    parts = place(add_partition_id(hot, spec), spec)
    placed = parts[-1]
    assert placed.split
    spread = placed.df.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) >= 3 and max(r["count"] for r in spread) < 1_000
    assert sum(part.df.count() for part in parts) == 6_000


def test_only_large_partitions_are_split(spark, monkeypatch):
    hot = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    spec = PartitionSpec(16, ("k",), ("k",), "id", task_bytes=20_000)
    numbered = add_partition_id(hot, spec)
    whole, split = place(numbered, spec)
    assert (whole.split, split.split) == (False, True)
    ids = [{r[0] for r in part.df.select("partition_id").distinct().collect()} for part in (whole, split)]
    assert len(ids[1]) == 1 and not ids[0] & ids[1] and len(ids[0]) == 15
    assert whole.df.count() + split.df.count() == 6_000
    monkeypatch.setattr(partition_module, "LISTED_PARTITIONS", 0)
    (everything,) = place(numbered, spec)
    assert everything.split and everything.df.count() == 6_000


def test_copies_of_one_row_are_spread_and_kept(spark):
    rows = spark.range(2_000).select(F.lit(1).cast("long").alias("a"), F.lit("x").alias("b"))
    rows = rows.union(spark.range(500).select("id", F.lit("y")))
    spec = PartitionSpec(2, ("a",), ("a",), None, task_bytes=6_000)
    placed = place(add_partition_id(rows, spec), spec)[-1]
    assert placed.split and placed.df.columns == ["a", "b", "partition_id"]
    spread = placed.df.filter("a = 1 and b = 'x'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in spread) == 2_000 and len(spread) >= 5
    assert placed.df.exceptAll(add_partition_id(rows, spec)).count() == 0
    assert partition_result(rows, spec).count() == 2_500


@pytest.mark.parametrize("key", ["id", None])
@pytest.mark.parametrize("query", [
    "SELECT id, t, int(rand() * 16) AS k FROM (SELECT /*+ REPARTITION(7) */ id, repeat('t', 20) AS t FROM range(20000))",
    "SELECT id, repeat('t', 20) AS t, int(rand() * 2) * 0 AS k FROM range(0, 40000, 1, 9) WHERE rand() < 0.5",
])
def test_a_query_that_does_not_repeat_itself_keeps_its_rows(spark, query, key):
    spec = PartitionSpec(4, ("k",), ("k",), key, task_bytes=100_000)
    rows = [(r.id, r.k) for r in partition_result(spark.sql(query), spec).collect()]
    assert len(rows) == len({i for i, _ in rows}) > 15_000
    assert len(rows) == 20_000 or "WHERE" in query


def test_the_source_is_read_once_when_split(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = spark.range(5_000).mapInArrow(seen, "id long")
    # An estimate that does not fit is not checked by another read.
    parts = place(add_partition_id(rows, spec := PartitionSpec(3, ("id",), (), "id", task_bytes=8_000)), spec)
    assert sum(p.df.count() for p in parts) == 5_000 and read.value == 5_000


def test_split_rows_keep_their_very_values(spark):
    rows = spark.sql("SELECT (id % 2 - 1) * 0D AS z, if(id % 4 < 2, 'a', 'A') COLLATE UTF8_LCASE AS t, id % 2 AS g FROM range(400)")
    spec = PartitionSpec(2, ("g",), (), None, task_bytes=2_000)
    got = partition_result(rows, spec).selectExpr("cast(z AS string) AS z", "t COLLATE UTF8_BINARY AS t").groupBy("z", "t").count().collect()
    assert {(r.z, r.t): r["count"] for r in got} == {("-0.0", "a"): 100, ("0.0", "a"): 100, ("-0.0", "A"): 100, ("0.0", "A"): 100}


@pytest.mark.parametrize("by, key", [((), None), ((), "row_id"), (("i1",), None), (("i1", "t1"), "row_id")])
def test_packing_does_not_change_the_partition(small, by, key):
    spec = PartitionSpec(7, by, (), key)
    plain = {(r.row_id, r.partition_id) for r in partition_result(small, spec).collect()}
    assert plain == {(r.row_id, r.partition_id) for r in pack_chunks(small, spec, 4_000).collect()}
    assert plain == {(r.row_id, r.partition_id) for r in pack_chunks(small, spec, 4_000, keep=["row_id"]).collect()}


@pytest.mark.parametrize("name", ["partition_id", "row_pos", "chunk_id", "ROW_BYTES", "_at", "_block", "_pos", "_chunk"])
def test_names_of_added_columns_are_refused(spark, name):
    rows = spark.range(3).withColumn(name, F.lit(1))
    for work in (partition_result, with_row_pos, lambda df, spec: pack_chunks(df, spec, 100)):
        with pytest.raises(ValueError, match="rename input columns"):
            work(rows, PartitionSpec(2, (), (), "id"))


def test_positions_do_not_depend_on_the_split(small):
    spec = PartitionSpec(3, ("i1",), ("i1", "d1"), "row_id")
    whole = {(r.row_id, r.partition_id, r.row_pos) for r in with_row_pos(small, spec).collect()}
    split = {(r.row_id, r.partition_id, r.row_pos) for r in with_row_pos(small, replace(spec, task_bytes=150)).collect()}
    assert whole == split and len(whole) == 14
    assert {p for _, _, p in whole} >= {0}


def test_empty_input(small):
    nothing = small.filter("false")
    spec = PartitionSpec(3, ("i1",), ("d1",), "row_id")
    assert partition_result(nothing, spec).count() == 0
    assert with_row_pos(nothing, spec).count() == 0


def test_reports(small):
    rows = add_partition_id(small, PartitionSpec(6, ("i1",)))
    report = partition_report(rows).collect()
    assert sum(r.row_count for r in report) == 14
    assert sum(r.bytes for r in report) == sum(64 + len((r.t1 or "") + (r.t2 or "")) for r in small.collect())
    routes = route_report(rows, 2, 2).collect()
    assert sum(r.row_count for r in routes) == 14
    assert sum(r.partitions for r in routes) == len(report)
    assert sum(r.partitions for r in node_report(rows, 4).collect()) == len(report)
    with pytest.raises(ValueError):
        route_report(rows, 0, 1)


def test_owners_take_partitions_in_turn(spark):
    rows = spark.range(12).select(F.col("id").alias("partition_id"))
    got = {r.partition_id: (r.worker_id, r.consumer_id, r.node_id) for r in with_routes(rows, 3, 2, 5).collect()}
    workers = {w: [p for p in range(12) if p % 3 == w] for w in range(3)}
    for worker, mine in workers.items():
        for turn, number in enumerate(mine):
            assert got[number] == (worker, turn % 2, number % 5)


def test_nested_values_count_by_what_they_hold(spark):
    rows = spark.sql("SELECT id, array_repeat(1.0F, 64) AS v, array('abc', NULL) AS t, map('k', id) AS m, named_struct('x', 'yy', 'n', 1) AS s FROM range(40)")
    size = rows.select(accounted_bytes(rows).alias("b")).distinct().collect()
    assert [r.b for r in size] == [8 + (64 * 8 + 16) + (16 + 3 + 16 + 16) + (16 + 1 + 16 + 8 + 16) + (2 + 16 + 8)]
    spec = PartitionSpec(1, (), ("id",), "id", task_bytes=4_000)
    (part,) = place(add_partition_id(rows, spec), spec)
    assert part.split and part.df.rdd.getNumPartitions() > 4


def test_small_doubles_are_told_apart(spark):
    rows = spark.range(1_000).selectExpr("id * 1e-12 AS d", "id")
    used = partition_result(rows, PartitionSpec(16, ("d",), (), "id")).select("partition_id").distinct().count()
    assert used == 16
    same = spark.createDataFrame([(0.0,), (-0.0,), (0.5,), (0.50,)], "d double")
    assert add_partition_id(same, PartitionSpec(64, ("d",))).select("partition_id").distinct().count() == 2


def test_columns_without_an_order(spark):
    rows = spark.range(40).selectExpr("map('k', id % 3) AS m", "array(struct(map(id % 2, 'v') AS inner)) AS n", "id % 5 AS g")
    for task_bytes in (1 << 30, 500):
        placed = partition_result(rows, PartitionSpec(4, ("g",), ("g",), None, task_bytes))
        assert placed.count() == 40 and placed.groupBy("g").agg(F.countDistinct("partition_id").alias("c")).filter("c > 1").count() == 0
    assert partition_result(rows, PartitionSpec(4)).count() == 40
