from dataclasses import replace

import numpy as np
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PythonException
from pyspark.sql import Window, functions as F

from chunkspark import (
    ChunkTooSmallError, PartitionSpec, chunk_index, compare_passes, order_violations, pack_chunks,
)
from chunkspark.operators import chunks, partition
from chunkspark.operators.chunks import _after, _openers, _pass, _statement, _walk
from chunkspark.operators.partition import add_partition_id, place
from chunkspark.operators.positions import freeze_blocks

SPEC = PartitionSpec(3, ("i1",), ("i1", "d1"), "row_id")


def greedy(sizes, limit):
    """Chunk of each size, by adding them up one at a time."""
    chunk, used, found = -1, limit, []
    for size in sizes:
        if used + size > limit:
            chunk, used = chunk + 1, 0
        used += size
        found.append(chunk)
    return found, used


def assert_greedy(packed, limit):
    rows = sorted(packed.collect(), key=lambda r: (r.partition_id, r.row_pos))
    for number in {r.partition_id for r in rows}:
        mine = [r for r in rows if r.partition_id == number]
        assert [r.row_pos for r in mine] == list(range(len(mine)))
        assert [r.chunk_id for r in mine] == greedy([r.row_bytes for r in mine], limit)[0]
    return rows


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=60), st.integers(20, 60), st.data())
def test_walk_matches_greedy_from_any_entry(sizes, limit, data):
    used = data.draw(st.integers(0, limit))
    starts, left = _walk(np.array(sizes), used, limit)
    chunk, held, opened = 0, used, []
    for i, size in enumerate(sizes):
        if held + size > limit:
            opened.append(i)
            held = 0
        held += size
    assert (starts, left) == (opened, held)


def assert_holds(statement, sizes, limit):
    for used in range(limit + 1):
        starts, left = _walk(sizes, used, limit)
        assert tuple(int(v) for v in _pass(statement, used, limit)) == (len(starts), left)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=60), st.integers(20, 60))
def test_a_statement_holds_for_every_entry(sizes, limit):
    sizes = np.array(sizes)
    assert_holds(_statement(sizes, limit), sizes, limit)


@pytest.mark.parametrize("limit", [90, 100, 150, 255, 256, 1000, 4096])
@pytest.mark.parametrize("task_bytes", [1 << 30, 160])
def test_packing_is_greedy_at_any_size(small, limit, task_bytes):
    rows = assert_greedy(pack_chunks(small, replace(SPEC, task_bytes=task_bytes), limit), limit)
    assert len(rows) == 14


def test_six_column_rows_fail_until_the_largest_fits(spark):
    rows = spark.createDataFrame(
        [(1, 1, 1.0, 1.0, "abc", "de"), (2, 2, 2.0, 2.0, "a", "b"), (3, 3, 3.0, 3.0, "abcdefghi", "j")],
        "i long, i2 long, d double, d2 double, t string, t2 string",
    )
    spec = PartitionSpec(1, key="i")
    for limit in (1, 68, 73):
        with pytest.raises(PythonException, match="is larger than a chunk"):
            pack_chunks(rows, spec, limit).collect()
    assert [r.row_bytes for r in pack_chunks(rows, spec, 74).orderBy("i").collect()] == [69, 66, 74]
    assert [r.chunk_id for r in pack_chunks(rows, spec, 135).orderBy("i").collect()] == [0, 0, 1]


def test_a_row_that_fits_exactly(spark):
    row = spark.createDataFrame([(1, b"abc")], "id long, var binary")
    spec = PartitionSpec(1, key="id")
    assert chunk_index(pack_chunks(row, spec, 27)).collect()[0].used_bytes == 27
    with pytest.raises(PythonException, match="a row of 27 bytes is larger than a chunk of 26"):
        pack_chunks(row, spec, 26).collect()


def test_large_value(spark):
    row = spark.createDataFrame([(1, b"x" * 120_000)], "id long, var binary")
    assert pack_chunks(row, PartitionSpec(1, key="id"), 120_024).count() == 1


def test_oversize_row_fails_when_partitions_are_split(spark):
    rows = spark.range(500).select("id", F.when(F.col("id") == 300, F.repeat(F.lit("x"), 500)).otherwise("y").alias("t"))
    with pytest.raises(PythonException, match="is larger than a chunk"):
        pack_chunks(rows, PartitionSpec(1, (), ("id",), "id", 2_000), 200).collect()


@pytest.mark.parametrize("task_bytes", [1 << 30, 300])
def test_fixed_rows_are_packed_by_division(spark, task_bytes):
    rows = spark.range(100).select("id", (F.col("id") * 0.5).alias("d"))
    packed = pack_chunks(rows, PartitionSpec(3, key="id", task_bytes=task_bytes), 100)
    assert_greedy(packed, 100)
    assert "MapInArrow" not in packed._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ChunkTooSmallError):
        pack_chunks(rows, PartitionSpec(3, key="id"), 15)


@pytest.mark.parametrize("limit", [65, 100, 1000, 20_000])
def test_hot_key_over_many_blocks(spark, limit):
    rows = spark.range(4_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("k"),
        "id", F.repeat(F.lit("z"), (F.xxhash64("id") % 17 + 17).cast("int")).alias("t"),
    )
    spec = PartitionSpec(4, ("k",), ("k", "t"), "id")
    whole = pack_chunks(rows, spec, limit)
    split = pack_chunks(rows, replace(spec, task_bytes=20_000), limit)
    names = ["id", "partition_id", "row_pos", "chunk_id"]
    assert sorted(whole.select(names).collect()) == sorted(split.select(names).collect())
    assert_greedy(split, limit)


def test_equal_sizes_over_many_blocks(spark):
    """Walks that never meet."""
    rows = spark.range(3_000).select("id", F.lit("abc").alias("t"))
    split = pack_chunks(rows, PartitionSpec(1, (), ("id",), "id", 5_000), 777)
    assert_greedy(split, 777)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(1, 20), min_size=1, max_size=12), min_size=2, max_size=6), st.integers(20, 60))
def test_joined_statements_hold_for_every_entry(stretches, limit):
    joined = _statement(np.array(stretches[0]), limit)
    for sizes in stretches[1:]:
        joined = _after(joined, _statement(np.array(sizes), limit), limit)
    assert_holds(joined, np.array(sum(stretches, [])), limit)


def windowed(blocks, limit):
    """A statement for each block of a partition, of the rows that can open a chunk."""
    out, before, widest = [], 0, 0
    for sizes in map(np.array, blocks):
        widest = max(widest, int(sizes.max()))
        out.append(_statement(sizes, limit, _openers(before + np.cumsum(sizes) - sizes, widest, limit)))
        before += int(sizes.sum())
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(1, 20), min_size=1, max_size=30), min_size=1, max_size=8), st.integers(20, 300), st.integers(1, 4))
def test_statements_of_openers_chain_like_the_walk(blocks, limit, span):
    """Blocks one by one, and blocks joined to spans."""
    statements = windowed(blocks, limit)
    joined = []
    for at in range(0, len(blocks), span):
        held = statements[at]
        for more in statements[at + 1: at + span]:
            held = _after(held, more, limit)
        joined.append(held)
    for told, length in ((statements, 1), (joined, span)):
        chunk, used, sizes = -1, limit, []
        for i, statement in enumerate(told):
            opened, used = (int(v) for v in _pass(statement, used, limit))
            chunk += opened
            sizes += sum(blocks[i * length: (i + 1) * length], [])
            found, left = greedy(sizes, limit)
            assert (chunk, used) == (found[-1], left)


def test_statements_do_not_grow_with_the_chunk():
    blocks = np.random.default_rng(3).integers(40, 200, (40, 5_000))
    stated = {limit: sum(len(s["before"]) for s in windowed(blocks, limit)) for limit in (1 << 19, 1 << 21, 1 << 23)}
    # All rows that can open a block's first chunk would be about 175,000 with either of the larger chunks.
    assert sorted(stated.values(), reverse=True) == list(stated.values()) and stated[1 << 19] < 3_000


@pytest.mark.parametrize("share", [1, 64])
@pytest.mark.parametrize("text", ["repeat('q', cast(id % 13 as int))", "'same'"])
def test_blocks_chained_in_spans(spark, monkeypatch, text, share):
    monkeypatch.setattr(chunks, "CHAINED_BLOCKS", 3)
    monkeypatch.setattr(chunks, "STATED_SHARE", share)
    rows = spark.range(3_000).select("id", F.expr(text).alias("t"))
    for limit in (60, 333, 30_000):
        assert_greedy(pack_chunks(rows, PartitionSpec(2, (), ("id",), "id", 4_000), limit), limit)


def test_spans_stay_whole_where_a_join_is_adapted(spark, monkeypatch):
    """A join that adaptive execution turns into a broadcast of the smaller side leaves the other side as its map tasks wrote it."""
    monkeypatch.setattr(chunks, "CHAINED_BLOCKS", 3)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "20KB",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "5"}
    before = {name: spark.conf.get(name, None) for name in conf}
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        rows = spark.range(3_000).select("id", F.expr("repeat('q', cast(id % 13 as int))").alias("t"))
        assert_greedy(pack_chunks(rows, PartitionSpec(2, (), ("id",), "id", 1_000), 333), 333)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_small_blocks_share_tasks(spark):
    """Ten rows or so are a block and ten blocks a chunk, yet there is not a task for each."""
    rows = spark.range(30_000).selectExpr("id", "if(id % 3 < 2, 0, id % 40) AS k", "repeat('q', cast(id * 7 % 23 as int)) AS t")
    spec = PartitionSpec(5, ("k",), ("k", "t"), "id", 800)
    packed = pack_chunks(rows, spec, 4_000)
    assert packed.rdd.getNumPartitions() <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(assert_greedy(packed, 4_000)) == 30_000
    whole = pack_chunks(rows, replace(spec, task_bytes=1 << 30), 4_000)
    assert compare_passes(whole, packed).first() == (0, 0)


def test_grouping_leaves_blocks_as_they_are(spark):
    rows = add_partition_id(spark.range(20_000).selectExpr("id", "id % 2 AS k", "'same' AS t"), spec := PartitionSpec(2, ("k",), (), "id", 5_000))
    (single,), (grouped,) = place(rows, spec), place(rows, spec, grouped=True)
    blocks = [freeze_blocks(p).groupBy("_block").count().collect() for p in (single, grouped)]
    assert single.tasks == single.blocks == single.df.rdd.getNumPartitions() and grouped.tasks == 8
    assert abs(len(blocks[1]) - len(blocks[0])) <= grouped.tasks and len(blocks[1]) <= grouped.blocks
    assert max(r["count"] for r in blocks[1]) == grouped.block_rows and sum(r["count"] for r in blocks[1]) == 20_000


@pytest.mark.parametrize("grouped_bytes", [1, 3_000, 9_000, 1 << 30])
@pytest.mark.parametrize("limit", [60, 1_900, 30_000])
def test_spans_of_tasks_with_several_blocks(spark, monkeypatch, grouped_bytes, limit):
    """From a block for each task to all blocks in the tasks of a shuffle; with the first three, spans hold several tasks."""
    monkeypatch.setattr(chunks, "CHAINED_BLOCKS", 3)
    monkeypatch.setattr(partition, "GROUPED_BYTES", grouped_bytes)
    rows = spark.range(4_000).selectExpr("id", "if(id < 900, 1, 2 + id % 2) AS k", "repeat('q', cast(id % 13 as int)) AS t")
    assert_greedy(pack_chunks(rows, PartitionSpec(3, ("k",), ("id",), "id", 1_500), limit), limit)


def test_joined_blocks_keep_their_order_without_broadcast(spark, monkeypatch):
    from chunkspark.operators import positions
    monkeypatch.setattr(positions, "BROADCAST_ROWS", 0)
    rows = spark.range(1_500).select("id", F.repeat(F.lit("q"), (F.col("id") % 13).cast("int")).alias("t"))
    assert_greedy(pack_chunks(rows, PartitionSpec(2, (), ("id",), "id", 5_000), 333), 333)


def test_copies_without_a_key(spark):
    rows = spark.range(900).select((F.col("id") % 3).alias("a"), F.lit("same").alias("t"))
    split = pack_chunks(rows, PartitionSpec(2, ("a",), ("a",), None, 3_000), 300)
    assert len(assert_greedy(split, 300)) == 900


def test_many_partitions_in_one_batch(spark):
    rows = spark.range(2_000).select("id", (F.col("id") % 700).alias("k"), F.lit("v").alias("t"))
    assert_greedy(pack_chunks(rows, PartitionSpec(300, ("k",), ("id",), "id"), 128), 128)


def test_kept_columns_and_index(small):
    narrow = pack_chunks(small, SPEC, 200, keep=["t1"])
    assert narrow.columns == ["t1", "partition_id", "row_pos", "chunk_id", "row_bytes"]
    index = chunk_index(narrow)
    assert compare_passes(index, chunk_index(pack_chunks(small, SPEC, 200))).first() == (0, 0)
    rows = index.orderBy("partition_id", "chunk_id").collect()
    assert sum(r.row_count for r in rows) == 14 and all(r.used_bytes <= 200 for r in rows)
    for a, b in zip(rows, rows[1:]):
        same = a.partition_id == b.partition_id
        assert b.first_row_pos == (a.first_row_pos + a.row_count if same else 0)
    assert compare_passes(index, index.filter("chunk_id > 0")).first().only_in_first > 0


def test_empty_input(small):
    assert pack_chunks(small.filter("false"), SPEC, 200).count() == 0


def test_chunks_follow_the_order(small):
    packed = pack_chunks(small, SPEC, 2_000)
    assert order_violations(packed, ["i1", "d1"]).count() == 0
    wrong = packed.withColumn("i1", -F.col("i1"))
    assert order_violations(wrong, ["i1"]).count() > 0


@pytest.mark.parametrize("placed", ["in order", "anywhere"])
def test_order_check_equals_a_window(spark, placed):
    draw = random.Random(4)
    values = [None, float("nan"), -0.0, 0.0, 1.5, -2.0]
    rows = [(p, c, i + 5 * c, draw.choice(values), draw.choice([None, "a", "b", "ü", ""]), draw.choice([None, [1], [2]]))
            for p in range(3) for c in range(4) for i in range(draw.randrange(5)) if draw.random() < 0.9]
    chunks = spark.createDataFrame(rows, "partition_id int, chunk_id long, row_pos long, d double, t string, a array<int>")
    chunks = chunks.coalesce(1).sortWithinPartitions("partition_id", "row_pos") if placed == "in order" else chunks.repartition(3)
    for order in (["d"], ["t", "d"], ["d", "t"], ["a"]):
        columns = F.struct(*order)
        ahead = F.lag(columns).over(Window.partitionBy("partition_id", "chunk_id").orderBy("row_pos"))
        want = chunks.withColumn("_a", ahead).filter(F.col("_a") > columns).select("partition_id", "chunk_id", "row_pos")
        got = order_violations(chunks, order)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_packed_rows_are_checked_where_they_are(spark):
    rows = spark.range(3000).selectExpr("id", "id % 7 AS g", "repeat('x', cast(id % 9 as int)) AS t")
    packed = pack_chunks(rows, PartitionSpec(4, ("g",), ("g", "id"), "id"), 600)
    assert order_violations(packed, ["g", "id"]).count() == 0
    assert order_violations(packed, ["t"]).count() > 100
    sent = order_violations(packed, ["g", "id"])
    sent.collect()
    plan = sent._jdf.queryExecution().executedPlan().toString()
    # What is shuffled behind the placement is the ends of stretches.
    assert plan.index("Window") < plan.index("MapInArrow")
