import pytest
from pyspark.sql import functions as F

from chunkspark import (
    PartitionSpec, chunk_index, get_chunks, get_chunks_by_keys, get_row_by_key, get_row_by_position, get_rows_by_keys, next_keys,
    get_rows_by_position, materialize_result, rows_by_key,
)
from chunkspark.operators import lookup
from chunkspark.session import shared_dir

LIMIT = 400


@pytest.fixture(scope="module")
def stored(spark, small):
    """64 copies of the small rows with keys of their own, stored in chunks."""
    many = small.crossJoin(spark.range(64)).withColumn("row_id", F.col("id") * 14 + F.col("row_id")).drop("id")
    spec = PartitionSpec(5, ("i1",), ("i1", "row_id"), "row_id")
    path = f"{shared_dir(spark)}/test-lookup"
    return materialize_result(spark, "lookup_rows", many, spec, LIMIT, path=path)


def test_second_pass_finds_the_same_chunks(stored):
    first = {(r.partition_id, r.chunk_id): r.row_count for r in chunk_index(stored).collect()}
    wanted = sorted(first)[::-3]
    again = chunk_index(get_chunks(stored, wanted)).collect()
    assert {(r.partition_id, r.chunk_id): r.row_count for r in again} == {k: first[k] for k in wanted}
    assert sum(first.values()) == 896


def test_every_row_by_position_and_by_key(stored):
    rows = stored.collect()
    some = rows[::37]
    for row in some[:4]:
        assert get_row_by_position(stored, row.partition_id, row.row_pos) == row
        assert get_row_by_key(stored, row.partition_id, "row_id", row.row_id) == row
    requests = stored.select("partition_id", "row_pos")
    assert get_rows_by_position(stored, requests).count() == 896
    assert rows_by_key(stored, stored.select("partition_id", "row_id"), "row_id").count() == 896
    assert get_rows_by_position(stored, [(r.partition_id, r.row_pos) for r in some]).count() == len(some)


def test_positions_start_at_zero(stored):
    firsts = stored.groupBy("partition_id").agg(
        F.min("row_pos").alias("p"), F.max("row_pos").alias("q"), F.count("*").alias("n")
    )
    assert all(r.p == 0 and r.q == r.n - 1 for r in firsts.collect())


def test_missing_rows(stored):
    with pytest.raises(LookupError, match="no row 99999"):
        get_row_by_position(stored, 0, 99_999)
    with pytest.raises(LookupError):
        get_row_by_key(stored, 0, "row_id", -1)
    assert get_rows_by_position(stored, [(0, 99_999)]).count() == 0
    assert get_chunks(stored, []).count() == 0


def test_long_request_lists_are_joined(stored, monkeypatch):
    monkeypatch.setattr(lookup, "PREDICATE_PAIRS", 3)
    pairs = [(r.partition_id, r.row_id) for r in stored.limit(20).collect()]
    assert rows_by_key(stored, pairs, "row_id").count() == 20


def test_listed_chunks_read_their_folder_only(stored):
    plan = get_chunks(stored, [(2, 0)])._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "partition_id" in filters


def brute_prefix(rows, limit):
    used, kept = 0, []
    for row in sorted(rows, key=lambda r: r.row_id):
        if used + row.row_bytes > limit:
            return kept, True
        used += row.row_bytes
        kept.append(row.row_id)
    return kept, False


@pytest.mark.parametrize("limit", [100, 500, 5_000, 1_000_000])
def test_rows_by_keys_stop_where_the_chunk_is_full(stored, limit):
    wanted = stored.filter("row_id % 2 = 0").select("partition_id", "row_id")
    got = get_rows_by_keys(stored, wanted, "row_id", limit).collect()
    rows = [r for r in stored.collect() if r.row_id % 2 == 0]
    for number in {r.partition_id for r in rows}:
        kept, truncated = brute_prefix([r for r in rows if r.partition_id == number], limit)
        mine = sorted(r.row_id for r in got if r.partition_id == number)
        assert mine == kept
        assert {r.truncated for r in got if r.partition_id == number} == {truncated}


@pytest.mark.parametrize("many", [128, 3])
def test_prefix_is_exact_for_uneven_rows(spark, monkeypatch, many):
    """A small row after one that does not fit must not slip in."""
    monkeypatch.setattr(lookup, "MANY_SPLITS", many)
    rows = spark.range(3_000).select(
        F.lit(0).cast("long").alias("partition_id"), F.col("id").alias("row_id"),
        F.when(F.pmod(F.xxhash64("id"), F.lit(5)) == 0, 700).otherwise(10).cast("long").alias("row_bytes"),
    )
    for limit in (705, 1_500, 9_999):
        got = get_rows_by_keys(rows, rows.select("partition_id", "row_id"), "row_id", limit).collect()
        kept, truncated = brute_prefix(rows.collect(), limit)
        assert sorted(r.row_id for r in got) == kept and truncated and all(r.truncated for r in got)


def test_first_row_larger_than_the_chunk_is_an_error(stored):
    with pytest.raises(Exception, match="is larger than a chunk of 10"):
        get_rows_by_keys(stored, stored.select("partition_id", "row_id"), "row_id", 10).collect()


def test_streams_cannot_be_looked_up(spark):
    stream = spark.readStream.format("rate").load().selectExpr("value AS partition_id", "value AS chunk_id")
    with pytest.raises(ValueError, match="delivered once"):
        get_chunks(stream, [(0, 0)])


@pytest.mark.parametrize("task_bytes", [1 << 30, 300])
def test_an_answer_goes_on_after_its_first_chunk(spark, task_bytes):
    rows = spark.range(200).selectExpr("id AS row_id", "repeat('x', cast(id % 13 as int)) AS t", "id % 3 AS partition_id")
    asked = rows.filter("row_id % 4 <> 1").select("partition_id", "row_id")
    answer = get_chunks_by_keys(rows, asked, "row_id", 150, task_bytes)
    whole = {(r.partition_id, r.chunk_id, r.row_id) for r in answer.collect()}
    assert {(p, k) for p, _, k in whole} == {tuple(r) for r in asked.collect()}
    # The same chunks one by one, each from the key the one before ended with.
    after, found = None, set()
    for chunk in range(40):
        part = get_rows_by_keys(rows, asked, "row_id", 150, after).withColumn("chunk_id", F.lit(chunk).cast("long"))
        got = [(r.partition_id, r.chunk_id, r.row_id) for r in part.select("partition_id", "chunk_id", "row_id").collect()]
        if not got:
            break
        found |= set(got)
        ends = [tuple(r) for r in next_keys(part, "row_id").select("partition_id", "after").collect()]
        after = spark.createDataFrame(ends, "partition_id long, after long")
    assert found == whole and max(c for _, c, _ in whole) > 5
    first = get_rows_by_keys(rows, asked, "row_id", 150, after=99).agg(F.min("row_id")).first()[0]
    assert first == 100
