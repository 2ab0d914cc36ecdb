import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chunkspark import (
    PartitionSpec, chunk_index, create_stream_table, drop_table, encode_table, pack_chunks, read_delivered, read_ledger, read_stream,
    stream_chunks, stream_load, stream_load_table,
)
from chunkspark.session import shared_dir
from chunkspark.sources.positional import field_name
from chunkspark.streaming import streams

SPEC = PartitionSpec(3, ("user",), ("id",), "id")


@pytest.fixture
def arriving(spark, tmp_path):
    """Four files of 100 rows."""
    rows = spark.range(400).select("id", (F.col("id") % 7).alias("user"), F.concat(F.lit("v"), F.col("id")).alias("t"))
    for part in range(4):
        rows.filter(f"id div 100 = {part}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return rows, read_stream(spark, f"{tmp_path}/in", rows.schema, files_per_batch=2), str(tmp_path)


def test_each_batch_is_packed(spark, arriving):
    rows, stream, base = arriving
    stream_chunks(stream, SPEC, 300, f"{base}/out", f"{base}/progress").awaitTermination()
    got = read_delivered(spark, f"{base}/out")
    assert sorted(r.id for r in got.collect()) == list(range(400))
    assert [r.batch_id for r in got.select("batch_id").distinct().orderBy("batch_id").collect()] == [0, 1]
    for batch in (0, 1):
        mine = got.filter(f"batch_id = {batch}").drop("batch_id")
        again = pack_chunks(mine.select(rows.columns), SPEC, 300)
        assert chunk_index(mine).exceptAll(chunk_index(again)).count() == 0


def test_stopped_and_started_again(spark, arriving):
    rows, stream, base = arriving
    stream_chunks(stream, SPEC, 300, f"{base}/out", f"{base}/progress").awaitTermination()
    rows.withColumn("id", F.col("id") + 1000).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream_chunks(stream, SPEC, 300, f"{base}/out", f"{base}/progress").awaitTermination()
    assert read_delivered(spark, f"{base}/out").count() == 800


def test_another_query_is_refused(spark, arriving):
    """Progress lost after delivery: the same rows come in other batches, and must not come twice."""
    rows, stream, base = arriving
    stream_load(stream, f"{base}/out", f"{base}/progress").awaitTermination()
    wider = read_stream(spark, f"{base}/in", rows.schema, files_per_batch=4)
    with pytest.raises(Exception, match="a sink of its own"):
        stream_load(wider, f"{base}/out", f"{base}/progress-2").awaitTermination()
    got = read_delivered(spark, f"{base}/out").drop("batch_id")
    assert got.count() == 400 and got.exceptAll(rows).count() == 0


def test_a_repeated_batch_replaces_itself(spark, arriving):
    """A batch delivered whose end was not recorded comes again under its number."""
    rows, stream, base = arriving
    stream_load(stream, f"{base}/out", f"{base}/progress").awaitTermination()
    os.remove(f"{base}/progress/commits/1")
    if os.path.exists(f"{base}/progress/commits/.1.crc"):
        os.remove(f"{base}/progress/commits/.1.crc")
    stream_load(stream, f"{base}/out", f"{base}/progress").awaitTermination()
    got = read_delivered(spark, f"{base}/out").drop("batch_id")
    assert got.count() == 400 and got.exceptAll(rows).count() == 0


def test_load_with_mapping(spark, arriving):
    rows, stream, base = arriving
    query = stream_load(stream, f"{base}/out", f"{base}/progress", lambda batch: batch.select("id", F.upper("t").alias("t")))
    query.awaitTermination()
    got = read_delivered(spark, f"{base}/out")
    assert sorted(got.columns) == ["batch_id", "id", "t"] and got.filter("t <> upper(t)").count() == 0


def test_tables_are_not_streams(spark):
    with pytest.raises(ValueError):
        stream_chunks(spark.range(3), SPEC, 100, "/tmp/x", "/tmp/y")


def test_a_failed_delivery_is_reported(spark, arriving):
    _, stream, base = arriving
    query = stream_chunks(stream, SPEC, 10, f"{base}/out", f"{base}/progress")
    with pytest.raises(Exception, match="larger than a chunk"):
        query.awaitTermination()
    assert not os.path.exists(f"{base}/out/{streams.BATCH_ID}=0/_SUCCESS")


def test_a_sink_without_batches_is_empty(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    stream = read_stream(spark, f"{tmp_path}/in", "id long, user long, t string")
    stream_chunks(stream, SPEC, 300, f"{tmp_path}/out", f"{tmp_path}/progress").awaitTermination()
    got = read_delivered(spark, f"{tmp_path}/out")
    assert got.count() == 0 and got.columns == ["id", "user", "t", "partition_id", "row_pos", "chunk_id", "row_bytes", "batch_id"]


@pytest.fixture
def target(spark, tmp_path):
    name = f"stream_{abs(hash(str(tmp_path)))}"
    create_stream_table(spark, name, "t STRING, id BIGINT, note STRING DEFAULT 'none', user BIGINT", f"{tmp_path}/table")
    yield name
    drop_table(spark, name)


def test_tables_are_loaded_by_name(spark, arriving, target):
    rows, stream, base = arriving
    assert spark.table(target).count() == 0 and read_ledger(spark, target) is None
    stream_load_table(stream, target, f"{base}/progress", ["id", "t"]).awaitTermination()
    got = spark.table(target)
    assert got.select("id", "t").exceptAll(rows.select("id", "t")).count() == 0 and got.count() == 400
    assert [tuple(r) for r in got.select("note", "user").distinct().collect()] == [("none", None)]
    ledger = read_ledger(spark, target)
    assert (ledger.batch, ledger.rows) == (1, 400)
    rows.limit(5).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream_load_table(stream, target, f"{base}/progress", ["id", "t"]).awaitTermination()
    assert (read_ledger(spark, target).batch, read_ledger(spark, target).rows, spark.table(target).count()) == (2, 405, 405)


def test_batches_lost_on_the_way_come_once(spark, arriving, target, monkeypatch):
    """Lost after the rows were written, but before they were entered."""
    rows, stream, base = arriving
    enter, lost = streams._enter, []

    def lose(spark_, table, ledger):
        if ledger.batch == 1 and not lost:
            lost.append(ledger)
            raise RuntimeError("session lost")
        enter(spark_, table, ledger)

    monkeypatch.setattr(streams, "_enter", lose)
    with pytest.raises(Exception, match="session lost"):
        stream_load_table(stream, target, f"{base}/progress").awaitTermination()
    assert read_ledger(spark, target).batch == 0 and spark.table(target).count() == 400
    stream_load_table(stream, target, f"{base}/progress").awaitTermination()
    assert read_ledger(spark, target).rows == spark.table(target).count() == 400
    assert spark.table(target).select(rows.columns).exceptAll(rows).count() == 0


def test_batches_already_entered_are_passed_over(spark, arriving, target):
    rows, stream, base = arriving
    stream_load_table(stream, target, f"{base}/progress").awaitTermination()
    before = {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in spark.table(target).inputFiles()}
    for name in ("1", ".1.crc"):
        if os.path.exists(f"{base}/progress/commits/{name}"):
            os.remove(f"{base}/progress/commits/{name}")
    stream_load_table(stream, target, f"{base}/progress").awaitTermination()
    spark.catalog.refreshTable(target)
    assert {f: os.stat(f.removeprefix("file://")).st_mtime_ns for f in spark.table(target).inputFiles()} == before
    assert read_ledger(spark, target).rows == 400


def test_tables_belong_to_their_query(spark, arriving, target, tmp_path):
    rows, stream, base = arriving
    stream_load_table(stream, target, f"{base}/progress").awaitTermination()
    with pytest.raises(Exception, match="a table of its own"):
        stream_load_table(stream, target, f"{base}/progress-2").awaitTermination()
    assert spark.table(target).count() == 400
    with pytest.raises(ValueError, match="not partitioned"):
        spark.sql(f"CREATE TABLE {target}_plain (id BIGINT) USING parquet LOCATION '{tmp_path}/plain'")
        try:
            stream_load_table(stream, f"{target}_plain", f"{base}/progress-3")
        finally:
            drop_table(spark, f"{target}_plain")


@pytest.mark.parametrize("empty_is_null", [True, False])
def test_records_are_mapped(spark, target, tmp_path, empty_is_null):
    rows = spark.createDataFrame([(None, "a"), (4, ""), (-(2**63), None)], "id long, t string")
    encode_table(rows).toDF(field_name(0), field_name(1)).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = read_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema)
    stream_load_table(stream, target, f"{tmp_path}/progress", schema=rows.schema, treat_zero_len_as_null=empty_is_null).awaitTermination()
    empty = None if empty_is_null else ""
    assert sorted(map(str, spark.table(target).select("id", "t", "note").collect())) == sorted(map(str, spark.createDataFrame(
        [(None, "a", "none"), (4, empty, "none"), (None, empty, "none")], "id long, t string, note string").collect()))


@pytest.mark.parametrize("task_bytes", [512 << 20, 2_000])
def test_batches_are_read_once(spark, tmp_path, task_bytes):
    """Rows that leave the source are counted, for batches packed whole and batches split over tasks; no copy stays."""
    rows = spark.range(600).select(F.col("id"), F.repeat(F.lit("x"), (F.col("id") % 17).cast("int")).alias("text"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    left = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            left.add(batch.num_rows)
            yield batch

    stream = read_stream(spark, str(tmp_path / "in"), rows.schema, files_per_batch=2).mapInArrow(counted, rows.schema)
    spec = PartitionSpec(4, by=("id",), order=("id",), key="id", task_bytes=task_bytes)
    stream_chunks(stream, spec, 256, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = read_delivered(spark, str(tmp_path / "out"))
    assert left.value == 600
    assert {(r.id, r.text) for r in got.collect()} == {(i, "x" * (i % 17)) for i in range(600)} and got.count() == 600
    assert got.groupBy("batch_id", "partition_id", "chunk_id").agg(F.sum("row_bytes").alias("b")).agg(F.max("b")).first()[0] <= 256
    assert not [p for p in (Path(shared_dir(spark).removeprefix("file:")) / "stream").glob("*") if not p.name.startswith(".")]
