import os

import pytest

from chunkspark import (
    create_table, create_table_as, delete_where, drop_table, export_positional, finish_change, import_positional, insert_rows,
    load_mapped, load_table, update_where, with_row_key,
)
from chunkspark.session import shared_dir
from chunkspark.sources import tables
from test_files import assert_same, load_rows


@pytest.fixture
def table(spark, request):
    name = f"t_{abs(hash(request.node.name))}"
    drop_table(spark, name)
    yield name
    drop_table(spark, name)


def path_of(spark, name):
    return f"{shared_dir(spark)}/{name}"


def test_changes_and_their_counts(spark, table):
    create_table(spark, table, "col_0 INT", path_of(spark, table))
    assert insert_rows(spark, table, "SELECT * FROM VALUES (1), (2), (3) AS v(col_0)") == 3
    assert delete_where(spark, table, "col_0 < 2") == 1
    assert update_where(spark, table, {"col_0": "col_0 * 2"}, "col_0 > 0") == 2
    assert sorted(r.col_0 for r in spark.table(table).collect()) == [4, 6]
    assert delete_where(spark, table, "col_0 > 100") == 0
    assert delete_where(spark, table, "true") == 2
    assert spark.table(table).count() == 0
    assert insert_rows(spark, table, "SELECT 9 AS col_0") == 1


def test_unknown_conditions_change_nothing(spark, table):
    create_table(spark, table, "a INT, b INT", path_of(spark, table))
    insert_rows(spark, table, "SELECT * FROM VALUES (1, NULL), (2, 5) AS v(a, b)")
    assert delete_where(spark, table, "b < 3") == 0
    assert update_where(spark, table, {"a": "b", "b": "a"}, "b > 3") == 1
    assert sorted((r.a, r.b) for r in spark.table(table).collect()) == [(1, None), (5, 2)]


def test_managed_tables_can_be_changed(spark, table, tmp_path):
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{tmp_path}/v' AS SELECT 1 AS a")
    assert update_where(spark, table, {"a": "a + 1"}, "true") == 1
    assert update_where(spark, table, {"a": "a + 1"}, "true") == 1
    assert [r.a for r in spark.table(table).collect()] == [3]


def test_neighbours_survive_a_change(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}' AS SELECT id AS a FROM range(4)")
    others = {f"{table}__next": None, f"{table}_n1": f"{path}__v1", f"{table}_n2": f"{path}__1"}
    for name, where in others.items():
        place = f"LOCATION '{where}'" if where else ""
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet {place} AS SELECT 7 AS c")
    try:
        assert update_where(spark, table, {"a": "a + 10"}, "a < 2") == 2
        assert delete_where(spark, table, "a = 3") == 1
        assert sorted(r.a for r in spark.table(table).collect()) == [2, 10, 11]
        for name in others:
            spark.sql(f"REFRESH TABLE {name}")
            assert [r.c for r in spark.table(name).collect()] == [7]
        # The user's own folder stays; of ours there is one.
        assert len([f for f in os.listdir(tmp_path) if f.startswith("t__") and f not in ("t__v1", "t__1")]) == 1
    finally:
        for name in others:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize("external", [True, False])
def test_partitioned_tables_stay_partitioned(spark, table, tmp_path, external):
    writer = spark.range(12).selectExpr("id AS a", "if(id % 4 = 3, null, 'p' || id % 4) AS p").write.partitionBy("p")
    (writer.option("path", f"{tmp_path}/t") if external else writer).saveAsTable(table)
    before = {f: os.stat(f).st_mtime_ns for f in spark.table(table).filter("p = 'p0'").inputFiles() if os.path.exists(f)}
    assert update_where(spark, table, {"a": "a * 100"}, "p = 'p1' AND a > 1") == 2
    assert delete_where(spark, table, "p IS NULL AND a < 10") == 2
    assert delete_where(spark, table, "p = 'p2'") == 3
    assert sorted((r.a, r.p) for r in spark.table(table).collect() if r.p) == [(0, "p0"), (1, "p1"), (4, "p0"), (8, "p0"), (500, "p1"), (900, "p1")]
    assert [r.a for r in spark.table(table).filter("p IS NULL").collect()] == [11]
    assert [c.name for c in spark.catalog.listColumns(table) if c.isPartition] == ["p"]
    assert all(os.stat(f).st_mtime_ns == t for f, t in before.items())
    assert update_where(spark, table, {"p": "'p9'"}, "a = 0") == 1
    assert [c.name for c in spark.catalog.listColumns(table) if c.isPartition] == ["p"] and spark.table(table).filter("p = 'p9'").count() == 1


def test_bucketed_tables_stay_bucketed(spark, table):
    spark.range(50).selectExpr("id AS a", "id % 5 AS b").write.bucketBy(4, "b").sortBy("a").saveAsTable(table)
    assert delete_where(spark, table, "a < 10") == 10
    assert [c.name for c in spark.catalog.listColumns(table) if c.isBucket] == ["b"]
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    assert told["Num Buckets"] == "4" and told["Sort Columns"] == "[`a`]" and spark.table(table).count() == 40


def test_tables_of_another_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS other_db")
    create_table(spark, "other_db.t1", "a INT")
    try:
        assert insert_rows(spark, "other_db.t1", "SELECT 1 AS a UNION ALL SELECT 2") == 2
        assert update_where(spark, "other_db.t1", {"a": "5"}, "a = 1") == 1
        assert sorted(r.a for r in spark.table("other_db.t1").collect()) == [2, 5]
    finally:
        drop_table(spark, "other_db.t1")
        spark.sql("DROP DATABASE other_db CASCADE")


def test_doubling(spark, table):
    create_table_as(spark, table, "SELECT id, id % 3 AS g FROM range(14)", path_of(spark, table))
    for n in range(3):
        assert insert_rows(spark, table, f"SELECT * FROM {table}") == 14 * 2 ** n
    assert spark.table(table).count() == 14 * 8


def test_inserting_nothing(spark, table):
    create_table(spark, table, "a BIGINT", path_of(spark, table))
    assert insert_rows(spark, table, "SELECT id AS a FROM range(5) WHERE 1 = 0") == 0
    assert insert_rows(spark, table, "SELECT id AS a FROM range(5) WHERE id > 7") == 0


def test_load_by_name(spark, table):
    create_table(spark, table, "a INT, b STRING DEFAULT 'none', c DOUBLE", path_of(spark, table))
    rows = spark.createDataFrame([(1.5, 1, "skip")], "c double, a int, d string")
    assert load_table(rows, table, ["c", "a"]) == 1
    assert tuple(spark.table(table).first()) == (1, "none", 1.5)


@pytest.mark.parametrize("times", [1, 3])
def test_mapped_load_equals_the_rows(spark, table, tmp_path, times):
    rows = load_rows(spark)
    export_positional(rows, f"{tmp_path}/p")
    records = import_positional(spark, f"{tmp_path}/p", rows.schema)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    create_table(spark, table, columns, path_of(spark, table))
    for _ in range(times):
        assert load_mapped(records, table, rows.schema) == 31
    assert spark.table(table).count() == 31 * times
    assert_same(spark.table(table).distinct(), rows)


@pytest.mark.parametrize("task_bytes", [1 << 30, 400])
def test_row_keys(spark, small, task_bytes):
    rows = with_row_key(small.drop("row_id"), ["i1", "d1"], "row_id", 1, task_bytes).collect()
    ordered = sorted(rows, key=lambda r: r.row_id)
    assert [r.row_id for r in ordered] == list(range(1, 15))
    keys = [(r.i1 is not None, r.i1 or 0, r.d1 or 0.0) for r in ordered]
    assert keys == sorted(keys)


@pytest.fixture(params=["static", "dynamic"])
def overwriting(spark, request):
    name = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield request.param
    spark.conf.set(name, before)


def test_rows_that_move_between_partitions(spark, table, tmp_path, overwriting):
    spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "a int, p int").write.partitionBy("p").option("path", f"{tmp_path}/t").saveAsTable(table)
    assert update_where(spark, table, {"p": "p + 1"}, "p = 1") == 2
    assert sorted(tuple(r) for r in spark.table(table).collect()) == [(1, 2), (2, 2), (3, 2)]
    assert delete_where(spark, table, "a > 1") == 2
    assert [tuple(r) for r in spark.table(table).collect()] == [(1, 2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == overwriting


@pytest.mark.parametrize("moving", [False, True])
def test_lost_changes_of_partitions_are_finished(spark, table, tmp_path, monkeypatch, moving):
    spark.range(9).selectExpr("id AS a", "id % 3 AS p").write.partitionBy("p").option("path", f"{tmp_path}/t").saveAsTable(table)

    def lost(*_):
        # What a session lost amid the overwriting leaves: some old partitions are gone, new ones not there.
        spark.sql(f"ALTER TABLE {table} DROP PARTITION (p = 1)")
        raise RuntimeError("session lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "_overwriting", lost)
        with pytest.raises(RuntimeError, match="session lost"):
            if moving:
                update_where(spark, table, {"p": "0"}, "p = 1")
            else:
                delete_where(spark, table, "p = 1 OR a = 0")
    assert finish_change(spark, table) and not finish_change(spark, table)
    want = [(a, 0 if a % 3 == 1 else a % 3) for a in range(9)] if moving else [(a, a % 3) for a in range(1, 9) if a % 3 != 1]
    assert sorted(tuple(r) for r in spark.table(table).collect()) == want


@pytest.mark.parametrize("step", ["SET LOCATION", "SET TBLPROPERTIES", "DROP TABLE"])
def test_a_lost_swap_leaves_old_rows_or_new_ones(spark, table, tmp_path, step, monkeypatch):
    create_table_as(spark, table, "SELECT id AS a FROM range(5)", f"{tmp_path}/t")

    class Lost:
        """The session, until it comes to ``step``."""
        def __getattr__(self, name):
            return getattr(spark, name)

        def sql(self, text, **args):
            if step in text and "chunkspark.change" not in text:
                raise RuntimeError("session lost")
            return spark.sql(text, **args)

    with pytest.raises(RuntimeError, match="session lost"):
        delete_where(Lost(), table, "a < 2")
    spark.catalog.refreshTable(table)
    left = sorted(r.a for r in spark.table(table).collect())
    assert left == ([0, 1, 2, 3, 4] if step == "SET LOCATION" else [2, 3, 4])
    assert delete_where(spark, table, "a = 4") == 1 and 4 not in [r.a for r in spark.table(table).collect()]
    for name in [r.tableName for r in spark.sql(f"SHOW TABLES LIKE '{table}__*'").collect()]:
        drop_table(spark, name)
