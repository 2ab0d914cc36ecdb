"""TSV and positional files."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from chunkspark import (
    export_positional, export_tsv, import_positional, import_tsv, map_positional,
)
from chunkspark.sources.positional import avro_format, record_schema
from test_codec import GOLDEN, all_types


def load_rows(spark):
    """Thirty rows of every type and one of NULLs."""
    day = dt.datetime(1958, 11, 30, 6, 7, 8)
    rows = [
        (
            7 * i - 90, 1000 - i, None if i % 4 == 0 else (i - 11) / 3 * 10.0 ** (20 * (i % 3)), f"no. {i} of \u0394", "a\tb\nc" * (i % 3 + 1),
            '"' * (i % 2) + "back\\slash", bytes([i + 1, 200, 9]), "\u017eluť", bytes([65 + i]) * 4,
            day + dt.timedelta(days=900 * i), day + dt.timedelta(hours=i, microseconds=i * 31_337), day.date() + dt.timedelta(days=401 * i),
            (i - 15) * 7_654_321_098,
        )
        for i in range(30)
    ]
    return all_types(spark, *rows, (0, *[None] * 12))


def comparable(df):
    """Binary columns of a fixed width keep their zero bytes."""
    return df.withColumn("fbinary", F.hex(F.substring(F.concat("fbinary", F.lit(bytes(9))), 1, 9)))


def assert_same(a, b):
    assert comparable(a).exceptAll(comparable(b)).count() == comparable(b).exceptAll(comparable(a)).count() == 0


def test_tsv_round_trip(spark, tmp_path):
    rows = load_rows(spark)
    export_tsv(rows, f"{tmp_path}/t")
    assert_same(import_tsv(spark, f"{tmp_path}/t", rows.schema), rows)


def test_tsv_text(spark, tmp_path):
    export_tsv(all_types(spark, GOLDEN).coalesce(1), f"{tmp_path}/t")
    line = (tmp_path / "t").glob("part-*.txt").__next__().read_bytes().decode().rstrip("\n")
    cells = line.split("\t")
    assert cells[:2] == ["-77", "31"]
    assert float(cells[2]) == -0.015625
    assert cells[3:7] == ['"Grüße"', '"a longer text"', '"v"', '"\x01bin"']
    assert cells[7] == '"' + "Ωm" + " " * 61 + '"' and cells[8] == '"xyz\0\0\0\0\0\0"'
    assert cells[9:] == ["1999-12-31 23:59:58", "1957-10-04 19:28:34.000123", "1957-10-04", "-2:3:4.000567"]


def test_tsv_nulls_and_empty_values(spark, tmp_path):
    rows = spark.createDataFrame([(None, None, float("nan")), (1, "", 2.0)], "i long, t string, d double").coalesce(1)
    export_tsv(rows, f"{tmp_path}/t")
    lines = (tmp_path / "t").glob("part-*.txt").__next__().read_text().splitlines()
    assert lines[0] == "\\N\t\\N\t\\N" and lines[1].startswith("1\t\\N\t")


@pytest.mark.parametrize("text", [
    'say "hi"', "back\\slash", "ends with \\", '\\"', "a\tb\nc", "\r\n", " lead and trail ", "#", '"', "N", "\\\\N", "\u0000x", "naïve 漢字 🙂",
])
def test_tsv_awkward_text(spark, tmp_path, text):
    rows = spark.createDataFrame([(1, text, text.encode())], "id long, t string, b binary")
    export_tsv(rows, f"{tmp_path}/t")
    row = import_tsv(spark, f"{tmp_path}/t", rows.schema).first()
    assert (row.id, row.t, bytes(row.b)) == (1, text, text.encode())


def test_tsv_keeps_any_bytes(spark, tmp_path):
    value = bytes(range(256))
    rows = spark.createDataFrame([(value,)], "b binary")
    export_tsv(rows, f"{tmp_path}/t")
    assert bytes(import_tsv(spark, f"{tmp_path}/t", rows.schema).first().b) == value


def test_tsv_text_that_reads_as_null(spark, tmp_path):
    rows = spark.createDataFrame([("\\N",), ("\\\\N",), (None,), ("N",)], "t string")
    export_tsv(rows, f"{tmp_path}/t")
    found = sorted(str(r.t) for r in import_tsv(spark, f"{tmp_path}/t", rows.schema).collect())
    assert found == sorted(["\\N", "\\\\N", "None", "N"])


def test_tsv_files_stay_small(spark, tmp_path):
    export_tsv(spark.range(100).coalesce(1), f"{tmp_path}/t", rows_per_file=30)
    assert len(list((tmp_path / "t").glob("part-*"))) == 4


def test_tsv_bad_number_fails(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("x\n")
    schema = spark.range(1).schema
    with pytest.raises(Exception):
        import_tsv(spark, f"{tmp_path}/t.tsv", schema).collect()


@pytest.mark.parametrize("fmt", [None, "parquet"])
def test_positional_round_trip(spark, tmp_path, fmt):
    rows = load_rows(spark)
    export_positional(rows, f"{tmp_path}/p", fmt)
    records = import_positional(spark, f"{tmp_path}/p", rows.schema, fmt)
    assert records.columns == [f"col_{i}" for i in range(13)]
    assert_same(map_positional(records, rows.schema), rows)


def test_positional_files_are_avro_where_possible(spark, tmp_path):
    if avro_format(spark) is None:
        pytest.skip("no Avro in this session")
    export_positional(spark.range(3), f"{tmp_path}/p")
    assert next((tmp_path / "p").glob("part-*")).read_bytes()[:3] == b"Obj"


def test_record_schema(spark):
    fields = json.loads(record_schema(all_types(spark).schema))["fields"]
    assert [f["name"] for f in fields] == [f"col_{i}" for i in range(13)]
    assert [f["type"] for f in fields] == [
        "long", "int", "double", "bytes", "bytes", "bytes", "bytes", "bytes", "bytes", "long", "long", "int", "long",
    ]
