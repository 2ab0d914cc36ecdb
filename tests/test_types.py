import pytest
from pyspark.sql import types as T

from chunkspark.functions.types import (
    UnsupportedTypeError, binary_field, char_field, fixed_row_bytes, row_bytes, time_field, type_class,
    value_width, with_fields,
)


def test_widths_of_char_columns():
    assert value_width(char_field("c", 16)) == 64
    assert value_width(char_field("c", 16, "utf8")) == 48
    assert value_width(binary_field("b", 9)) == 9


def test_classes():
    fields = {
        "Int64": T.LongType(), "Int32": T.IntegerType(), "Double": T.DoubleType(), "Variable": T.BinaryType(),
        "Date": T.DateType(), "DateTime": T.TimestampNTZType(), "Unsupported": T.DecimalType(10, 2),
    }
    for kind, data_type in fields.items():
        assert type_class(T.StructField("c", data_type)) == kind
    assert type_class(time_field("t")) == "Time"
    assert type_class(char_field("c", 3)) == "Fixed"


def test_row_bytes_counts_bytes_not_characters(spark):
    df = spark.createDataFrame([(1, "рус"), (2, None), (3, "")], "id long, t string")
    assert [r[0] for r in df.orderBy("id").select(row_bytes(df.schema)).collect()] == [30, 24, 24]


def test_row_bytes_of_the_boundary_row(spark):
    df = spark.createDataFrame([(1, b"abc")], "id long, var binary")
    assert df.select(row_bytes(df.schema)).first()[0] == 27


def test_fixed_columns_take_their_aligned_width(spark):
    df = spark.createDataFrame([("a", b"b", 1)], "c string, b binary, n int")
    df = with_fields(df, char_field("c", 4), binary_field("b", 9))
    assert fixed_row_bytes(df.schema) == 16 + 16 + 8
    assert df.select(row_bytes(df.schema)).first()[0] == 40


def test_unsupported_types_are_refused_on_packing(spark):
    from chunkspark import PartitionSpec, encode_table, pack_chunks
    df = spark.createDataFrame([(1, [0.5])], "id long, v array<float>")
    with pytest.raises(UnsupportedTypeError, match="v array<float>"):
        encode_table(df)
    with pytest.raises(UnsupportedTypeError):
        pack_chunks(df, PartitionSpec(2, key="id"), 100)
