"""Golden exchange values and round trips."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F, types as T

from chunkspark import binary_field, char_field, decode_table, encode_table, time_field, with_fields
from chunkspark.functions.hashing import partition_number
from chunkspark.functions.codec import (
    INT32_NULL, INT64_NULL, micros_to_time_text, time_text_to_micros,
)

ALL_TYPES = (
    "row_id long, iint int, ddouble double, vtext string, vlongtext string, vvarchar string, vvarbinary binary, "
    "fchar string, fbinary binary, idatetime timestamp_ntz, idatetime_6 timestamp_ntz, idate date, itime long"
)
FIELDS = (char_field("fchar", 16), binary_field("fbinary", 9), time_field("itime"))


def all_types(spark, *rows):
    return with_fields(spark.createDataFrame(list(rows), ALL_TYPES), *FIELDS)


GOLDEN = (
    -77, 31, -0.015625, "Grüße", "a longer text", "v", b"\x01bin", "Ωm", b"xyz",
    dt.datetime(1999, 12, 31, 23, 59, 58), dt.datetime(1957, 10, 4, 19, 28, 34, 123), dt.date(1957, 10, 4), -7_384_000_567,
)
EPOCH = dt.datetime(1960, 1, 1)


def since_1960(moment):
    return (moment - EPOCH) // dt.timedelta(microseconds=1)


def test_every_type(spark):
    row = encode_table(all_types(spark, GOLDEN)).first()
    assert row[:3] == (-77, 31, -0.015625)
    assert bytes(row.vtext) == "Grüße".encode() and len(row.vtext) == 7
    assert (len(row.vlongtext), len(row.vvarchar), len(row.vvarbinary)) == (13, 1, 4)
    assert len(row.fchar) == 64 and bytes(row.fchar) == "Ωm".encode().ljust(64)
    assert bytes(row.fbinary) == b"xyz".ljust(16, b"\0")
    assert (row.idatetime, row.idatetime_6) == (since_1960(GOLDEN[9]), since_1960(GOLDEN[10]))
    assert (row.idate, row.itime) == ((GOLDEN[11] - EPOCH.date()).days, -7_384_000_567)


def test_null_row(spark):
    row = encode_table(all_types(spark, (None,) * 13)).first()
    assert row.row_id == row.idatetime == row.idatetime_6 == row.itime == INT64_NULL
    assert row.iint == row.idate == INT32_NULL
    assert math.isnan(row.ddouble)
    assert [len(row[c]) for c in ("vtext", "vlongtext", "vvarchar", "vvarbinary")] == [0] * 4
    assert bytes(row.fchar) == bytes(64) and bytes(row.fbinary) == bytes(16)


def test_round_trip(spark):
    rows = all_types(spark, GOLDEN, (None,) * 13)
    back = decode_table(encode_table(rows), rows.schema)
    assert back.schema == rows.schema
    expected = list(GOLDEN)
    expected[8] = b"xyz".ljust(9, b"\0")
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in back.collect()]
    assert got == [tuple(expected), (None,) * 13]


def test_values_that_become_null(spark):
    rows = all_types(
        spark,
        (INT64_NULL, INT32_NULL, float("nan"), "", "", "", b"", "    ", bytes(9), None, None, None, INT64_NULL),
    )
    assert decode_table(encode_table(rows), rows.schema).first() == (None,) * 13


def test_empty_values_may_be_kept(spark):
    rows = spark.createDataFrame([("", b"")], "t string, b binary")
    back = decode_table(encode_table(rows), rows.schema, zero_length_is_null=False).first()
    assert back.t == "" and bytes(back.b) == b""


def test_values_longer_than_their_column_fail(spark):
    rows = with_fields(spark.createDataFrame([("abcdefghi",)], "c string"), char_field("c", 2))
    with pytest.raises(Exception, match="value of 9 bytes in a column of 8"):
        encode_table(rows).collect()


@pytest.mark.parametrize("encoded, moment", [
    (-6185436480000000, "1763-12-28 07:12:00"),
    (-1234567, "1959-12-31 23:59:58.765433"),
    (0, "1960-01-01 00:00:00"),
    (10, "1960-01-01 00:00:00.000010"),
    (253370764800000001, None),
])
def test_datetimes(spark, encoded, moment):
    schema = spark.createDataFrame([], "dt timestamp_ntz").schema
    decoded = decode_table(spark.createDataFrame([(encoded,)], "dt long"), schema)
    if moment:
        assert decoded.select(F.col("dt") == F.lit(moment).cast("timestamp_ntz")).first()[0]
    assert encode_table(decoded).first().dt == encoded


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_datetimes_do_not_depend_on_the_session_zone(spark, zone):
    """The skipped hour of a zone's clock change is a moment like any other."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.sql("SELECT TIMESTAMP_NTZ'2021-03-14 02:30:00.5' AS dt")
        assert encode_table(rows).first().dt == 1931308200500000
        assert decode_table(encode_table(rows), rows.schema).exceptAll(rows).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("encoded, day", [
    (-71590, "1763-12-29"), (-50, "1959-11-12"), (0, "1960-01-01"), (10, "1960-01-11"), (2, "1960-01-03"),
])
def test_dates(spark, encoded, day):
    rows = spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date")
    assert encode_table(rows).first().d == encoded
    assert decode_table(encode_table(rows), rows.schema).first().d.isoformat() == day


@pytest.mark.parametrize("micros, text", [
    (0, "0:0:0.000000"), (-1000, "-0:0:0.001000"), (10, "0:0:0.000010"), (-40271751234, "-11:11:11.751234"),
    (90_000_000_000, "25:0:0.000000"), (3_020_399_000_000, "838:59:59.000000"), (None, None),
])
def test_times(spark, micros, text):
    rows = spark.createDataFrame([(micros, text)], "m long, t string")
    row = rows.select(micros_to_time_text(F.col("m")), time_text_to_micros(F.col("t"))).first()
    assert row == (text, micros)


def test_time_text_of_other_shapes(spark):
    rows = spark.createDataFrame([("1:2:3",), ("1:2:3.5",), ("x",), ("1:2",)], "t string")
    got = [r[0] for r in rows.select(time_text_to_micros(F.col("t"))).collect()]
    assert got == [3_723_000_000, 3_723_500_000, None, None]


def test_no_python_in_the_plan(spark):
    rows = all_types(spark, GOLDEN)
    plan = decode_table(encode_table(rows), rows.schema)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


@pytest.mark.parametrize("zone", ["America/New_York", "UTC"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    """05:30Z and 06:30Z read the same on New York's clocks on that day."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.sql("SELECT timestamp_seconds(1636263000 + 3600 * id) AS at FROM range(2)")
        encoded = encode_table(rows)
        assert sorted(r.at for r in encoded.collect()) == [1951882200000000, 1951885800000000]
        assert decode_table(encoded, rows.schema).exceptAll(rows).count() == 0
        numbers = {r.n for r in rows.select(partition_number([rows.schema["at"]], 1 << 30).alias("n")).collect()}
        assert len(numbers) == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_blank_fixed_values_are_kept_on_request(spark):
    fields = [char_field("t", 2, "latin1"), binary_field("b", 3)]
    rows = spark.createDataFrame([("", b""), (" ", b"a"), (None, None), ("x", b"abc")], T.StructType(fields))
    rows = with_fields(rows, *fields)
    kept = [tuple(r) for r in decode_table(encode_table(rows), rows.schema, zero_length_is_null=False).collect()]
    zeros = "\0" * 6
    assert kept == [("", bytes(3)), ("", b"a\0\0"), (zeros, bytes(3)), ("x", b"abc")]
    assert [tuple(r) for r in decode_table(encode_table(rows), rows.schema).collect()][0] == (None, None)
