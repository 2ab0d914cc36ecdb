"""Exchange values: 1960-based dates and times, NULL markers, fixed-width slots.

All of it is built-in expressions, so whole tables are converted inside code
generation. A TIMESTAMP_NTZ counts from the start of 1960 on its own clock, a TIMESTAMP, which is an instant, from the
start of 1960 in UTC; neither depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from chunkspark.functions.types import (
    DATE, DATETIME, DOUBLE, FIXED, INT32, INT64, TIME,
    aligned, check_supported, quoted, type_class, value_width,
)

# Fixed values of the exchange form.
EPOCH = "1960-01-01"
INT64_NULL = -(2**63)
INT32_NULL = -(2**31)
MICROS_TO_1970 = 315_619_200_000_000
MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400_000_000
TIME_PATTERN = r"^(-?)(\d+):(\d+):(\d+)(?:\.(\d{1,6}))?$"


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


# ---- dates and times ---------------------------------------------------------

def date_to_days(column: Column) -> Column:
    return F.date_diff(column, F.lit(EPOCH).cast("date"))


def days_to_date(column: Column) -> Column:
    return F.date_add(F.lit(EPOCH).cast("date"), column.cast("int"))


def datetime_to_micros(column: Column) -> Column:
    """Microseconds from the start of 1960 to a TIMESTAMP_NTZ."""
    seconds = F.hour(column) * F.lit(3600) + F.minute(column) * F.lit(60)
    fraction = (F.extract(F.lit("SECOND"), column) * F.lit(MICROS_PER_SECOND)).cast("long")
    days = F.date_diff(column.cast("date"), F.lit(EPOCH).cast("date")).cast("long")
    return days * _long(MICROS_PER_DAY) + seconds.cast("long") * _long(MICROS_PER_SECOND) + fraction


def micros_to_datetime(column: Column) -> Column:
    """Inverse of datetime_to_micros, also before 1960."""
    within = F.pmod(column, _long(MICROS_PER_DAY))
    days = F.call_function("div", column - within, _long(MICROS_PER_DAY)).cast("int")
    seconds = (within.cast("decimal(18,0)") / F.lit(MICROS_PER_SECOND)).cast("decimal(18,6)")
    start = F.lit(EPOCH + " 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds)


def stamp_to_micros(field: T.StructField) -> Column:
    """Microseconds from the start of 1960 to a DATETIME column of either kind."""
    column = quoted(field.name)
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_micros(column) + _long(MICROS_TO_1970)
    return datetime_to_micros(column)


def micros_to_stamp(column: Column, kind: T.DataType) -> Column:
    """Inverse of stamp_to_micros."""
    return F.timestamp_micros(column - _long(MICROS_TO_1970)) if isinstance(kind, T.TimestampType) else micros_to_datetime(column)


def micros_to_time_text(column: Column) -> Column:
    """Signed microseconds as [-]h:m:s.ffffff; hours may pass 24, zero has no sign."""
    size = F.abs(column)
    seconds = _div(size, MICROS_PER_SECOND)
    parts = (
        F.when(column < 0, F.lit("-")).otherwise(F.lit("")),
        _div(seconds, 3600), F.lit(":"), F.pmod(_div(seconds, 60), _long(60)), F.lit(":"), F.pmod(seconds, _long(60)),
        F.lit("."), F.lpad(F.pmod(size, _long(MICROS_PER_SECOND)).cast("string"), 6, "0"),
    )
    return F.concat(*[p.cast("string") for p in parts])


def _div(column: Column, by: int) -> Column:
    """Whole part of a division of a BIGINT that is not negative."""
    return F.call_function("div", column, _long(by))


def time_text_to_micros(column: Column) -> Column:
    """Inverse of micros_to_time_text; text of another shape gives NULL."""
    def part(number: int) -> Column:
        return F.regexp_extract(column, TIME_PATTERN, number)

    seconds = part(2).try_cast("long") * 3600 + part(3).try_cast("long") * 60 + part(4).try_cast("long")
    micros = seconds * _long(MICROS_PER_SECOND) + F.rpad(part(5), 6, "0").try_cast("long")
    return F.when(part(1) == "-", -micros).otherwise(micros)


# ---- fixed width -------------------------------------------------------------

def pad_fixed(column: Column, width: int, text: bool) -> Column:
    """Bytes padded to the slot: spaces for text, zero bytes for binary."""
    slot = aligned(width)
    raw = column.cast("binary")
    pad = F.lit(b" " * slot if text else bytes(slot))
    too_long = F.raise_error(
        F.format_string("value of %d bytes in a column of " + str(width), F.octet_length(raw))
    ).cast("binary")
    padded = F.substring(F.concat(raw, pad), 1, slot)
    return F.when(F.octet_length(raw) > width, too_long).otherwise(padded)


def unpad_fixed(column: Column, width: int, text: bool, blank_is_null: bool = True) -> Column:
    """Value of a slot; only spaces or only zero bytes means NULL, unless blank values are to be kept: then text of
    spaces is empty text, and zero bytes are what they are."""
    raw = F.substring(column, 1, width)
    value = F.rtrim(raw.cast("string")) if text else raw
    if not blank_is_null:
        return value
    return F.when(~raw.isin(F.lit(b" " * width), F.lit(bytes(width))), value)


# ---- whole tables ------------------------------------------------------------

def _is_text(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType)


def encoded_value(field: T.StructField) -> Column:
    """Exchange value of a column, NULL as its marker."""
    column, kind = quoted(field.name), type_class(field)
    if kind in (INT64, TIME):
        return F.coalesce(column, _long(INT64_NULL))
    if kind == INT32:
        return F.coalesce(column, F.lit(INT32_NULL))
    if kind == DOUBLE:
        return F.coalesce(column, F.lit(float("nan")))
    if kind == DATE:
        return F.coalesce(date_to_days(column), F.lit(INT32_NULL))
    if kind == DATETIME:
        return F.coalesce(stamp_to_micros(field), _long(INT64_NULL))
    if kind == FIXED:
        width = value_width(field)
        return F.coalesce(pad_fixed(column, width, _is_text(field)), F.lit(bytes(aligned(width))))
    return F.coalesce(column.cast("binary"), F.lit(b""))


def decoded_value(field: T.StructField, column: Column, zero_length_is_null: bool = True) -> Column:
    """Table value of an exchange column, marker as NULL. Inverse of encoded_value."""
    kind = type_class(field)
    if kind in (INT64, TIME):
        value = F.nullif(column, _long(INT64_NULL))
    elif kind == INT32:
        value = F.nullif(column, F.lit(INT32_NULL))
    elif kind == DOUBLE:
        value = F.when(~F.isnan(column), column)
    elif kind == DATE:
        value = days_to_date(F.nullif(column, F.lit(INT32_NULL)))
    elif kind == DATETIME:
        value = micros_to_stamp(F.nullif(column, _long(INT64_NULL)), field.dataType)
    elif kind == FIXED:
        value = unpad_fixed(column, value_width(field), _is_text(field), zero_length_is_null)
    else:
        value = F.when(F.octet_length(column) > 0, column) if zero_length_is_null else column
    return value.cast(field.dataType)


def encode_table(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Every column as its exchange value."""
    schema = schema or df.schema
    check_supported(schema)
    return df.select(*[encoded_value(f).alias(f.name) for f in schema])


def decode_table(df: DataFrame, schema: T.StructType, zero_length_is_null: bool = True) -> DataFrame:
    """Table values of an encoded table; ``schema`` is that of the original."""
    check_supported(schema)
    return df.select(*[
        decoded_value(f, quoted(f.name), zero_length_is_null).alias(f.name, metadata=f.metadata) for f in schema
    ])
