"""Type classes of a result column and the bytes a row takes in a chunk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F, types as T

INT64, INT32, DOUBLE = "Int64", "Int32", "Double"
VARIABLE, FIXED = "Variable", "Fixed"
TIME, DATE, DATETIME = "Time", "Date", "DateTime"
UNSUPPORTED = "Unsupported"

# Bytes of a value in the fixed section, before rounding up to ALIGN.
WIDTHS = {INT64: 8, INT32: 4, DOUBLE: 8, VARIABLE: 0, TIME: 8, DATE: 4, DATETIME: 8, UNSUPPORTED: 0}
ALIGN = 8
VARIABLE_SLOT = 16
CHAR_BYTES = {"utf8mb4": 4}
CHAR_BYTES_OTHER = 3

_CLASS_OF = {
    T.LongType: INT64,
    T.IntegerType: INT32,
    T.DoubleType: DOUBLE,
    T.StringType: VARIABLE,
    T.BinaryType: VARIABLE,
    T.DateType: DATE,
    T.TimestampNTZType: DATETIME,
    T.TimestampType: DATETIME,
}


class UnsupportedTypeError(TypeError):
    """A column type that has no exchange form."""


def char_field(name: str, chars: int, charset: str = "utf8mb4") -> T.StructField:
    """CHAR(chars) column: text of a fixed byte width."""
    width = chars * CHAR_BYTES.get(charset, CHAR_BYTES_OTHER)
    return T.StructField(name, T.StringType(), True, {"width": width})


def binary_field(name: str, width: int) -> T.StructField:
    """BINARY(width) column."""
    return T.StructField(name, T.BinaryType(), True, {"width": width})


def time_field(name: str) -> T.StructField:
    """TIME(6) column, kept as signed microseconds because it may exceed a day."""
    return T.StructField(name, T.LongType(), True, {"time": True})


def type_class(field: T.StructField) -> str:
    known = _CLASS_OF.get(type(field.dataType), UNSUPPORTED)
    if known == VARIABLE and "width" in field.metadata:
        return FIXED
    if known == INT64 and field.metadata.get("time"):
        return TIME
    return known


def value_width(field: T.StructField) -> int:
    """Declared bytes of a value; 0 where it varies or is not supported."""
    kind = type_class(field)
    return field.metadata["width"] if kind == FIXED else WIDTHS[kind]


def aligned(width: int) -> int:
    return -(-width // ALIGN) * ALIGN


def with_fields(df, *fields: T.StructField):
    """Attach the width or time metadata of ``fields`` to columns of the same name."""
    for field in fields:
        df = df.withMetadata(field.name, field.metadata)
    return df


def quoted(name: str) -> Column:
    """Column by its exact name, odd characters included."""
    return F.col("`" + name.replace("`", "``") + "`")


def column_bytes(field: T.StructField) -> Column:
    """Bytes one value of the column takes in a chunk, NULL included."""
    kind = type_class(field)
    if kind == VARIABLE:
        return F.coalesce(F.octet_length(quoted(field.name)), F.lit(0)).cast("long") + F.lit(VARIABLE_SLOT)
    if kind == FIXED:
        return F.lit(aligned(value_width(field))).cast("long")
    return F.lit(ALIGN).cast("long")


def held_bytes(column: Column, kind: T.DataType) -> Column:
    """About the bytes a value takes, nested ones by what they hold; for placing rows, not for chunks."""
    long = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)):
            inner = F.aggregate(column, F.lit(0).cast("long"), lambda total, x: total + held_bytes(x, kind.elementType))
            return long(inner) + VARIABLE_SLOT
        return long(F.greatest(F.size(column), F.lit(0))) * ALIGN + VARIABLE_SLOT
    if isinstance(kind, T.MapType):
        keys, values = T.ArrayType(kind.keyType), T.ArrayType(kind.valueType)
        return held_bytes(F.map_keys(column), keys) + held_bytes(F.map_values(column), values)
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a + b, [held_bytes(column[f.name], f.dataType) for f in kind], F.lit(0).cast("long"))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return long(F.octet_length(column)) + VARIABLE_SLOT
    return F.lit(ALIGN).cast("long")


def check_supported(schema: T.StructType) -> None:
    bad = [f"{f.name} {f.dataType.simpleString()}" for f in schema if type_class(f) == UNSUPPORTED]
    if bad:
        raise UnsupportedTypeError("no exchange form for " + ", ".join(bad))


def fixed_row_bytes(schema: T.StructType) -> int | None:
    """Bytes of every row when they are all equal, else None."""
    if any(type_class(f) == VARIABLE for f in schema):
        return None
    return sum(aligned(value_width(f)) if type_class(f) == FIXED else ALIGN for f in schema)


def row_bytes(schema: T.StructType) -> Column:
    """Bytes a row takes in a chunk, as BIGINT. A literal when no column varies,
    so that nothing but the grouping columns is read to total it."""
    constant = fixed_row_bytes(schema)
    if constant is not None:
        return F.lit(constant).cast("long")
    varying = [f for f in schema if type_class(f) == VARIABLE]
    steady = fixed_row_bytes(T.StructType([f for f in schema if type_class(f) != VARIABLE]))
    return reduce(lambda a, b: a + b, [column_bytes(f) for f in varying], F.lit(steady).cast("long"))
