"""Partition number of a row, computed the same way by any SQL engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from chunkspark.functions.codec import stamp_to_micros
from chunkspark.functions.types import quoted

# Fixed values of the key text: column separator and NULL mark.
SEPARATOR = "|"
NULL_TEXT = "\\N"


def key_text(field: T.StructField) -> Column:
    """Text of one key column. Values that compare equal give equal text."""
    column, kind = quoted(field.name), field.dataType
    if isinstance(kind, T.StringType):
        text = F.replace(column, F.lit("\\"), F.lit("\\\\"))
        text = F.replace(text, F.lit(SEPARATOR), F.lit("\\" + SEPARATOR))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        # Engines print doubles differently, but agree on those of six decimals; for any other, and past the
        # decimal range, a stable text of all its digits will do. Adding 0 turns -0.0 into 0.0, which equals it.
        number = column.cast("double") + F.lit(0.0)
        short = number.try_cast("decimal(38,6)")
        text = F.when(short.cast("double") == number, short.cast("string")).otherwise(number.cast("string"))
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = stamp_to_micros(field).cast("string")
    elif isinstance(kind, T.BinaryType):
        text = F.hex(column)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(NULL_TEXT))


def partition_number(fields: list[T.StructField], partitions: int) -> Column:
    """0 to ``partitions`` - 1 from the first 32 bits of the MD5 of the key text."""
    if partitions == 1:
        return F.lit(0).cast("long")
    text = F.concat_ws(SEPARATOR, *[key_text(f) for f in fields])
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"), F.lit(partitions).cast("long"))
