"""Tab-separated files: ``"`` quotes, ``\\`` escapes, unquoted ``\\N`` for NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from chunkspark.functions.codec import (
    datetime_to_micros, micros_to_datetime, micros_to_stamp, micros_to_time_text, stamp_to_micros, time_text_to_micros, unpad_fixed,
)
from chunkspark.functions.types import (
    DATETIME, DOUBLE, FIXED, TIME, VARIABLE, check_supported, quoted, type_class, value_width,
)
from chunkspark.sources.tsv_records import read_values

# Fixed values of the file format.
TAB, NULL_MARK = "\t", "\\N"


def _quoted_text(raw: Column) -> Column:
    """Quoted and escaped value; its quotes tell text that reads ``\\N`` from NULL."""
    text = F.replace(F.replace(raw.cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    return F.concat(F.lit('"'), text, F.lit('"'))


def _datetime_text(column: Column) -> Column:
    """Seconds, and six digits after them only where there are microseconds."""
    text = column.cast("string")
    return F.when(F.instr(text, ".") > 0, F.rpad(text, 26, "0")).otherwise(text)


def tsv_value(field: T.StructField) -> Column:
    """Text of a column value; NULL, NaN and empty values give the NULL mark."""
    column, kind = quoted(field.name), type_class(field)
    if kind == VARIABLE:
        text = F.when(F.octet_length(column) > 0, _quoted_text(column))
    elif kind == FIXED:
        width = value_width(field)
        is_text = isinstance(field.dataType, T.StringType)
        raw = column.cast("binary")
        padded = F.substring(F.concat(raw, F.lit(b" " * width if is_text else bytes(width))), 1, width)
        too_long = F.raise_error(F.lit(f"value longer than {width} bytes")).cast("binary")
        value = F.when(F.octet_length(raw) > width, too_long).otherwise(padded)
        text = F.when(unpad_fixed(value, width, is_text).isNotNull(), _quoted_text(value))
    elif kind == DOUBLE:
        # The shortest text that reads back as the same number.
        text = F.when(~F.isnan(column), column.cast("string"))
    elif kind == TIME:
        text = micros_to_time_text(column)
    elif kind == DATETIME:
        # An instant is written as UTC's clocks show it.
        text = _datetime_text(micros_to_datetime(stamp_to_micros(field)) if isinstance(field.dataType, T.TimestampType) else column)
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(NULL_MARK))


def export_tsv(df: DataFrame, path: str, rows_per_file: int = 1_000_000, mode: str = "errorifexists") -> None:
    """Write one record per row, ``rows_per_file`` at most to a file."""
    check_supported(df.schema)
    line = F.concat_ws(TAB, *[tsv_value(f) for f in df.schema])
    df.select(line.alias("value")).write.mode(mode).option("maxRecordsPerFile", rows_per_file).text(path)


def _loaded_value(field: T.StructField, raw: Column) -> Column:
    """Value of a field's bytes; bytes that are no value of its type are an error."""
    kind, text = type_class(field), raw.cast("string")
    if kind == VARIABLE:
        return raw.cast(field.dataType)
    if kind == FIXED:
        return unpad_fixed(raw, value_width(field), isinstance(field.dataType, T.StringType)).cast(field.dataType)
    if kind == TIME:
        value = time_text_to_micros(text)
    elif isinstance(field.dataType, T.TimestampType):
        value = micros_to_stamp(datetime_to_micros(text.try_cast("timestamp_ntz")), field.dataType)
    else:
        value = text.try_cast(field.dataType)
    error = F.raise_error(F.concat(F.lit(f"no {field.dataType.simpleString()} for column {field.name}: "), text)).cast(field.dataType)
    return F.coalesce(value, F.when(raw.isNotNull(), error))


def import_tsv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    """Rows of TSV files. A file is read by as many tasks as it has blocks, also where values hold newlines;
    ``multi_line=False`` says that none does, which saves a reading."""
    check_supported(schema)
    values = read_values(spark, path, len(schema.fields), multi_line)
    return values.select(*[_loaded_value(f, F.col(f"c{i}")).alias(f.name, metadata=f.metadata) for i, f in enumerate(schema)])
