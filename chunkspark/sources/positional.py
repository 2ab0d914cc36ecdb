"""Records with fields named by position, holding exchange values."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, types as T

from chunkspark.functions.codec import decoded_value, encode_table
from chunkspark.functions.types import (
    DATE, DATETIME, DOUBLE, FIXED, INT32, INT64, TIME, VARIABLE, check_supported, quoted, type_class,
)

AVRO_CLASS = "org.apache.spark.sql.avro.AvroFileFormat"

# Record name and the record type of each class.
RECORD_NAME = "schema_name"
RECORD_TYPES = {
    INT64: "long", DATETIME: "long", TIME: "long",
    INT32: "int", DATE: "int",
    DOUBLE: "double",
    VARIABLE: "bytes", FIXED: "bytes",
}
_SPARK_TYPES = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "bytes": T.BinaryType()}


def field_name(position: int) -> str:
    return f"col_{position}"


def record_schema(schema: T.StructType) -> str:
    """Avro schema of the records, as JSON."""
    check_supported(schema)
    fields = [{"name": field_name(i), "type": RECORD_TYPES[type_class(f)]} for i, f in enumerate(schema)]
    return json.dumps({"type": "record", "name": RECORD_NAME, "fields": fields})


def _file_schema(schema: T.StructType) -> T.StructType:
    check_supported(schema)
    return T.StructType([
        T.StructField(field_name(i), _SPARK_TYPES[RECORD_TYPES[type_class(f)]]) for i, f in enumerate(schema)
    ])


def avro_format(spark: SparkSession) -> str | None:
    """Name of the Avro source: the short one where its module is deployed, else
    the format class that ships with Spark SQL itself."""
    java = spark.sparkContext._jvm
    try:
        conf = spark._jsparkSession.sessionState().conf()
        java.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource("avro", conf)
        return "avro"
    except Exception:
        pass
    try:
        java.java.lang.Thread.currentThread().getContextClassLoader().loadClass(AVRO_CLASS)
        return AVRO_CLASS
    except Exception:
        return None


def _format(spark: SparkSession, fmt: str | None) -> str:
    """Avro where there is any, else the same fields in Parquet."""
    return fmt or avro_format(spark) or "parquet"


def _with_record_schema(reader_or_writer, fmt: str, schema: T.StructType):
    return reader_or_writer if fmt == "parquet" else reader_or_writer.option("avroSchema", record_schema(schema))


def export_positional(df: DataFrame, path: str, fmt: str | None = None, mode: str = "errorifexists") -> None:
    fmt = _format(df.sparkSession, fmt)
    records = encode_table(df).toDF(*[field_name(i) for i in range(len(df.columns))])
    _with_record_schema(records.write.mode(mode).format(fmt), fmt, df.schema).save(path)


def import_positional(spark: SparkSession, path: str, schema: T.StructType, fmt: str | None = None) -> DataFrame:
    """Records of a file set, still positional; see load_mapped and map_positional."""
    fmt = _format(spark, fmt)
    reader = spark.read.schema(_file_schema(schema)).format(fmt)
    return _with_record_schema(reader, fmt, schema).load(path)


def map_positional(records: DataFrame, schema: T.StructType, treat_zero_len_as_null: bool = True) -> DataFrame:
    """Table values of positional records: markers to NULL, offsets to dates and times."""
    check_supported(schema)
    return records.select(*[
        decoded_value(f, quoted(field_name(i)), treat_zero_len_as_null).alias(f.name, metadata=f.metadata)
        for i, f in enumerate(schema)
    ])
