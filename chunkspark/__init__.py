"""Partitioned extract and load on Spark."""

from chunkspark.functions.codec import decode_table, encode_table
from chunkspark.functions.types import binary_field, char_field, row_bytes, time_field, with_fields
from chunkspark.operators.checks import affinity_violations, compare_passes, order_violations
from chunkspark.operators.chunks import ChunkTooSmallError, chunk_index, pack_chunks
from chunkspark.operators.lookup import (
    get_chunks, get_chunks_by_keys, get_row_by_key, get_row_by_position, get_rows_by_keys, get_rows_by_position, next_keys,
    rows_by_key,
)
from chunkspark.operators.partition import PartitionSpec, add_partition_id, partition_result, sort_key
from chunkspark.operators.positions import with_row_pos
from chunkspark.operators.reports import node_report, partition_report, route_report, with_routes
from chunkspark.session import make_session, register_views
from chunkspark.sources.positional import export_positional, import_positional, map_positional
from chunkspark.sources.results import (
    choose_mode, drop_result, materialize_result, read_auto, read_in_place, read_owned, read_partition, read_partitions,
    run_query, snapshot_result,
)
from chunkspark.sources.schema import column_sizes, describe_schema, list_tables, table_row_counts
from chunkspark.sources.tables import (
    create_table, create_table_as, delete_where, drop_table, finish_change, insert_rows, load_mapped, load_table,
    update_where, with_row_key,
)
from chunkspark.sources.tsv import export_tsv, import_tsv
from chunkspark.streaming.streams import (
    Ledger, create_stream_table, read_delivered, read_ledger, read_stream, stream_chunks, stream_load, stream_load_table,
)
