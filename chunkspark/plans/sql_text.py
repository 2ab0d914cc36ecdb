"""SQL for checking: the operators' definitions in plain statements."""

from __future__ import annotations


def key_text(expression: str, kind: str = "other") -> str:
    """Key text of a column; see functions.hashing."""
    if kind == "text":
        expression = f"replace(replace({expression}, '\\', '\\\\'), '|', '\\|')"
    elif kind == "double":
        expression = f"CAST(CAST({expression} AS DECIMAL(38,6)) AS VARCHAR)"
    elif kind == "datetime":
        expression = f"CAST({micros(expression)} AS VARCHAR)"
    else:
        expression = f"CAST({expression} AS VARCHAR)"
    return f"coalesce({expression}, '\\N')"


def partition_number(texts: list[str], partitions: int) -> str:
    joined = " || '|' || ".join(texts)
    return f"(CAST('0x' || substr(md5({joined}), 1, 8) AS BIGINT) % {partitions})"


def micros(expression: str) -> str:
    return f"(epoch_us({expression}) + 315619200000000)"


def days(expression: str) -> str:
    return f"CAST(date_diff('day', DATE '1960-01-01', {expression}) AS INTEGER)"


def placed(table: str, columns: str, number: str, order: str, size: str = "0") -> str:
    """Body of a CTE: rows with partition_id, row_pos and row_bytes."""
    return (
        f"SELECT *, CAST(row_number() OVER (PARTITION BY partition_id ORDER BY {order}) - 1 AS BIGINT) AS row_pos "
        f"FROM (SELECT {columns}, {number} AS partition_id, CAST({size} AS BIGINT) AS row_bytes FROM {table})"
    )


def packed(source: str, limit: int) -> str:
    """CTEs ``placed``, ``walk`` and ``packed`` (rows with chunk_id), by walking rows one by one."""
    return f"""
WITH RECURSIVE placed AS MATERIALIZED ({source}),
walk AS (
  SELECT partition_id, row_pos, CAST(0 AS BIGINT) AS chunk_id, row_bytes AS used
  FROM placed WHERE row_pos = 0
  UNION ALL
  SELECT p.partition_id, p.row_pos,
         CASE WHEN w.used + p.row_bytes > {limit} THEN w.chunk_id + 1 ELSE w.chunk_id END,
         CASE WHEN w.used + p.row_bytes > {limit} THEN p.row_bytes ELSE w.used + p.row_bytes END
  FROM walk w JOIN placed p ON p.partition_id = w.partition_id AND p.row_pos = w.row_pos + 1),
packed AS MATERIALIZED (
  SELECT p.*, w.chunk_id FROM placed p JOIN walk w ON w.partition_id = p.partition_id AND w.row_pos = p.row_pos)
"""


INDEX = (
    "SELECT partition_id, chunk_id, CAST(count(*) AS BIGINT) AS row_count, CAST(sum(row_bytes) AS BIGINT) AS used_bytes, "
    "CAST(min(row_pos) AS BIGINT) AS first_row_pos FROM packed GROUP BY partition_id, chunk_id"
)
