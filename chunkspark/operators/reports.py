"""How partitions, workers and consumers are loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from chunkspark.operators.partition import PARTITION_ID, accounted_bytes


def partition_report(df: DataFrame) -> DataFrame:
    """Rows and bytes per partition; as many rows as there are partitions in use."""
    return df.groupBy(PARTITION_ID).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(accounted_bytes(df.drop(PARTITION_ID))).alias("bytes"),
    )


def worker_id(workers: int) -> Column:
    _positive(workers=workers)
    return F.pmod(F.col(PARTITION_ID), F.lit(workers).cast("long"))


def consumer_id(workers: int, consumers: int) -> Column:
    """Consumers of a worker take its partitions in turn."""
    _positive(workers=workers, consumers=consumers)
    turn = F.call_function("div", F.col(PARTITION_ID), F.lit(workers).cast("long"))
    return F.pmod(turn, F.lit(consumers).cast("long"))


def node_id(nodes: int) -> Column:
    _positive(nodes=nodes)
    return F.pmod(F.col(PARTITION_ID), F.lit(nodes).cast("long"))


def with_routes(df: DataFrame, workers: int, consumers: int, nodes: int = 1) -> DataFrame:
    """Owner columns of every row's partition."""
    return df.withColumns({
        "worker_id": worker_id(workers),
        "consumer_id": consumer_id(workers, consumers),
        "node_id": node_id(nodes),
    })


def route_report(df: DataFrame, workers: int, consumers: int) -> DataFrame:
    """Partitions, rows and bytes of every owner."""
    owned = with_routes(partition_report(df), workers, consumers)
    return owned.groupBy("worker_id", "consumer_id").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("row_count").alias("row_count"),
        F.sum("bytes").alias("bytes"),
    )


def node_report(df: DataFrame, nodes: int) -> DataFrame:
    """Partitions, rows and bytes read through every node."""
    return partition_report(df).groupBy(node_id(nodes).alias("node_id")).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("row_count").alias("row_count"),
        F.sum("bytes").alias("bytes"),
    )


def _positive(**values: int) -> None:
    for name, value in values.items():
        if value <= 0:
            raise ValueError(f"{name} must be positive")
