"""Spark session helpers: settings, shared scratch folder, input views."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def make_session(app: str = "chunkspark", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the library is tuned for; ``conf`` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Reading a bucketed table in place relies on the bucketed scan staying on.
        "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
        # Checkpoints of a result go away with the last reference to it.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach, for checkpoints and written intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local
    session without that setting falls back to a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            named = tempfile.mkdtemp(prefix="chunkspark-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Freeze ``df`` in the shared folder: same rows in the same tasks on every later read."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    for name in names:
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
