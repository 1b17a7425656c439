"""Session settings and the one place that cuts lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "areascore", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans rely on; anything in ``conf`` wins."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Checkpoint files go when the frame that wrote them is no longer used.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; where none is named, one below the warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context.setCheckpointDir(shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it from there.

    For a small or already reduced frame that several branches read, and for a frame
    that is about to overwrite files it was read from.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """Path of a new folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as columns to the shared folder and read it from there; for a frame as large as its input whose
    readers take some of its columns each."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
