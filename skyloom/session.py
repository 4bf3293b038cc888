"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "skyloom", **conf: str) -> SparkSession:
    """A session with the settings the operators rely on.

    UTC keeps naive timestamps stable; adaptive execution sizes shuffle
    partitions and splits skewed join partitions at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # the JVM compiles no method over 8000 bytes; a wider stage is better split
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.ui.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there the
    driver and the executors are one process.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="skyloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """The folder of this application below the shared one."""
    return f"{shared_dir(spark)}/skyloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder of this application."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df):
    """``df`` materialised once in reliable storage, so a lost executor cannot
    change rows whose position was already used."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
