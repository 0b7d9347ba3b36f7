"""Shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Spark's own removal of an execution's shuffle files as it ends; a plan takes the setting as it is made.
FREES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing = threading.Lock()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, whose executors are threads of the driver, may fall
    back to a folder of the machine.
    """
    context = spark.sparkContext
    folder = context.getConf().get(SETTING) or spark.conf.get(SETTING, None)
    if folder:
        return folder
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="evenframe-"))
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, stem: str) -> str:
    """A path in the shared folder that nobody else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{stem}-{uuid.uuid4().hex}"


def durable(df: DataFrame, free: bool = False) -> DataFrame:
    """Materialise ``df`` so that lost executors cannot change its rows.

    ``free`` removes the shuffle files that this took as soon as the rows are
    stored. Otherwise they stay until the driver happens to collect its garbage.
    """
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return (_freed(df) if free else df).checkpoint(eager=True)


def _freed(df: DataFrame) -> DataFrame:
    """The same rows by a plan of its own, whose shuffle files go when it has run."""
    conf = df.sparkSession.conf
    with _freeing:
        before = conf.get(FREES, None)
        conf.set(FREES, "true")
        try:
            return df.select("*")
        finally:
            if before is None:
                conf.unset(FREES)
            else:
                conf.set(FREES, before)
