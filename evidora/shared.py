"""The folder that the driver and all executors share, for state between jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir`` of the session.

    Where that is unset a local session (one process, as in tests) gets a folder of its own. A cluster has no such
    folder that all machines see, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="evidora-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def written(frame: DataFrame) -> DataFrame:
    """``frame`` written once to the shared folder and read back from there, which cuts its lineage."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder(frame.sparkSession))
    return frame.checkpoint(eager=True)


def stored(frame: DataFrame) -> DataFrame:
    """``frame`` as a table written to the shared folder, with the size that it has there.

    For loops: a checkpoint keeps the size that was estimated for its plan, and estimates of joins multiply from round to round.
    """
    path = f"{folder(frame.sparkSession)}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
