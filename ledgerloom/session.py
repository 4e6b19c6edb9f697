"""Session settings and reliable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the library relies on.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset so that the
    submit-time configuration wins; adaptive execution then sizes the shuffles.
    """
    builder = (
        SparkSession.builder.appName("ledgerloom")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder all executors can reach.

    It is the session's ``spark.checkpoint.dir``. Only a local session without
    that setting gets a folder of its own; a cluster must name one, because a
    machine-local folder would not survive a lost executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="ledgerloom-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table.

    Like a checkpoint this cuts the lineage and survives lost executors. As
    Parquet it also lets later passes read only the columns they need, and the
    planner see the true size.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written_tables(spark: SparkSession) -> int:
    """Delete the tables ``checkpointed`` wrote for this application and say how many there were.

    Frames that read them, results of the operators included, cannot be used
    afterwards: call it when the results have been written.
    """
    paths = spark._jvm.org.apache.hadoop.fs.Path
    pattern = paths(f"{shared_folder(spark)}/table-*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    found = list(files.globStatus(pattern))
    for status in found:
        files.delete(status.getPath(), True)
    return len(found)
