"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "shelfwise") -> SparkSession:
    """Session for tests and the bench; on a cluster the job's own session is used as it is.

    ``hugeMethodLimit`` 8000 keeps generated methods small enough for the JVM to compile them.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.files.minPartitionNum", cores)
        .config("spark.sql.files.openCostInBytes", "65536")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``; one of our own only where it is unset."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shelfwise-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    The rows survive the loss of any executor, later readers see exactly these rows, and each of them reads only
    the columns it needs.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
