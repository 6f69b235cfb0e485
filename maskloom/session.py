"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "maskloom",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the operators are designed for.

    Adaptive execution stays on: it sizes join sides at run time, coalesces small shuffle partitions
    and splits skewed join partitions.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # recording the call site of every column expression costs more than planning it
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    already_set = spark.sparkContext.getCheckpointDir()
    if already_set:
        return already_set
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="maskloom-")
        spark.sparkContext.setCheckpointDir(folder)
        return spark.sparkContext.getCheckpointDir() or folder
    raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can read")


#: Sub-folder of this process's intermediate tables.
RUN = f"maskloom-{uuid.uuid4().hex}"


def drop_intermediate(spark: SparkSession) -> bool:
    """Delete all intermediate tables of this process; results that still read them become unusable.

    To be called when everything of a run has been written. True if there was something to delete.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/{RUN}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and return a scan of it.

    Later readers get column pruning, exact sizes for join planning, and rows that survive the loss
    of any executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{RUN}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
