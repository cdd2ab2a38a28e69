"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "larkspur", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are tuned for.

    ``conf`` keys use ``__`` for dots. The number of shuffle partitions is left to
    the caller: it depends on the data, and AQE coalesces whatever is too many.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    It is the one the cluster names in ``spark.checkpoint.dir``. A folder of our
    own is made only where that is unset and the master is local, because a
    machine-local folder would be invisible to other executors.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="larkspur-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh path below :func:`scratch_root`."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as a table in the scratch folder and read it back.

    Used where two passes must see identical partition contents. Unlike a cached
    frame, the table outlives lost executors and carries no lineage.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table of the scratch folder that nothing reads again."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def collect_garbage(spark: SparkSession) -> None:
    """Let Spark remove shuffles that nothing refers to now; else they stay until the driver runs short of memory."""
    spark.sparkContext._jvm.System.gc()
