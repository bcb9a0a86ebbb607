"""Session helper and shared-storage lookup."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import RDD, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def local_session(app: str = "lendspark", cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench.  On a cluster the submitter owns the configuration."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # the JIT skips methods above 8,000 bytes of bytecode: split wide projections instead of interpreting them
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def split_wide_projections(spark: SparkSession) -> None:
    """Split generated methods that the JIT would skip, unless the session has its own limit: dozens of derived inputs a row run interpreted otherwise."""
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", None) is None:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that their Python finds it from any working directory."""
    context = spark.sparkContext
    if any(os.path.basename(f) == "lendspark.zip" for f in context.listFiles):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="lendspark-zip-"), "lendspark.zip")  # only the driver reads it: it serves the file
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(target)


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``; only where that is unset (local tests) a temporary folder is used.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.removeprefix("file:")
    folder = tempfile.mkdtemp(prefix="lendspark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """A new folder in the shared one.  Each application's folders lie in one that is deleted when it ends."""
    folder = f"{shared_dir(spark)}/lendspark-{spark.sparkContext.applicationId}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return f"{folder}/{uuid.uuid4().hex}"


def materialize(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    For frames that several fits read: computed once, columnar, pruned per reader, and a lost executor re-reads files
    instead of recomputing the plan behind them.  ``group_rows``: rows of a row group, for rows of megabytes.  Readers take up to 4,096 rows of a row
    group at once, as one array a column.
    """
    path = run_folder(df.sparkSession)
    (df.write.option("parquet.block.row.count.limit", str(group_rows)) if group_rows else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(*fits: Callable[[], T]) -> list[T]:
    """Results of independent fits, each from a driver thread of its own: jobs of one fill the cores that those of another leave idle."""
    spark = SparkSession.getActiveSession()
    carried = inheritable_thread_target(spark) if spark else inheritable_thread_target
    with ThreadPoolExecutor(max(len(fits), 1)) as pool:
        return [f.result() for f in [pool.submit(carried(fit)) for fit in fits]]


def checkpointed(rdd: RDD, spark: SparkSession) -> None:
    """Write a persisted RDD to the shared folder now, so that it no longer depends on those it is made of."""
    shared_dir(spark)  # names a checkpoint folder in sessions without one
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(run_folder(spark))
    rdd.checkpoint()
    rdd.count()


def delete_files(spark: SparkSession, path: str | None) -> None:
    """Remove a folder that this session has written, if any."""
    if path:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
