"""Session defaults and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rillflow", **conf: str) -> SparkSession:
    """Session with the adaptive settings the plans count on; the cluster sets the rest."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # sum up each task's part of a busy session before the shuffle
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def in_one_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where it is unset.

    Only in one process: on a cluster every executor would write to a disk of its own.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named is None:
        if not in_one_process(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="rillflow-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and go on from there.

    This cuts the lineage, survives the loss of executors, and later readers prune columns.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, "pinned")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._pinned = path
    return out


def unpin(*tables: DataFrame) -> None:
    """Deletes tables that ``pin`` wrote and nothing reads any more, as a loop needs it.

    Shuffle files of the plans that are gone follow once the JVM has collected its garbage.
    """
    for df in tables:
        remove(df.sparkSession, df._pinned)
        df.sparkSession._jvm.System.gc()


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder in any file system that Spark can write to; none there is fine."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def reducers(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def together(*jobs: Callable[[], object]) -> list:
    """Submit independent Spark jobs at once, so that one fills the executors another leaves idle."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inherit(job)) for job in jobs]
        return [job.result() for job in running]
