"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings that hold on any cluster; sizes are left to the deployment and to adaptive execution.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "kandela", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.lru_cache(maxsize=None)
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="kandela-")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting a cluster session is refused. Only a local-mode session, where driver and executors are one
    process, gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder(context.applicationId)


_SCOPES: list[str] = []  # of the whole process: streams and parallel fits write from threads of their own


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[str]:
    """Owns the intermediate tables made inside it and deletes them at its end.

    Frames built inside read those tables, so they must be consumed before the scope ends.
    """
    folder = f"{shared_folder(spark)}/kandela/scope-{uuid.uuid4().hex}"
    _SCOPES.append(folder)
    try:
        yield folder
    finally:
        _SCOPES.remove(folder)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder, inside the innermost scope if there is one."""
    folder = _SCOPES[-1] if _SCOPES else f"{shared_folder(spark)}/kandela"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several branches of a plan would otherwise each rescan the raw input. Unlike a
    cached frame, the files outlive any executor, are column-pruned, and carry an exact size, so
    Spark's own broadcast threshold decides on real numbers.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)
