"""Session settings and the two ways this library cuts lineage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs the next operator its partitioning.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "icelens", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Where this run writes, below the shared folder; ``clear`` removes it.
RUN = f"icelens-{uuid.uuid4().hex}"
_chosen: dict[str, str] = {}
_scopes: list[str] = []


def use_folder(path: str) -> None:
    """Set the shared folder for sessions that do not name one in ``spark.checkpoint.dir``."""
    _chosen["folder"] = path


def shared_folder(spark: SparkSession) -> str:
    """This run's folder below ``spark.checkpoint.dir``, which every executor sees, or below the one of ``use_folder``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _chosen.get("folder")
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "/".join([folder.rstrip("/"), RUN, *_scopes])


@contextmanager
def scope(name: str):
    """Within it, the shared folder is the folder ``name`` of the run."""
    _scopes.append(name)
    try:
        yield
    finally:
        _scopes.remove(name)


def clear(spark: SparkSession) -> None:
    """Remove what this run has settled, within a scope only what was settled there. Frames that were read from it can no longer be used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


#: Spark removes the shuffle files of a query that ends with this setting; by itself it keeps them until the driver
#: collects garbage, and a chain of settled tables fills the disks.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet; the shuffle files that this took are removed when it is done."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several consumers would otherwise recompute the same wide plan; the
    copy survives the loss of executors and keeps column pruning for its readers.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    write(df, path)
    return spark.read.schema(df.schema).parquet(path)
