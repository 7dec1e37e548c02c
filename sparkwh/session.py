"""Session settings and the shared scratch area."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.cbo.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_bases: dict[str, str] = {}


# Shuffled bytes a task should get, so that it sorts in memory.
TASK_BYTES = 128 * 1024 * 1024


def builder(app_name: str = "sparkwh", data_bytes: int | None = None, **extra: str) -> SparkSession.Builder:
    """A session builder with the settings the library is written for.

    ``data_bytes``, the size of the largest input, sets the number of shuffle partitions; adaptive execution merges
    those that turn out small.
    """
    out = SparkSession.builder.appName(app_name)
    sized = {} if data_bytes is None else {
        "spark.sql.shuffle.partitions": str(max(200, data_bytes // TASK_BYTES))}
    for key, value in {**SETTINGS, **sized, **extra}.items():
        out = out.config(key, value)
    return out


def app_id(spark: SparkSession) -> str:
    return spark.conf.get("spark.app.id")


def shared_base(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors are one process, may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    key = app_id(spark)
    if key not in _local_bases:
        _local_bases[key] = tempfile.mkdtemp(prefix="sparkwh-")
    return _local_bases[key]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_base(spark)}/{app_id(spark)}/{name}-{uuid.uuid4().hex}"


def new_name(prefix: str) -> str:
    """A catalog name that nothing has used before."""
    return f"{prefix}_{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at files that outlive any executor, and fixes values such as partition numbers that a
    second evaluation could assign differently.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _file_system(spark, path)
    return system.exists(place)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The folders right below ``path``, by name; none if there is no such folder."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return []
    return sorted(f.getPath().toString() for f in system.listStatus(place) if f.isDirectory())


def make_folder(spark: SparkSession, path: str) -> str:
    system, place = _file_system(spark, path)
    system.mkdirs(place)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    system, place = _file_system(spark, path)
    system.delete(place, True)


# Sizes from here on stand for "unknown" in the optimizer's statistics.
_UNKNOWN = 1 << 60


def planned_bytes(df: DataFrame) -> int | None:
    """Bytes of the files and local rows that ``df`` reads, by the optimizer's statistics; None if a part is unknown. Nothing
    is run."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return sum(sizes) if all(x < _UNKNOWN for x in sizes) else None
