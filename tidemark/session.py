"""Session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import tidemark

# Functions that run inside Python workers travel with the task, so executors need no installed copy.
cloudpickle.register_pickle_by_value(tidemark)

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, AQE and skew handling on; everything cluster-sized stays with the cluster.

    On a cluster, streaming state lives in RocksDB, off the heap: the keys of a long watermark do not fit an executor.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    )
    if master:
        builder = builder.master(master)
    if not (master or "").startswith("local"):
        builder = builder.config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """An unused path below the work folder; two runs never share one."""
    return f"{work_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def list_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder of any file system Spark knows; none if it does not exist."""
    files, place = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(place)] if files.exists(place) else []


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of the library's own making."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing, and values that depend on the physical
    layout (partition numbers, row positions) stay the same for every later reader.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
