"""Session settings, and the shared folder for data that must outlive its executors."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The built-in broadcast choice stays on, so a join side is broadcast only when it is small.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
}

# For streams with more open windows than the executors' heap holds: build(app, **LARGE_STATE).
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build(app: str, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or a local one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _local_dir(spark.sparkContext.applicationId)
    return folder.rstrip("/")


@cache
def _local_dir(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"touchline-{application}-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, in a folder of this application that goes when it ends."""
    home = f"{shared_dir(spark)}/touchline/{spark.sparkContext.applicationId}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(home)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{home}/{name}-{uuid.uuid4().hex}"


# Where each pinned copy lies.
_PLACES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once; later uses read that copy, also after a lost executor.

    It is Parquet, so a use that needs two columns reads two, and joins know its true size.
    """
    path = scratch(df.sparkSession, "pinned")
    df.write.parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    _PLACES[copy] = path
    return copy


def unpin(copy: DataFrame) -> None:
    """Drop what ``pin`` returned before the application ends; nothing may read it any more."""
    path = copy.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(_PLACES.pop(copy))
    path.getFileSystem(copy.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
