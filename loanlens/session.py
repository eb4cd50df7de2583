"""Session set-up and the shared scratch folder.

The cluster decides sizes (executors, shuffle partitions, checkpoint folder); the
settings here are only the ones the results or the skew handling depend on.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Day differences and instants are defined on UTC wall-clock time, so the zone is part
# of the result.  The adaptive settings let a join split one oversized key.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Narrow rows compress well in a shuffle: the usual 64 MB of keys are millions of rows a
    # task, which take a GB and more once they are sorted and grouped.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A join that few keys survive sends a filter of the keys to the other side's scan.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # A projection over all raw columns can outgrow what HotSpot compiles; beyond this
    # size Spark splits the work into small methods instead of one interpreted one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A task that writes a few partitions keeps their files open instead of sorting its
    # rows by partition first; with more partitions it falls back to the sort.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "loanlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; cluster settings stay with the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """The folder that the session names for data all machines must see.

    That is ``spark.checkpoint.dir``.  Where it is unset the warehouse stands in, on one machine
    or if it is in a store that all machines share: a local folder on a cluster would be another
    one on every machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        store = root.partition(":")[0] if ":" in root else spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file").partition(":")[0]
        if store == "file" and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share; {root} is local")
    return f"{root.rstrip('/')}/loanlens"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the session's shared folder; what is written there goes when the application ends."""
    holder = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    files, folder = _store_of(spark, holder)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{holder}/data"


def _store_of(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _store_of(spark, path)
    return files.exists(folder)


def remove(spark: SparkSession, path: str, chosen: Callable[[str], bool]) -> None:
    """Remove those folders directly below ``path`` whose name is chosen; no path, nothing to remove."""
    files, folder = _store_of(spark, path)
    for found in files.listStatus(folder) if files.exists(folder) else ():
        if found.isDirectory() and chosen(found.getPath().getName()):
            files.delete(found.getPath(), True)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For a frame several later jobs read: the written table survives the loss of an
    executor and cuts the lineage, which a cache does not.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
