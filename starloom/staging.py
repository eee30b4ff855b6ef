"""Tables written once to the cluster's shared folder and read back.

A written table cuts lineage, survives lost executors, and gives Catalyst its true file size,
so that its own broadcast threshold decides whether a join side is small enough.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only for a local master."""
    path = spark.conf.get(_SETTING, None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="starloom-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{_own_dir(spark)}/{uuid.uuid4().hex}/{name}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/starloom/{spark.sparkContext.applicationId}"


def clear(spark: SparkSession) -> None:
    """Remove what this application has staged. Call it when no table read from there is used
    any more, at the end of a run."""
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under a fresh path and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
