"""Shared scratch space for intermediate tables.

Tables that cut a lineage, or that two later steps read, are written as parquet
under the folder the cluster names in ``spark.checkpoint.dir``. Unlike cached
blocks they outlive the executors that wrote them, and unlike a checkpointed
RDD they keep column pruning and size statistics.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders this process has written and not yet dropped.
_written: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share.

    ``spark.checkpoint.dir``, or else the folder given to ``setCheckpointDir``.
    Only a local master may do without either: it then gets a temporary folder,
    which on a cluster each executor would see differently.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return tempfile.mkdtemp(prefix="tarnwork-")
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared scratch folder."""
    path = f"{scratch_root(spark)}/tarnwork/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once and return a DataFrame that reads it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """How many scratch folders there are: a mark for :func:`drop_scratch`."""
    return len(_written)


def drop_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the scratch folders this process has written; how many there were.

    Call it once the results that read them are stored elsewhere. ``since`` spares those
    written before that mark (:func:`written`), ``keep`` the last so many. With a mark it
    is for steps that run one after the other, not for several threads.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    last = len(_written) - keep
    gone = _written[since:last]
    del _written[since:last]
    dropped = 0
    for folder in gone:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        dropped += bool(path.getFileSystem(conf).delete(path, True))
    return dropped
