"""Session builder for tests, the benchmark and the pipeline job.

Operators never call this: they work on whatever session their input
DataFrames belong to.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "tarnwork",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session in UTC with AQE on.

    ``master`` and ``shuffle_partitions`` stay unset on a cluster, where
    ``spark-submit`` and AQE decide.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
