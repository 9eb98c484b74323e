"""What a registered query is: a function of the driver tables, with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tarnwork.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """The driver tables as lazily read DataFrames."""

    spark: SparkSession
    path: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)


def query(oracle: str, name: str | None = None):
    """Register a function of the tables, by default under its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, path: build(Tables(spark, path))
        ORACLES[key] = oracle
        return build

    return register
