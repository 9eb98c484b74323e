"""Keyed state of a stream: the newest row of each key, kept in a versioned table.

Each micro-batch becomes one version. A version carries the number of its batch, so a
batch that is replayed after a failure, or a stream that is started again, changes
nothing twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tarnwork.operators.joins import as_list
from tarnwork.operators.keyed import dedup_latest
from tarnwork.sources.versioned import add_version, latest_batch, read_version, versions


def apply_batch(
    batch: DataFrame, number: int, path: str, keys: str | Sequence[str], order: str | Sequence[str]
) -> bool:
    """Merge one micro-batch into the state at ``path``; False if it was merged before.

    Of a key's rows the newest by ``order`` is kept, whichever batch brought it, so a row
    that comes late never replaces a newer one. Rows with a NULL key are one key.
    """
    spark = batch.sparkSession
    done = latest_batch(spark, path)
    if done is not None and number <= done:
        return False
    rows = batch
    if versions(spark, path):
        rows = read_version(spark, path).unionByName(batch)
    add_version(dedup_latest(rows, keys, order), path, batch=number)
    return True


def keep_latest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: str | Sequence[str],
    order: str | Sequence[str],
) -> None:
    """Process what is there and stop; the state is ``read_version(spark, path)`` then."""
    key_columns, order_columns = as_list(keys), as_list(order)

    def merge(batch: DataFrame, number: int) -> None:
        apply_batch(batch, number, path, key_columns, order_columns)

    query = (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
