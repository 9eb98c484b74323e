"""Calls to an outside service, a bounded number at a time per task."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def call_external(
    df: DataFrame,
    fn: Callable[[dict[str, Any], float], int],
    payload_cols: Sequence[str],
    max_in_flight: int = 10,
    timeout_s: float = 1.0,
    rows_per_task: int | None = None,
    success_status: int = 201,
) -> DataFrame:
    """Call ``fn(payload, timeout_s)`` once per row and add ``status`` and ``outcome``.

    ``fn`` returns a status number. Every row gets exactly one outcome:
    ``success`` for ``success_status``, ``error`` for any other status, and
    ``timeout`` (status NULL) when ``fn`` raises a timeout or another ``OSError``,
    as network clients do. Any other exception is a mistake in ``fn`` and fails the
    job. ``fn`` has to honour the timeout itself.

    Each task keeps at most ``max_in_flight`` calls open, so the service sees at
    most that many times the number of running tasks. The next batch of rows is handed
    in before the last one is finished, so no slot waits for the slowest call. The
    input's partitions are kept; ``rows_per_task`` counts the rows and deals them out
    anew, for inputs with too few partitions. Calls are at-least-once: a task that runs again, and
    every further action on an unsaved result, calls again. Write the result once
    (``tarnwork.scratch.materialize``) before using it twice.
    """
    if max_in_flight < 1:
        raise ValueError("max_in_flight must be positive")
    names = list(payload_cols)
    taken = sorted({"status", "outcome"} & set(df.columns))
    if taken:
        raise ValueError(f"columns already present: {taken}")
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("status", T.IntegerType()),
            T.StructField("outcome", T.StringType()),
        ]
    )
    rows = df.repartition(max(1, -(-df.count() // rows_per_task))) if rows_per_task else df

    def call_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from concurrent.futures import ThreadPoolExecutor

        def call(payload: dict[str, Any]) -> tuple[int | None, str]:
            try:
                status = int(fn(payload, timeout_s))
            except OSError:  # TimeoutError is one
                return None, "timeout"
            return status, "success" if status == success_status else "error"

        def finished(batch: pa.RecordBatch, calls: list) -> pa.RecordBatch:
            results = [c.result() for c in calls]
            statuses = pa.array([status for status, _ in results], pa.int32())
            outcomes = pa.array([outcome for _, outcome in results], pa.string())
            return batch.append_column("status", statuses).append_column("outcome", outcomes)

        with ThreadPoolExecutor(max_in_flight) as pool:
            open_batches: deque = deque()
            for batch in batches:
                payloads = batch.select(names).to_pylist()
                open_batches.append((batch, [pool.submit(call, p) for p in payloads]))
                if len(open_batches) > 1:
                    yield finished(*open_batches.popleft())
            while open_batches:
                yield finished(*open_batches.popleft())

    return rows.mapInArrow(call_batches, schema)
