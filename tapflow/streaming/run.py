"""Starting, draining and stopping streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_file_sink(stream: DataFrame, path: str, checkpoint: str, *,
                    fmt: str = "parquet", output_mode: str = "append",
                    trigger: dict | None = None, partition_by: list[str] | None = None,
                    name: str | None = None) -> StreamingQuery:
    """Append a stream to files; the sink's commit log makes it exactly-once."""
    w = (stream.writeStream.format(fmt).outputMode(output_mode)
         .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None],
                        checkpoint: str, *, output_mode: str = "append",
                        trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    w = (stream.writeStream.foreachBatch(fn).outputMode(output_mode)
         .option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def drain(query: StreamingQuery, timeout_s: float | None = None) -> StreamingQuery:
    """Wait for an ``availableNow`` query to finish; re-raise its failure.
    A query that is still running after ``timeout_s`` is stopped and raises
    ``TimeoutError``: its output is not complete."""
    query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
    if query.isActive:
        query.stop()
        raise TimeoutError(f"streaming query still running after {timeout_s} s")
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"streaming query failed: {exc}")
    return query


def await_any_and_stop(spark, queries: list[StreamingQuery]) -> None:
    """Run until one query ends (or fails), then stop the others."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()
