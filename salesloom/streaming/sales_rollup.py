"""Sales per tumbling window as a stream: late rows within bounds count, repeated ones count once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesloom.sources import snapshots


def windowed_totals(
    sales: DataFrame,
    time: str,
    key: str,
    by: Sequence[str],
    totals: Sequence[str],
    width: str,
    lateness: str,
) -> DataFrame:
    """Sums of ``totals`` and the number of sales per window of ``width`` and ``by``.

    Rows up to ``lateness`` older than the newest one count, as does the first
    of rows that share ``key`` within that time.  State is kept for that long
    only: ids and open windows, not the history.  On a batch frame the same
    rows come out, without a bound on lateness.
    """
    marked = sales.withWatermark(time, lateness)
    once = marked.dropDuplicatesWithinWatermark([key]) if sales.isStreaming else marked.dropDuplicates([key])
    grouped = once.groupBy(F.window(time, width), *by).agg(
        F.count("*").alias("sales"), *[F.sum(total).alias(total) for total in totals]
    )
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by, "sales", *totals
    )


def append_once(path: str, stream: str):
    """A batch function that appends to the snapshot table at ``path`` unless the batch is there already."""

    def append(batch: DataFrame, batch_id: int) -> None:
        current = snapshots.opened(batch.sparkSession, path)
        batches = dict(current.stamps.get("batches", {})) if current else {}
        if batch_id > batches.get(stream, -1):
            snapshots.append(batch, path, {"batches": {**batches, stream: batch_id}})

    return append


def roll_up(totals: DataFrame, path: str, checkpoint: str, stream: str = "rollup") -> StreamingQuery:
    """Start a query that adds each window to the table at ``path`` once it is closed, then stops."""
    return (
        totals.writeStream.outputMode("append")
        .foreachBatch(append_once(path, stream))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query left out as too late, over the steps Spark remembers."""
    return sum(
        operator["numRowsDroppedByWatermark"] for step in query.recentProgress for operator in step["stateOperators"]
    )
