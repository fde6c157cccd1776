"""Streaming sink: one write per micro-batch, safe to repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def start_append(
    df: DataFrame,
    name: str,
    checkpoint: str,
    root: str | None = None,
    fmt: str = "parquet",
    available_now: bool = False,
    interval: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Append a stream to the collection ``name``, one ``foreachBatch`` write per micro-batch.

    After a failure Spark runs the last micro-batch again under the same number. Below a ``root``
    each batch owns the folder ``root/name/batch_id=<n>`` and overwrites it, so a repeat changes
    nothing. Without a ``root`` the connector ``fmt`` appends and gets the number as its option
    ``batch_id``; a repeat is the connector's to handle by it. Offsets and window state live in ``checkpoint/name``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Small batches end in few files, however many partitions the state has.
        batch = batch.hint("rebalance")
        if root is not None:
            writer = batch.write.format(fmt).mode("overwrite").options(**options)
            writer.save(f"{root}/{name}/batch_id={batch_id}")
        else:
            writer = batch.write.format(fmt).mode("append")
            writer.options(**{"collection": name, "batch_id": str(batch_id), **options}).save()

    query = (
        df.writeStream.queryName(name)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoint}/{name}")
        .foreachBatch(write)
    )
    if available_now:
        query = query.trigger(availableNow=True)
    elif interval is not None:
        query = query.trigger(processingTime=interval)
    return query.start()
