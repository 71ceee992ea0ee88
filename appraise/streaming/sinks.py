"""Exactly-once micro-batch output for the notification streams.

Each micro-batch is written to its own ``batch_id=<n>`` folder with overwrite,
so a batch replayed after a failure replaces its own output instead of adding
duplicates; the checkpoint keeps the file-source offsets, so a restart never
reads a processed file again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def idempotent_writer(sink_path: str, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{sink_path}/batch_id={batch_id}")
    return write


def start_available(stream: DataFrame, sink_path: str, checkpoint: str,
                    fmt: str = "parquet", name: str | None = None) -> StreamingQuery:
    """Process everything that has landed, in as many batches as the source allows."""
    w = (stream.writeStream.foreachBatch(idempotent_writer(sink_path, fmt))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    return w.start()


def run_available(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet") -> int:
    """Start, wait until the available input is done; return the number of batches written.

    An empty folder of the stream's schema is written first, so an input without
    any file still reads back as zero rows.
    """
    spark = stream.sparkSession
    done: list[int] = []
    spark.createDataFrame([], stream.schema).write.mode("append").format(fmt).save(f"{sink_path}/batch_id=-1")
    write = idempotent_writer(sink_path, fmt)

    def counted(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        done.append(batch_id)

    q = (stream.writeStream.foreachBatch(counted).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return len(set(done))
