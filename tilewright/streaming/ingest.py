"""Staging of files as they arrive: each micro-batch is tiled and merged into the tiles that exist."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import staging


def done_before(spark, path: str, batch: str) -> bool:
    """Whether the summary holds the batch already, as after a restart."""
    summary = staging.read_if_there(spark, f"{path}/summary")
    return summary is not None and not summary.where(F.col("batch_id") == batch).isEmpty()


def ingest(stream: DataFrame, path: str, config: staging.StagingConfig, checkpoint: str, stage: Callable[[DataFrame], DataFrame], once: bool = False) -> StreamingQuery:
    """Writes each batch of ``stream`` by ``staging.save_tiles``; ``stage`` makes rows of tiles of a batch.

    A batch whose number the summary holds is skipped, and what a torn attempt of one left is replaced, so that a
    replayed batch isn't added twice.
    ``once``: takes what is there and stops.
    """

    def merge(batch: DataFrame, number: int) -> None:
        if not done_before(batch.sparkSession, path, f"stream-{number}") and not batch.isEmpty():
            staging.save_tiles(stage(batch), path, config, batch_id=f"stream-{number}")

    out = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()
