"""The engine over a stream of frames: admission, decoding, catalog and recovery in one streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tickline.operators.admit import admit
from tickline.operators.catalog import match
from tickline.operators.decode_tick import decode_ticks
from tickline.operators.recovery import positions
from tickline.plans.config import EngineConfig
from tickline.streaming.recovery import recover_stream


def run_stream(frames: DataFrame, catalog: DataFrame, config: EngineConfig) -> DataFrame:
    """Events (see `recover_stream`) of a stream of frames; the catalog is a table.

    Frames that are not admitted make no event. Only the recovery of channels
    keeps state; everything before it is done frame by frame.
    """
    return recover_stream(positions(match(decode_ticks(admit(frames, config), config), catalog)), config)


def rejected_stream(frames: DataFrame, config: EngineConfig) -> DataFrame:
    """The frames of a stream that are not admitted, with the reason."""
    return admit(frames, config).where("admission_result != 'accepted'")


def replay(events: DataFrame, folder: str) -> StreamingQuery:
    """Runs a stream of events over what its source has now, into a Parquet table at {folder}/out, and waits for its end.

    Timers of channels at rest ask for one batch after the other, so a stream that
    is to end runs without batches that have no data.
    """
    conf, name = events.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        query = events.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").outputMode("append").trigger(availableNow=True).start()
    finally:
        conf.set(name, before)
    query.awaitTermination()
    return query
