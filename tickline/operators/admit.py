"""Admission: which frames enter the engine, and why the others do not."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.functions.fixed import HEADER_BYTES, KINDS, Kind
from tickline.functions.unpack import ROUTE_TEXTS, scanned
from tickline.plans.config import EngineConfig

#: What decoding takes over from admission.
COMMON = ("ingress_sequence", "receive_monotonic_ns", "vendor_sequence", "vendor_local_time_raw", "service_id", "service_version", "message_id", "kind")


def _number(at: int, size: int) -> Column:
    """The unsigned little-endian number at an offset of the body."""
    return F.conv(F.concat(*(F.hex(F.substring("body", at + i + 1, 1)) for i in reversed(range(size)))), 16, 10).cast("bigint")


def _text(at: int) -> Column:
    """The text whose size and place stand at an offset of the body."""
    return F.substring(F.col("body"), (_number(at + 2, 4) + at + 1).cast("int"), _number(at, 2).cast("int"))


def route_key(admitted: DataFrame) -> DataFrame:
    """Adds route_key of accepted frames, null for others: all frames of a channel, and all snapshots of an instrument, have one key.

    Of a tick it is service and channel in one number, of a snapshot a hash of its
    identity, read from the body without decoding the rest.
    """
    tick = F.shiftleft(F.col("service_id").cast("bigint"), 32) + F.col("route_channel")
    snapshot = F.lit(None).cast("bigint")
    for kind, texts in ROUTE_TEXTS.items():
        snapshot = F.when(F.col("kind") == kind.name, F.xxhash64(F.lit(kind.market), *(_text(at) for at in texts))).otherwise(snapshot)
    return admitted.withColumn("route_key", F.when(F.col("admission_result") == "accepted", F.coalesce(tick, snapshot)))


def admit(frames: DataFrame, config: EngineConfig | None = None) -> DataFrame:
    """Adds the header's fields, kind and admission_result; the first reason that holds wins, `accepted` if none does.

    Nothing is shuffled and no frame is dropped: accepted and rejected frames
    are told apart by a filter on admission_result.
    """
    config = config or EngineConfig()
    return scanned(frames, config.streams, config.maximum_tick_body_bytes, config.maximum_snapshot_body_bytes)


def as_reported(admitted: DataFrame, first_fault: int | None = None) -> DataFrame:
    """Adds what a live engine behind a vendor's callback reports for each frame, and whether the frame gets to the engine.

    The callback turns away a frame that is null as a whole (`null_message`), a
    null header, a header with wrong sizes, and a null body where the header
    announces one (`body_truncated`). The engine takes nothing after the frame
    `first_fault`, the ingress sequence of its first fault: `not_running`.
    """
    lost, sizes = F.col("header").isNull(), (F.col("head_size") != HEADER_BYTES) | (F.col("message_size") < HEADER_BYTES)
    callback = F.when(lost & F.col("body").isNull(), "null_message").when(lost, "header_truncated").when(sizes, "header_invalid").when(F.col("body").isNull() & (F.col("message_size") != HEADER_BYTES), "body_truncated")
    after = F.lit(False) if first_fault is None else F.col("ingress_sequence") > first_fault
    engine = F.when(after, "not_running").otherwise(F.col("admission_result"))
    return admitted.withColumns({"reported_result": F.coalesce(callback, engine), "reaches_engine": callback.isNull()})


def accepted(admitted: DataFrame, kinds: Iterable[Kind] = KINDS) -> DataFrame:
    return admitted.where((F.col("admission_result") == "accepted") & F.col("kind").isin([k.name for k in kinds]))
