"""The engine as a plan: frames in, ordered ticks, snapshots and side outputs out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tickline.operators import dispatch
from tickline.operators.admit import admit, as_reported
from tickline.operators.catalog import match
from tickline.operators.decode_snapshot import decode_snapshots
from tickline.operators.decode_tick import decode_ticks
from tickline.operators.recovery import late_ticks, positions, recover, recovered_ticks
from tickline.plans.config import FROM_OPEN, EngineConfig


@dataclass
class Outputs:
    """What a run over a table of frames gives; nothing is computed before it is read."""

    admitted: DataFrame
    decoded: DataFrame
    events: DataFrame
    ticks: DataFrame
    snapshots: DataFrame
    late: DataFrame
    gaps: DataFrame
    faults: DataFrame
    rejected: DataFrame
    engine_faults: DataFrame
    all_snapshots: DataFrame

    def stats(self) -> DataFrame:
        return dispatch.counters(self.admitted, self.decoded, self.all_snapshots, self.events)

    def first_fault(self) -> Row | None:
        """The first of engine_faults, which is what a live engine stops at; None for a healthy one."""
        return self.engine_faults.orderBy("ingress_sequence", "fault").first()

    def reported(self) -> DataFrame:
        """The admitted frames with the result that a live engine reports (see `as_reported`)."""
        first = self.first_fault()
        return as_reported(self.admitted, None if first is None else first["ingress_sequence"])


def run(frames: DataFrame, catalog: DataFrame, config: EngineConfig | None = None, *, flush: bool = True, folder: str | None = None) -> Outputs:
    """Plans a run. Ticks are matched with the catalog before recovery and filtered after it, so that a foreign record still holds its place.

    With `folder`, which driver and executors must share, decoded ticks and
    recovery events are written there once, and all outputs read them; without it
    each output decodes the frames for itself.
    """
    config = config or EngineConfig()

    def kept(df: DataFrame, name: str) -> DataFrame:
        if folder is None:
            return df
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    admitted = admit(frames, config)
    decoded = kept(match(decode_ticks(admitted, config), catalog), "decoded")
    events = kept(recover(positions(decoded), config, flush=flush), "events")
    owned = dispatch.with_owner(recovered_ticks(decoded, events), config.owners)
    every = match(decode_snapshots(admitted, config), catalog)
    snapshots = dispatch.with_owner(every.where("decode_error is null and catalog_match"), config.owners)
    side = lambda kind, *columns: events.where(F.col("output_kind") == kind).select("market", "channel", *columns)
    gaps = side("gap", F.col("gap_first").alias("first_missing"), F.col("gap_last").alias("last_missing"), F.col("next_sequence").alias("first_present_after_gap"), "detected_ns", "gap_epoch", F.col("cumulative_missing").alias("cumulative_missing_sequences"))
    faults = side("fault", "reason", F.col("next_sequence").alias("expected_sequence"), F.col("native_sequence").alias("observed_sequence"), "detected_ns")
    fatal = admitted.where("admission_result = 'body_too_large'").select("ingress_sequence", F.lit("body_too_large").alias("fault"))
    if config.mode == FROM_OPEN:
        fatal = fatal.unionByName(decoded.where("decode_error is not null and native_sequence <= 0").select("ingress_sequence", F.lit("invalid_native_position").alias("fault")))
    if config.maximum_channels is not None:
        opened = decoded.where("native_sequence > 0").groupBy("market", "channel").agg(F.min("ingress_sequence").alias("ingress_sequence"))
        # one row for each channel
        turn = F.row_number().over(Window.orderBy("ingress_sequence", "market", "channel"))
        fatal = fatal.unionByName(opened.withColumn("turn", turn).where(F.col("turn") > config.maximum_channels).select("ingress_sequence", F.lit("channel_capacity").alias("fault")))
    return Outputs(admitted, decoded, events, owned, snapshots, late_ticks(decoded, events), gaps, faults, admitted.where("admission_result != 'accepted'"), fatal, every)


def strict(outputs: Outputs) -> None:
    """Raises RuntimeError if the data holds what would stop a live engine."""
    first = outputs.first_fault()
    if first is not None:
        raise RuntimeError(f"{first['fault']} at ingress sequence {first['ingress_sequence']}")
