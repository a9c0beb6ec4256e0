"""Sequence recovery over tables: closed forms as windows, and the state machine for the rest.

All forms take one row for each record: market, channel, ingress_sequence (order
of arrival), receive_monotonic_ns, native_sequence, payload and catalog_match,
and optionally decode_error. A channel's records are handled in order of arrival
by one task, as its frontier is one; channels are independent of each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickline.functions.fixed import QUALITY, VALID
from tickline.operators.recovery_state import Channel, Event, Record
from tickline.plans.config import FROM_OPEN, EngineConfig

CHANNEL = ["market", "channel"]
PAYLOAD = ("kind", "exchange_time_raw", "security_id_source", "security_id", "price.raw", "price.source_scale", "price.raw_valid", "amount.raw", "amount.source_scale", "amount.raw_valid", "quantity", "primary_order_id", "buy_order_id", "sell_order_id", "matched_quantity", "raw_type", "raw_side", "action", "side", "aggressor", "order_type", "phase")
EVENT_DDL = "market string, channel bigint, output_kind string, ingress_sequence bigint, native_sequence bigint, history_complete boolean, gap_epoch bigint, gap_first bigint, gap_last bigint, next_sequence bigint, cumulative_missing bigint, detected_ns bigint, reason string"
EVENT_NAMES = [x.split()[0] for x in EVENT_DDL.split(", ")]
EVENT_TYPES = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), *(pa.int64(),) * 6, pa.string()]
INPUT = [*CHANNEL, "ingress_sequence", "receive_monotonic_ns", "native_sequence", "payload", "catalog_match", "decode_error"]


def payload() -> Column:
    """What two records of one native position must agree on to be the same: content, but no clocks, flags or stream."""
    values = [F.col(c) for c in PAYLOAD]
    # 128 bits stand for the content, so that no text of it is shuffled
    return F.concat(F.hex(F.xxhash64(*values)), F.lit("."), F.hex(F.xxhash64(F.lit("second"), *values)))


def positions(decoded: DataFrame) -> DataFrame:
    """Decoded and matched ticks that have a place in a channel, as recovery takes them; those that failed to decode hold theirs."""
    return decoded.where("decode_error is null or (native_sequence > 0 and (market = 'SZ' or channel > 0))").withColumn("payload", payload())


def recover_at_once(records: DataFrame, mode: str = FROM_OPEN) -> DataFrame:
    """No wait: every record at or beyond the frontier is emitted, a jump is a gap, the rest is late.

    One window over each channel, in order of arrival. Adds frontier (sequence
    committed before), output_kind (tick, unmatched or late), is_gap, gap_epoch
    and cumulative_missing (up to and with this record), history_complete, and
    for a tick that is the first one emitted after gaps gap_before (the last of them).
    """
    order = Window.partitionBy(*CHANNEL).orderBy("ingress_sequence")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, 0)
    seq = F.col("native_sequence")
    base = F.lit(0) if mode == FROM_OPEN else F.first("native_sequence").over(upto) - 1
    x = records.withColumn("frontier", F.coalesce(F.max(seq).over(before), base))
    x = x.withColumn("is_gap", seq > F.col("frontier") + 1)
    gap = F.when(F.col("is_gap"), F.struct((F.col("frontier") + 1).alias("first"), (seq - 1).alias("last")))
    x = x.withColumns(
        {
            "gap_epoch": F.sum(F.col("is_gap").cast("bigint")).over(upto),
            "cumulative_missing": F.sum(F.when(F.col("is_gap"), seq - F.col("frontier") - 1).otherwise(0)).over(upto),
            "last_gap": F.last(gap, ignorenulls=True).over(upto),
            "output_kind": F.when(seq <= F.col("frontier"), "late").when(F.col("catalog_match"), "tick").otherwise("unmatched"),
        }
    )
    told = F.coalesce(F.max(F.when(F.col("output_kind") == "tick", F.col("gap_epoch"))).over(before), F.lit(0))
    x = x.withColumn("gap_before", F.when((F.col("output_kind") == "tick") & (F.col("gap_epoch") > told), F.col("last_gap"))).drop("last_gap")
    return x.withColumn("history_complete", F.lit(mode == FROM_OPEN) & (F.col("gap_epoch") == 0) & (F.col("output_kind") != "late"))


def gaps_of(at_once: DataFrame) -> DataFrame:
    """The gaps of `recover_at_once`."""
    return at_once.where("is_gap").select(*CHANNEL, (F.col("frontier") + 1).alias("first_missing"), (F.col("native_sequence") - 1).alias("last_missing"), F.col("native_sequence").alias("first_present_after_gap"), F.col("receive_monotonic_ns").alias("detected_ns"), "gap_epoch", "cumulative_missing")


def recover_patiently(records: DataFrame) -> DataFrame:
    """Endless wait and room, from the open: when each record is committed, before the end of the stream.

    Adds commit_at (ingress sequence at which the record's position is
    committed; null while a position below is missing) and output_kind: tick,
    pending (still held), late (arrived after its position was committed) or
    duplicate (arrived while it was held).
    """
    first = Window.partitionBy(*CHANNEL, "native_sequence")
    x = records.withColumn("first_arrival", F.min("ingress_sequence").over(first))
    own = F.col("ingress_sequence") == F.col("first_arrival")
    order = Window.partitionBy(*CHANNEL).orderBy("native_sequence").rangeBetween(Window.unboundedPreceding, 0)
    dense = F.col("native_sequence") == F.sum(own.cast("bigint")).over(order)
    x = x.withColumn("commit_at", F.when(dense, F.max("first_arrival").over(order)))
    kind = F.when(own, F.when(F.col("commit_at").isNull(), "pending").otherwise("tick")).when(F.col("ingress_sequence") > F.col("commit_at"), "late").otherwise("duplicate")
    return x.withColumn("output_kind", kind)


def freeze_points(records: DataFrame) -> DataFrame:
    """For `recover_patiently` with payloads: the channels that a conflict freezes.

    market, channel, frozen_at (ingress sequence), observed_sequence and
    expected_sequence: the first record that arrives while its position is held
    with another payload, and the frontier at that time.
    """
    held = recover_patiently(records)
    same = Window.partitionBy(*CHANNEL, "native_sequence").orderBy("ingress_sequence").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    clash = held.withColumn("kept", F.first("payload").over(same)).where((F.col("output_kind") == "duplicate") & ~F.col("payload").eqNullSafe(F.col("kept")))
    first = clash.groupBy(*CHANNEL).agg(F.min(F.struct("ingress_sequence", "native_sequence")).alias("at"))
    done = held.where("output_kind = 'tick'").join(first, CHANNEL).where(F.col("commit_at") < F.col("at.ingress_sequence")).groupBy(*CHANNEL).agg(F.count("*").alias("committed"))
    return first.join(done, CHANNEL, "left").select(*CHANNEL, F.col("at.ingress_sequence").alias("frozen_at"), F.col("at.native_sequence").alias("observed_sequence"), (F.coalesce("committed", F.lit(0)) + 1).alias("expected_sequence"))


def partial_origin(records: DataFrame, hold_ns: int) -> DataFrame:
    """market, channel, discovery_ends_ns and origin for an endless wait after a start in the middle.

    Discovery ends with the first record of a new position that arrives when the
    hold is over, or with the stream; the origin is the least sequence up to then.
    """
    first = Window.partitionBy(*CHANNEL, "native_sequence")
    x = records.withColumn("begins", F.min("receive_monotonic_ns").over(Window.partitionBy(*CHANNEL))).withColumn("own", F.col("ingress_sequence") == F.min("ingress_sequence").over(first))
    over = F.col("own") & (F.col("receive_monotonic_ns") >= F.col("begins") + hold_ns)
    ends = x.groupBy(*CHANNEL).agg(F.min(F.when(over, F.struct("ingress_sequence", "receive_monotonic_ns"))).alias("end"), (F.min("begins") + hold_ns).alias("due"))
    held = records.join(ends, CHANNEL).where(F.col("end").isNull() | (F.col("ingress_sequence") <= F.col("end.ingress_sequence")))
    return held.groupBy(*CHANNEL).agg(F.min(F.coalesce("end.receive_monotonic_ns", "due")).alias("discovery_ends_ns"), F.min("native_sequence").alias("origin"))


def event_row(market: str, channel: int, e: Event) -> tuple:
    return (market, channel, *e)


def event_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), EVENT_TYPES, strict=True)], names=EVENT_NAMES)


def _machine(config: EngineConfig, flush: bool):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, channel, now, rows = None, None, 0, []
        for batch in batches:
            for market, number, ingress, ns, seq, content, matched, error in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (market, number) != at:
                    if channel is not None and flush:
                        rows += [event_row(*at, e) for e in channel.flush(now)]
                    at, channel = (market, number), Channel.start(config)
                now = ns
                events = channel.arrive(Record(ingress, seq, content, matched), ns) if error is None else channel.fail(seq, ns)
                rows += [event_row(market, number, e) for e in events]
            if rows:
                yield event_batch(rows)
                rows = []
        if channel is not None and flush:
            rows = [event_row(*at, e) for e in channel.flush(now)]
            if rows:
                yield event_batch(rows)

    return run


def recover(records: DataFrame, config: EngineConfig, *, flush: bool = True) -> DataFrame:
    """Events of the state machine for any waits and table sizes, one row each (EVENT_DDL).

    Channels are dealt out by hash and their records streamed through the machine
    in order of arrival; a task holds only the records that wait. Records that
    failed to decode are given with decode_error and their native position.
    """
    if "decode_error" not in records.columns:
        records = records.withColumn("decode_error", F.lit(None).cast("string"))
    dealt = records.select(*INPUT).repartition(*CHANNEL).sortWithinPartitions(*CHANNEL, "ingress_sequence")
    return dealt.mapInArrow(_machine(config, flush), EVENT_DDL)


def recovered_ticks(ticks: DataFrame, events: DataFrame) -> DataFrame:
    """Emitted ticks with the flags and gap metadata that recovery gives them."""
    own = ["ingress_sequence", "history_complete", "gap_epoch", "gap_first", "gap_last"]
    x = ticks.join(events.where("output_kind = 'tick'").select(*own), "ingress_sequence")
    flags = F.when(F.col("history_complete"), 0).otherwise(QUALITY["history_incomplete"]).bitwiseOR(F.when(F.col("gap_first").isNotNull(), QUALITY["gap_before"]).otherwise(0))
    return x.withColumns({"quality": F.col("quality").bitwiseOR(flags.cast("bigint")), "validity": F.when(F.col("history_complete"), F.col("validity")).otherwise(F.col("validity").bitwiseAND(F.lit(~VALID["history"]).cast("bigint")))})


def late_ticks(ticks: DataFrame, events: DataFrame) -> DataFrame:
    """Ticks diverted as late, with the frontier and gap epoch at that time. They are not filtered by the catalog."""
    own = ["ingress_sequence", F.col("next_sequence").alias("committed_next_sequence"), F.col("gap_epoch").alias("observed_gap_epoch"), "reason"]
    x = ticks.join(events.where("output_kind = 'late'").select(*own), "ingress_sequence")
    return x.withColumns({"quality": F.col("quality").bitwiseOR(F.lit(QUALITY["history_incomplete"] | QUALITY["late"]).cast("bigint")), "validity": F.col("validity").bitwiseAND(F.lit(~VALID["history"]).cast("bigint"))})
