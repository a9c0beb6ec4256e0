"""Owners, mailboxes, counters and reports over recovered records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_owner(records: DataFrame, owners: int) -> DataFrame:
    """Adds the owner of each record: its instrument's ordinal modulo the number of owners."""
    return records.withColumn("owner", F.pmod("instrument_ordinal", F.lit(owners)).cast("int"))


def owned_by(records: DataFrame, owner: int, owners: int) -> DataFrame:
    """What one owner polls. Records keep native order within a channel; nothing orders channels."""
    return with_owner(records, owners).where(F.col("owner") == owner)


def dealt_by_owner(records: DataFrame, owners: int) -> DataFrame:
    """Records of an owner side by side, in native order within each channel."""
    return with_owner(records, owners).repartition(owners, "owner").sortWithinPartitions("owner", "market", "channel", "native_sequence")


def gap_mailbox(gaps: DataFrame) -> DataFrame:
    """The latest gap of each channel: what a reader sees that polls once."""
    return gaps.groupBy("market", "channel").agg(F.max_by(F.struct(*[c for c in gaps.columns if c not in ("market", "channel")]), "gap_epoch").alias("gap")).select("market", "channel", "gap.*")


def mailbox_jumps(observed: DataFrame) -> DataFrame:
    """Adds skipped_epochs: gaps that were replaced before the reader saw them."""
    order = Window.partitionBy("market", "channel").orderBy("gap_epoch")
    return observed.withColumn("skipped_epochs", F.col("gap_epoch") - F.coalesce(F.lag("gap_epoch").over(order), F.lit(0)) - 1)


def order_violations(ticks: DataFrame) -> DataFrame:
    """Ticks that do not come after the one emitted before them in their channel (order: emitted_at)."""
    order = Window.partitionBy("market", "channel").orderBy("emitted_at")
    return ticks.withColumn("previous", F.lag("native_sequence").over(order)).where(F.col("native_sequence") <= F.col("previous"))


def lower_percentiles(values: DataFrame, keys: list[str], column: str, points: dict[str, float]) -> DataFrame:
    """For each group, name -> the value at index floor(q (n - 1)) of its sorted values. Nulls do not count.

    Equal values are counted before anything is sorted, so that a group costs as
    much as it has different values.
    """
    counts = values.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("times"))
    order = Window.partitionBy(*keys).orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumns({"upto": F.sum("times").over(order), "all": F.sum("times").over(Window.partitionBy(*keys))})
    return upto.groupBy(*keys).agg(*(F.min(F.when(F.col("upto") > F.floor(F.lit(q) * (F.col("all") - 1)), F.col(column))).alias(name) for name, q in points.items()))


def counters(admitted: DataFrame, ticks: DataFrame, snapshots: DataFrame, events: DataFrame) -> DataFrame:
    """One row with the engine's counters. ticks and snapshots: decoded and matched with the catalog."""
    count = lambda test: F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("bigint")
    kind = F.col("output_kind")
    a = admitted.agg(F.count("*").alias("callbacks"), count(F.col("admission_result") == "accepted").alias("admitted"), count(F.col("admission_result") != "accepted").alias("rejected"))
    good, lost = F.col("decode_error").isNull(), F.col("decode_error").isNotNull()
    t = ticks.agg(count(good).alias("decoded_ticks"), count(lost).alias("tick_errors"), count(good & ~F.col("catalog_match")).alias("tick_misses"))
    s = snapshots.agg(count(good).alias("decoded_snapshots"), count(lost).alias("snapshot_errors"), count(good & ~F.col("catalog_match")).alias("snapshot_misses"), count(good & F.col("catalog_match")).alias("dispatched_snapshots"))
    e = events.agg(
        count(kind == "tick").alias("dispatched_ticks"),
        count(kind.isin("late", "dropped") | ((kind == "fault") & (F.col("reason") == "canonical_conflict"))).alias("duplicates_or_late"),
        count(kind == "late").alias("late_recovery_dispatched"),
        count(kind == "gap").alias("gaps_skipped"),
        count(kind == "fault").alias("from_open_channels_frozen"),
        count(kind == "fault").alias("channel_faults_dispatched"),
    )
    # four single rows side by side
    one = F.lit(1)
    joined = a.withColumn("k", one).join(t.withColumn("k", one), "k").join(s.withColumn("k", one), "k").join(e.withColumn("k", one), "k").drop("k")
    return joined.withColumns({"decode_errors": F.col("tick_errors") + F.col("snapshot_errors"), "catalog_misses": F.col("tick_misses") + F.col("snapshot_misses")}).drop("tick_errors", "snapshot_errors", "tick_misses", "snapshot_misses")
