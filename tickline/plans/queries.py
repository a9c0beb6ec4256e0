"""Queries over the relational tables that exercise every operator, and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.functions import wire
from tickline.functions.fixed import KINDS, NULL_I32, NULL_I64, SH_SNAPSHOT, SH_TICK, SZ_ORDER, SZ_SNAPSHOT, SZ_TRANSACTION, Kind
from tickline.operators import dispatch, recovery
from tickline.operators.admit import admit, route_key
from tickline.operators.catalog import match, problems
from tickline.operators.decode_snapshot import decode_snapshots
from tickline.operators.decode_tick import decode_ticks
from tickline.plans.config import PARTIAL, EngineConfig
from tickline.plans.pipeline import Outputs, run
from tickline.plans.workspace import work_folder
from tickline.sources import encode
from tickline.sources.adapters import event_arrivals, security, supplier_definitions, table
from tickline.streaming.engine import replay, run_stream

AT_ONCE = EngineConfig(from_open_wait_ns=0, owners=3, reorder_entries=1 << 20, maximum_span=1 << 20)
PATIENT = EngineConfig(from_open_wait_ns=None, partial_wait_ns=None, reorder_entries=1 << 30, maximum_span=1 << 30)

# ---- recovery without a wait


def _at_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.recover_at_once(event_arrivals(spark, sf_dir))


def ordered_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_once(spark, sf_dir).where("output_kind = 'tick'").select("channel", "native_sequence", "ingress_sequence", "gap_epoch", "history_complete")


def channel_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.gaps_of(_at_once(spark, sf_dir)).drop("market")


def late_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_once(spark, sf_dir).where("output_kind = 'late'").select("channel", "ingress_sequence", "native_sequence", (F.col("frontier") + 1).alias("committed_next_sequence"), F.col("gap_epoch").alias("observed_gap_epoch"), "catalog_match")


def gap_mailbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch.gap_mailbox(recovery.gaps_of(_at_once(spark, sf_dir))).drop("market")


def gap_metadata_on_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_once(spark, sf_dir).where("gap_before is not null").select("channel", "native_sequence", "gap_epoch", F.col("gap_before.first").alias("gap_first"), F.col("gap_before.last").alias("gap_last"))


def history_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _at_once(spark, sf_dir).where("output_kind = 'tick'").groupBy("channel").agg(F.sum(F.col("history_complete").cast("bigint")).alias("complete"), F.sum((~F.col("history_complete")).cast("bigint")).alias("incomplete"))


def catalog_continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = recovery.recover_at_once(event_arrivals(spark, sf_dir).withColumn("catalog_match", F.col("native_sequence") % 3 != 0))
    return x.groupBy("channel", "output_kind").agg(F.count("*").alias("records"), F.sum(F.col("is_gap").cast("bigint")).alias("gaps"))


def order_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that break native order: as they arrive, and as the machine emits them."""
    records = event_arrivals(spark, sf_dir)
    ticks = recovery.recover(records, AT_ONCE).where("output_kind in ('tick', 'unmatched')").withColumn("emitted_at", F.monotonically_increasing_id())
    broken = lambda df, name: dispatch.order_violations(df).groupBy("channel").agg(F.count("*").alias(name))
    arrived = broken(records.withColumn("emitted_at", F.col("ingress_sequence")), "arrived")
    return arrived.join(broken(ticks, "emitted"), "channel", "left").select("channel", "arrived", F.coalesce("emitted", F.lit(0)).cast("bigint").alias("emitted"))


# ---- the engine from end to end


def _event_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The arrivals of the events as frames of Shanghai orders; every tenth comes a second time with its header cut off."""
    sec = F.when(F.col("catalog_match"), F.concat(F.lit("E"), (F.col("native_sequence") % 7).cast("string"))).otherwise("X")
    content = encode.sh_tick_body(sequence=F.col("native_sequence"), channel=F.col("channel") + 1, security=sec, type_=F.lit("A"), mark=F.lit("B"), price=F.col("payload").cast("bigint") % 100_000 + 1, quantity=F.lit(100), money=F.lit(0), buy=F.col("native_sequence"), sell=F.lit(0), time=F.lit(93_000_000))
    whole = encode.frames(event_arrivals(spark, sf_dir), SH_TICK, content, ingress=F.col("ingress_sequence"), receive_ns=F.col("receive_monotonic_ns"))
    cut = whole.where("ingress_sequence % 10 = 3").withColumn("header", F.substring("header", 1, 20)).withColumn("ingress_sequence", F.col("ingress_sequence") + 1_000_000_000)
    return whole.unionByName(cut)


def _event_catalog(spark: SparkSession) -> DataFrame:
    return spark.range(7).select((F.col("id") + 1).alias("instrument_id"), F.col("id").alias("instrument_ordinal"), F.lit("SH").alias("market"), F.lit("").alias("security_id_source"), F.concat(F.lit("E"), F.col("id").cast("string")).alias("security_id"))


def _engine(spark: SparkSession, sf_dir: str) -> Outputs:
    return run(_event_frames(spark, sf_dir), _event_catalog(spark), AT_ONCE, flush=False, folder=work_folder(spark, "engine"))


def engine_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(spark, sf_dir).ticks.select((F.col("channel") - 1).alias("channel"), "native_sequence", "ingress_sequence", "instrument_id", "owner", F.col("price.p6").alias("price_p6"), "gap_first", "gap_last", "validity", "quality")


def engine_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the owners poll, by owner and instrument."""
    ticks = _engine(spark, sf_dir).ticks
    polled = [dispatch.owned_by(ticks, i, AT_ONCE.owners).groupBy("instrument_id").agg(F.count("*").alias("records"), F.max("native_sequence").alias("last_sequence")).withColumn("owner", F.lit(i)) for i in range(AT_ONCE.owners)]
    return reduce(DataFrame.unionByName, polled)


def engine_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(spark, sf_dir).late.select((F.col("channel") - 1).alias("channel"), "ingress_sequence", "native_sequence", "committed_next_sequence", "observed_gap_epoch", "reason", "catalog_match", "validity", "quality")


def stats_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _engine(spark, sf_dir).stats()


def live_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a live engine reports for frames of which some are too large for it, and some have no header, no body or neither."""
    frames = _event_frames(spark, sf_dir)
    i = F.col("ingress_sequence")
    longer = F.concat("body", F.unhex(F.lit("00" * 512)))
    large = frames.where(i % 700 == 650).withColumn("body", longer).withColumn("header", encode.header(SH_TICK, F.octet_length("body"), F.lit(93_000_000), F.col("receive_monotonic_ns")))
    whole = frames.where(i < 1_000_000_000)
    part = lambda at, *lost: whole.where(i % 50 == at).withColumns({c: F.lit(None).cast("binary") for c in lost} | {"ingress_sequence": i + 2_000_000_000})
    every = [frames.where((i % 700 != 650) | (i >= 1_000_000_000)), large.where(i < 1_000_000_000), part(7, "header", "body"), part(8, "header"), part(9, "body")]
    out = run(reduce(DataFrame.unionByName, every), _event_catalog(spark), AT_ONCE)
    return out.reported().groupBy("reported_result", "reaches_engine").agg(F.count("*").alias("frames"), F.min("ingress_sequence").alias("first_ingress"))


def channel_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channels that an engine with room for three has no place for."""
    config = replace(AT_ONCE, maximum_channels=3)
    return run(_event_frames(spark, sf_dir), _event_catalog(spark), config).engine_faults


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same frames as a stream of files in three batches, recovered without a wait."""
    folder = work_folder(spark, "replay")
    frames = _event_frames(spark, sf_dir)
    last = frames.where("ingress_sequence < 1000000000").agg(F.max("ingress_sequence")).first()[0] or 0
    third = F.least(F.floor(F.col("ingress_sequence") * 3 / (last + 1)), F.lit(2))
    for i in range(3):
        frames.where(third == i).coalesce(1).write.parquet(f"{folder}/in/part={i}")
    stream = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in/part=*")
    replay(run_stream(stream, _event_catalog(spark), AT_ONCE), folder)
    events = spark.read.schema(recovery.EVENT_DDL).parquet(f"{folder}/out").where("output_kind in ('tick', 'late', 'gap')")
    return events.select((F.col("channel") - 1).alias("channel"), "output_kind", "ingress_sequence", "native_sequence", "gap_epoch", "gap_first", "gap_last")


_A1 = """
WITH base AS (
  SELECT event_id % 8 AS channel, event_id, user_id, CAST(floor(value * 100) AS BIGINT) AS cents,
         row_number() OVER (PARTITION BY event_id % 8 ORDER BY event_id + 8 * (user_id % 16), event_id) AS seq
  FROM events),
kept AS (SELECT * FROM base WHERE {keep}),
arrivals AS (
  SELECT channel, event_id * 2 AS ingress, seq, cents, user_id % 5 <> 0 AS matched FROM kept
  UNION ALL
  SELECT channel, (event_id + {delay}) * 2 + 1, seq, {again}, user_id % 5 <> 0 FROM kept WHERE event_id % 101 = 0)"""
_HOLES = _A1.format(keep="event_id % 97 <> 0", again="cents", delay=400)
_WHOLE = _A1.format(keep="true", again="cents", delay=40)
_ALTERED = _A1.format(keep="true", again="CASE WHEN event_id % 303 = 0 THEN cents + 1 ELSE cents END", delay=40)
_ONCE = """,
f AS (SELECT *, coalesce(max(seq) OVER (PARTITION BY channel ORDER BY ingress ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS frontier FROM {source}),
g AS (SELECT *, seq > frontier + 1 AS is_gap, seq <= frontier AS late,
      CAST(count(*) FILTER (seq > frontier + 1) OVER w AS BIGINT) AS epoch,
      CAST(coalesce(sum(seq - frontier - 1) FILTER (seq > frontier + 1) OVER w, 0) AS BIGINT) AS missing
      FROM f WINDOW w AS (PARTITION BY channel ORDER BY ingress ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_AT_ONCE = _HOLES + _ONCE.format(source="arrivals")
_GAPS = "SELECT channel, frontier + 1 AS first_missing, seq - 1 AS last_missing, seq AS first_present_after_gap, ingress * 1000 AS detected_ns, epoch AS gap_epoch, missing AS cumulative_missing FROM g WHERE is_gap"

# ---- recovery with an endless wait


def pending_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.recover_patiently(event_arrivals(spark, sf_dir, drop=False)).groupBy("channel", "output_kind").agg(F.count("*").alias("records"))


def reorder_delay(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = recovery.recover_patiently(event_arrivals(spark, sf_dir, drop=False)).where("output_kind = 'tick'")
    return x.select("channel", "native_sequence", "commit_at", (F.col("commit_at") - F.col("ingress_sequence")).alias("delay"))


def latency_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch.lower_percentiles(reorder_delay(spark, sf_dir), ["channel"], "delay", {"p50": 0.5, "p90": 0.9, "p99": 0.99, "p999": 0.999, "max_all": 1.0})


def conflict_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.freeze_points(event_arrivals(spark, sf_dir, drop=False, alter=True)).drop("market")


def partial_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = event_arrivals(spark, sf_dir, drop=False).where("native_sequence >= 100")
    return recovery.partial_origin(records, 200_000).drop("market")


_PATIENT = """,
firsts AS (SELECT channel, seq, min(ingress) AS first_at FROM arrivals GROUP BY ALL),
dense AS (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY seq) = seq AS reached,
          max(first_at) OVER (PARTITION BY channel ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS top FROM firsts),
commits AS (SELECT channel, seq, first_at, CASE WHEN reached THEN top END AS commit_at FROM dense),
kinds AS (SELECT a.*, first_at, commit_at,
   CASE WHEN ingress = first_at THEN CASE WHEN commit_at IS NULL THEN 'pending' ELSE 'tick' END WHEN ingress > commit_at THEN 'late' ELSE 'duplicate' END AS kind
   FROM arrivals a JOIN commits USING (channel, seq))"""

# ---- the state machine


def machine_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state machine without a wait must give what the closed form gives."""
    config = EngineConfig(from_open_wait_ns=0, reorder_entries=1 << 20, maximum_span=1 << 20)
    events = recovery.recover(event_arrivals(spark, sf_dir), config, flush=False)
    return events.select("channel", "output_kind", "ingress_sequence", "native_sequence", "gap_epoch", "gap_first", "gap_last").where("output_kind in ('tick', 'late', 'gap')")


def machine_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With an endless wait the machine emits what form 2 commits, then flushes."""
    events = recovery.recover(event_arrivals(spark, sf_dir, drop=False), PATIENT)
    return events.groupBy("channel", "output_kind").agg(F.count("*").alias("records"))


def machine_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = recovery.recover(event_arrivals(spark, sf_dir, drop=False, alter=True), PATIENT)
    return events.where("output_kind = 'fault'").select("channel", "reason", F.col("next_sequence").alias("expected_sequence"), F.col("native_sequence").alias("observed_sequence"))


def bounded_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finite wait and a small table: no closed form is known, so no SQL either."""
    config = EngineConfig(from_open_wait_ns=40_000, reorder_entries=16, maximum_span=16)
    return recovery.recover(event_arrivals(spark, sf_dir), config).groupBy("channel", "output_kind").agg(F.count("*").alias("records"))


def partial_recovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A start in the middle of the day, with the machine."""
    config = EngineConfig(mode=PARTIAL, initial_hold_ns=200_000, partial_wait_ns=None, reorder_entries=1 << 30, maximum_span=1 << 30)
    records = event_arrivals(spark, sf_dir, drop=False).where("native_sequence >= 100")
    ticks = recovery.recover(records, config, flush=False).where("output_kind in ('tick', 'unmatched')")
    return ticks.groupBy("channel").agg(F.min("native_sequence").alias("origin"))


# ---- decoding round trips


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with all the values that a tick needs; the row's own content is its identity."""
    x = table(spark, sf_dir, "lineitem")
    return x.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), (F.col("l_suppkey") % 50 + 1).alias("channel"), "l_partkey", "l_suppkey", F.col("l_quantity").cast("bigint").alias("qty"), _cents("l_extendedprice").alias("cents"), "l_returnflag", "l_linestatus")


_LINES = "SELECT l_orderkey * 8 + l_linenumber AS seq, l_suppkey % 50 + 1 AS channel, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS qty, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_returnflag, l_linestatus FROM lineitem"


def _sh_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.element_at(F.array(*map(F.lit, "ADTSX")), (F.col("l_partkey") % 5 + 1).cast("int"))
    mark = F.when(kind == "S", F.element_at(F.array(*map(F.lit, ("START", "TRADE", "NONE"))), (F.col("qty") % 3 + 1).cast("int"))).otherwise(F.element_at(F.array(*map(F.lit, "BSN")), (F.col("qty") % 3 + 1).cast("int")))
    content = encode.sh_tick_body(
        sequence=F.col("seq"), channel=F.col("channel"), security=security(F.col("l_suppkey")), type_=kind, mark=mark, price=F.col("cents") % 1_000_000 - 500, quantity=F.col("qty") - 3,
        money=F.col("cents") * 10 - 100_000, buy=F.col("l_partkey"), sell=F.col("l_suppkey") - 2, time=F.lit(93_000_000) + F.col("seq") % 100 * 1000,
    )
    return encode.frames(_lines(spark, sf_dir), SH_TICK, content, ingress=F.col("seq"), receive_ns=F.col("seq") * 1000)


def _tick_columns() -> list[str | Column]:
    named = {"price.p6": "price_p6", "price.p6_valid": "price_valid", "quantity.raw": "quantity", "quantity.valid": "quantity_valid"}
    return ["channel", "native_sequence", "security_id", "action", "side", *(F.col(c).alias(n) for c, n in named.items()), "primary_order_id", "validity", "quality"]


def sh_tick_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_ticks(admit(_sh_frames(spark, sf_dir))).where("kind = 'shanghai_tick' and decode_error is null").select(*_tick_columns(), "aggressor", "phase", F.col("amount.p6").alias("amount_p6"), "matched_quantity")


def _sz_order_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.element_at(F.array(*map(F.lit, (49, 50, 70, 71, 1))), (F.col("l_partkey") % 5 + 1).cast("int"))
    type_ = F.element_at(F.array(*map(F.lit, (49, 50, 85, 2))), (F.col("qty") % 4 + 1).cast("int"))
    content = encode.sz_order_body(channel=F.col("channel") - 1, sequence=F.col("seq"), stream=F.lit("010"), security=security(F.col("l_suppkey")), source=F.lit("102"), price=F.col("cents") - 500_000, quantity=F.col("qty") - 3, side=side, time=F.lit(93_000_000) + F.col("seq") % 70 * 1000, type_=type_)
    return encode.frames(_lines(spark, sf_dir), SZ_ORDER, content, ingress=F.col("seq"), receive_ns=F.col("seq") * 1000)


def sz_order_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_ticks(admit(_sz_order_frames(spark, sf_dir))).where("kind = 'shenzhen_order' and decode_error is null").select(*_tick_columns(), "order_type", "security_id_source", "md_stream_id")


def _sz_transaction_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    exec_ = F.element_at(F.array(*map(F.lit, (70, 52, 9))), (F.col("l_partkey") % 3 + 1).cast("int"))
    content = encode.sz_transaction_body(channel=F.col("channel") - 1, sequence=F.col("seq"), stream=F.lit("011"), security=security(F.col("l_suppkey")), source=F.lit("102"), buy=F.col("qty") - 10, sell=F.col("l_suppkey") % 7 - 3, price=F.col("cents") - 500_000, quantity=F.col("qty") - 3, exec_=exec_, time=F.lit(93_000_000))
    return encode.frames(_lines(spark, sf_dir), SZ_TRANSACTION, content, ingress=F.col("seq"), receive_ns=F.col("seq") * 1000)


def sz_txn_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_ticks(admit(_sz_transaction_frames(spark, sf_dir))).where("kind = 'shenzhen_transaction' and decode_error is null").select(*_tick_columns(), "buy_order_id", "sell_order_id")


def p6_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _cents("l_extendedprice") * (F.col("l_orderkey") % 7 - 3) * 1_000_000
    x = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return x.select("l_orderkey", "l_linenumber", "raw", *(wire.p6(F.col("raw"), s).alias(f"p6_from_{s}") for s in (0, 3, 4, 6)))


def time_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = (F.col("o_orderkey") * 7919 % 260_000_000).alias("raw")
    return table(spark, sf_dir, "orders").select("o_orderkey", raw).select("o_orderkey", "raw", wire.time_ns(F.col("raw")).alias("ns"))


def null_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.when(F.col("o_orderkey") % 11 == 0, F.lit(NULL_I64)).otherwise(_cents("o_totalprice"))
    x = table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw"))
    d = wire.decimal(F.col("raw"), 4, 64, F.col("raw") > 0)
    return x.select("o_orderkey", d.alias("d")).select("o_orderkey", "d.raw", "d.p6", "d.raw_valid", "d.p6_valid")


def admission_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of orders, spoiled by the order key."""
    k = F.col("seq")
    x = _lines(spark, sf_dir)
    content = encode.sz_order_body(channel=F.col("channel"), sequence=k, stream=F.lit("010"), security=F.lit("000001"), source=F.lit("102"), price=F.lit(1), quantity=F.lit(1), side=F.lit(49), time=F.lit(0), type_=F.lit(50))
    made = x.select("seq", content.column().alias("whole")).withColumn("body", F.when(k % 13 == 8, F.substring("whole", 1, 40)).otherwise(F.col("whole")))
    size = F.octet_length("body") + 23 + F.when(k % 13 == 3, 1).otherwise(0)
    size = F.when(k % 13 == 2, 22).otherwise(size)
    head = encode.header(SZ_ORDER, size, F.lit(0), k, encoding=F.when(k % 13 == 4, 2).otherwise(1), message_size=size, key=(F.lit(6), F.lit(101), F.when(k % 13 == 5, 53).when(k % 13 == 6, 36).otherwise(33)))
    frames = made.select(k.alias("ingress_sequence"), k.alias("receive_monotonic_ns"), F.when(k % 13 == 1, F.substring(head, 1, 20)).otherwise(head).alias("header"), "body")
    config = EngineConfig(streams=tuple(x.key for x in KINDS if x != SZ_TRANSACTION))
    return admit(frames, config).groupBy("admission_result").agg(F.count("*").alias("frames"))


# ---- books

# Where a snapshot's prices and share counts stand in its body.
_HEADER_PRICES = {
    "SH": {"previous_close": 14, "open": 18, "high": 22, "low": 26, "last": 30, "close": 34, "weighted_average_bid": 72, "weighted_average_ask": 88},
    "SZ": {"previous_close": 32, "last": 64, "open": 72, "high": 80, "low": 88, "weighted_average_ask": 152, "weighted_average_bid": 168},
}
_HEADER_SHARES = {"SH": {"volume": 48, "total_bid_quantity": 64, "total_ask_quantity": 80}, "SZ": {"volume": 48, "total_ask_quantity": 144, "total_bid_quantity": 160}}
#: The least price of the queries' headers, before the place and the part are added.
_HEADER_BASE = {"SH": 10_000, "SZ": 10_000_000}


def _book_frames(spark: SparkSession, sf_dir: str, kind: Kind, *, full: bool = False) -> DataFrame:
    """One snapshot for each part, odd ones of Shanghai and even ones of Shenzhen: its line items are the levels of the bids, with queues of one to three orders.

    With `full`, the asks have the same levels the other way round, without queues,
    and each header value is one of its own.
    """
    sh = kind == SH_SNAPSHOT
    item, depth = (16, 236) if sh else (8, 216)
    lines = _lines(spark, sf_dir).where("l_partkey % 2 = 1" if sh else "l_partkey % 2 = 0").select("l_partkey", F.struct("cents", "qty", "seq", "l_suppkey").alias("x"))
    books = lines.groupBy("l_partkey").agg(F.sort_array(F.collect_list("x")).alias("levels"))
    n = F.size("levels")
    queues = F.transform("levels", lambda v: v.qty % 3 + 1)

    def level(v: Column, i: Column) -> Column:
        p, q = v.cents % 900_000 - 1000, v.qty - 2
        before = F.aggregate(F.slice(queues, 1, i), F.lit(0).cast("bigint"), lambda a, b: a + b)
        offset = n * 28 + before * item - (i * 28 + 20)
        parts = [F.lit("00" * 4), encode.little_endian(p, 4), encode.little_endian(q, 8)] if sh else [encode.little_endian(q, 8), encode.little_endian(p, 8)]
        return F.concat(*parts, encode.little_endian(F.lit(3), 4), encode.little_endian(v.qty % 3 + 1, 4), encode.little_endian(offset, 4))

    def queue(v: Column) -> Column:
        one = F.concat(F.lit("00" * 8) if sh else F.lit(""), encode.little_endian(v.qty - 3, 8))
        return F.array_join(F.transform(F.sequence(F.lit(1), (v.qty % 3 + 1).cast("int")), lambda _: one), "")

    def ask(v: Column) -> Column:
        p, q = v.cents % 900_000 + 1, v.qty + 7
        parts = [F.lit("00" * 4), encode.little_endian(p, 4), encode.little_endian(q, 8)] if sh else [encode.little_endian(q, 8), encode.little_endian(p, 8)]
        return F.concat(*parts, encode.little_endian(v.qty % 5, 4), F.lit("00" * 8))

    items = F.concat(F.array_join(F.transform("levels", level), ""), F.array_join(F.transform("levels", queue), ""))
    asks = F.array_join(F.transform(F.reverse("levels"), ask), "") if full else F.lit("")
    book = books.select("l_partkey", n.cast("bigint").alias("n"), items.alias("items"), asks.alias("asks"))
    sec = security(F.col("l_partkey"))
    if sh:
        fields = {0: (F.lit(93_001_000), 4), 10: (F.lit(1), 4), **{at: (F.lit(12345), 4) for at in (14, 18, 22, 26, 30, 34)}, 44: (F.col("n"), 4), 48: (F.lit(1000), 8), 56: (F.col("l_partkey") * 100_000, 8), 64: (F.lit(400), 8), 72: (F.lit(12340), 4), 80: (F.lit(500), 8), 88: (F.lit(12350), 4)}
        texts = {4: sec}
    else:
        fields = {0: (F.lit(93_001_500), 4), 4: (F.lit(7), 4), 32: (F.lit(123_400), 8), 40: (F.col("n"), 8), 48: (F.lit(2000), 8), 56: (F.col("l_partkey") * 10_000, 8), **{at: (F.lit(12_340_000), 8) for at in (64, 72, 80, 88)}, 144: (F.lit(700), 8), 152: (F.lit(12_350_000), 8), 160: (F.lit(600), 8), 168: (F.lit(12_330_000), 8)}
        texts = {8: F.lit("010"), 14: sec, 20: F.lit("102"), 26: F.lit("T0")}
    if full:
        k, size, most = F.col("l_partkey"), 4 if sh else 8, NULL_I32 if sh else NULL_I64
        places = _HEADER_PRICES[kind.market].values()
        fields |= {at: (_HEADER_BASE[kind.market] + at + k % 1000, size) for at in places}
        fields |= {at: (at + k, 8) for at in _HEADER_SHARES[kind.market].values()}
        fields[_HEADER_PRICES[kind.market]["open"]] = (F.when(k % 7 != 0, _HEADER_BASE[kind.market] + k % 1000).otherwise(0), size)
        fields[_HEADER_PRICES[kind.market]["high"]] = (F.when(k % 11 != 0, _HEADER_BASE[kind.market] + k % 1000).otherwise(F.lit(most)), size)
        if sh:
            fields[10] = (k % 3, 4)
            texts[38] = F.when(k % 3 != 0, "TRADE").otherwise("")
        else:
            fields[4] = (k % 5 + 1, 4)
    # the list of bids comes last, its queues right behind it; only the levels count as its items
    lists = {depth: (F.col("n"), 28, F.col("asks"))} if full else {}
    content = encode.body(kind, fields, texts, lists | {depth - 8: (F.col("n"), 28, F.col("items"))})
    return encode.frames(book, kind, content, ingress=F.col("l_partkey"), receive_ns=F.col("l_partkey"))


def _books(spark: SparkSession, sf_dir: str, *, full: bool = False) -> DataFrame:
    frames = _book_frames(spark, sf_dir, SH_SNAPSHOT, full=full).unionByName(_book_frames(spark, sf_dir, SZ_SNAPSHOT, full=full))
    return decode_snapshots(admit(frames))


def book_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _books(spark, sf_dir).select("market", F.col("ingress_sequence").alias("part"), F.posexplode("bids").alias("level", "b"))
    return x.select("market", "part", F.col("level").cast("bigint").alias("level"), F.col("b.price.raw").alias("price"), F.col("b.price.p6").alias("price_p6"), F.col("b.quantity.raw").alias("quantity"), F.col("b.quantity.valid").alias("quantity_valid"), F.col("b.order_count").alias("order_count"))


def book_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _books(spark, sf_dir).select("market", F.col("ingress_sequence").alias("part"), "source_bid_depth", F.size("bids").cast("bigint").alias("retained"), (F.col("quality").bitwiseAND(F.lit(64)) > 0).alias("truncated"), F.col("turnover.p6").alias("turnover_p6"), "trade_count")


def book_asks(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = _books(spark, sf_dir, full=True).select("market", F.col("ingress_sequence").alias("part"), "source_ask_depth", F.posexplode("asks").alias("level", "a"))
    return x.select("market", "part", "source_ask_depth", F.col("level").cast("bigint").alias("level"), F.col("a.price.raw").alias("price"), F.col("a.price.p6").alias("price_p6"), F.col("a.quantity.raw").alias("quantity"), F.col("a.quantity.scale").cast("int").alias("scale"), F.col("a.order_count").alias("order_count"))


def snapshot_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything of a snapshot but its levels."""
    prices = [F.col(f"{name}.{part}").alias(f"{name}_{part}") for name in _HEADER_PRICES["SH"] for part in ("p6", "p6_valid")]
    shares = [F.col(f"{name}.raw").alias(name) for name in _HEADER_SHARES["SH"]]
    plain = ["security_id", "security_id_source", "md_stream_id", "channel", "vendor_local_time_ns", "exchange_time_ns", "trade_count", "image_status_valid", "instrument_status_code", "trading_phase_code", "quality"]
    return _books(spark, sf_dir, full=True).select("market", F.col("ingress_sequence").alias("part"), *plain, F.col("image_status").cast("int").alias("image_status"), F.col("high.raw_valid").alias("high_raw_valid"), F.col("turnover.p6").alias("turnover_p6"), *prices, *shares)


def queue_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _books(spark, sf_dir).select("market", F.col("ingress_sequence").alias("part"), (F.col("quality").bitwiseAND(F.lit(4)) > 0).alias("bad_quantity"), (F.col("quality").bitwiseAND(F.lit(8)) > 0).alias("bad_price"), F.coalesce("decode_error", F.lit("none")).alias("decode_error"))


_BOOK = f"""WITH l AS ({_LINES}),
b AS (SELECT CASE WHEN l_partkey % 2 = 1 THEN 'SH' ELSE 'SZ' END AS market, l_partkey AS part, cents, qty, seq, l_suppkey,
      row_number() OVER (PARTITION BY l_partkey ORDER BY cents, qty, seq, l_suppkey) - 1 AS level FROM l)"""



def _header_sql() -> str:
    """Each header value by its rule, for both markets."""

    def price(market: str, name: str) -> tuple[str, str]:
        if name not in _HEADER_PRICES[market]:
            return "0", "false"
        at, base = _HEADER_PRICES[market][name], _HEADER_BASE[market]
        scale = 1000 if market == "SH" else 100 if name == "previous_close" else 1
        absent = {"open": "part % 7 = 0", "high": "part % 11 = 0"}.get(name)
        value = f"({base} + part % 1000{'' if absent else f' + {at}'}) * {scale}"
        return (f"CASE WHEN {absent} THEN 0 ELSE {value} END", f"NOT ({absent})") if absent else (value, "true")

    def of(market: str) -> str:
        sh = market == "SH"
        plain = {
            "security_id": "'S' || part", "security_id_source": "''" if sh else "'102'", "md_stream_id": "''" if sh else "'010'", "channel": "CAST(0 AS BIGINT)" if sh else "part % 5 + 1", "vendor_local_time_ns": "CAST(34200000000000 AS BIGINT)",
            "exchange_time_ns": "CAST(34201000000000 AS BIGINT)" if sh else "CAST(34201500000000 AS BIGINT)", "trade_count": "n", "image_status_valid": "true" if sh else "false",
            "instrument_status_code": "CASE WHEN part % 3 = 0 THEN '' ELSE 'TRADE' END" if sh else "''", "trading_phase_code": "''" if sh else "'T0'", "image_status": f"CAST({'part % 3' if sh else '0'} AS INTEGER)", "high_raw_valid": "part % 11 <> 0", "turnover_p6": "part * 1000000",
            "quality": "CAST(CASE WHEN part % 11 = 0 THEN 1 ELSE 0 END + CASE WHEN bad_quantity THEN 4 ELSE 0 END + CASE WHEN bad_price OR part % 7 = 0 THEN 8 ELSE 0 END + CASE WHEN n > 10 THEN 64 ELSE 0 END AS BIGINT)",
        }
        for name in _HEADER_PRICES["SH"]:
            value, there = price(market, name)
            plain |= {f"{name}_p6": f"CAST({value} AS BIGINT)", f"{name}_p6_valid": there}
        plain |= {name: f"part + {at}" for name, at in _HEADER_SHARES[market].items()}
        return f"SELECT market, part, {', '.join(f'{plain[name]} AS {name}' for name in sorted(plain))} FROM h WHERE market = '{market}'"

    return _BOOK + ", h AS (SELECT market, part, count(*) AS n, bool_or(qty < 3) AS bad_quantity, bool_or(cents % 900000 - 1000 <= 0) AS bad_price FROM b GROUP BY market, part) " + of("SH") + " UNION ALL " + of("SZ")


def route_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames and different route keys of a family; of ticks also the least and the greatest key, else 0."""
    frames = [_sh_frames(spark, sf_dir), _sz_order_frames(spark, sf_dir), _book_frames(spark, sf_dir, SH_SNAPSHOT), _book_frames(spark, sf_dir, SZ_SNAPSHOT)]
    keys = reduce(DataFrame.unionByName, (route_key(admit(x)).groupBy("kind", "route_key").agg(F.count("*").alias("n")) for x in frames))
    tick = F.when(F.col("kind").isin(SH_TICK.name, SZ_ORDER.name), F.col("route_key")).otherwise(0)
    return keys.groupBy("kind").agg(F.sum("n").alias("frames"), F.count("route_key").alias("keys"), F.min(tick).alias("least"), F.max(tick).alias("greatest"))


# ---- catalog and dispatch


def catalog_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = supplier_definitions(spark, sf_dir)
    k = F.col("instrument_id")
    spoiled = d.withColumns(
        {"security_id": F.when(k % 17 == 0, "").when(k % 19 == 0, F.lit("S1")).otherwise(F.col("security_id")), "security_id_source": F.when(k % 23 == 0, "").otherwise(F.col("security_id_source")), "market": F.when(k % 29 == 0, "HK").otherwise(F.col("market"))}
    )
    return problems(spoiled)


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return supplier_definitions(spark, sf_dir).where("instrument_id % 4 != 0").withColumnRenamed("ordinal", "instrument_ordinal")


def owner_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select(F.when(F.col("l_suppkey") % 2 == 1, "SH").otherwise("SZ").alias("market"), F.when(F.col("l_suppkey") % 2 == 1, "").otherwise("102").alias("security_id_source"), security(F.col("l_suppkey")).alias("security_id"), "qty")
    owned = dispatch.with_owner(match(lines, _catalog(spark, sf_dir)), 6)
    return owned.groupBy("owner", "catalog_match").agg(F.count("*").alias("records"), F.sum("qty").alias("quantity"))


# discovery ends with the first new position that arrives when the hold of 200,000 ns is over
_DISCOVERY = """, s AS (SELECT * FROM arrivals WHERE seq >= 100), b AS (SELECT channel, min(ingress) * 1000 AS begins FROM s GROUP BY channel),
ends AS (SELECT channel, min(first_at) AS e FROM (SELECT channel, seq, min(ingress) AS first_at FROM s GROUP BY ALL) JOIN b USING (channel) WHERE first_at * 1000 >= begins + 200000 GROUP BY channel)
"""
_EVERY = _AT_ONCE + """,
h AS (SELECT g.*, cents % 100000 + 1 AS price, x.gap_first, x.gap_last, NOT late AND matched AND epoch > 0 AND row_number() OVER (PARTITION BY g.channel, g.epoch, late, matched ORDER BY ingress) = 1 AS first_after
      FROM g LEFT JOIN (SELECT channel, epoch, frontier + 1 AS gap_first, seq - 1 AS gap_last FROM g WHERE is_gap) x USING (channel, epoch))
"""

SQL: dict[str, str] = {
    "ordered_ticks": _AT_ONCE + "SELECT channel, seq AS native_sequence, ingress AS ingress_sequence, epoch AS gap_epoch, epoch = 0 AS history_complete FROM g WHERE NOT late AND matched",
    "channel_gaps": _AT_ONCE + _GAPS,
    "late_recovery": _AT_ONCE + "SELECT channel, ingress AS ingress_sequence, seq AS native_sequence, frontier + 1 AS committed_next_sequence, epoch AS observed_gap_epoch, matched AS catalog_match FROM g WHERE late",
    "gap_mailbox": _AT_ONCE + ", m AS (" + _GAPS + ") SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY channel ORDER BY gap_epoch DESC) = 1",
    "gap_metadata_on_next": _AT_ONCE + """, n AS (SELECT channel, epoch, min(seq) AS seq FROM g WHERE NOT late AND matched AND epoch > 0 GROUP BY ALL),
x AS (SELECT channel, epoch, frontier + 1 AS gap_first, seq - 1 AS gap_last FROM g WHERE is_gap)
SELECT n.channel, n.seq AS native_sequence, n.epoch AS gap_epoch, gap_first, gap_last FROM n JOIN x USING (channel, epoch)""",
    "history_quality": _AT_ONCE + "SELECT channel, count(*) FILTER (epoch = 0) AS complete, count(*) FILTER (epoch > 0) AS incomplete FROM g WHERE NOT late AND matched GROUP BY channel",
    "catalog_continuity": _AT_ONCE + "SELECT channel, CASE WHEN late THEN 'late' WHEN seq % 3 <> 0 THEN 'tick' ELSE 'unmatched' END AS output_kind, count(*) AS records, count(*) FILTER (is_gap) AS gaps FROM g GROUP BY ALL",
    "order_check": _HOLES + """SELECT channel, count(*) AS arrived, CAST(0 AS BIGINT) AS emitted
FROM (SELECT channel, seq, lag(seq) OVER (PARTITION BY channel ORDER BY ingress) AS previous FROM arrivals) WHERE seq <= previous GROUP BY channel""",
    "pending_dups": _WHOLE + _PATIENT + "SELECT channel, kind AS output_kind, count(*) AS records FROM kinds GROUP BY ALL",
    "reorder_delay": _WHOLE + _PATIENT + "SELECT channel, seq AS native_sequence, commit_at, commit_at - ingress AS delay FROM kinds WHERE kind = 'tick'",
    "latency_percentiles": _WHOLE + _PATIENT + """, d AS (SELECT channel, list(commit_at - ingress ORDER BY commit_at - ingress) AS v FROM kinds WHERE kind = 'tick' GROUP BY channel)
SELECT channel, v[1 + CAST(floor(0.5 * (len(v) - 1)) AS BIGINT)] AS p50, v[1 + CAST(floor(0.9 * (len(v) - 1)) AS BIGINT)] AS p90,
       v[1 + CAST(floor(0.99 * (len(v) - 1)) AS BIGINT)] AS p99, v[1 + CAST(floor(0.999 * (len(v) - 1)) AS BIGINT)] AS p999, v[len(v)] AS max_all FROM d""",
    "conflict_faults": _ALTERED + _PATIENT + """, clash AS (SELECT k.channel, k.ingress, k.seq FROM kinds k JOIN arrivals a ON a.channel = k.channel AND a.ingress = k.first_at WHERE kind = 'duplicate' AND a.cents <> k.cents),
first_clash AS (SELECT channel, min(ingress) AS frozen_at, arg_min(seq, ingress) AS observed_sequence FROM clash GROUP BY channel)
SELECT c.channel, frozen_at, observed_sequence, (SELECT count(*) FROM commits m WHERE m.channel = c.channel AND m.commit_at < frozen_at) + 1 AS expected_sequence FROM first_clash c""",
    "partial_start": _WHOLE + _DISCOVERY + "SELECT channel, e * 1000 AS discovery_ends_ns, min(seq) AS origin FROM s JOIN ends USING (channel) WHERE ingress <= e GROUP BY ALL",
    "machine_events": _AT_ONCE + """SELECT channel, CASE WHEN late THEN 'late' ELSE 'tick' END AS output_kind, ingress AS ingress_sequence, seq AS native_sequence,
  CASE WHEN late OR first_after THEN epoch ELSE 0 END AS gap_epoch, CASE WHEN first_after THEN gap_first END AS gap_first, CASE WHEN first_after THEN gap_last END AS gap_last
FROM (SELECT g.*, x.gap_first, x.gap_last, NOT late AND matched AND epoch > 0 AND row_number() OVER (PARTITION BY g.channel, g.epoch, late, matched ORDER BY ingress) = 1 AS first_after
      FROM g LEFT JOIN (SELECT channel, epoch, frontier + 1 AS gap_first, seq - 1 AS gap_last FROM g WHERE is_gap) x USING (channel, epoch)) WHERE late OR matched
UNION ALL SELECT channel, 'gap', NULL, NULL, epoch, frontier + 1, seq - 1 FROM g WHERE is_gap""",
    "machine_patient": _WHOLE + _PATIENT + "SELECT channel, CASE WHEN kind IN ('tick', 'pending') THEN CASE WHEN matched THEN 'tick' ELSE 'unmatched' END WHEN kind = 'duplicate' THEN 'dropped' ELSE kind END AS output_kind, count(*) AS records FROM kinds GROUP BY ALL",
    "partial_recovery": _WHOLE + _DISCOVERY + "SELECT channel, min(seq) AS origin FROM s JOIN ends USING (channel) WHERE ingress <= e GROUP BY channel",
    "p6_normalize": """WITH l AS (SELECT l_orderkey, l_linenumber, CAST(round(l_extendedprice * 100) AS BIGINT) * (l_orderkey % 7 - 3) * 1000000 AS raw FROM lineitem)
SELECT l_orderkey, l_linenumber, raw, TRY_CAST(CAST(raw AS HUGEINT) * 1000000 AS BIGINT) AS p6_from_0, TRY_CAST(CAST(raw AS HUGEINT) * 1000 AS BIGINT) AS p6_from_3, TRY_CAST(CAST(raw AS HUGEINT) * 100 AS BIGINT) AS p6_from_4, raw AS p6_from_6 FROM l""",
    "time_decode": """WITH o AS (SELECT o_orderkey, o_orderkey * 7919 % 260000000 AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN raw // 10000000 < 24 AND raw // 100000 % 100 < 60 AND raw // 1000 % 100 < 60
  THEN (((raw // 10000000) * 3600 + (raw // 100000 % 100) * 60 + raw // 1000 % 100) * 1000 + raw % 1000) * 1000000 END AS ns FROM o""",
    "null_sentinels": """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN -9223372036854775808 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS raw,
  CASE WHEN o_orderkey % 11 = 0 OR round(o_totalprice * 100) <= 0 THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) * 100 END AS p6, o_orderkey % 11 <> 0 AS raw_valid, o_orderkey % 11 <> 0 AND round(o_totalprice * 100) > 0 AS p6_valid FROM orders""",
    "admission_results": f"""WITH l AS ({_LINES}) SELECT CASE seq % 13 WHEN 1 THEN 'header_truncated' WHEN 2 THEN 'header_invalid' WHEN 3 THEN 'body_size_mismatch' WHEN 4 THEN 'non_binary_encoding'
  WHEN 5 THEN 'unsupported_message' WHEN 6 THEN 'disabled_message' WHEN 8 THEN 'body_truncated' ELSE 'accepted' END AS admission_result, count(*) AS frames FROM l GROUP BY ALL""",
    "book_top10": _BOOK + """SELECT market, part, level, cents % 900000 - 1000 AS price, CASE WHEN cents % 900000 - 1000 > 0 THEN (cents % 900000 - 1000) * CASE WHEN market = 'SH' THEN 1000 ELSE 1 END ELSE 0 END AS price_p6,
  qty - 2 AS quantity, qty >= 2 AS quantity_valid, CAST(3 AS BIGINT) AS order_count FROM b WHERE level < 10""",
    "book_truncated": _BOOK + """SELECT market, part, count(*) AS source_bid_depth, CAST(least(count(*), 10) AS BIGINT) AS retained, count(*) > 10 AS truncated,
  part * 1000000 AS turnover_p6, count(*) AS trade_count FROM b GROUP BY market, part""",
    "book_asks": _BOOK + """, a AS (SELECT *, count(*) OVER (PARTITION BY part) AS n FROM b)
SELECT market, part, n AS source_ask_depth, n - 1 - level AS level, cents % 900000 + 1 AS price, (cents % 900000 + 1) * CASE WHEN market = 'SH' THEN 1000 ELSE 1 END AS price_p6, qty + 7 AS quantity,
  CASE WHEN market = 'SH' THEN 3 ELSE 0 END AS scale, qty % 5 AS order_count FROM a WHERE n - 1 - level < 10""",
    "snapshot_headers": _header_sql(),
    "queue_validation": _BOOK + "SELECT market, part, bool_or(qty < 3) AS bad_quantity, bool_or(cents % 900000 - 1000 <= 0) AS bad_price, 'none' AS decode_error FROM b GROUP BY market, part",
    "catalog_validate": """WITH d AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 29 = 0 THEN 'HK' WHEN s_suppkey % 2 = 1 THEN 'SH' ELSE 'SZ' END AS market,
  CASE WHEN s_suppkey % 23 = 0 OR s_suppkey % 2 = 1 THEN '' ELSE '102' END AS source, CASE WHEN s_suppkey % 17 = 0 THEN '' WHEN s_suppkey % 19 = 0 THEN 'S1' ELSE 'S' || s_suppkey END AS security FROM supplier),
p AS (SELECT 'instrument_id must be positive' AS problem, count(*) AS instruments FROM d WHERE k <= 0 UNION ALL SELECT 'market must be SH or SZ', count(*) FROM d WHERE market = 'HK'
  UNION ALL SELECT 'security_id must be 1 to 32 printable bytes', count(*) FROM d WHERE security = '' UNION ALL SELECT 'security_id_source must be empty for SH', count(*) FROM d WHERE market = 'SH' AND source <> ''
  UNION ALL SELECT 'security_id_source must be 1 to 32 printable bytes for SZ', count(*) FROM d WHERE market = 'SZ' AND source = ''
  UNION ALL SELECT 'identity must be unique', coalesce(CAST(sum(n) AS BIGINT), 0) FROM (SELECT count(*) AS n FROM d GROUP BY market, source, security HAVING count(*) > 1))
SELECT problem, instruments FROM p WHERE instruments > 0""",
    "owner_dispatch": f"""WITH l AS ({_LINES}), s AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS ordinal FROM supplier),
j AS (SELECT CASE WHEN l_suppkey % 4 <> 0 THEN ordinal % 6 END AS owner, ordinal IS NOT NULL AND l_suppkey % 4 <> 0 AS catalog_match, qty FROM l LEFT JOIN s ON s_suppkey = l_suppkey)
SELECT CAST(owner AS INTEGER) AS owner, catalog_match, count(*) AS records, CAST(sum(qty) AS BIGINT) AS quantity FROM j GROUP BY ALL""",
}
SQL["stream_replay"] = SQL["machine_events"]
SQL["engine_ticks"] = _EVERY + """SELECT channel, seq AS native_sequence, ingress AS ingress_sequence, seq % 7 + 1 AS instrument_id, CAST(seq % 7 % 3 AS INTEGER) AS owner, price * 1000 AS price_p6,
  CASE WHEN first_after THEN gap_first END AS gap_first, CASE WHEN first_after THEN gap_last END AS gap_last, CAST(2635 + CASE WHEN epoch = 0 THEN 4096 ELSE 0 END AS BIGINT) AS validity,
  CAST(CASE WHEN epoch = 0 THEN 0 ELSE 512 END + CASE WHEN first_after THEN 256 ELSE 0 END AS BIGINT) AS quality FROM h WHERE NOT late AND matched"""
SQL["engine_owner"] = _AT_ONCE + "SELECT CAST(seq % 7 % 3 AS INTEGER) AS owner, seq % 7 + 1 AS instrument_id, count(*) AS records, max(seq) AS last_sequence FROM g WHERE NOT late AND matched GROUP BY ALL"
SQL["engine_late"] = _AT_ONCE + """SELECT channel, ingress AS ingress_sequence, seq AS native_sequence, frontier + 1 AS committed_next_sequence, epoch AS observed_gap_epoch, 'behind_committed_frontier' AS reason, matched AS catalog_match,
  CAST(2635 AS BIGINT) AS validity, CAST(8704 + CASE WHEN matched THEN 0 ELSE 128 END AS BIGINT) AS quality FROM g WHERE late"""
SQL["stats_counters"] = _AT_ONCE + """SELECT count(*) + count(*) FILTER (ingress % 10 = 3) AS callbacks, count(*) AS admitted, count(*) FILTER (ingress % 10 = 3) AS rejected, count(*) AS decoded_ticks, CAST(0 AS BIGINT) AS decoded_snapshots,
  CAST(0 AS BIGINT) AS dispatched_snapshots, count(*) FILTER (NOT late AND matched) AS dispatched_ticks, count(*) FILTER (late) AS duplicates_or_late, count(*) FILTER (late) AS late_recovery_dispatched, count(*) FILTER (is_gap) AS gaps_skipped,
  CAST(0 AS BIGINT) AS from_open_channels_frozen, CAST(0 AS BIGINT) AS channel_faults_dispatched, CAST(0 AS BIGINT) AS decode_errors, count(*) FILTER (NOT matched) AS catalog_misses FROM g"""
SQL["route_keys"] = f"""WITH l AS ({_LINES}), k AS (SELECT 'shanghai_tick' AS kind, (CAST(4 AS BIGINT) << 32) + channel AS key, true AS tick FROM l UNION ALL SELECT 'shenzhen_order', (CAST(6 AS BIGINT) << 32) + channel - 1, true FROM l
  UNION ALL SELECT DISTINCT CASE WHEN l_partkey % 2 = 1 THEN 'shanghai_snapshot' ELSE 'shenzhen_snapshot' END, l_partkey, false FROM l)
SELECT kind, count(*) AS frames, count(DISTINCT key) AS keys, min(CASE WHEN tick THEN key ELSE 0 END) AS least, max(CASE WHEN tick THEN key ELSE 0 END) AS greatest FROM k GROUP BY kind"""
SQL["live_admission"] = _AT_ONCE + """, first AS (SELECT coalesce(min(ingress), 9000000000) AS fatal FROM g WHERE ingress % 700 = 650),
e AS (SELECT ingress AS i, CASE WHEN ingress > fatal THEN 'not_running' WHEN ingress % 700 = 650 THEN 'body_too_large' ELSE 'accepted' END AS r, true AS inside FROM g, first
  UNION ALL SELECT ingress + 1000000000, CASE WHEN ingress + 1000000000 > fatal THEN 'not_running' ELSE 'header_truncated' END, true FROM g, first WHERE ingress % 10 = 3
  UNION ALL SELECT ingress + 2000000000, ['null_message', 'header_truncated', 'body_truncated'][ingress % 50 - 6], false FROM g WHERE ingress % 50 IN (7, 8, 9))
SELECT r AS reported_result, inside AS reaches_engine, count(*) AS frames, min(i) AS first_ingress FROM e GROUP BY r, inside"""
SQL["channel_capacity"] = _AT_ONCE + """, c AS (SELECT channel, min(ingress) AS ingress_sequence FROM g GROUP BY channel)
SELECT ingress_sequence, 'channel_capacity' AS fault FROM (SELECT *, row_number() OVER (ORDER BY ingress_sequence, channel) AS turn FROM c) WHERE turn > 3"""
SQL["machine_conflicts"] = SQL["conflict_faults"].replace("SELECT c.channel, frozen_at, observed_sequence,", "SELECT c.channel, 'canonical_conflict' AS reason, observed_sequence,")

SQL["sz_order_roundtrip"] = f"""WITH l AS ({_LINES}), v AS (SELECT *, cents - 500000 AS price, qty - 3 AS q,
  CASE l_partkey % 5 WHEN 0 THEN 'buy' WHEN 1 THEN 'sell' WHEN 2 THEN 'lend' WHEN 3 THEN 'borrow' ELSE 'unknown' END AS side,
  CASE qty % 4 WHEN 0 THEN 'market' WHEN 1 THEN 'limit' WHEN 2 THEN 'same_side_best' ELSE 'unknown' END AS order_type, seq % 70 < 60 AS timely FROM l)
SELECT channel - 1 AS channel, seq AS native_sequence, 'S' || l_suppkey AS security_id, 'add' AS action, side,
  CASE WHEN order_type = 'limit' AND price > 0 THEN price * 100 ELSE 0 END AS price_p6, order_type = 'limit' AND price > 0 AS price_valid, q AS quantity, q >= 0 AS quantity_valid, seq AS primary_order_id,
  CAST(CASE WHEN order_type = 'limit' AND price > 0 THEN 1 ELSE 0 END + CASE WHEN q >= 0 THEN 2 ELSE 0 END + 8 + CASE WHEN side <> 'unknown' THEN 64 ELSE 0 END + CASE WHEN order_type <> 'unknown' THEN 256 ELSE 0 END
    + CASE WHEN timely THEN 512 ELSE 0 END + 4096 AS BIGINT) AS validity,
  CAST(CASE WHEN timely THEN 0 ELSE 2 END + CASE WHEN q < 0 THEN 4 ELSE 0 END + CASE WHEN order_type = 'limit' AND price <= 0 THEN 8 ELSE 0 END + CASE WHEN side = 'unknown' OR order_type = 'unknown' THEN 16 ELSE 0 END AS BIGINT) AS quality,
  order_type, '102' AS security_id_source, '010' AS md_stream_id FROM v"""
SQL["sz_txn_roundtrip"] = f"""WITH l AS ({_LINES}), v AS (SELECT *, cents - 500000 AS price, qty - 3 AS q, qty - 10 AS buy, l_suppkey % 7 - 3 AS sell, CASE l_partkey % 3 WHEN 0 THEN 'trade' WHEN 1 THEN 'cancel' ELSE 'unknown' END AS action FROM l),
w AS (SELECT *, action = 'trade' AND price > 0 AS priced, action = 'cancel' AND (buy > 0) <> (sell > 0) AS alone FROM v)
SELECT channel - 1 AS channel, seq AS native_sequence, 'S' || l_suppkey AS security_id, action, CASE WHEN alone THEN CASE WHEN buy > 0 THEN 'buy' ELSE 'sell' END ELSE 'unknown' END AS side,
  CASE WHEN priced THEN price * 100 ELSE 0 END AS price_p6, priced AS price_valid, q AS quantity, q >= 0 AND action <> 'unknown' AS quantity_valid, CASE WHEN alone THEN CASE WHEN buy > 0 THEN buy ELSE sell END ELSE 0 END AS primary_order_id,
  CAST(CASE WHEN priced THEN 1 ELSE 0 END + CASE WHEN action <> 'unknown' THEN CASE WHEN q >= 0 THEN 2 ELSE 0 END + CASE WHEN buy > 0 THEN 16 ELSE 0 END + CASE WHEN sell > 0 THEN 32 ELSE 0 END ELSE 0 END
    + CASE WHEN alone THEN 72 ELSE 0 END + 512 + 4096 AS BIGINT) AS validity,
  CAST(CASE WHEN buy < 0 OR sell < 0 THEN 2048 ELSE 0 END + CASE WHEN q < 0 THEN 4 ELSE 0 END + CASE WHEN action = 'trade' AND price <= 0 THEN 8 ELSE 0 END + CASE WHEN action = 'cancel' AND NOT alone THEN 32 ELSE 0 END
    + CASE WHEN action = 'unknown' THEN 16 ELSE 0 END AS BIGINT) AS quality, buy AS buy_order_id, sell AS sell_order_id FROM w"""
SQL["sh_tick_roundtrip"] = f"""WITH l AS ({_LINES}), v AS (SELECT *, cents % 1000000 - 500 AS price, qty - 3 AS q, cents * 10 - 100000 AS money, l_partkey AS buy, l_suppkey - 2 AS sell, ['A', 'D', 'T', 'S', 'X'][l_partkey % 5 + 1] AS t FROM l),
w AS (SELECT *, CASE WHEN t = 'S' THEN ['START', 'TRADE', 'NONE'][qty % 3 + 1] ELSE ['B', 'S', 'N'][qty % 3 + 1] END AS m FROM v),
x AS (SELECT *, t IN ('A', 'T') AND price > 0 AS priced, t IN ('A', 'D') AND m = 'B' AS buys, t IN ('A', 'D') AND m = 'S' AS sells, t = 'T' AND money >= 0 AS paid, t = 'A' AND money >= 0 AND money % 1000 = 0 AS matched, seq % 100 < 60 AS timely FROM w),
y AS (SELECT *, CASE WHEN buys THEN buy WHEN sells THEN sell ELSE 0 END AS primary_id, CASE WHEN t = 'S' THEN CASE m WHEN 'START' THEN 'start' WHEN 'TRADE' THEN 'continuous' ELSE 'unknown' END ELSE 'unknown' END AS phase FROM x)
SELECT channel, seq AS native_sequence, 'S' || l_suppkey AS security_id, CASE t WHEN 'A' THEN 'add' WHEN 'D' THEN 'cancel' WHEN 'T' THEN 'trade' WHEN 'S' THEN 'status' ELSE 'unknown' END AS action,
  CASE WHEN buys THEN 'buy' WHEN sells THEN 'sell' ELSE 'unknown' END AS side, CASE WHEN priced THEN price * 1000 ELSE 0 END AS price_p6, priced AS price_valid, q AS quantity, q >= 0 AND t IN ('A', 'D', 'T') AS quantity_valid, primary_id AS primary_order_id,
  CAST(CASE WHEN priced THEN 1 ELSE 0 END + CASE WHEN q >= 0 AND t IN ('A', 'D', 'T') THEN 2 ELSE 0 END + CASE WHEN paid THEN 4 ELSE 0 END + CASE WHEN (buys OR sells) AND primary_id > 0 THEN 8 ELSE 0 END
    + CASE WHEN t = 'T' AND buy > 0 THEN 16 ELSE 0 END + CASE WHEN t = 'T' AND sell > 0 THEN 32 ELSE 0 END + CASE WHEN buys OR sells THEN 64 ELSE 0 END + CASE WHEN t = 'T' THEN 128 ELSE 0 END
    + CASE WHEN timely THEN 512 ELSE 0 END + CASE WHEN phase <> 'unknown' THEN 1024 ELSE 0 END + CASE WHEN matched THEN 2048 ELSE 0 END + 4096 AS BIGINT) AS validity,
  CAST(CASE WHEN timely THEN 0 ELSE 2 END + CASE WHEN q < 0 OR (t = 'A' AND money < 0) THEN 4 ELSE 0 END + CASE WHEN t IN ('A', 'T') AND price <= 0 THEN 8 ELSE 0 END
    + CASE WHEN t = 'X' OR (t IN ('A', 'D') AND m = 'N') OR (t = 'S' AND phase = 'unknown') THEN 16 ELSE 0 END + CASE WHEN t = 'T' AND money < 0 THEN 1024 ELSE 0 END
    + CASE WHEN buy < 0 OR sell < 0 THEN 2048 ELSE 0 END + CASE WHEN t = 'A' AND money >= 0 AND money % 1000 <> 0 THEN 4096 ELSE 0 END AS BIGINT) AS quality,
  CASE WHEN t = 'T' THEN CASE m WHEN 'B' THEN 'buy' WHEN 'S' THEN 'sell' ELSE 'neutral' END ELSE 'unknown' END AS aggressor, phase, CASE WHEN paid THEN money * 1000 ELSE 0 END AS amount_p6, CASE WHEN matched THEN money // 1000 ELSE 0 END AS matched_quantity FROM y"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        ordered_ticks, channel_gaps, late_recovery, gap_mailbox, gap_metadata_on_next, history_quality, catalog_continuity, order_check, engine_ticks, engine_owner, engine_late, stats_counters, live_admission, channel_capacity, stream_replay, pending_dups, reorder_delay, latency_percentiles, conflict_faults,
        partial_start, machine_events, machine_patient, machine_conflicts, bounded_recovery, partial_recovery, sh_tick_roundtrip, sz_order_roundtrip, sz_txn_roundtrip, p6_normalize, time_decode, null_sentinels,
        admission_results, route_keys, book_top10, book_truncated, book_asks, snapshot_headers, queue_validation, catalog_validate, owner_dispatch,
    )
}
