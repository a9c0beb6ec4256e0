"""The engine's behaviour on small hand-made frames."""

from __future__ import annotations

import struct

import frames as f
import pytest
from pyspark.sql import functions as F

from tickline.functions.fixed import QUALITY, VALID
from tickline.operators.admit import admit, route_key
from tickline.operators.decode_snapshot import decode_snapshots
from tickline.operators.decode_tick import decode_ticks
from tickline.plans.config import PARTIAL, EngineConfig, trade_date_valid
from tickline.plans.pipeline import run, strict

OPEN = EngineConfig(from_open_wait_ns=1_000_000_000, reorder_entries=16, maximum_span=15)
LATER = EngineConfig(mode=PARTIAL, initial_hold_ns=0, partial_wait_ns=0, reorder_entries=16, maximum_span=15)


def outputs(spark, messages, config=OPEN, **more):
    return run(f.table(spark, messages), f.catalog(spark), config, **more)


def seqs(df):
    return [r["native_sequence"] for r in df.orderBy("native_sequence").collect()]


def results(spark, rows, config=None):
    return [r["admission_result"] for r in admit(spark.createDataFrame(rows, f.SCHEMA), config).orderBy("ingress_sequence").collect()]


def test_admission_takes_the_first_reason(spark):
    key, body = f.sh_tick(1)
    body = bytes(body)
    n = len(body)
    rows = [
        (1, 1, f.header(key, n), body), (2, 1, f.header(key, n)[:22], body), (3, 1, f.header(key, n, head=24), body), (4, 1, f.header(key, n, message=10), body), (5, 1, f.header(key, n + 1), body),
        (6, 1, f.header(key, n, encoding=2), body), (7, 1, f.header((6, 101, 53), n), body), (8, 1, f.header(key, 600), bytes(600)), (9, 1, f.header(key, 69), bytes(69)), (10, 1, f.header(key, n), bytes(n)),
        (11, 1, None, None), (12, 1, f.header(key, 0), None),
    ]
    assert results(spark, rows) == ["accepted", "header_truncated", "header_invalid", "header_invalid", "body_size_mismatch", "non_binary_encoding", "unsupported_message", "body_too_large", "body_truncated", "route_invalid", "header_truncated", "body_truncated"]
    assert results(spark, rows[:1], EngineConfig(streams=((4, 101, 4),))) == ["disabled_message"]
    first = route_key(admit(spark.createDataFrame(rows[:1], f.SCHEMA))).first()
    assert (first["vendor_local_time_raw"], int(first["vendor_sequence"]), first["route_key"]) == (93_000_000, 1, (4 << 32) + 1)


def test_vendor_sequence_has_all_64_bits(spark):
    key, body = f.sh_tick(1)
    top = (1 << 64) - 1
    row = admit(spark.createDataFrame([(1, 1, f.header(key, len(body), vendor=top), bytes(body))], f.SCHEMA)).first()
    assert int(row["vendor_sequence"]) == top


def test_from_open_reorders(spark):
    out = outputs(spark, [f.sh_tick(2), f.sh_tick(1)])
    rows = out.ticks.orderBy("native_sequence").collect()
    assert [r["native_sequence"] for r in rows] == [1, 2]
    assert all(r["price"]["p6"] == 12345000 and r["validity"] & VALID["history"] for r in rows)


def test_waits_are_equal_by_default():
    assert EngineConfig().partial_wait_ns == EngineConfig().from_open_wait_ns == 500_000


def test_from_open_timeout_then_late(spark):
    out = outputs(spark, [f.sh_tick(2), f.sh_tick(1)], EngineConfig(from_open_wait_ns=0, reorder_entries=16, maximum_span=15))
    gap = out.gaps.collect()
    assert [(g["first_missing"], g["last_missing"], g["first_present_after_gap"]) for g in gap] == [(1, 1, 2)]
    tick = out.ticks.collect()
    assert [t["native_sequence"] for t in tick] == [2] and not tick[0]["validity"] & VALID["history"]
    late = out.late.collect()
    assert [(x["native_sequence"], x["committed_next_sequence"], x["reason"]) for x in late] == [(1, 3, "behind_committed_frontier")]
    assert late[0]["quality"] & QUALITY["late"]


def test_from_open_small_table(spark):
    out = outputs(spark, [f.sh_tick(s) for s in (2, 3, 4, 5, 6, 1)], EngineConfig(from_open_wait_ns=1_000_000_000, reorder_entries=4, maximum_span=4))
    assert [(g["first_missing"], g["last_missing"], g["gap_epoch"]) for g in out.gaps.collect()] == [(1, 1, 1)]
    assert seqs(out.ticks) == [2, 3, 4, 5, 6]
    assert [(x["native_sequence"], x["committed_next_sequence"]) for x in out.late.collect()] == [(1, 7)]
    assert out.faults.count() == 0


def test_shenzhen_shares_one_sequence(spark):
    out = outputs(spark, [f.sz_transaction(2), f.sz_order(1)])
    rows = out.ticks.orderBy("native_sequence").collect()
    assert [r["kind"] for r in rows] == ["shenzhen_order", "shenzhen_transaction"] and rows[0]["price"]["p6"] == 12340000


def test_partial_gap_and_late(spark):
    out = outputs(spark, [f.sh_tick(s) for s in (10, 12, 11)], LATER)
    ticks = {r["native_sequence"]: r for r in out.ticks.collect()}
    assert set(ticks) == {10, 12} and ticks[10]["quality"] & QUALITY["history_incomplete"]
    assert (ticks[12]["gap_first"], ticks[12]["gap_last"], ticks[12]["gap_epoch"]) == (11, 11, 1) and ticks[12]["quality"] & QUALITY["gap_before"]
    late = out.late.collect()
    assert [(x["native_sequence"], x["committed_next_sequence"], x["observed_gap_epoch"]) for x in late] == [(11, 13, 1)]


def test_partial_small_table(spark):
    config = EngineConfig(mode=PARTIAL, initial_hold_ns=0, partial_wait_ns=1_000_000_000, reorder_entries=4, maximum_span=4)
    out = outputs(spark, [f.sh_tick(s) for s in (3, 5, 6, 7, 8, 9)], config)
    assert [(g["first_missing"], g["last_missing"], g["first_present_after_gap"]) for g in out.gaps.collect()] == [(4, 4, 5)]
    assert seqs(out.ticks) == [3, 5, 6, 7, 8, 9]


def test_mailbox_keeps_the_latest_gap(spark):
    from tickline.operators.dispatch import gap_mailbox, mailbox_jumps

    out = outputs(spark, [f.sh_tick(s, security=b"699999") for s in range(10, 211, 2)], LATER)
    box = gap_mailbox(out.gaps)
    row = box.first()
    assert box.count() == 1 and (row["first_missing"], row["gap_epoch"], row["cumulative_missing_sequences"]) == (209, 100, 100)
    assert mailbox_jumps(box).first()["skipped_epochs"] == 99
    assert out.ticks.count() == 0


def test_foreign_instruments_hold_their_place(spark):
    out = outputs(spark, [f.sh_tick(1, security=b"600001"), f.sh_tick(2)])
    assert [(r["native_sequence"], r["instrument_id"], r["owner"]) for r in out.ticks.collect()] == [(2, 1, 0)]
    assert out.gaps.count() == 0 and out.stats().first()["catalog_misses"] == 1


def test_snapshots(spark):
    out = outputs(spark, [f.sh_snapshot(), f.sz_snapshot()])
    rows = {r["market"]: r for r in out.snapshots.collect()}
    assert rows["SH"]["last"]["p6"] == 12345000 and rows["SH"]["trade_count"] == 5 and rows["SH"]["turnover"]["p6"] == 123450000 and rows["SH"]["instrument_status_code"] == "T"
    assert rows["SZ"]["last"]["p6"] == 12340000 and rows["SZ"]["channel"] == 7 and not rows["SZ"]["close"]["p6_valid"] and rows["SZ"]["trading_phase_code"] == "T0"
    assert rows["SH"]["quality"] == 0 and rows["SZ"]["quality"] == 0


def test_malformed_list_and_shared_bytes(spark):
    key, body = f.sh_snapshot()
    struct.pack_into("<II", body, 228, 1, 8)
    assert decode_snapshots(admit(f.table(spark, [(key, body)]))).first()["decode_error"] == "invalid_offset"
    key, body = f.sh_tick(1)
    struct.pack_into("<HI", body, 22, 6, 48)
    assert decode_ticks(admit(f.table(spark, [(key, body)]))).first()["decode_error"] == "range_overlap"


def test_depth_and_queues(spark):
    row = decode_snapshots(admit(f.table(spark, [f.sh_snapshot([(12340, 500, 1)], [500])]))).first()
    assert row["decode_error"] is None and row["bids"][0]["price"]["p6"] == 12340000 and row["bids"][0]["quantity"]["raw"] == 500 and row["bids"][0]["order_count"] == 1
    deep = decode_snapshots(admit(f.table(spark, [f.sh_snapshot([(12340 - i, 500, 1) for i in range(12)])]))).first()
    assert deep["source_bid_depth"] == 12 and len(deep["bids"]) == 10 and deep["quality"] & QUALITY["depth_truncated"]
    many = decode_snapshots(admit(f.table(spark, [f.sh_snapshot([(12340, 500, 1)], [1, 2])]))).first()
    assert many["decode_error"] == "count_mismatch"
    bad = decode_snapshots(admit(f.table(spark, [f.sh_snapshot([(0, 500, 1)], [-1])]))).first()
    assert bad["quality"] & QUALITY["price"] and bad["quality"] & QUALITY["quantity"]


def test_conflicts(spark):
    out = outputs(spark, [f.sh_tick(2), f.sh_tick(2, price=12346), f.sh_tick(1)])
    assert [(x["reason"], x["expected_sequence"], x["observed_sequence"]) for x in out.faults.collect()] == [("canonical_conflict", 1, 2)]
    assert out.ticks.count() == 0
    config = EngineConfig(mode=PARTIAL, initial_hold_ns=0, partial_wait_ns=1_000_000_000, reorder_entries=16, maximum_span=15)
    out = outputs(spark, [f.sh_tick(10), f.sh_tick(12), f.sh_tick(12, price=12346), f.sh_tick(11)], config)
    assert seqs(out.ticks) == [10, 11, 12]
    assert [(x["native_sequence"], x["reason"], x["price"]["raw"]) for x in out.late.collect()] == [(12, "pending_canonical_conflict", 12346)]


def test_decode_failures(spark):
    out = outputs(spark, [f.sh_tick(1), f.sh_tick(2, price=1, mark=b"\x01"), f.sh_tick(3), f.sh_tick(0)])
    assert seqs(out.ticks) == [1]
    assert [(x["reason"], x["expected_sequence"], x["observed_sequence"]) for x in out.faults.collect()] == [("decode_failure", 2, 2)]
    assert [r["fault"] for r in out.engine_faults.collect()] == ["invalid_native_position"]
    with pytest.raises(RuntimeError, match="invalid_native_position"):
        strict(out)


@pytest.mark.parametrize(
    ("make", "expected"),
    [
        (f.sh_tick(1, price=-(1 << 31), type_=b"D", mark=b"B"), {"quality": QUALITY["null_source"], "action": "cancel", "primary_order_id": 101}),
        (f.sh_tick(1, type_=b"A", mark=b"S", money=5000), {"matched_quantity": 5, "side": "sell", "primary_order_id": 202}),
        (f.sh_tick(1, type_=b"A", mark=b"B", money=5001), {"quality": QUALITY["matched_quantity"], "matched_quantity": 0}),
        (f.sh_tick(1, type_=b"S", mark=b"OCALL"), {"phase": "opening_call", "action": "status"}),
        (f.sh_tick(1, type_=b"Q"), {"action": "unknown", "quality": QUALITY["enum"]}),
        (f.sh_tick(1, money=-1), {"quality": QUALITY["amount"]}),
        (f.sh_tick(1, time=1_000_000_000), {"quality": QUALITY["null_source"] | QUALITY["time"], "exchange_time_ns": None}),
        (f.sh_tick(1, money=(1 << 63) - 1), {"decode_error": "fixed_point_overflow"}),
        (f.sh_tick(1, type_=b"A", money=(1 << 63) - 1), {"decode_error": None}),
        (f.sz_order(1, type_=49, price=-1), {"quality": 0, "order_type": "market"}),
        (f.sz_order(1, price=0), {"quality": QUALITY["price"]}),
        (f.sz_order(1, channel=0), {"decode_error": None, "channel": 0}),
        (f.sz_transaction(1, exec_=52, sell=0), {"side": "buy", "primary_order_id": 111, "action": "cancel"}),
        (f.sz_transaction(1, exec_=52), {"quality": QUALITY["ambiguous_order"]}),
        (f.sz_transaction(1, buy=-1), {"quality": QUALITY["order_reference"]}),
    ],
)
def test_tick_rules(spark, make, expected):
    row = decode_ticks(admit(f.table(spark, [make]))).first()
    assert {k: row[k] for k in expected} == expected


def test_config_and_dates():
    assert trade_date_valid(20240229) and not trade_date_valid(20230229) and not trade_date_valid(19911231) and not trade_date_valid(22010101)
    for bad in ({"trade_date": 20261301}, {"mode": "x"}, {"streams": ()}, {"streams": ((1, 2, 3),)}, {"owners": 0}, {"reorder_entries": 6, "maximum_span": 4}, {"reorder_entries": 4, "maximum_span": 5}, {"maximum_tick_body_bytes": 69}, {"maximum_text_bytes": 33}, {"from_open_wait_ns": -1}):
        with pytest.raises(ValueError):
            EngineConfig(**bad)


def test_empty_tables(spark):
    out = run(spark.createDataFrame([], f.SCHEMA), f.catalog(spark), OPEN)
    assert out.ticks.count() == out.snapshots.count() == out.gaps.count() == 0
    assert out.stats().first()["callbacks"] == 0


def test_reported_results(spark):
    rows = f.table(spark, [f.sh_tick(1), f.sh_tick(2), (*f.sh_tick(3)[:1], bytes(600)), f.sh_tick(4)])
    i = rows.agg({"ingress_sequence": "max"}).first()[0]
    whole = {r["ingress_sequence"]: r for r in rows.collect()}[i]
    odd = [(i + 1, 1, None, None), (i + 2, 1, None, whole["body"]), (i + 3, 1, whole["header"], None), (i + 4, 1, b"\x16" + bytes(whole["header"][1:]), whole["body"]), (i + 5, 1, whole["header"][:20], whole["body"])]
    out = run(rows.unionByName(spark.createDataFrame(odd, f.SCHEMA)), f.catalog(spark), OPEN)
    got = [(r["reported_result"], r["reaches_engine"]) for r in out.reported().orderBy("ingress_sequence").collect()]
    assert got == [("accepted", True), ("accepted", True), ("body_too_large", True), ("not_running", True), ("null_message", False), ("header_truncated", False), ("body_truncated", False), ("header_invalid", False), ("not_running", True)]
    healthy = run(rows.limit(0), f.catalog(spark), OPEN)
    assert healthy.first_fault() is None and healthy.reported().count() == 0


def test_route_keys_of_snapshots(spark):
    messages = [f.sh_snapshot(), f.sh_snapshot([(12340, 500, 1)], [500]), f.sh_snapshot(security=b"600001"), f.sz_snapshot(), f.sh_tick(1), ((4, 101, 4), bytes(100))]
    rows = route_key(admit(f.table(spark, messages))).orderBy("ingress_sequence").collect()
    keys = [r["route_key"] for r in rows]
    assert keys[0] == keys[1] and len(set(keys)) == 5 and keys[4] == (4 << 32) + 1 and keys[5] is None
    by_identity = decode_snapshots(admit(f.table(spark, messages[:4]))).orderBy("ingress_sequence")
    sh, sz = F.xxhash64("market", F.col("security_id").cast("binary")), F.xxhash64("market", F.col("security_id").cast("binary"), F.col("security_id_source").cast("binary"))
    assert keys[:4] == [r[0] for r in by_identity.select(F.when(F.col("market") == "SH", sh).otherwise(sz)).collect()]


def test_channel_capacity(spark):
    frames = f.table(spark, [f.sh_tick(1), f.sh_tick(1, channel=2), f.sh_tick(2), f.sh_tick(1, channel=3), f.sh_tick(2, channel=3)])
    out = run(frames, f.catalog(spark), EngineConfig(maximum_channels=2))
    assert [r["fault"] for r in out.engine_faults.collect()] == ["channel_capacity"]
    assert run(frames, f.catalog(spark), EngineConfig(maximum_channels=3)).first_fault() is None
    with pytest.raises(RuntimeError, match="channel_capacity"):
        strict(out)
    with pytest.raises(ValueError, match="maximum_channels"):
        EngineConfig(maximum_channels=0)
