"""Decoding of the three tick families into canonical ticks.

One pass over the frames: a batch is split by family, and all fields, texts and
rules of a family are computed on whole arrays. Records that cannot be decoded
keep their row, with decode_error set, so that recovery can hold their channel.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tickline.functions import arrays as wire
from tickline.functions.arrays import flags
from tickline.functions.fixed import NULL_I32, NULL_I64, QUALITY, SH_PHASES, SH_TICK, SZ_CANCEL, SZ_ORDER, SZ_ORDER_TYPES, SZ_SIDES, SZ_TRADE, SZ_TRANSACTION, VALID, Kind
from tickline.functions.unpack import Bodies
from tickline.operators.admit import COMMON, accepted
from tickline.plans.config import EngineConfig

# Where the fields and the texts of each family stand.
SH_TICK_FIELDS = {"sequence": (0, "<i8"), "channel": (8, "<i4"), "time": (18, "<u4"), "buy": (28, "<i8"), "sell": (36, "<i8"), "price": (44, "<i4"), "qty": (48, "<i8"), "money": (56, "<i8")}
SH_TICK_TEXTS = {"security": 12, "type": 22, "mark": 64}
SZ_ORDER_FIELDS = {"channel": (0, "<u4"), "sequence": (4, "<i8"), "price": (30, "<i8"), "qty": (38, "<i8"), "side": (46, "<i4"), "time": (50, "<u4"), "type": (54, "<i4")}
SZ_ORDER_TEXTS = {"stream": 12, "security": 18, "source": 24}
SZ_TRANSACTION_FIELDS = {"channel": (0, "<u4"), "sequence": (4, "<i8"), "buy": (18, "<i8"), "sell": (26, "<i8"), "price": (46, "<i8"), "qty": (54, "<i8"), "exec": (62, "<i4"), "time": (66, "<u4")}
SZ_TRANSACTION_TEXTS = {"stream": 12, "security": 34, "source": 40}

TICK_KINDS = (SH_TICK, SZ_ORDER, SZ_TRANSACTION)
#: The words of all enumerations of a tick; a column of them is an array of places in this list.
WORDS = ("unknown", "add", "cancel", "trade", "status", "buy", "sell", "borrow", "lend", "neutral", "market", "limit", "same_side_best", *SH_PHASES.values())
WORD = {w: i for i, w in enumerate(WORDS)}
ERRORS = ("count_exceeded", "invalid_offset", "invalid_text", "range_overlap", "invalid_native_sequence", "fixed_point_overflow")
BAD_SEQUENCE, OVERFLOW = 5, 6
MONEY = [("raw", pa.int64()), ("p6", pa.int64()), ("source_scale", pa.int8()), ("raw_valid", pa.bool_()), ("p6_valid", pa.bool_())]
MONEY_DDL = "struct<raw:bigint,p6:bigint,source_scale:tinyint,raw_valid:boolean,p6_valid:boolean>"
TICK_DDL = (
    "ingress_sequence bigint, receive_monotonic_ns bigint, vendor_sequence decimal(20,0), vendor_local_time_raw bigint, vendor_local_time_ns bigint, message_key struct<service_id:int,service_version:int,message_id:int>, kind string, trade_date int, market string, "
    f"security_id_source string, security_id string, md_stream_id string, channel bigint, native_sequence bigint, exchange_time_raw bigint, exchange_time_ns bigint, price {MONEY_DDL}, amount {MONEY_DDL}, quantity struct<raw:bigint,scale:tinyint,valid:boolean>, "
    "primary_order_id bigint, buy_order_id bigint, sell_order_id bigint, matched_quantity bigint, raw_type int, raw_side int, action string, side string, aggressor string, order_type string, phase string, validity bigint, quality bigint, decode_error string"
)
TICK_NAMES = [x.split()[0] for x in TICK_DDL.replace("decimal(20,0)", "decimal").split(", ")]
_WORDS = pa.array(WORDS)
_ERRORS = pa.array([None, *ERRORS])


def _coded(value: np.ndarray, table: dict[int, str]) -> np.ndarray:
    """Words of a code table; what it lacks is unknown."""
    out = np.zeros(len(value), np.int8)
    for code, word in table.items():
        out[value == code] = WORD[word]
    return out


def _chosen(*cases: tuple[np.ndarray, str]) -> np.ndarray:
    return np.select([c for c, _ in cases], [WORD[w] for _, w in cases], 0).astype(np.int8)


def _first(*errors: tuple[np.ndarray, int] | np.ndarray) -> np.ndarray:
    """The first error of each record, by number; 0 for none."""
    out = None
    for e in errors:
        code = e if isinstance(e, np.ndarray) else np.where(e[0], e[1], 0)
        out = code if out is None else np.where(out == 0, code, out)
    return out


def _priced(raw: np.ndarray, null: int, uses: np.ndarray) -> np.ndarray:
    """Quality of a price: the null sentinel always shows, a bad value only where it is used."""
    return flags((raw == null, QUALITY["null_source"]), (uses & (raw != null) & (raw <= 0), QUALITY["price"]))


def _sh_tick(b: Bodies) -> dict:
    price, qty, money, buy, sell, sequence, channel = (b.field(n) for n in ("price", "qty", "money", "buy", "sell", "sequence", "channel"))
    kind, mark = b.letter("type"), b.letter("mark")
    add, cancel, trade, status = (kind == ord(x) for x in "ADTS")
    ordered = add | cancel
    buys, sells, neutral = (mark == ord(x) for x in "BSN")
    priced, paid = (add | trade) & (price > 0), trade & (money >= 0)
    phase_at = pc.index_in(b.text("mark"), value_set=pa.array(list(SH_PHASES))).fill_null(-1).to_numpy(zero_copy_only=False)
    phase = np.where(status & (phase_at >= 0), np.array([WORD[w] for w in SH_PHASES.values()])[phase_at], 0)
    side = _chosen((ordered & buys, "buy"), (ordered & sells, "sell"))
    aggressor = _chosen((trade & buys, "buy"), (trade & sells, "sell"), (trade & neutral, "neutral"))
    primary = np.select([ordered & buys, ordered & sells], [buy, sell], 0)
    has_money = money != NULL_I64
    matched = add & has_money & (money >= 0) & (money % 1000 == 0)
    price_value, price_over = wire.decimal(price.astype(np.int64), 3, 32, priced)
    amount_value, amount_over = wire.decimal(money, 3, 64, paid)
    unknown = ~(ordered | trade | status) | (ordered & (side == 0)) | (trade & (aggressor == 0)) | (status & (phase == 0))
    return {
        "price": price_value, "amount": amount_value, "quantity": (qty, (qty >= 0) & (add | cancel | trade)),
        "primary_order_id": primary, "buy_order_id": buy, "sell_order_id": sell, "matched_quantity": np.where(matched, money // 1000, 0),
        "raw_type": kind.astype(np.int32), "raw_side": mark.astype(np.int32), "action": _coded(kind, {ord("A"): "add", ord("D"): "cancel", ord("T"): "trade", ord("S"): "status"}),
        "side": side, "aggressor": aggressor, "phase": phase,
        "decode_error": _first(((sequence <= 0) | (channel <= 0), BAD_SEQUENCE), b.text_error(), (price_over | amount_over, OVERFLOW)),
        "validity": flags(
            (priced & (price != NULL_I32), VALID["price"]), ((add | cancel | trade) & (qty >= 0), VALID["quantity"]), (paid & has_money, VALID["amount"]), ((side != 0) & (primary > 0), VALID["primary_id"]), (trade & (buy > 0), VALID["buy_id"]),
            (trade & (sell > 0), VALID["sell_id"]), (side != 0, VALID["side"]), (aggressor != 0, VALID["aggressor"]), (phase != 0, VALID["phase"]), (matched, VALID["matched_quantity"]),
        ),
        "quality": _priced(price, NULL_I32, add | trade) | flags(
            ((buy < 0) | (sell < 0), QUALITY["order_reference"]), ((qty < 0) | (add & has_money & (money < 0)), QUALITY["quantity"]), (~has_money, QUALITY["null_source"]), (trade & has_money & (money < 0), QUALITY["amount"]),
            (add & has_money & (money >= 0) & (money % 1000 != 0), QUALITY["matched_quantity"]), (unknown, QUALITY["enum"]),
        ),
    }


def _sz_order(b: Bodies) -> dict:
    price, qty, sequence = b.field("price"), b.field("qty"), b.field("sequence")
    side, order = _coded(b.field("side"), SZ_SIDES), _coded(b.field("type"), SZ_ORDER_TYPES)
    limit = order == WORD["limit"]
    priced = limit & (price > 0)
    value, over = wire.decimal(price, 4, 64, priced)
    return {
        "price": value, "quantity": (qty, qty >= 0), "primary_order_id": sequence, "raw_type": b.field("type"), "raw_side": b.field("side"), "action": np.full(len(qty), WORD["add"]), "side": side, "order_type": order,
        "decode_error": _first(b.text_error(), (sequence <= 0, BAD_SEQUENCE), (over, OVERFLOW)),
        "validity": flags((priced, VALID["price"]), (qty >= 0, VALID["quantity"]), (side != 0, VALID["side"]), (order != 0, VALID["order_type"])) | VALID["primary_id"],
        "quality": _priced(price, NULL_I64, limit) | flags((qty < 0, QUALITY["quantity"]), ((side == 0) | (order == 0), QUALITY["enum"])),
    }


def _sz_transaction(b: Bodies) -> dict:
    price, qty, buy, sell, what, sequence = (b.field(n) for n in ("price", "qty", "buy", "sell", "exec", "sequence"))
    trade, cancel = what == SZ_TRADE, what == SZ_CANCEL
    known, priced = trade | cancel, trade & (price > 0)
    alone = cancel & ((buy > 0) != (sell > 0))
    value, over = wire.decimal(price, 4, 64, priced)
    return {
        "price": value, "quantity": (qty, (qty >= 0) & known), "primary_order_id": np.where(alone, np.where(buy > 0, buy, sell), 0), "buy_order_id": buy, "sell_order_id": sell, "raw_type": what,
        "action": _chosen((trade, "trade"), (cancel, "cancel")), "side": _chosen((alone & (buy > 0), "buy"), (alone, "sell")),
        "decode_error": _first(b.text_error(), (sequence <= 0, BAD_SEQUENCE), (over, OVERFLOW)),
        "validity": flags((priced, VALID["price"]), (known & (qty >= 0), VALID["quantity"]), (known & (buy > 0), VALID["buy_id"]), (known & (sell > 0), VALID["sell_id"]), (alone, VALID["primary_id"] | VALID["side"])),
        "quality": _priced(price, NULL_I64, trade) | flags(((buy < 0) | (sell < 0), QUALITY["order_reference"]), (qty < 0, QUALITY["quantity"]), (cancel & ~alone, QUALITY["ambiguous_order"]), (~known, QUALITY["enum"])),
    }


RULES = {SH_TICK: (SH_TICK_FIELDS, SH_TICK_TEXTS, _sh_tick), SZ_ORDER: (SZ_ORDER_FIELDS, SZ_ORDER_TEXTS, _sz_order), SZ_TRANSACTION: (SZ_TRANSACTION_FIELDS, SZ_TRANSACTION_TEXTS, _sz_transaction)}


def _canonical(batch: pa.RecordBatch, kind: Kind, config: EngineConfig) -> pa.RecordBatch:
    """The canonical ticks of frames of one family; values that it has none of are unknown, zero or invalid."""
    fields, texts, rules = RULES[kind]
    n = batch.num_rows
    b = Bodies(batch.column("body"), kind, fields, texts, config.maximum_text_bytes)
    zero = np.zeros(n, np.int64)
    nothing = (zero, zero, 0, zero > 0, zero > 0)
    got = rules(b)
    local, local_ok = wire.time_ns(batch.column("vendor_local_time_raw").to_numpy(zero_copy_only=False))
    raw_time = b.field("time")
    exchange, exchange_ok = wire.time_ns(raw_time)
    times = wire.time_flags(batch.column("vendor_local_time_raw").to_numpy(zero_copy_only=False), local_ok) | wire.time_flags(raw_time, exchange_ok)

    def money(name: str) -> pa.Array:
        raw, p6, scale, raw_valid, valid = got.get(name, nothing)
        return pa.StructArray.from_arrays([pa.array(raw), pa.array(p6), pa.array(np.full(n, scale, np.int8)), pa.array(raw_valid), pa.array(valid)], names=[x for x, _ in MONEY])

    def constant(value: object, t: pa.DataType) -> pa.Array:
        return pa.repeat(pa.scalar(value, t), n)

    qty, qty_valid = got["quantity"]
    sh = kind == SH_TICK
    columns = {
        **{name: batch.column(name) for name in COMMON[:4]},
        "vendor_local_time_ns": pa.array(local, mask=~local_ok),
        "message_key": pa.StructArray.from_arrays([batch.column(c) for c in COMMON[4:7]], names=list(COMMON[4:7])),
        "kind": constant(kind.name, pa.string()), "trade_date": constant(config.trade_date, pa.int32()), "market": constant(kind.market, pa.string()),
        "security_id_source": constant("", pa.string()) if sh else b.text("source"), "security_id": b.text("security"), "md_stream_id": constant("", pa.string()) if sh else b.text("stream"),
        "channel": pa.array(b.field("channel").astype(np.int64)), "native_sequence": pa.array(b.field("sequence")), "exchange_time_raw": pa.array(raw_time), "exchange_time_ns": pa.array(exchange, mask=~exchange_ok),
        "price": money("price"), "amount": money("amount"),
        "quantity": pa.StructArray.from_arrays([pa.array(qty), constant(0, pa.int8()), pa.array(qty_valid)], names=["raw", "scale", "valid"]),
        **{name: pa.array(got.get(name, zero).astype(np.int64)) for name in ("primary_order_id", "buy_order_id", "sell_order_id", "matched_quantity")},
        **{name: pa.array(got.get(name, zero).astype(np.int32)) for name in ("raw_type", "raw_side")},
        **{name: _WORDS.take(pa.array(got.get(name, zero))) for name in ("action", "side", "aggressor", "order_type", "phase")},
        "validity": pa.array(got["validity"] | flags((exchange_ok, VALID["exchange_time"])) | VALID["history"]), "quality": pa.array(got["quality"] | times),
        "decode_error": _ERRORS.take(pa.array(got["decode_error"])),
    }
    return pa.RecordBatch.from_arrays([columns[name] for name in TICK_NAMES], names=TICK_NAMES)


def decode_ticks(admitted: DataFrame, config: EngineConfig | None = None) -> DataFrame:
    """Canonical ticks of all accepted tick frames, those that cannot be decoded with decode_error set."""
    config = config or EngineConfig()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind in TICK_KINDS:
                own = batch.filter(pc.equal(batch.column("kind"), kind.name))
                if own.num_rows:
                    yield _canonical(own, kind, config)

    return accepted(admitted, TICK_KINDS).select(*COMMON, "body").mapInArrow(decode, TICK_DDL)
