"""Decoding of the two snapshot families, with their order books.

Levels and their nested queues are read batch by batch; every level is checked,
the first ten of a side are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.functions import wire
from tickline.functions.fixed import BOOK_DEPTH, NULL_I32, NULL_I64, QUALITY, SH_SNAPSHOT, SZ_SNAPSHOT, Kind
from tickline.functions.unpack import with_books
from tickline.operators.admit import COMMON, accepted
from tickline.plans.config import EngineConfig


def _flag(condition: Column, bit: int) -> Column:
    return F.when(condition, bit).otherwise(0).cast("bigint")


def _join(*flags: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), flags)


def _price(raw: Column, scale: int, bits: int) -> tuple[Column, Column, Column]:
    """(struct, quality, overflow) of a price, which must be positive."""
    null = NULL_I32 if bits == 32 else NULL_I64
    good = raw > 0
    quality = F.when(raw == null, QUALITY["null_source"]).when(raw <= 0, QUALITY["price"]).otherwise(0).cast("bigint")
    return wire.decimal(raw, scale, bits, good), quality, wire.overflows(raw.cast("bigint"), scale, bits, good)


def _amount(raw: Column, scale: int) -> tuple[Column, Column, Column]:
    return wire.decimal(raw, scale, 64, F.lit(True)), _flag(raw == NULL_I64, QUALITY["null_source"]), wire.overflows(raw, scale, 64, F.lit(True))


def _amount_of_shares(raw: Column, scale: int, nullable: bool) -> tuple[Column, Column]:
    bad = _flag(raw < 0, QUALITY["quantity"])
    if nullable:
        bad = F.when(raw == NULL_I64, QUALITY["null_source"]).when(raw < 0, QUALITY["quantity"]).otherwise(0).cast("bigint")
    return wire.quantity(raw, scale, nullable), bad


def _book(side: str, sh: bool) -> Column:
    """The kept levels of a side, with their values as structs."""

    def level(x: Column) -> Column:
        price = wire.decimal(x.price, 3 if sh else 6, 32 if sh else 64, x.price > 0)
        return F.struct(price.alias("price"), wire.quantity(x.quantity, 3 if sh else 0, sh).alias("quantity"), x.order_count.alias("order_count"))

    return F.transform(side, level)


def _decode(admitted: DataFrame, kind: Kind, config: EngineConfig) -> DataFrame:
    sh = kind == SH_SNAPSHOT
    if sh:
        texts = {"security": (4, True), "status": (38, False)}
        lists = {"bids": 228, "asks": 236}
        prices = {"previous_close": (14, 3, 32), "open": (18, 3, 32), "high": (22, 3, 32), "low": (26, 3, 32), "last": (30, 3, 32), "close": (34, 3, 32), "weighted_average_bid": (72, 3, 32), "weighted_average_ask": (88, 3, 32)}
        shares = {"volume": 48, "total_bid_quantity": 64, "total_ask_quantity": 80}
        fields = {"image_status": (10, "<i4"), "trade_count": (44, "<u4"), "turnover_raw": (56, "<i8")}
        scale, paid_scale = 3, 5
    else:
        texts = {"stream": (8, True), "security": (14, True), "source": (20, True), "phase_code": (26, True)}
        lists = {"bids": 208, "asks": 216}
        prices = {"previous_close": (32, 4, 64), "last": (64, 6, 64), "open": (72, 6, 64), "high": (80, 6, 64), "low": (88, 6, 64), "weighted_average_ask": (152, 6, 64), "weighted_average_bid": (168, 6, 64)}
        shares = {"volume": 48, "total_ask_quantity": 144, "total_bid_quantity": 160}
        fields = {"channel": (4, "<u4"), "trade_count": (40, "<i8"), "turnover_raw": (56, "<i8")}
        scale, paid_scale = 0, 4
    fields |= {"time": (0, "<u4")} | {f"{n}_raw": (at, f"<i{bits // 8}") for n, (at, _, bits) in prices.items()} | {f"{n}_raw": (at, "<i8") for n, at in shares.items()}
    base = accepted(admitted, [kind]).select(*COMMON, "body")
    df = with_books(base, kind, fields, texts, lists, longest=config.maximum_text_bytes, depth=config.maximum_depth_items, queue_limit=config.maximum_queue_items, keep=BOOK_DEPTH)
    priced = {n: _price(F.col(f"{n}_raw"), s, bits) for n, (_, s, bits) in prices.items()}
    shared = {n: _amount_of_shares(F.col(f"{n}_raw"), scale, sh) for n in shares}
    paid = _amount(F.col("turnover_raw"), paid_scale)
    local, exchange, count = F.col("vendor_local_time_raw"), F.col("time"), F.col("trade_count")
    quality = _join(
        *(q for _, q, _ in priced.values()), *(q for _, q in shared.values()), paid[1], F.col("book_quality"),
        _flag((F.col("bids_depth") > BOOK_DEPTH) | (F.col("asks_depth") > BOOK_DEPTH), QUALITY["depth_truncated"]),
        _flag(count < 0, QUALITY["quantity"]),
        wire.time_flags(local, QUALITY["null_source"], QUALITY["time"]), wire.time_flags(exchange, QUALITY["null_source"], QUALITY["time"]),
    )
    over = paid[2]
    for _, _, o in priced.values():
        over = over | o
    error = F.coalesce(F.when(over, "fixed_point_overflow"), F.col("book_error"))
    absent = wire.decimal(F.lit(NULL_I64), 6, 64, F.lit(False))
    value = lambda n: F.col(n) if n in texts else F.lit("")
    return df.select(
        *COMMON[:4],
        wire.time_ns(local).alias("vendor_local_time_ns"),
        F.struct("service_id", "service_version", "message_id").alias("message_key"),
        "kind",
        F.lit(config.trade_date).alias("trade_date"),
        F.lit(kind.market).alias("market"),
        value("source").alias("security_id_source"),
        value("security").alias("security_id"),
        value("stream").alias("md_stream_id"),
        (F.lit(0) if sh else F.col("channel")).cast("bigint").alias("channel"),
        exchange.alias("exchange_time_raw"),
        wire.time_ns(exchange).alias("exchange_time_ns"),
        *((priced[n][0] if n in priced else absent).alias(n) for n in ("previous_close", "open", "high", "low", "last", "close", "weighted_average_bid", "weighted_average_ask")),
        paid[0].alias("turnover"),
        *(shared[n][0].alias(n) for n in ("volume", "total_bid_quantity", "total_ask_quantity")),
        count.cast("bigint").alias("trade_count"),
        (count >= 0).alias("trade_count_valid"),
        (F.col("image_status") if sh else F.lit(0)).alias("image_status"),
        F.lit(sh).alias("image_status_valid"),
        value("status").alias("instrument_status_code"),
        value("phase_code").alias("trading_phase_code"),
        F.col("bids_depth").alias("source_bid_depth"),
        F.col("asks_depth").alias("source_ask_depth"),
        _book("bids", sh).alias("bids"),
        _book("asks", sh).alias("asks"),
        quality.alias("quality"),
        error.alias("decode_error"),
    )


def decode_snapshots(admitted: DataFrame, config: EngineConfig | None = None) -> DataFrame:
    """Canonical snapshots of all accepted snapshot frames, those that cannot be decoded with decode_error set."""
    config = config or EngineConfig()
    return _decode(admitted, SH_SNAPSHOT, config).unionByName(_decode(admitted, SZ_SNAPSHOT, config))
