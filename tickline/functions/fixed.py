"""Fixed values of the message formats and of the canonical records."""

from __future__ import annotations

from dataclasses import dataclass

# Header layout, encodings and sentinels.
HEADER_BYTES = 23
BINARY_ENCODING = 1
NULL_I32 = -(1 << 31)
NULL_I64 = -(1 << 63)
NULL_TIME = 1_000_000_000
MAX_TEXT_BYTES = 32
MAX_DEPTH_ITEMS = 4096
MAX_QUEUE_ITEMS = 1_000_000
BOOK_DEPTH = 10


@dataclass(frozen=True)
class Kind:
    """A message family: its key, its fixed bytes, and whether it is a tick."""

    name: str
    market: str
    key: tuple[int, int, int]
    fixed: int
    tick: bool


# The five supported families.
SH_TICK = Kind("shanghai_tick", "SH", (4, 101, 24), 70, True)
SZ_ORDER = Kind("shenzhen_order", "SZ", (6, 101, 33), 58, True)
SZ_TRANSACTION = Kind("shenzhen_transaction", "SZ", (6, 101, 36), 70, True)
SH_SNAPSHOT = Kind("shanghai_snapshot", "SH", (4, 101, 4), 248, False)
SZ_SNAPSHOT = Kind("shenzhen_snapshot", "SZ", (6, 101, 28), 224, False)
KINDS = (SH_TICK, SZ_ORDER, SZ_TRANSACTION, SH_SNAPSHOT, SZ_SNAPSHOT)

# Bits of quality and of tick validity.
QUALITY = {
    name: 1 << i
    for i, name in enumerate(
        ["null_source", "time", "quantity", "price", "enum", "ambiguous_order", "depth_truncated", "not_in_catalog", "gap_before", "history_incomplete", "amount", "order_reference", "matched_quantity", "late"]
    )
}
VALID = {name: 1 << i for i, name in enumerate(["price", "quantity", "amount", "primary_id", "buy_id", "sell_id", "side", "aggressor", "order_type", "exchange_time", "phase", "matched_quantity", "history"])}

# Codes of the wire formats.
SH_PHASES = {"START": "start", "OCALL": "opening_call", "TRADE": "continuous", "SUSP": "suspended", "CCALL": "closing_call", "CLOSE": "closed", "ENDTR": "ended"}
SZ_SIDES = {49: "buy", 50: "sell", 71: "borrow", 70: "lend"}
SZ_ORDER_TYPES = {49: "market", 50: "limit", 85: "same_side_best"}
SZ_TRADE, SZ_CANCEL = 70, 52
