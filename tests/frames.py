"""Frames built byte by byte, apart from the library's own encoder."""

from __future__ import annotations

import struct

SCHEMA = "ingress_sequence bigint, receive_monotonic_ns bigint, header binary, body binary"


def header(key, size, *, head=23, message=None, encoding=1, local=93_000_000, vendor=1):
    return struct.pack("<BIBBHHIQ", head, 23 + size if message is None else message, encoding, *key, local, vendor)


def _body(fixed, fields, texts):
    raw = bytearray(fixed)
    for at, fmt, value in fields:
        struct.pack_into("<" + fmt, raw, at, value)
    for at, value in texts:
        struct.pack_into("<HI", raw, at, len(value), len(raw) - at if value else 0)
        raw += value
    return raw


def sh_tick(seq, *, security=b"600000", channel=1, price=12345, quantity=100, money=1234500, type_=b"T", mark=b"B", buy=101, sell=202, time=93_000_123):
    fields = [(0, "q", seq), (8, "i", channel), (18, "I", time), (28, "q", buy), (36, "q", sell), (44, "i", price), (48, "q", quantity), (56, "q", money)]
    return (4, 101, 24), _body(70, fields, [(12, security), (22, type_), (64, mark)])


def sz_order(seq, *, channel=7, price=123400, quantity=900, side=49, type_=50, security=b"000001"):
    fields = [(0, "I", channel), (4, "q", seq), (30, "q", price), (38, "q", quantity), (46, "i", side), (50, "I", 93_000_456), (54, "i", type_)]
    return (6, 101, 33), _body(58, fields, [(12, b"010"), (18, security), (24, b"102")])


def sz_transaction(seq, *, channel=7, buy=111, sell=222, price=123400, quantity=10, exec_=70, security=b"000001"):
    fields = [(0, "I", channel), (4, "q", seq), (18, "q", buy), (26, "q", sell), (46, "q", price), (54, "q", quantity), (62, "i", exec_), (66, "I", 93_000_789)]
    return (6, 101, 36), _body(70, fields, [(12, b"010"), (34, security), (40, b"102")])


def sh_snapshot(levels=(), queue=(), security=b"600000"):
    prices = [(at, "i", 12345) for at in (14, 18, 22, 26, 30, 34)]
    fields = [(0, "I", 93_001_000), (10, "i", 1), *prices, (44, "I", 5), (48, "q", 1000), (56, "q", 12345000), (64, "q", 400), (72, "i", 12340), (80, "q", 500), (88, "i", 12350)]
    raw = _body(248, fields, [(4, security), (38, b"T")])
    if levels:
        start = len(raw)
        struct.pack_into("<II", raw, 228, len(levels), start - 228)
        for price, quantity, orders in levels:
            raw += struct.pack("<4xiqI8x", price, quantity, orders)
        if queue:
            at = start + 20
            struct.pack_into("<II", raw, at, len(queue), len(raw) - at)
            for quantity in queue:
                raw += struct.pack("<8xq", quantity)
    return (4, 101, 4), raw


def sz_snapshot():
    fields = [(0, "I", 93_001_500), (4, "I", 7), (32, "q", 123400), (40, "q", 8), (48, "q", 2000), (56, "q", 2468000), *((at, "q", 12340000) for at in (64, 72, 80, 88)), (144, "q", 700), (152, "q", 12350000), (160, "q", 600), (168, "q", 12330000)]
    return (6, 101, 28), _body(224, fields, [(8, b"010"), (14, b"000001"), (20, b"102"), (26, b"T0")])


def table(spark, messages, step=1000):
    rows = [(i, i * step, header(key, len(body)), bytes(body)) for i, (key, body) in enumerate(messages, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def catalog(spark):
    return spark.createDataFrame([(1, 0, "SH", "", "600000"), (2, 1, "SZ", "102", "000001")], "instrument_id bigint, instrument_ordinal bigint, market string, security_id_source string, security_id string")
