"""Frames from values: the layouts of `decode_tick` and `decode_snapshot`.

Used for synthetic loads and round trips; texts and lists follow the fixed part.
Tick frames are packed batch by batch (`Body`); books, whose lists are nested, are
Column expressions (`body`).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.functions.fixed import BINARY_ENCODING, HEADER_BYTES, SH_TICK, SZ_ORDER, SZ_TRANSACTION, Kind

FRAME_COLUMNS = ("ingress_sequence", "receive_monotonic_ns", "header", "body")


def little_endian(value: Column, size: int) -> Column:
    """Hex of an integer in `size` bytes, lowest first; negative ones as two's complement."""
    h = F.lpad(F.hex(value.cast("bigint")), 16, "0")
    return F.concat(*(F.substring(h, 15 - 2 * i, 2) for i in range(size)))


class Body(NamedTuple):
    """Fields: offset -> (value, bytes); texts: offset of the descriptor -> text."""

    kind: Kind
    fields: dict[int, tuple[Column, int]]
    texts: dict[int, Column]

    def column(self) -> Column:
        return body(self.kind, self.fields, self.texts)


def _little(value: np.ndarray, size: int) -> np.ndarray:
    return np.ascontiguousarray(value.astype("<i8")).view(np.uint8).reshape(-1, 8)[:, :size]


def _ranges(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, place within it) of every item of ranges of these sizes."""
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size)


def packed_frames(df: DataFrame, content: Body, *, ingress: Column, receive_ns: Column, local_time: Column) -> DataFrame:
    """Frames of one family, packed with numpy."""
    kind = content.kind
    columns = [ingress.cast("bigint").alias("ingress_sequence"), receive_ns.cast("bigint").alias("receive_monotonic_ns"), local_time.cast("bigint").alias("local")]
    columns += [v.cast("bigint").alias(f"f{at}") for at, (v, _) in content.fields.items()] + [v.cast("string").alias(f"t{at}") for at, v in content.texts.items()]
    sizes, places = {at: n for at, (_, n) in content.fields.items()}, list(content.texts)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            fixed = np.zeros((n, kind.fixed), np.uint8)
            for at, size in sizes.items():
                fixed[:, at : at + size] = _little(batch.column(f"f{at}").to_numpy(zero_copy_only=False), size)
            total, texts = np.full(n, kind.fixed), []
            for at in places:
                column = batch.column(f"t{at}").cast(pa.large_string())
                off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
                raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
                length = np.diff(off)
                fixed[:, at : at + 2], fixed[:, at + 2 : at + 6] = _little(length, 2), _little(np.where(length > 0, total - at, 0), 4)
                texts.append((raw, off, length, total))
                total = total + length
            start = np.cumsum(total) - total
            out = np.empty(int(total.sum()), np.uint8)
            out[start[:, None] + np.arange(kind.fixed)] = fixed
            for raw, off, length, at in texts:
                which, place = _ranges(length)
                out[start[which] + at[which] + place] = raw[off[which] + place]
            receive = batch.column("receive_monotonic_ns").to_numpy(zero_copy_only=False)
            head = np.zeros((n, HEADER_BYTES), np.uint8)
            at = 0
            for value, size in ((HEADER_BYTES, 1), (total + HEADER_BYTES, 4), (BINARY_ENCODING, 1), (kind.key[0], 1), (kind.key[1], 2), (kind.key[2], 2), (batch.column("local").to_numpy(zero_copy_only=False), 4), (receive, 8)):
                head[:, at : at + size] = _little(np.broadcast_to(value, n), size)
                at += size
            blob = lambda data, edge: pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(np.append(edge, len(data)).astype(np.int64)), pa.py_buffer(data.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), blob(head.ravel(), np.arange(n) * HEADER_BYTES), blob(out, start)], names=list(FRAME_COLUMNS))

    return df.select(*columns).mapInArrow(pack, "ingress_sequence bigint, receive_monotonic_ns bigint, header binary, body binary")


def body(kind: Kind, fields: dict[int, tuple[Column, int]], texts: dict[int, Column], lists: dict[int, tuple[Column, int, Column]] | None = None) -> Column:
    """Body bytes. fields: offset -> (value, bytes); texts: offset of the descriptor -> text; lists: offset -> (count, item bytes, hex of the items)."""
    after: Column = F.lit(kind.fixed)
    parts: dict[int, tuple[Column, int]] = {at: (little_endian(v, n), n) for at, (v, n) in fields.items()}
    tail: list[Column] = []
    for at, value in texts.items():
        size = F.octet_length(value)
        parts[at] = (F.concat(little_endian(size, 2), little_endian(F.when(size > 0, after - at).otherwise(0), 4)), 6)
        tail.append(F.hex(F.encode(value, "UTF-8")))
        after = after + size
    for at, (count, item, items) in (lists or {}).items():
        parts[at] = (F.concat(little_endian(count, 4), little_endian(F.when(count > 0, after - at).otherwise(0), 4)), 8)
        tail.append(items)
        after = after + count * item
    out, at = [], 0
    for start in sorted(parts):
        if start > at:
            out.append(F.lit("00" * (start - at)))
        out.append(parts[start][0])
        at = start + parts[start][1]
    out.append(F.lit("00" * (kind.fixed - at)))
    return F.unhex(F.concat(*out, *tail))


def header(kind: Kind, size: Column, local_time: Column, vendor_sequence: Column, *, encoding: Column | None = None, message_size: Column | None = None, key: tuple[Column, Column, Column] | None = None) -> Column:
    service, version, message = key or tuple(F.lit(x) for x in kind.key)
    pieces = [(F.lit(HEADER_BYTES), 1), (message_size if message_size is not None else size + HEADER_BYTES, 4), (encoding if encoding is not None else F.lit(BINARY_ENCODING), 1), (service, 1), (version, 2), (message, 2), (local_time, 4), (vendor_sequence, 8)]
    return F.unhex(F.concat(*(little_endian(v, n) for v, n in pieces)))


def frames(df: DataFrame, kind: Kind, content: Column | Body, *, ingress: Column, receive_ns: Column, local_time: Column | None = None) -> DataFrame:
    if isinstance(content, Body):
        return packed_frames(df, content, ingress=ingress, receive_ns=receive_ns, local_time=local_time if local_time is not None else F.lit(93_000_000))
    made = df.select(ingress.cast("bigint").alias("ingress_sequence"), receive_ns.cast("bigint").alias("receive_monotonic_ns"), (local_time if local_time is not None else F.lit(93_000_000)).alias("local"), content.alias("body"))
    return made.select("ingress_sequence", "receive_monotonic_ns", header(kind, F.octet_length("body"), F.col("local"), F.col("receive_monotonic_ns")).alias("header"), "body")


def sh_tick_body(*, sequence: Column, channel: Column, security: Column, type_: Column, mark: Column, price: Column, quantity: Column, money: Column, buy: Column, sell: Column, time: Column) -> Body:
    fields = {0: (sequence, 8), 8: (channel, 4), 18: (time, 4), 28: (buy, 8), 36: (sell, 8), 44: (price, 4), 48: (quantity, 8), 56: (money, 8)}
    return Body(SH_TICK, fields, {12: security, 22: type_, 64: mark})


def sz_order_body(*, channel: Column, sequence: Column, stream: Column, security: Column, source: Column, price: Column, quantity: Column, side: Column, time: Column, type_: Column) -> Body:
    return Body(SZ_ORDER, {0: (channel, 4), 4: (sequence, 8), 30: (price, 8), 38: (quantity, 8), 46: (side, 4), 50: (time, 4), 54: (type_, 4)}, {12: stream, 18: security, 24: source})


def sz_transaction_body(*, channel: Column, sequence: Column, stream: Column, security: Column, source: Column, buy: Column, sell: Column, price: Column, quantity: Column, exec_: Column, time: Column) -> Body:
    return Body(SZ_TRANSACTION, {0: (channel, 4), 4: (sequence, 8), 18: (buy, 8), 26: (sell, 8), 46: (price, 8), 54: (quantity, 8), 62: (exec_, 4), 66: (time, 4)}, {12: stream, 34: security, 40: source})


def hex_join(parts: list[Column]) -> Column:
    return reduce(lambda a, b: F.concat(a, b), parts)
