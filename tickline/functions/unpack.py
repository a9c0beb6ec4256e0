"""Fixed fields and texts of message bodies, a whole batch at a time.

The bodies of a batch are one buffer; a field is a strided view of it, a text a
range. Written as Column expressions, the same reads outgrow the size of a
generated method and fall back to interpretation, which is why this step alone
works on Arrow batches. Everything after it is expressions again.
"""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tickline.functions.fixed import BINARY_ENCODING, HEADER_BYTES, KINDS, MAX_TEXT_BYTES, NULL_I32, NULL_I64, QUALITY, SH_SNAPSHOT, SH_TICK, SZ_SNAPSHOT, Kind

SQL_TYPES = {"<i4": "int", "<i8": "bigint", "<u4": "bigint"}
_ERRORS = np.array(["", "count_exceeded", "invalid_offset", "invalid_text"], dtype=object)
RANGE_OVERLAP = 4


def _bodies(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)), off


def _field(fixed: np.ndarray, at: int, kind: str) -> np.ndarray:
    size = int(kind[-1])
    return np.ascontiguousarray(fixed[:, at : at + size]).view(kind)[:, 0]


def _text(raw: np.ndarray, off: np.ndarray, odd: np.ndarray, fixed: np.ndarray, at: int, floor: int, *, required: bool, longest: int, rows: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(values, error codes, starts, ends) of a descriptor: u16 length, u32 offset from the descriptor. rows: those that `fixed` has, if not all."""
    size, base = np.diff(off), off[:-1]
    if rows is not None:
        size, base = size[rows], base[rows]
    length, offset = _field(fixed, at, "<u2").astype(np.int64), _field(fixed, at + 2, "<u4").astype(np.int64)
    start = offset + at
    outside = (offset < 6) | (start < floor) | (start + length > size)
    a = np.where(outside, base, base + start)
    strange = odd[np.where(outside, a, a + length)] > odd[a]
    error = np.select(
        [length > longest, (length == 0) & (offset != 0) & (start > size), (length == 0) & required, (length > 0) & outside, (length > 0) & strange], [1, 2, 3, 2, 3], 0
    )
    keep = np.where(error == 0, length, 0)
    ends = np.cumsum(keep)
    pick = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - keep, keep) + np.repeat(a, keep)
    values = pa.StringArray.from_buffers(len(keep), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(raw[pick].tobytes()))
    return values, error, start, start + keep


class Bodies:
    """The fields and texts of the bodies of one family, each of which has the kind's fixed bytes at least."""

    def __init__(self, column: pa.Array, kind: Kind, fields: Mapping[str, tuple[int, str]], texts: Mapping[str, int], longest: int) -> None:
        self.raw, self.off = _bodies(column)
        self.fields = fields
        self.fixed = _gather(self.raw, self.off[:-1], kind.fixed)
        odd = np.concatenate([[0], np.cumsum((self.raw < 0x20) | (self.raw > 0x7E))])
        self.texts = {name: _text(self.raw, self.off, odd, self.fixed, at, kind.fixed, required=True, longest=longest) for name, at in texts.items()}

    def field(self, name: str) -> np.ndarray:
        at, kind = self.fields[name]
        value = _field(self.fixed, at, kind)
        return value.astype(np.int64) if kind == "<u4" else value

    def text(self, name: str) -> pa.Array:
        return self.texts[name][0]

    def letter(self, name: str) -> np.ndarray:
        """The byte of a text of one byte, else 0."""
        _, _, start, end = self.texts[name]
        one = end - start == 1
        out = np.zeros(len(one), np.int64)
        out[one] = self.raw[self.off[:-1][one] + start[one]]
        return out

    def text_error(self) -> np.ndarray:
        """Number of the first fault of the texts in their order, or that two of them share bytes; 0 for none."""
        first = np.zeros(len(self.off) - 1, np.int64)
        for _, error, _, _ in self.texts.values():
            first = np.where(first == 0, error, first)
        spans = [(b, e) for _, _, b, e in self.texts.values()]
        for i, (b, e) in enumerate(spans):
            for b2, e2 in spans[:i]:
                first = np.where((first == 0) & (e > b) & (e2 > b2) & (b < e2) & (b2 < e), RANGE_OVERLAP, first)
        return first


# Header fields, name -> (offset, type).
HEADER_FIELDS = {"head_size": (0, "<u1"), "message_size": (1, "<u4"), "encoding": (5, "<u1"), "service_id": (6, "<u1"), "service_version": (7, "<u2"), "message_id": (9, "<u2"), "vendor_local_time_raw": (11, "<u4"), "vendor_sequence": (15, "<u8")}
HEADER_DDL = "head_size int, message_size bigint, encoding int, service_id int, service_version int, message_id int, vendor_local_time_raw bigint, vendor_sequence decimal(20,0), route_channel bigint, kind string, admission_result string"
#: Descriptors of the texts that route a snapshot.
ROUTE_TEXTS = {SH_SNAPSHOT: (4,), SZ_SNAPSHOT: (14, 20)}


def _gather(raw: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    return raw[start[:, None] + np.arange(size)] if len(start) else np.empty((0, size), np.uint8)


#: Why a frame is rejected; the first reason that holds counts.
RESULTS = ("accepted", "header_truncated", "header_invalid", "body_size_mismatch", "non_binary_encoding", "unsupported_message", "disabled_message", "body_too_large", "body_truncated", "route_invalid")


def scanned(frames: DataFrame, streams: Collection[tuple[int, int, int]], tick_capacity: int, snapshot_capacity: int) -> DataFrame:
    """Adds the header's fields (null where it is too short), the channel of a tick, kind (null if it is none of the five) and admission_result."""
    names = frames.columns
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frames.schema.fields)
    kinds, results = pa.array([*(k.name for k in KINDS), None]), pa.array(RESULTS)
    # by number of the family; the last entry is for frames of none
    enabled = np.array([k.key in streams for k in KINDS] + [False])
    fixed_size = np.array([k.fixed for k in KINDS] + [0])
    capacity = np.array([tick_capacity if k.tick else snapshot_capacity for k in KINDS] + [1 << 62])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            raw, off = _bodies(batch.column(names.index("header")).fill_null(b""))
            whole = np.diff(off) >= HEADER_BYTES
            fixed = np.zeros((n, HEADER_BYTES), np.uint8)
            fixed[whole] = _gather(raw, off[:-1][whole], HEADER_BYTES)
            got = {name: np.ascontiguousarray(fixed[:, at : at + int(t[-1])]).view(t)[:, 0] for name, (at, t) in HEADER_FIELDS.items()}
            out = []
            for name, v in got.items():
                if name == "vendor_sequence":
                    out.append(pa.array(v, pa.uint64(), mask=~whole).cast(pa.decimal128(20, 0)))
                else:
                    out.append(pa.array(v.astype(np.int64), mask=~whole).cast(pa.int64() if v.dtype == np.uint32 else pa.int32()))
            raw, off = _bodies(batch.column(names.index("body")).fill_null(b""))
            size, bad, channel, family = np.diff(off), np.zeros(n, bool), np.zeros(n, np.int64), np.full(n, len(KINDS))
            ticks = np.zeros(n, bool)
            odd = None
            for i, kind in enumerate(KINDS):
                is_kind = whole & (got["service_id"] == kind.key[0]) & (got["service_version"] == kind.key[1]) & (got["message_id"] == kind.key[2])
                family[is_kind] = i
                own = np.flatnonzero(is_kind & (size >= kind.fixed))
                if not len(own):
                    continue
                if kind.tick:
                    at, t = (8, "<i4") if kind == SH_TICK else (0, "<u4")
                    channel[own] = _field(_gather(raw, off[own], at + 4), at, t)
                    ticks[own] = True
                    if kind == SH_TICK:
                        bad[own] = channel[own] <= 0
                for at in ROUTE_TEXTS.get(kind, ()):
                    odd = np.concatenate([[0], np.cumsum((raw < 0x20) | (raw > 0x7E))]) if odd is None else odd
                    _, error, _, _ = _text(raw, off, odd, _gather(raw, off[own], kind.fixed), at, kind.fixed, required=True, longest=MAX_TEXT_BYTES, rows=own)
                    bad[own] |= error > 0
            message = got["message_size"].astype(np.int64)
            tests = [
                ~whole, (got["head_size"] != HEADER_BYTES) | (message < HEADER_BYTES), size != message - HEADER_BYTES, got["encoding"] != BINARY_ENCODING, family == len(KINDS), ~enabled[family], size > capacity[family],
                size < fixed_size[family], bad,
            ]
            result = np.select(tests, range(1, len(RESULTS)), 0)
            out += [pa.array(channel, mask=~ticks), kinds.take(pa.array(family)), results.take(pa.array(result))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *out], names=[*names, *HEADER_FIELDS, "route_channel", "kind", "admission_result"])

    return frames.mapInArrow(scan, f"{kept}, {HEADER_DDL}")


LEVEL_BYTES = 28
LEVELS_DDL = "array<struct<price:bigint,quantity:bigint,order_count:bigint>>"


def _cross(row: np.ndarray, b: np.ndarray, e: np.ndarray, n: int) -> np.ndarray:
    """Rows in which two of the ranges [b, e) that are not empty share a byte."""
    some = e > b
    row, b, e = row[some], b[some], e[some]
    order = np.lexsort((b, row))
    row, b, e = row[order], b[order], e[order]
    hit = (row[1:] == row[:-1]) & (b[1:] < e[:-1])
    out = np.zeros(n, bool)
    out[row[1:][hit]] = True
    return out


def _listed(size: np.ndarray, at: np.ndarray, count: np.ndarray, offset: np.ndarray, item: int, floor: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, error code: 0, 1 count_exceeded, 2 invalid_offset) of lists whose descriptors stand at `at`."""
    start = at + offset
    error = np.select([count > most, (count == 0) & (offset != 0) & (start > size), (count > 0) & ((offset < 8) | (start < floor) | (start + count * item > size))], [1, 2, 2], 0)
    return start, error


def _expanded(start: np.ndarray, count: np.ndarray, item: int) -> tuple[np.ndarray, np.ndarray]:
    """(which list, place in the body) of every item."""
    which = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    return which, start[which] + (np.arange(len(which)) - first[which]) * item


def with_books(frames: DataFrame, kind: Kind, fields: Mapping[str, tuple[int, str]], texts: Mapping[str, tuple[int, bool]], lists: Mapping[str, int], *, longest: int, depth: int, queue_limit: int, keep: int) -> DataFrame:
    """The columns of `frames` but for body, with each field and text, for each list the first `keep` levels, its whole depth, and book_quality and book_error of all levels and queues."""
    sh = kind == SH_SNAPSHOT
    item, inner, null = (16, 8, NULL_I64) if sh else (8, 0, None)
    price_at, price_type, shares_at = (4, "<i4", 8) if sh else (8, "<i8", 0)
    price_null, most_price = (NULL_I32, 1 << 40) if sh else (NULL_I64, (1 << 63) - 1)
    others = [c for c in frames.columns if c != "body"]

    def shares_flags(v: np.ndarray) -> np.ndarray:
        flags = np.where(v < 0, QUALITY["quantity"], 0)
        return np.where(v == null, QUALITY["null_source"], flags) if null is not None else flags

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            raw, off = _bodies(batch.column(len(others)))
            size = np.diff(off)
            fixed = _gather(raw, off[:-1], kind.fixed)
            odd = np.concatenate([[0], np.cumsum((raw < 0x20) | (raw > 0x7E))])
            out = [pa.array(c.astype(np.int64) if c.dtype == np.uint32 else c) for c in (_field(fixed, at, t) for at, t in fields.values())]
            error = np.full(n, None, dtype=object)
            rows, begins, ends = [], [], []

            def fault(where: np.ndarray, name: str, error: np.ndarray = error) -> None:
                error[where & (error == None)] = name  # noqa: E711

            for at, required in texts.values():
                values, code, b, e = _text(raw, off, odd, fixed, at, kind.fixed, required=required, longest=longest)
                out.append(values)
                for i, name in enumerate(_ERRORS[1:], 1):
                    fault(code == i, name)
                rows.append(np.arange(n)), begins.append(b), ends.append(e)
            quality = np.zeros(n, np.int64)
            queued = np.zeros(n, np.int64)
            for at in lists.values():
                count, offset = _field(fixed, at, "<u4").astype(np.int64), _field(fixed, at + 4, "<u4").astype(np.int64)
                start, code = _listed(size, np.full(n, at), count, offset, LEVEL_BYTES, kind.fixed, depth)
                fault(code == 1, "count_exceeded"), fault(code == 2, "invalid_offset")
                count = np.where(code == 0, count, 0)
                rows.append(np.arange(n)), begins.append(start), ends.append(start + count * LEVEL_BYTES)
                row, place = _expanded(start, count, LEVEL_BYTES)
                level = _gather(raw, off[row] + place, LEVEL_BYTES)
                price, shares, orders = _field(level, price_at, price_type).astype(np.int64), _field(level, shares_at, "<i8"), _field(level, 16, "<u4").astype(np.int64)
                flags = np.where(price == price_null, QUALITY["null_source"], np.where(price <= 0, QUALITY["price"], 0)) | shares_flags(shares)
                fault(_any(row, price > most_price, n), "fixed_point_overflow")
                held, where = _field(level, 20, "<u4").astype(np.int64), _field(level, 24, "<u4").astype(np.int64)
                qstart, code = _listed(size[row], place + 20, held, where, item, kind.fixed, queue_limit)
                fault(_any(row, code == 1, n), "count_exceeded"), fault(_any(row, code == 2, n), "invalid_offset")
                held = np.where(code == 0, held, 0)
                fault(_any(row, held > orders, n), "count_mismatch")
                queued += np.bincount(row, held, minlength=n).astype(np.int64)
                rows.append(row), begins.append(qstart), ends.append(qstart + held * item)
                which, spot = _expanded(qstart, held, item)
                waiting = _field(_gather(raw, off[row[which]] + spot + inner, 8), 0, "<i8")
                np.bitwise_or.at(flags, which, shares_flags(waiting))
                np.bitwise_or.at(quality, row, flags)
                rank = np.arange(len(row)) - (np.cumsum(count) - count)[row]
                near = rank < keep
                edge = np.concatenate([[0], np.cumsum(np.minimum(count, keep))]).astype(np.int32)
                struct = pa.StructArray.from_arrays([pa.array(price[near]), pa.array(shares[near]), pa.array(orders[near])], names=["price", "quantity", "order_count"])
                out += [pa.ListArray.from_arrays(pa.array(edge), struct), pa.array(count)]
            fault(queued > queue_limit, "count_exceeded")
            fault(_cross(np.concatenate(rows), np.concatenate(begins), np.concatenate(ends), n), "range_overlap")
            out += [pa.array(quality), pa.array(error.tolist(), pa.string())]
            names = [x for name in lists for x in (name, f"{name}_depth")]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], *out], names=[*others, *fields, *texts, *names, "book_quality", "book_error"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frames.select(*others).schema.fields)
    added = [*(f"{name} {SQL_TYPES[t]}" for name, (_, t) in fields.items()), *(f"{name} string" for name in texts), *(x for name in lists for x in (f"{name} {LEVELS_DDL}", f"{name}_depth bigint"))]
    return frames.select(*others, "body").mapInArrow(unpack, f"{kept}, {', '.join(added)}, book_quality bigint, book_error string")


def _any(row: np.ndarray, test: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, bool)
    out[row[test]] = True
    return out
