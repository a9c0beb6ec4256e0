"""Exchange of anchored runs: which windows of a document may occur elsewhere.

A window is W consecutive items (words or bytes) of one document. The anchor of
a window is the smallest hash of its k-grams, a function of the window's content
alone, so equal windows have equal anchors. Consecutive windows with one anchor
form a run: two records a window length on average, instead of one per window.
Runs are exchanged by anchor. A run whose anchor occurs once has no equal window
anywhere; runs that agree as a whole are settled by their hash; what remains,
runs that share an anchor but not all of their content, is asked for again with
content ("requests").

Records travel as packed arrays, one blob for each bucket and flush, so no row
is made for a run. A task sends at most `CROWD` contents of one anchor and one
record of each content, so a key that a third of all documents share adds only
a few records for each task.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickline.llm.text import U, gram_hash, mix, owner, slide_min, span_hash

RECORD = np.dtype([("m", "<u8"), ("rh", "<u8"), ("key", "<i8"), ("doc", "<i8"), ("s", "<i4"), ("n", "<i4"), ("flag", "u1")])
SPAN = np.dtype([("key", "<i8"), ("s", "<i4"), ("e", "<i4"), ("weight", "u1")])
#: Contents of one anchor beyond which a task asks for all of them at once.
CROWD = 8
#: Records that a task holds before it sends them.
HELD = 1 << 20
#: Bytes of input (as Spark estimates them) that a bucket stands for.
BUCKET_BYTES = 64 << 20
MULTI, MIXED, SELF = 1, 2, 4
PACKED = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("payload", pa.binary())])
SETTLED = pa.schema([("kind", pa.int8()), ("key", pa.int64()), ("s", pa.int32()), ("e", pa.int32()), ("weight", pa.int8())])
PACKED_DDL = "bucket int, kind tinyint, payload binary"
SETTLED_DDL = "kind tinyint, key bigint, s int, e int, weight tinyint"
RECORDS, COVERED, WANTED = 0, 1, 2
#: Stands for a missing id.
NO_ID = (1 << 63) - 1


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """key, doc and text. Equal rows share a key; rows with one id and two texts do not.

    The id is the key where it is an integer and no two rows have the same one,
    which a count finds out; else a hash of id and text is. Rows without an id
    come after all others (doc).
    """
    integral = docs.schema[id_col].dataType.typeName() in ("byte", "short", "integer", "long")
    c = F.col(id_col)
    if integral and docs.groupBy(c.alias("id")).count().where("count > 1 or id is null").isEmpty():
        # a key that cannot be null spares joins a filter, so that they share one exchange of the texts
        key = doc = F.coalesce(c.cast("bigint"), F.lit(NO_ID))
    else:
        key = F.xxhash64(c, F.col(text_col))
        doc = F.coalesce(c.cast("bigint"), F.lit(NO_ID)) if integral else key
    return docs.select(key.alias("key"), doc.alias("doc"), F.col(text_col).alias("text"), c.alias("id"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucket_count(docs: DataFrame) -> int:
    """Buckets of an exchange: a task sorts its rows by bucket and holds one at a time, so a bucket stands for a bounded share of the input."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # Spark takes a table that it knows nothing of for endless
    return max(4 * partitions(docs.sparkSession), min(size // BUCKET_BYTES, 1 << 20) if size < 1 << 60 else 0)


def runs(sums: np.ndarray, off: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """(anchor, run hash, document number, first window, number of windows) of each run.

    First windows count from the start of the document.
    """
    anchors = slide_min(gram_hash(sums, k), window - k + 1)
    if not len(anchors):
        return (anchors, anchors, *(np.empty(0, np.int64) for _ in range(3)))
    doc = owner(off)
    valid = doc[: len(anchors)] == doc[window - 1 : window - 1 + len(anchors)]
    cut = np.ones(len(anchors) + 1, dtype=bool)
    cut[1:-1] = (anchors[1:] != anchors[:-1]) | ~valid[1:] | ~valid[:-1]
    first = np.flatnonzero(cut[:-1] & valid)
    end = np.flatnonzero(cut[1:] & valid) + 1
    return anchors[first], span_hash(sums, first, end - 1 + window), doc[first], first - off[doc[first]], end - first


def repeats_inside(sums: np.ndarray, first: np.ndarray, n: np.ndarray, anchor: np.ndarray, window: int, k: int) -> np.ndarray:
    """Runs in which the anchor occurs more than once, so that a window may recur within the run."""
    grams = gram_hash(sums, k)
    width = window - k + 1
    count = np.zeros(len(first), dtype=np.int64)
    reach = n - 1 + width
    for t in range(2 * width - 1):
        count += (grams[np.minimum(first + t, len(grams) - 1)] == anchor) & (t < reach)
    return (count > 1) | (n > width)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Marks of the rows where any of the sorted columns begins a new value."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def spans(key: np.ndarray, s: np.ndarray, e: np.ndarray, weight: np.ndarray | int = 1) -> np.ndarray:
    out = np.empty(len(key), dtype=SPAN)
    out["key"], out["s"], out["e"], out["weight"] = key, s, e, weight
    return out


def merged(x: np.ndarray) -> np.ndarray:
    """Spans of one key that touch become one."""
    if len(x) < 2:
        return x
    x = x[np.lexsort((x["s"], x["key"]))]
    first = _starts(x["key"])
    group = np.cumsum(first)
    far = np.int64(1) << 33
    reach = np.maximum.accumulate(x["e"] + group * far) - group * far
    new = first.copy()
    new[1:] |= x["s"][1:] > reach[:-1]
    at = np.flatnonzero(new)
    ends = np.append(at[1:], len(x)) - 1
    return spans(x["key"][at], x["s"][at], reach[ends], x["weight"][at])


def _settle_shared(r: np.ndarray, *, smaller: bool, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    r = r[np.lexsort((r["s"], r["key"], r["doc"], r["rh"], r["m"]))]
    new_m = _starts(r["m"])
    new_c = new_m | _starts(r["rh"])
    group = np.cumsum(new_c) - 1
    at = np.flatnonzero(new_c)
    size = np.diff(np.append(at, len(r)))
    special = r["flag"] == MIXED
    if smaller:
        known = (r["doc"] > r["doc"][at][group]) & ~special
        keep = ~known
        multi = np.zeros(len(r), np.uint8)
        hit = known
    else:
        many = (size > 1) | (np.maximum.reduceat(r["flag"] & MULTI, at) > 0)
        many = many[group]
        hit = many & (r["flag"] & MULTI == 0) & ~special
        keep = new_c
        multi = (many & ~special).astype(np.uint8)
    covered = spans(r["key"][hit], r["s"][hit], r["s"][hit] + r["n"][hit])
    m_group = np.cumsum(new_m) - 1
    m_at = np.flatnonzero(new_m)
    contents = np.add.reduceat(new_c.astype(np.int64), m_at)
    has_special = np.add.reduceat(special.astype(np.int64), m_at) > 0
    crowd = (contents > (1 if last else CROWD)) | has_special | (np.maximum.reduceat(r["flag"] & SELF, m_at) > 0)
    wide = crowd[m_group]
    ask = wide & keep & ~special
    wanted = spans(r["key"][ask], r["s"][ask], r["s"][ask] + r["n"][ask], multi[ask] + 1)
    if last:
        return r[:0], covered, wanted
    send = r[keep & ~wide].copy()
    send["flag"] = multi[keep & ~wide]
    crowded = r[m_at][crowd].copy()
    crowded["rh"], crowded["flag"], crowded["s"], crowded["n"] = 0, MIXED, 0, 0
    return np.concatenate([send, crowded]), covered, wanted


def settle(r: dict[str, np.ndarray], *, smaller: bool, last: bool) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """(records to send on, spans known as repeated, requests).

    smaller: a window counts as repeated only if a document with a smaller id has
    it; else if it starts anywhere else. last: no further records will be seen,
    so nothing is sent on.
    """
    n = len(r["m"])
    order = np.argsort(r["m"])
    m = r["m"][order]
    edge = np.ones(n + 1, dtype=bool)
    edge[1:-1] = m[1:] != m[:-1]
    alone = np.empty(n, dtype=bool)
    alone[order] = edge[:-1] & edge[1:]
    if not last:
        alone &= r["flag"] == 0
    else:
        alone &= r["flag"] & SELF == 0
    shared = np.empty(n - int(alone.sum()), dtype=RECORD)
    for name in RECORD.names:
        shared[name] = r[name][~alone]
    if len(shared):
        send, covered, wanted = _settle_shared(shared, smaller=smaller, last=last)
    else:
        send, covered, wanted = shared, np.empty(0, SPAN), np.empty(0, SPAN)
    if last:
        return {}, covered, wanted
    return {name: np.concatenate([r[name][alone], send[name]]) for name in RECORD.names}, covered, wanted


def _narrow(x: np.ndarray) -> tuple[int, bytes]:
    """(bytes for each value, those bytes) of non-negative integers."""
    top = int(x.max()) if len(x) else 0
    width = max(1, (top.bit_length() + 7) // 8) if top else 0
    return width, np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _widened(raw: np.ndarray, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = raw[: n * width].reshape(n, width)
    return out.view("<u8")[:, 0]


#: Count, least document, and the bytes of m, rh, doc, key, s, n and flag in each record.
HEAD = struct.Struct("<iq7B")
#: Bytes of the anchor that travel; the bucket tells more of it. The hash of the content, which decides, travels whole.
ANCHOR_HASH_BYTES = 5


def _encode(r: dict[str, np.ndarray]) -> bytes:
    """Records column by column, each in as few bytes as its values need. The key is left out where it is the document."""
    least = int(r["doc"].min())
    columns = [_narrow(r["m"] & U((1 << 8 * ANCHOR_HASH_BYTES) - 1)), _narrow(r["rh"]), _narrow((r["doc"] - least).view(np.uint64))]
    columns += [(0, b"") if np.array_equal(r["key"], r["doc"]) else (8, r["key"].tobytes())]
    columns += [_narrow(r["s"]), _narrow(r["n"]), _narrow(r["flag"])]
    return HEAD.pack(len(r["m"]), least, *(w for w, _ in columns)) + b"".join(x for _, x in columns)


def _decode(raw: bytes) -> dict[str, np.ndarray]:
    n, least, *widths = HEAD.unpack_from(raw)
    data, at, out = np.frombuffer(raw, np.uint8), HEAD.size, {}
    for name, width in zip(("m", "rh", "doc", "key", "s", "n", "flag"), widths, strict=True):
        out[name] = _widened(data[at:], n, width).astype(RECORD[name])
        at += n * width
    out["doc"] += least
    if not widths[3]:
        out["key"] = out["doc"]
    return out


def _raw_spans(x: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(x[name]).tobytes() for name in SPAN.names)


def _read_spans(raw: bytes) -> np.ndarray:
    out = np.empty(len(raw) // SPAN.itemsize, dtype=SPAN)
    at = 0
    for name in SPAN.names:
        out[name] = np.frombuffer(raw, dtype=SPAN[name], count=len(out), offset=at)
        at += SPAN[name].itemsize * len(out)
    return out


class Sender:
    """Gathers records of a task and packs them for the exchange."""

    def __init__(self, buckets: int, *, smaller: bool) -> None:
        self.buckets, self.smaller = buckets, smaller
        self.parts: list[dict[str, np.ndarray]] = []
        self.held = 0

    def add(self, m: np.ndarray, rh: np.ndarray, key: np.ndarray, doc: np.ndarray, s: np.ndarray, n: np.ndarray | int, flag: np.ndarray | int = 0) -> None:
        # the smallest hash of a window is small; spread it again, so that its high bits tell the bucket
        x = {"m": mix(m), "rh": rh, "key": key, "doc": doc, "s": s, "n": n, "flag": flag}
        self.parts.append({name: np.broadcast_to(np.asarray(v, RECORD[name]), len(m)) for name, v in x.items()})
        self.held += len(m)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        send, covered, wanted = settle({name: np.concatenate([p[name] for p in self.parts]) for name in RECORD.names}, smaller=self.smaller, last=False)
        self.parts, self.held = [], 0
        rows: list[tuple[int, int, bytes]] = []
        bucket = ((send["m"] >> U(40)) % U(self.buckets)).astype(np.int32 if self.buckets > 65535 else np.uint16)
        order = np.argsort(bucket, kind="stable")
        send = {name: v[order] for name, v in send.items()}
        edge = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for b in np.flatnonzero(np.diff(edge)):
            rows.append((int(b), RECORDS, _encode({name: v[edge[b] : edge[b + 1]] for name, v in send.items()})))
        for kind, x in ((COVERED, merged(covered)), (WANTED, wanted)):
            for i in range(0, len(x), 4096):
                part = x[i : i + 4096]
                rows.append((int(part["key"][0]) % self.buckets, kind, _raw_spans(part)))
        for i in range(0, len(rows), 1024):
            b, k, p = zip(*rows[i : i + 1024], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.int8()), pa.array(p, pa.binary())], schema=PACKED)


def _settled(kind: int, x: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(x), 65536):
        part = x[i : i + 65536]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int8)), *(pa.array(np.ascontiguousarray(part[c])) for c in ("key", "s", "e")), pa.array(part["weight"].astype(np.int8))], schema=SETTLED)


def exchange(sent: DataFrame, *, smaller: bool) -> DataFrame:
    """Deals the packed records out by anchor and settles them: COVERED and WANTED spans."""

    def settled(records: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if records:
            joined = {name: np.concatenate([x[name] for x in records]) for name in RECORD.names}
            _, covered, wanted = settle(joined, smaller=smaller, last=True)
            yield from _settled(COVERED, merged(covered))
            yield from _settled(WANTED, wanted)

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, now = [], None
        for batch in batches:
            for bucket, kind, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if bucket != now:
                    yield from settled(records)
                    records, now = [], bucket
                raw = payload.as_buffer()
                if kind == RECORDS:
                    records.append(_decode(raw))
                else:
                    yield from _settled(kind, _read_spans(raw))
        yield from settled(records)

    # in order by bucket: only one bucket's records are held at a time
    return sent.repartition(partitions(sent.sparkSession), "bucket").sortWithinPartitions("bucket").mapInArrow(receive, SETTLED_DDL)


def asked(column: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, ...]:
    """(row from lo, s, e, weight) of the structs in rows [lo, hi) of a list column."""
    part = column.slice(lo, hi - lo)
    off = np.asarray(part.offsets)
    flat = part.flatten()
    return np.repeat(np.arange(hi - lo), np.diff(off)), *(np.asarray(flat.field(i)) for i in range(3))


def expand(s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All values of the ranges [s, e), and which range each comes from."""
    size = (e - s).astype(np.int64)
    which = np.repeat(np.arange(len(s)), size)
    first = np.cumsum(size) - size
    return np.arange(len(which)) - first[which] + s[which], which
