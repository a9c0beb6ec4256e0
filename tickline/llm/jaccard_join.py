"""N-gram Jaccard join with several global token orders.

Documents with one set of shingles are one class; each class is compared once.
Under a global order of all shingles, the prefix of a set of n shingles is its
first n - a + e ones, where a is the least overlap that a link needs and e grows
with n. Two linked sets then share at least e(the smaller) prefix shingles, so a
class whose prefix meets other prefixes in fewer places has no link. That test
runs under several orders, each over the classes that passed the one before, so
what stays is the intersection of the filters. The last order puts rare shingles
first, by a table of frequencies of fixed size: there, texts that only have
frequent passages in common meet in no prefix. Only then are pairs formed, from
classes that share a shingle of the shortest sufficient prefix under that order.

A bucket's row carries what rules a pair out before it leaves the bucket: the
set's size, the shingle's place in the order, and a parity bitmap that bounds from
below in how many shingles two sets differ. A class has a row for each shingle of
its prefix, so what each row carries is what the join costs in disk. The bitmaps
of the prefixes under the other orders, which must intersect, thus stay with the
class and meet only the pairs that left a bucket. Only pairs that pass these, too,
meet as whole sets.

Pairs are formed in rounds. In a round, the first members of each bucket that
have not been centres yet are compared with the bucket's other members, except
where both are known to be connected. A group of near copies thus costs a few
comparisons for each member, not all its pairs, and every link between different
components is still found. A large bucket is dealt out in blocks, each with a copy
of the round's centres.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.components import components
from tickline.llm.repeats import NO_ID, bucket_count, keyed, partitions
from tickline.llm.shared import Scratch, small_batches, sweep
from tickline.llm.text import U, chunks, gram_hash, mix, owner, prefix_sums, span_hash, word_hash, words

#: Salts of the global orders; order i sorts shingles by mix(shingle ^ salt).
ORDERS = (0x2545F4914F6CDD1D, 0x9E6C63D0676A9A99, 0xD1342543DE82EF95)
#: Records that a task holds before it sends them.
HELD = 1 << 19
#: Bytes of packed sets that a task works on at a time, unless one set is longer.
SET_BYTES = 2 << 20
#: Bits of the map that keeps documents without links out of the exchange of sets: 1 MB, whatever the input.
MARKS = 1 << 23
#: Slots of the table of shingle frequencies (4 MB), and the pieces in which it is added up.
SKETCH = 1 << 22
PIECES = 64
#: Bits of each bitmap of a signature, and the salt of the parity bitmap.
BITS = 512
PARITY = 0x8CB92BA72F3D8DD7
#: Rows of buckets that a task compares at a time. A bucket of more members is dealt out in blocks.
ROWS = 1 << 15
#: Shingles of each set that tell which of several buckets sends a pair; what stands for none, and what is above all.
FIRSTS = 4
NONE, OVER = -(1 << 63), (1 << 63) - 1
TOKENS, HITS, CLASSES = 0, 1, 2
MEET_DDL = "bucket int, kind tinyint, payload binary"
MET_DDL = "kind tinyint, class bigint, n int, hits int, key bigint, doc bigint"


def overlap_needed(n, percent: int):  # noqa: ANN001, ANN201
    """Least overlap of a set of n with any set that it links to."""
    return (percent * n + 99) // 100


def extra(n):  # noqa: ANN001, ANN201
    """Shingles by which the prefix exceeds the shortest one that could hold a shared shingle, and that one."""
    return 1 + n // 10


def prefix_length(n, percent: int):  # noqa: ANN001, ANN201
    return np.minimum(n, n - overlap_needed(n, percent) + extra(n))


def shared_needed(n, percent: int):  # noqa: ANN001, ANN201
    """Prefix shingles that a set of n shares with any set that it links to, at least."""
    return np.minimum(extra(overlap_needed(n, percent)), overlap_needed(n, percent))


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document number, shingle) of the distinct shingles, in order."""
    first, last, word_off = words(data, off)
    sums = prefix_sums(word_hash(data, first, last, lower=True))
    doc = owner(word_off)
    grams = gram_hash(sums, size)
    whole = doc[: len(grams)] == doc[size - 1 : size - 1 + len(grams)]
    count = np.diff(word_off)
    short = np.flatnonzero((count > 0) & (count < size))
    d = np.concatenate([doc[: len(grams)][whole], short])
    g = np.concatenate([grams[whole], span_hash(sums, word_off[short], word_off[short + 1])])
    order = np.lexsort((g, d))
    d, g = d[order], g[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (g[1:] != g[:-1])
    return d[new], g[new]


def _grouped(d: np.ndarray, rows: int) -> np.ndarray:
    return np.searchsorted(d, np.arange(rows + 1))


def set_class(g: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """A hash of each set; 0 for the empty one."""
    sums = np.zeros(len(g) + 1, dtype=U)
    np.cumsum(mix(g ^ U(0xA0761D6478BD642F)), out=sums[1:])
    size = np.diff(edge)
    return np.where(size > 0, mix((sums[edge[1:]] - sums[edge[:-1]]) + size.astype(U)) | U(1), U(0)).view(np.int64)


def prefixes(g: np.ndarray, d: np.ndarray, edge: np.ndarray, salt: int, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order key, document number) of each set's first `length` shingles under the order of `salt`."""
    at = mix(g ^ U(salt))
    order = np.lexsort((at, d))
    rank = np.arange(len(d)) - edge[d]
    take = rank < length[d]
    return at[order][take], d[take]


class _Meeting:
    """Packs prefix shingles by bucket; a shingle goes out once from each task and flush."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, token: np.ndarray, cls: np.ndarray) -> None:
        self.parts.append((token, cls))
        self.held += len(token)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        token, cls = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.held = [], 0
        token, cls, many = _distinct(token, cls)
        hit_class, hits = np.unique(cls[many], return_counts=True)
        first = np.ones(len(token), dtype=bool)
        first[1:] = token[1:] != token[:-1]
        cls = np.where(many, 0, cls)[first]
        token = token[first]
        # five bytes of a shingle tell it apart within its bucket well enough: a clash only lets a class pass
        bucket = (token % U(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        token, cls = token[order] >> U(24), cls[order]
        edge = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(edge)):
            part = slice(edge[b], edge[b + 1])
            five = token[part].view(np.uint8).reshape(-1, 8)[:, :5]
            rows.append((int(b), TOKENS, np.ascontiguousarray(five).tobytes() + cls[part].tobytes()))
        for i in range(0, len(hits), 8192):
            rows.append((int(hit_class[i] % self.buckets), HITS, hit_class[i : i + 8192].tobytes() + hits[i : i + 8192].astype(np.int32).tobytes()))
        for i in range(0, len(rows), 512):
            b, k, p = zip(*rows[i : i + 512], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.int8()), pa.array(p, pa.binary())], names=["bucket", "kind", "payload"])


def _distinct(token: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, and whether a token has several classes (class 0 stands for several)."""
    order = np.lexsort((cls, token))
    token, cls = token[order], cls[order]
    new = np.ones(len(token), dtype=bool)
    new[1:] = (token[1:] != token[:-1]) | (cls[1:] != cls[:-1])
    token, cls = token[new], cls[new]
    start = np.ones(len(token) + 1, dtype=bool)
    start[1:-1] = token[1:] != token[:-1]
    many = ~(start[:-1] & start[1:])
    return token, cls, many


def _met(kind: int, rows: int, /, **columns: np.ndarray) -> pa.RecordBatch:
    out = [pa.array(np.full(rows, kind, np.int8))]
    for name, t in (("class", pa.int64()), ("n", pa.int32()), ("hits", pa.int32()), ("key", pa.int64()), ("doc", pa.int64())):
        out.append(pa.array(columns[name], t, from_pandas=False) if name in columns else pa.nulls(rows, t))
    return pa.RecordBatch.from_arrays(out, names=["kind", "class", "n", "hits", "key", "doc"])


def _receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order by bucket; only one bucket's shingles are held at a time."""
    tokens, classes, now = [], [], None
    for batch in batches:
        for bucket, kind, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            if bucket != now:
                yield from _meetings(tokens, classes)
                tokens, classes, now = [], [], bucket
            raw = np.frombuffer(payload.as_buffer(), dtype=np.uint8)
            if kind == TOKENS:
                n = len(raw) // 13
                wide = np.zeros((n, 8), dtype=np.uint8)
                wide[:, :5] = raw[: 5 * n].reshape(n, 5)
                tokens.append(wide.view(np.uint64)[:, 0])
                classes.append(raw[5 * n :].copy().view(np.int64))
            elif kind == HITS:
                n = len(raw) // 12
                yield _met(HITS, n, **{"class": raw[: 8 * n].view(np.int64), "hits": raw[8 * n :].view(np.int32)})
            else:
                n = len(raw) // 28
                key, doc, cls = (raw[8 * n * i : 8 * n * (i + 1)].view(np.int64) for i in range(3))
                yield _met(CLASSES, n, key=key, doc=doc, n=raw[24 * n :].view(np.int32), **{"class": cls})
    yield from _meetings(tokens, classes)


def _meetings(tokens: list[np.ndarray], classes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """How many shingles of one bucket each class shares with others."""
    if tokens:
        _, cls, many = _distinct(np.concatenate(tokens), np.concatenate(classes))
        hit, hits = np.unique(cls[many & (cls != 0)], return_counts=True)
        for i in range(0, len(hit), 65536):
            yield _met(HITS, len(hit[i : i + 65536]), **{"class": hit[i : i + 65536], "hits": hits[i : i + 65536].astype(np.int32)})


def _send_documents(buckets: int, size: int, percent: int):  # noqa: ANN202
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, seen = _Meeting(buckets), np.empty(0, np.int64)
        for batch in batches:
            key, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            rows = []
            for lo, hi, data, off in chunks(batch.column(2)):
                d, g = shingle_sets(data, off, size)
                edge = _grouped(d, hi - lo)
                n = np.diff(edge)
                cls = set_class(g, edge)
                rows.append((int(cls[0]) % buckets, CLASSES, key[lo:hi].tobytes() + doc[lo:hi].tobytes() + cls.tobytes() + n.astype(np.int32).tobytes()))
                fresh = np.zeros(hi - lo, dtype=bool)
                fresh[np.unique(cls, return_index=True)[1]] = True
                fresh &= ~np.isin(cls, seen)
                token, row = prefixes(g, d, edge, ORDERS[0], np.where(fresh, prefix_length(n, percent), 0))
                out.add(token, cls[row])
                if out.held > HELD:
                    yield from out.flush()
                    seen = np.empty(0, np.int64)
                seen = np.concatenate([seen, cls[fresh]])
            if rows:
                b, k, p = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.int8()), pa.array(p, pa.binary())], names=["bucket", "kind", "payload"])
        yield from out.flush()

    return send


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, document numbers, edges) of a column of packed sets."""
    column = column.cast(pa.large_binary())
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    edge = (off - off[0]) // 8
    g = np.frombuffer(column.buffers()[2], dtype=np.uint8)[off[0] : off[-1]].view(U) if edge[-1] else np.empty(0, U)
    return g, owner(edge), edge


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices whose packed sets in `column` hold about SET_BYTES together."""
    off = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(), dtype=np.int64)
    lo = 0
    while lo < batch.num_rows:
        before = int(off[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(off, before + SET_BYTES, side="right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _send_sets(buckets: int, salt: int, percent: int):  # noqa: ANN202
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Meeting(buckets)
        for batch in batches:
            for part in _parts(batch, 1):
                g, d, edge = _sets(part.column(1))
                token, row = prefixes(g, d, edge, salt, prefix_length(np.diff(edge), percent))
                out.add(token, part.column(0).to_numpy()[row])
                if out.held > HELD:
                    yield from out.flush()
        yield from out.flush()

    return send


def _pack_sets(size: int, marks: np.ndarray):  # noqa: ANN202
    """Sets of the documents whose bit is marked."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(3).to_numpy()
            batch = batch.filter(pa.array((marks[bit >> 6] >> (bit & 63)) & 1 == 1))
            for lo, hi, data, off in chunks(batch.column(2)):
                d, g = shingle_sets(data, off, size)
                edge = _grouped(d, hi - lo)
                raw = g.tobytes()
                blobs = [raw[8 * a : 8 * b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(set_class(g, edge)), pa.array(blobs, pa.binary()), pa.array(np.diff(edge).astype(np.int32))], names=["key", "doc", "class", "shingles", "n"])

    return pack


def _marks(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that has the bit of every key, and of some others."""
    words = keys.select(F.pmod(F.xxhash64("key"), F.lit(MARKS)).alias("bit")).select(F.shiftright("bit", 6).alias("word"), F.expr("shiftleft(1L, int(bit & 63))").alias("value")).groupBy("word").agg(F.bit_or("value").alias("value")).toArrow()
    marks = np.zeros(MARKS >> 6, dtype=np.int64)
    marks[words["word"].to_numpy()] = words["value"].to_numpy()
    return marks


def _send_counts(width: int):  # noqa: ANN202
    """How many sets of a task have each shingle, in a table of fixed width, piece by piece."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=np.uint32)
        for batch in batches:
            for part in _parts(batch, 0):
                g, _, _ = _sets(part.column(0))
                np.add.at(total, (mix(g) & U(width - 1)).astype(np.int64), 1)
        raw = np.minimum(total, 255).astype(np.uint8).reshape(PIECES, -1)
        pieces = [i for i in range(PIECES) if raw[i].any()]
        yield pa.RecordBatch.from_arrays([pa.array(pieces, pa.int32()), pa.array([zlib.compress(raw[i].tobytes(), 1) for i in pieces], pa.binary())], names=["piece", "counts"])

    return send


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(zlib.decompress(raw), np.uint8)
            total[piece] = np.minimum(total.get(piece, np.zeros(len(x), np.uint16)) + x, 255).astype(np.uint16)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([zlib.compress(x.astype(np.uint8).tobytes(), 1) for x in total.values()], pa.binary())], names=["piece", "counts"])


def frequency_sketch(sets: DataFrame) -> np.ndarray:
    """For each slot of a shingle, about how many sets have one of its shingles, at most 255.

    The table's width is fixed, so its size is bounded. Any values make a global
    order; better ones only make rare shingles come first more often.
    """
    counted = sets.select("shingles").mapInArrow(_send_counts(SKETCH), "piece int, counts binary").repartition(PIECES, "piece").mapInArrow(_add_counts, "piece int, counts binary").toArrow()
    out = np.zeros((PIECES, SKETCH // PIECES), dtype=np.uint8)
    for piece, raw in zip(counted["piece"].to_pylist(), counted["counts"].to_pylist(), strict=True):
        out[piece] = np.frombuffer(zlib.decompress(raw), np.uint8)
    return out.ravel()


def rare_first(g: np.ndarray, d: np.ndarray, edge: np.ndarray, sketch: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Like `prefixes`, under the order by frequency and then by hash."""
    key = mix(g)
    level = sketch[(key & U(len(sketch) - 1)).astype(np.int64)].astype(U)
    order = np.lexsort((key, level, d))
    rank = np.arange(len(d)) - edge[d]
    take = rank < length[d]
    return key[order][take], d[take]


def _send_rare(buckets: int, percent: int, sketch: Broadcast):  # noqa: ANN202
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Meeting(buckets)
        for batch in batches:
            for part in _parts(batch, 1):
                g, d, edge = _sets(part.column(1))
                token, row = rare_first(g, d, edge, sketch.value, prefix_length(np.diff(edge), percent))
                out.add(token, part.column(0).to_numpy()[row])
                if out.held > HELD:
                    yield from out.flush()
        yield from out.flush()

    return send


def row_bits(h: np.ndarray, d: np.ndarray, rows: int, *, parity: bool) -> np.ndarray:
    """A bitmap of BITS for each row: bit h % BITS of each value, set, or flipped with `parity`."""
    out = np.zeros((rows, BITS // 8), dtype=np.uint8)
    edge = np.searchsorted(d, np.arange(0, rows + 1024, 1024))
    for i, (a, b) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
        lo, hi = 1024 * i, min(rows, 1024 * (i + 1))
        if a < b:
            times = np.bincount((d[a:b] - lo) * BITS + (h[a:b] & U(BITS - 1)).astype(np.int64), minlength=(hi - lo) * BITS)
            bits = (times & 1) if parity else (times > 0)
            out[lo:hi] = np.packbits(bits.astype(np.uint8).reshape(hi - lo, BITS), axis=1)
    return out


def signatures(g: np.ndarray, d: np.ndarray, edge: np.ndarray, percent: int) -> np.ndarray:
    """For each set its parity bitmap, and bitmaps of its shortest sufficient prefix under the orders by hash.

    Two sets differ in at least as many shingles as their parity bitmaps differ in
    bits, and linked sets have a prefix shingle, and so a bit, in common under
    every order: neither test can lose a link.
    """
    n = np.diff(edge)
    parts = [row_bits(mix(g ^ U(PARITY)), d, len(n), parity=True)]
    for salt in ORDERS:
        token, row = prefixes(g, d, edge, salt, n - overlap_needed(n, percent) + 1)
        parts.append(row_bits(mix(token), row, len(n), parity=False))
    return np.concatenate(parts, axis=1)


def _sign(percent: int):  # noqa: ANN202
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, 1):
                g, d, edge = _sets(part.column(1))
                raw = signatures(g, d, edge, percent)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([r.tobytes() for r in raw], pa.binary())], names=["class", "shingles", "n", "signature"])

    return sign


def _bucket_rows(percent: int, sketch: Broadcast):  # noqa: ANN202
    """One row for each shingle of the shortest sufficient prefix under the order by frequency, with its place there."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, 1):
                g, d, edge = _sets(part.column(1))
                n = np.diff(edge)
                length = n - overlap_needed(n, percent) + 1
                token, row = rare_first(g, d, edge, sketch.value, length)
                place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), part.column(0).take(pa.array(row)), pa.array(place.astype(np.int32))], names=["token", "class", "place"])

    return rows


BUCKET_DDL = "token bigint, class bigint, place int"
PAIR_DDL = "a bigint, b bigint"


class _Bucket:
    """Rows of whole buckets, side by side."""

    def __init__(self, batches: list[pa.RecordBatch]) -> None:
        table = pa.Table.from_batches(batches)
        column = {name: table.column(name).to_numpy() for name in ("token", "block", "rank", "class", "n", "place", "root", "home")}
        order = np.lexsort((column["class"], column["rank"], column["block"], column["token"]))
        self.token, self.block, self.rank, self.cls, self.n, self.place, self.root, self.home = (v[order] for v in column.values())
        self.n = self.n.astype(np.int64)
        firsts = table.column("firsts").combine_chunks()
        firsts = firsts if isinstance(firsts, pa.Array) else pa.concat_arrays(firsts.chunks)
        size = np.diff(np.asarray(firsts.offsets))
        self.firsts, at = np.full((len(order), FIRSTS), NONE), owner(np.concatenate([[0], np.cumsum(size)]))
        self.firsts[at, np.arange(len(at)) - (np.cumsum(size) - size)[at]] = firsts.flatten().to_numpy()
        self.firsts = self.firsts[order]
        self.parity = _sets(pa.concat_arrays(table.column("signature").chunks))[0].reshape(len(order), -1)[order, : BITS // 64]

    def may_link(self, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
        """Of the pairs of rows, those that no test of their rows can rule out and no other bucket has.

        Where two sets have some of their first shingles in common, only the
        bucket of the least of these sends the pair.
        """
        ok = (self.root[x] != self.root[y]) & (self.cls[x] != self.cls[y]) & self.home[y]
        ok &= 100 * np.minimum(self.n[x], self.n[y]) >= percent * np.maximum(self.n[x], self.n[y])
        x, y, at = x[ok], y[ok], np.flatnonzero(ok)
        need = -(-percent * (self.n[x] + self.n[y]) // (100 + percent))
        # shingles before the shared one, the shared one, and those after it
        i, j = self.place[x].astype(np.int64), self.place[y].astype(np.int64)
        ok = np.minimum(i, j) + 1 + np.minimum(self.n[x] - i, self.n[y] - j) - 1 >= need
        x, y, at, need = x[ok], y[ok], at[ok], need[ok]
        keep = []
        for lo in range(0, len(x), 16384):
            apart = np.bitwise_count(self.parity[x[lo : lo + 16384]] ^ self.parity[y[lo : lo + 16384]]).sum(axis=1, dtype=np.int64)
            ok = (self.n[x[lo : lo + 16384]] + self.n[y[lo : lo + 16384]] - apart) // 2 >= need[lo : lo + 16384]
            a, b = self.firsts[x[lo : lo + 16384]][:, :, None], self.firsts[y[lo : lo + 16384]][:, None, :]
            least = np.where(((a == b) & (a != NONE)).any(axis=2), a[:, :, 0], OVER).min(axis=1)
            keep.append(ok & ((least == OVER) | (least == self.token[x[lo : lo + 16384]])))
        return at[np.concatenate(keep)] if keep else at

    def pairs(self, hi: int, percent: int) -> Iterator[np.ndarray]:
        """Pairs of a row whose rank is below hi with rows after it in its bucket."""
        if not len(self.token):
            return
        start = np.flatnonzero(np.concatenate([[True], (self.token[1:] != self.token[:-1]) | (self.block[1:] != self.block[:-1])]))
        size = np.diff(np.append(start, len(self.token)))
        centres = np.add.reduceat((self.rank < hi).astype(np.int64), start)
        # buckets whose rows are connected already hold nothing to find
        divided = np.maximum.reduceat(self.root, start) != np.minimum.reduceat(self.root, start)
        start, size, centres = start[divided], size[divided], centres[divided]
        for r in range(int(centres.max(initial=0))):
            wide = (centres > r) & (size > r + 1)
            at, left = start[wide] + r, size[wide] - r - 1
            x = np.repeat(at, left)
            y = np.arange(len(x)) - np.repeat(np.cumsum(left) - left, left) + x + 1
            found = self.may_link(x, y, percent)
            if len(found):
                a, b = self.cls[x[found]], self.cls[y[found]]
                yield np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)


def _pairs(hi: int, percent: int):  # noqa: ANN202
    """Pairs that may link, from rows in order by token and block. A task holds only what blocks of about ROWS rows hold."""

    def complete(held: list[pa.RecordBatch], *, last: bool) -> tuple[list[pa.RecordBatch], list[pa.RecordBatch]]:
        if last:
            return held, []
        table = pa.Table.from_batches(held)
        token, block = table.column("token").to_numpy(), table.column("block").to_numpy()
        end = int(np.flatnonzero((token != token[-1]) | (block != block[-1]))[-1]) + 1 if (token[0], block[0]) != (token[-1], block[-1]) else 0
        return table.slice(0, end).to_batches(), table.slice(end).to_batches()

    def send(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        out = np.unique(np.concatenate(found), axis=0)
        for i in range(0, len(out), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(out[i : i + 65536, j])) for j in (0, 1)], names=["a", "b"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows, found, count = 0, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= ROWS:
                now, held = complete(held, last=False)
                rows = sum(x.num_rows for x in held)
                if now:
                    for x in _Bucket(now).pairs(hi, percent):
                        found.append(x)
                        count += len(x)
                        if count > HELD:
                            found, count = [np.unique(np.concatenate(found), axis=0)], 0
        if held:
            found += _Bucket(complete(held, last=True)[0]).pairs(hi, percent)
        if found:
            yield from send(found)

    return pairs


def prefixes_meet(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the prefix bitmaps of two signatures, row by row, intersect under every order by hash."""
    both = (x & y).reshape(len(x), -1, BITS // 64)[:, 1:]
    return both.any(axis=2).all(axis=1)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, and their signatures) whose prefixes meet under every order by hash."""
    for batch in batches:
        if batch.num_rows:
            x, y = (_sets(batch.column(i))[0].reshape(batch.num_rows, -1) for i in (2, 3))
            keep = pa.array(prefixes_meet(x, y))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _verify(percent: int):  # noqa: ANN202
    def linked(x: np.ndarray, y: np.ndarray) -> bool:
        both = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * both >= percent * (len(x) + len(y) - both)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = batch.column(2), batch.column(3)
            ok = [linked(np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)) for x, y in zip(xs, ys, strict=True)]
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    return verify


def _passing(met: DataFrame, percent: int, sizes: DataFrame) -> DataFrame:
    """Classes whose prefix meets others often enough."""
    a = F.floor((F.col("n") * percent + 99) / 100)
    hits = met.where(F.col("kind") == HITS).groupBy("class").agg(F.sum("hits").alias("hits"))
    return sizes.join(hits, "class").where(F.col("hits") >= F.least(a, 1 + F.floor(a / 10))).drop("hits")


def _near_roots(links: DataFrame) -> DataFrame:
    """(class, root): classes with one root are connected. A few steps along the links, so connected ones may have several roots."""
    both = links.select(F.col("a").alias("class"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("class"), F.col("a").alias("to")))
    roots = both.groupBy("class").agg(F.least(F.min("to"), F.col("class")).alias("root"))
    for _ in range(2):
        near = both.join(roots.withColumnRenamed("class", "to"), "to").groupBy("class").agg(F.min("root").alias("root"))
        jump = near.select(F.col("class").alias("root"), F.col("root").alias("further"))
        roots = near.join(jump, "root").select("class", F.least("root", "further").alias("root"))
    return roots


def link_classes(sets: DataFrame, percent: int, sketch: Broadcast, scratch: Scratch) -> DataFrame:
    """(class, root) of all classes with links. sets: class, shingles, n and signature of the classes that may have links."""
    spark = sets.sparkSession
    parts = partitions(spark)
    rows = scratch.store(sets.select("class", "shingles").mapInArrow(_bucket_rows(percent, sketch), BUCKET_DDL))
    crowds = rows.groupBy("token").agg(F.count("*").alias("m")).where("m > 1")
    # classes are hashes, so a class has about the same rank in each of its buckets
    rank = F.floor((F.col("class") / F.lit(2.0**64) + 0.5) * F.col("m"))
    members = scratch.store(rows.join(crowds, "token").select("token", "class", "place", "m", F.least(rank, F.col("m") - 1).alias("rank")))
    scratch.drop(rows)
    sweep(spark)
    # the first few shingles that a class shares with any other: see _Bucket.may_link
    firsts = members.groupBy("class").agg(F.slice(F.sort_array(F.collect_list("token")), 1, FIRSTS).alias("firsts"))
    info = scratch.store(sets.select("class", "n", "signature").join(firsts, "class"))
    light = info.withColumn("signature", F.substring("signature", 1, BITS // 8))
    top = members.agg(F.max("m")).first()[0] or 0
    links, roots = None, None
    lo, hi = 0, 1
    while lo < top:
        still = members.where(F.col("rank") >= lo).join(light, "class")
        still = still.withColumn("root", F.col("class")) if roots is None else still.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class"))
        blocks = F.ceil(F.col("m") / F.lit(ROWS))
        own = F.pmod(F.xxhash64("class"), blocks)
        every = F.when((F.col("rank") < hi) & (blocks > 1), F.sequence(F.lit(0).cast("bigint"), blocks - 1)).otherwise(F.array(own))
        dealt = still.withColumn("own", own).withColumn("block", F.explode(every)).withColumn("home", F.col("own") == F.col("block"))
        dealt = dealt.select("token", "block", "rank", "class", "n", "place", "root", "home", "signature", "firsts").repartition(parts, "token", "block").sortWithinPartitions("token", "block")
        pairs = dealt.mapInArrow(_pairs(hi, percent), PAIR_DDL).distinct()
        for end, name in (("a", "x"), ("b", "y")):
            pairs = pairs.join(info.select(F.col("class").alias(end), F.col("signature").alias(name)), end)
        pairs = scratch.store(pairs.select("a", "b", "x", "y").mapInArrow(_meet, PAIR_DDL))
        # only sets of some pair leave their place: the others are kept back by a bitmap of fixed size
        needed = _marks(pairs.select(F.explode(F.array("a", "b")).alias("key")))
        shingles = sets.select("class", "shingles", F.pmod(F.xxhash64("class"), F.lit(MARKS)).alias("bit")).mapInArrow(_marked(needed), "class bigint, shingles binary")
        both = pairs.join(shingles.withColumnsRenamed({"class": "a", "shingles": "x"}), "a").join(shingles.withColumnsRenamed({"class": "b", "shingles": "y"}), "b").select("a", "b", "x", "y")
        found = both.mapInArrow(_verify(percent), PAIR_DDL)
        before = links
        links = scratch.store(found if links is None else links.unionByName(found))
        scratch.drop(pairs, before)
        before, roots = roots, scratch.store(_near_roots(links)) if hi < top else None
        scratch.drop(before)
        sweep(spark)
        lo, hi = hi, hi * 8
    scratch.drop(members, info)
    if links is None:
        return sets.select("class", F.col("class").alias("root")).limit(0)
    return components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("class"), "root")


def _marked(marks: np.ndarray):  # noqa: ANN202
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column(2).to_numpy()
            some = batch.filter(pa.array((marks[bit >> 6] >> (bit & 63)) & 1 == 1))
            yield pa.RecordBatch.from_arrays(some.columns[:2], names=["class", "shingles"])

    return keep


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """Components of documents whose sets of `size`-word shingles have a Jaccard similarity of `percent` or more.

    Returns one row for each row of `docs`: the id, n_shingles and component_id,
    the smallest id that links reach. Words are lower-cased (A-Z). A text of
    fewer than `size` words has one shingle, all its words; a null or blank text
    has none and links to nothing, so its component is its own id. Ids must be
    integers (else ValueError); rows without an id take part, and give no
    component its name unless it has no other. Other columns of `docs` are not
    read.
    """
    spark = docs.sparkSession
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{id_col} must be an integer")
    parts, buckets = partitions(spark), bucket_count(docs)
    scratch = Scratch(spark, "jaccard")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = keyed(docs, id_col, text_col).select("key", "doc", "text")
    meet = lambda sent: sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_receive, MET_DDL)
    with small_batches(spark):
        met = scratch.store(meet(rows.select("key", "doc", "text").mapInArrow(_send_documents(buckets, size, percent), MEET_DDL)))
    sweep(spark)
    every = met.where(F.col("kind") == CLASSES).select("key", "doc", "class", "n")
    classes = every.where("n > 0").groupBy("class").agg(F.min(F.struct("doc", "key")).alias("first"), F.first("n").alias("n")).select("class", "n", F.col("first.doc").alias("doc"), F.col("first.key").alias("key"))
    passing = scratch.store(_passing(met, percent, classes).select("key", "class"))
    marked = rows.select("key", "doc", "text", F.pmod(F.xxhash64("key"), F.lit(MARKS)).alias("bit"))
    near = marked.mapInArrow(_pack_sets(size, _marks(passing)), "key bigint, doc bigint, class bigint, shingles binary, n int")
    with small_batches(spark):
        sets = scratch.store(near.join(passing, ["key", "class"], "left_semi").dropDuplicates(["key", "class"]).select("class", "shingles", "n"))
    scratch.drop(passing)
    sweep(spark)
    sizes = sets.select("class", "n")
    for salt in ORDERS[1:]:
        sizes = _passing(meet(sets.select("class", "shingles").mapInArrow(_send_sets(buckets, salt, percent), MEET_DDL)), percent, sizes)
    with small_batches(spark):
        sketch = spark.sparkContext.broadcast(frequency_sketch(sets))
        sizes = scratch.store(_passing(meet(sets.select("class", "shingles").mapInArrow(_send_rare(buckets, percent, sketch), MEET_DDL)), percent, sizes))
    sweep(spark)
    signed = sets.join(sizes.select("class"), "class", "left_semi").mapInArrow(_sign(percent), "class bigint, shingles binary, n int, signature binary")
    with small_batches(spark):
        linkable = scratch.store(signed)
    scratch.drop(sets, sizes)
    with small_batches(spark):
        roots = scratch.store(link_classes(linkable, percent, sketch, scratch))
    scratch.drop(linkable)
    named = roots.join(classes.select("class", "doc"), "class").groupBy("root").agg(F.min("doc").alias("component_id"))
    linked = roots.join(named, "root").select("class", "component_id")
    own = classes.join(linked, "class", "left").select("class", F.coalesce("component_id", "doc").alias("component_id"))
    out = every.join(own, "class", "left").select("doc", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component_id", "doc").alias("component_id"))
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).cast(id_type)
    return out.select(real("doc").alias(id_col), "n_shingles", real("component_id").alias("component_id"))
