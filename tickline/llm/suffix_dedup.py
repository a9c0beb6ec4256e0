"""Suffix-array deduplication: repeated byte strings found by merging shard Burrows-Wheeler transforms.

Sorting or merging every suffix of the corpus is not needed to find strings that
repeat: a 50-byte string can only repeat if its anchor (see `repeats`) does.
Runs that agree as a whole with a run of a smaller document are settled in the
exchange. The text of the remaining runs with a repeated anchor, one of each
content, is dealt out by anchor, or, where an anchor has very much text, by a
longer one; within a partition it is cut into shards, each shard's Burrows-Wheeler transform is built, and the transforms are merged by
iterative interleave refinement to the depth of the string length (see `bwt`).
The merge's blocks of suffixes with a common prefix of that length are the
repeated intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm import repeats
from tickline.llm.bwt import repeated_intervals
from tickline.llm.fragments import FRAGMENT_DDL, Places, meet
from tickline.llm.repeats import COVERED, HELD, PACKED_DDL, WANTED, Sender
from tickline.llm.shared import Scratch
from tickline.llm.text import BYTE_VALUE, chunks, gram_hash, prefix_sums, slide_min

#: Bytes of the grams that anchor a string of 50 bytes.
ANCHOR_BYTES = 20
#: Bytes of fragments that one merge takes on, few enough for its arrays to stay in cache.
MERGE_BYTES = 1 << 18


def _anchor(length: int) -> int:
    return min(ANCHOR_BYTES, (length + 1) // 2)


def _find_runs(buckets: int, length: int):  # noqa: ANN202
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(buckets, smaller=True)
        for batch in batches:
            key, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, _, data, off in chunks(batch.column(2)):
                m, rh, row, s, n = repeats.runs(prefix_sums(BYTE_VALUE[data]), off, length, _anchor(length))
                out.add(m, rh, key[lo + row], doc[lo + row], s, n)
                if out.held > HELD:
                    yield from out.flush()
        yield from out.flush()

    return find


def _cut_fragments(length: int):  # noqa: ANN202
    k = _anchor(length)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, doc = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo, hi, data, off in chunks(batch.column(2)):
                row, s, e, _ = repeats.asked(batch.column(3), lo, hi)
                start, end = off[row] + s, off[row] + e - 1 + length
                width = length - k + 1
                grams = gram_hash(prefix_sums(BYTE_VALUE[data]), k)
                anchor = slide_min(grams, width)[start] if len(start) else np.empty(0, np.uint64)
                raw = data.tobytes()
                for i in range(0, len(row), 16384):
                    at = slice(i, i + 16384)
                    pieces = [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(anchor[at].view(np.int64)), pa.array(key[lo + row[at]]), pa.array(doc[lo + row[at]]), pa.array(s[at].astype(np.int32)), pa.array(pieces, pa.binary())], names=["anchor", "key", "doc", "s", "piece"])

    return cut_out


def _repeated(pieces: list[bytes], doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first window, end) of the windows of distinct pieces that a piece of a smaller document has too."""
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])
    starts, block = repeated_intervals([np.frombuffer(p, np.uint8) + np.uint8(1) for p in pieces], length)
    piece = np.searchsorted(base, starts, side="right") - 1
    whole = starts - base[piece] + length <= sizes[piece]
    starts, block, piece = starts[whole], block[whole], piece[whole]
    if not len(starts):
        return (np.empty(0, np.int64),) * 3
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    least = np.minimum.reduceat(doc[piece], first)
    hit = doc[piece] > np.repeat(least, np.diff(np.append(first, len(block))))
    found = np.sort(starts[hit])
    cut_at = np.ones(len(found) + 1, dtype=bool)
    cut_at[1:-1] = found[1:] != found[:-1] + 1
    lo, hi = found[cut_at[:-1]], found[cut_at[1:]] + 1
    which = np.searchsorted(base, lo, side="right") - 1
    return which, lo - base[which], hi - base[which]


def _longer(length: int):  # noqa: ANN202
    """The longer anchor of a string is its anchor with the bytes beside it, on the side where the string has more of them."""
    k = _anchor(length)
    more = (length - k + 1) // 2

    def longer(anchor: int, s: int, piece: bytes) -> list[tuple[int, int, bytes]]:
        sums = prefix_sums(BYTE_VALUE[np.frombuffer(piece, np.uint8)])
        at = np.flatnonzero(gram_hash(sums, k).view(np.int64) == anchor)
        window = np.arange(len(piece) - length + 1)
        place = at[np.searchsorted(at, window)]
        place = np.where(place - window < more, place, place - more)
        wide = gram_hash(sums, k + more).view(np.int64)[place]
        edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]])).tolist()
        return [(int(wide[a]), s + a, piece[a : b - 1 + length]) for a, b in zip(edge[:-1], edge[1:], strict=True)]

    return longer


def _settle(length: int):  # noqa: ANN202
    def settle(held: dict[bytes, Places]) -> list[tuple[int, int, int]]:
        """Equal pieces are merged once, for their smallest document; the others are covered whole."""
        least = np.array([min(doc for _, doc, _ in rows) for rows in held.values()], dtype=np.int64)
        pieces = list(held)
        spans = [(key, s, s + len(piece) - length + 1) for (piece, rows), m in zip(held.items(), least.tolist(), strict=True) for key, doc, s in rows if doc > m]
        if len(pieces) > 1 or len(pieces[0]) > length:
            for which, lo, hi in zip(*(x.tolist() for x in _repeated(pieces, least, length)), strict=True):
                spans += [(key, s + lo, s + hi) for key, doc, s in held[pieces[which]] if doc == least[which]]
        return spans

    return settle


def duplicate_spans(docs: DataFrame, dealt: DataFrame, length: int, scratch: Scratch) -> DataFrame:
    """key, s, e: strings starting at bytes [s, e) of the row `key` that start in a smaller document too. dealt: the same rows, by key."""
    first = scratch.store(repeats.exchange(docs.select("key", "doc", "text").mapInArrow(_find_runs(repeats.bucket_count(docs), length), PACKED_DDL), smaller=True))
    asked = first.where(F.col("kind") == WANTED).groupBy("key").agg(F.collect_list(F.struct("s", "e", "weight")).alias("asked"))
    pieces = dealt.join(asked.hint("shuffle_hash"), "key").select("key", "doc", "text", "asked", "id").mapInArrow(_cut_fragments(length), FRAGMENT_DDL)
    second = meet(pieces, _settle(length), _longer(length), MERGE_BYTES)
    return first.where(F.col("kind") == COVERED).select("key", "s", "e").unionByName(second)


def _remove(length: int):  # noqa: ANN202
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, runs, digest, texts = [], [], [], [], []
            starts, ends = batch.column(2), batch.column(3)
            for i, text in enumerate(batch.column(1)):
                raw = (text.as_py() or "").encode()
                gone = spans = 0
                total.append(len(raw))
                if starts[i].is_valid and raw:
                    s, e = np.asarray(starts[i].values).astype(np.int64), np.asarray(ends[i].values) - 1 + length
                    order = np.argsort(s)
                    s, reach = s[order], np.maximum.accumulate(e[order])
                    new = np.flatnonzero(np.concatenate([[True], s[1:] > reach[:-1]]))
                    lo, hi = s[new], reach[np.append(new[1:], len(s)) - 1]
                    gone, spans = int((hi - lo).sum()), len(lo)
                    raw = b"".join(raw[a:b] for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(raw)], strict=True))
                removed.append(gone)
                runs.append(spans)
                digest.append(hashlib.sha256(raw).hexdigest())
                texts.append(raw if gone else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string()), pa.array(texts, pa.binary())],
                names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"],
            )

    return remove


def dedup_bytes(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50) -> DataFrame:
    """Removes every byte that a string of `length` bytes (even) covers which also starts in a document with a smaller id.

    Returns one row for each row of `docs`: the id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept_sha256 and kept_bytes (null if nothing was
    removed; the bytes that stay need not be UTF-8, since a string may begin
    within a character). Null and empty texts have no bytes. Ids are integers;
    rows without an id come after all others and are not smaller than each
    other, nor are rows with equal ids. Other columns of `docs` are not read.
    """
    if length % 2:
        raise ValueError("length must be even")
    rows = repeats.keyed(docs, id_col, text_col)
    dealt = rows.repartition(repeats.partitions(docs.sparkSession), "key")
    gathered = duplicate_spans(rows, dealt, length, Scratch(docs.sparkSession, "suffixes")).groupBy("key").agg(F.collect_list("s").alias("s"), F.collect_list("e").alias("e"))
    id_type = docs.schema[id_col].dataType.simpleString()
    out = dealt.join(gathered.hint("shuffle_hash"), "key", "left").select("id", "text", "s", "e", "doc").mapInArrow(_remove(length), f"id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept_bytes binary")
    return out.withColumnRenamed("id", id_col)
