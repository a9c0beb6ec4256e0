"""Substring deduplication by relative Lempel-Ziv parsing.

The reference is the corpus itself, in blocks: runs of windows with one anchor
(see `repeats`), indexed by it. Blocks that agree as a whole are one factor, found
by hash in the exchange. The texts of all other blocks whose anchor occurs again
meet there; each is factored greedily against all of them (see `factors`). A
factor of a window or more is a duplicate span, and windows that cross the end of
a factor are looked up one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm import repeats
from tickline.llm.factors import repeated_windows
from tickline.llm.fragments import FRAGMENT_DDL, Places, meet
from tickline.llm.repeats import COVERED, HELD, PACKED_DDL, WANTED, Sender
from tickline.llm.shared import Scratch
from tickline.llm.text import chunks, gram_hash, prefix_sums, slide_min, word_hash, words

#: Words of the k-grams that anchor a window of 35 words.
ANCHOR_WORDS = 18
#: Bytes of blocks that are factored together.
TOGETHER_BYTES = 1 << 20


def _anchor(window: int) -> int:
    return min(ANCHOR_WORDS, (window + 1) // 2)


def _hashed(text: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for lo, hi, data, off in chunks(text):
        first, last, word_off = words(data, off)
        yield lo, hi, prefix_sums(word_hash(data, first, last)), word_off


def _parse(buckets: int, window: int):  # noqa: ANN202
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sender(buckets, smaller=False)
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, _, sums, off in _hashed(batch.column(1)):
                m, rh, doc, s, n = repeats.runs(sums, off, window, _anchor(window))
                own = repeats.repeats_inside(sums, s + off[doc], n, m, window, _anchor(window))
                k = key[lo + doc]
                out.add(m, rh, k, k, s, n, np.where(own, repeats.SELF, 0))
                if out.held > HELD:
                    yield from out.flush()
        yield from out.flush()

    return parse


def _cut_blocks(window: int):  # noqa: ANN202
    """The texts of the runs asked for, each with its anchor."""
    k = _anchor(window)

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, data, off in chunks(batch.column(1)):
                row, s, e, _ = repeats.asked(batch.column(2), lo, hi)
                first, last, word_off = words(data, off)
                anchors = slide_min(gram_hash(prefix_sums(word_hash(data, first, last)), k), window - k + 1)
                start = word_off[row] + s
                begin, end = first[start], last[word_off[row] + e - 2 + window]
                raw = data.tobytes()
                for i in range(0, len(row), 16384):
                    at = slice(i, i + 16384)
                    pieces = [raw[a:b] for a, b in zip(begin[at].tolist(), end[at].tolist(), strict=True)]
                    keys = pa.array(key[lo + row[at]])
                    yield pa.RecordBatch.from_arrays([pa.array(anchors[start[at]].view(np.int64)), keys, keys, pa.array(s[at].astype(np.int32)), pa.array(pieces, pa.binary())], names=["anchor", "key", "doc", "s", "piece"])

    return cut_out


def _items(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all pieces, and each piece's range of them."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
    first, last, word_off = words(data, off)
    return word_hash(data, first, last), word_off


def _settle(window: int):  # noqa: ANN202
    def settle(held: dict[bytes, Places]) -> list[tuple[int, int, int]]:
        """Windows of a piece recur if the piece has two places, or a factor of a piece holds them."""
        pieces = list(held)
        h, off = _items(pieces)
        _, item = np.unique(h, return_inverse=True)
        spans = []
        for piece, hit in zip(pieces, repeated_windows(np.split(item, off[1:-1]), window), strict=True):
            places = held[piece]
            if len(places) > 1:
                spans += [(key, s, s + len(hit)) for key, _, s in places]
            elif hit.any():
                key, _, s = places[0]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))).tolist()
                spans += [(key, s + a, s + b) for a, b in zip(edge[::2], edge[1::2], strict=True)]
        return spans

    return settle


def _longer(window: int):  # noqa: ANN202
    """The longer anchor of a window is its anchor with the words beside it, on the side where the window has more of them."""
    k = _anchor(window)
    more = (window - k + 1) // 2

    def longer(anchor: int, s: int, piece: bytes) -> list[tuple[int, int, bytes]]:
        data = np.frombuffer(piece, np.uint8)
        first, last, _ = words(data, np.array([0, len(data)]))
        sums = prefix_sums(word_hash(data, first, last))
        at = np.flatnonzero(gram_hash(sums, k).view(np.int64) == anchor)
        start = np.arange(len(first) - window + 1)
        place = at[np.searchsorted(at, start)]
        place = np.where(place - start < more, place, place - more)
        wide = gram_hash(sums, k + more).view(np.int64)[place]
        edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1], [True]])).tolist()
        return [(int(wide[a]), s + a, piece[first[a] : last[b - 2 + window]]) for a, b in zip(edge[:-1], edge[1:], strict=True)]

    return longer


def duplicate_spans(texts: DataFrame, dealt: DataFrame, window: int) -> DataFrame:
    """key, s, e: windows [s, e) of the text `key` that start elsewhere too. dealt: the same texts, by key."""
    n = repeats.bucket_count(texts)
    first = Scratch(texts.sparkSession, "windows").store(repeats.exchange(texts.select("key", "text").mapInArrow(_parse(n, window), PACKED_DDL), smaller=False))
    asked = first.where(F.col("kind") == WANTED).groupBy("key").agg(F.collect_list(F.struct("s", "e", "weight")).alias("asked"))
    blocks = dealt.join(asked.hint("shuffle_hash"), "key").select("key", "text", "asked", "id").mapInArrow(_cut_blocks(window), FRAGMENT_DDL)
    second = meet(blocks, _settle(window), _longer(window), TOGETHER_BYTES)
    return first.where(F.col("kind") == COVERED).select("key", "s", "e").unionByName(second)


def _remove(window: int):  # noqa: ANN202
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, digest, kept_text = [], [], [], []
            starts, ends = batch.column(2), batch.column(3)
            for i, text in enumerate(batch.column(1)):
                tokens = (text.as_py() or "").encode().split()
                n, s = len(tokens), starts[i]
                total.append(n)
                gone = 0
                if s.is_valid and n:
                    mark = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(mark, np.asarray(s.values), 1)
                    np.add.at(mark, np.asarray(ends[i].values) - 1 + window, -1)
                    keep = np.cumsum(mark[:-1]) == 0
                    gone = n - int(keep.sum())
                    tokens = list(compress(tokens, keep.tolist()))
                removed.append(gone)
                kept = b" ".join(tokens)
                digest.append(hashlib.sha256(kept).hexdigest())
                kept_text.append(kept if gone else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(kept_text, pa.binary()).cast(pa.string())],
                names=["id", "n_words", "n_removed", "kept_sha256", "kept_text"],
            )

    return remove


def dedup_substrings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """Removes every word that a repeated window of `window` words covers.

    Returns one row for each row of `docs`: the id, n_words, n_removed,
    kept_sha256 (of the kept words, joined by one space) and kept_text (null if
    nothing was removed, as the text then stays as it is). Null and empty texts
    have no words. Rows with an id in common are judged as separate documents;
    equal rows are copies of each other. Ids may be null. Other columns of
    `docs`, whatever their names, are not read.
    """
    texts = repeats.keyed(docs, id_col, text_col).select("key", "text", "id")
    dealt = texts.repartition(repeats.partitions(docs.sparkSession), "key")
    spans = duplicate_spans(texts, dealt, window)
    gathered = spans.groupBy("key").agg(F.collect_list("s").alias("s"), F.collect_list("e").alias("e"))
    id_type = docs.schema[id_col].dataType.simpleString()
    out = dealt.join(gathered.hint("shuffle_hash"), "key", "left").select("id", "text", "s", "e").mapInArrow(_remove(window), f"id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")
    return out.withColumnRenamed("id", id_col)
