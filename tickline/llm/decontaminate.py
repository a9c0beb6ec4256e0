"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The seeds of a test item are its n-grams, without the most frequent in the
corpus as far as every copy must hold two others. A copy of half the score may
have lost any of them, so then none is spared and nothing need be counted.
Passages of documents with two different seeds of an item near each other
are aligned with the item, word by word. A passage whose alignment reaches a
share of the score of a perfect copy is contamination.

Test items are taken in blocks of bounded size, each broadcast to one pass over
the documents; what is broadcast never grows beyond a block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.text import LOWER_VALUE, U, buffers, chunks, gram_hash, owner, prefix_sums, span_hash

#: Bytes of item text in one block.
BLOCK_BYTES = 8 << 20
GRAM = 3
#: Documents in which an n-gram may occur and still be rare, whatever the item's others.
RARE = 3
#: Share of a perfect copy's score that makes a passage a copy.
SHARE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
_BREAK = np.ones(256, dtype=bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def tokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words, each document's range): runs of letters, digits and other than ASCII, lower-cased."""
    gap = _BREAK[data]
    edges = off[(off > 0) & (off < len(data))]
    before = np.ones(len(data), dtype=bool)
    before[1:] = gap[:-1]
    before[edges] = True
    after = np.ones(len(data), dtype=bool)
    after[:-1] = gap[1:]
    after[edges - 1] = True
    first, last = np.flatnonzero(~gap & before), np.flatnonzero(~gap & after) + 1
    return span_hash(prefix_sums(LOWER_VALUE[data]), first, last), np.searchsorted(first, off)


@dataclass
class Items:
    """A block of test items: their words, and the distinct n-grams of each."""

    ids: np.ndarray
    words: np.ndarray
    edge: np.ndarray
    gram: np.ndarray
    item: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, text: pa.Array, n: int) -> Items:
        raw, off = buffers(text)
        off = off - off[0] if len(off) else off
        h, edge = tokens(raw[: off[-1]] if len(off) else raw, off)
        count = np.diff(edge)
        grams = gram_hash(prefix_sums(h), n)
        doc = owner(edge)
        whole = doc[: len(grams)] == doc[n - 1 : n - 1 + len(grams)]
        short = np.flatnonzero((count > 0) & (count < n))
        item = np.concatenate([doc[: len(grams)][whole], short])
        gram = np.concatenate([grams[whole], span_hash(prefix_sums(h), edge[short], edge[short + 1])])
        pair = np.unique(np.stack([gram, item.astype(U)], axis=1), axis=0)
        return cls(ids, h, edge, pair[:, 0], pair[:, 1].astype(np.int64))

    def keep(self, seeds: np.ndarray) -> Items:
        return Items(self.ids, self.words, self.edge, self.gram[seeds], self.item[seeds])


def _seed_hits(h: np.ndarray, off: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document number, word position, place among the distinct `grams`) of each occurrence."""
    if not len(grams):
        return (np.empty(0, np.int64),) * 3
    g = gram_hash(prefix_sums(h), n)
    doc = owner(off)
    at = np.searchsorted(grams, g)
    at[at == len(grams)] = 0
    hit = np.flatnonzero((grams[at] == g) & (doc[: len(g)] == doc[n - 1 : n - 1 + len(g)]))
    return doc[hit], hit, at[hit]


def _count(grams: np.ndarray, n: int):  # noqa: ANN202
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(grams), dtype=np.int64)
        for batch in batches:
            for _, _, data, off in chunks(batch.column(0)):
                h, edge = tokens(data, off)
                doc, _, at = _seed_hits(h, edge, grams, n)
                if len(at):
                    np.add.at(total, np.unique(np.stack([doc, at], axis=1), axis=0)[:, 1], 1)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["gram", "docs"])

    return count


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Smith-Waterman: (best score, start, end) of the passage's part in the best alignment."""
    m = len(passage)
    steps = np.arange(m + 1) * GAP
    best, end = 0, 0
    score = np.zeros(m + 1, dtype=np.int64)
    start = np.arange(m + 1)
    origin = 0
    for word in item:
        same = np.where(passage == word, MATCH, MISMATCH)
        up, diagonal = score + GAP, score[:-1] + same
        new, began = np.zeros(m + 1, dtype=np.int64), np.arange(m + 1)
        new[1:], began[1:] = diagonal, start[:-1]
        better = up > new
        new[better], began[better] = up[better], start[better]
        low = new <= 0
        new[low], began[low] = 0, np.arange(m + 1)[low]
        level = new - steps
        reach = np.maximum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == reach, np.arange(m + 1), 0))
        along = reach + steps
        longer = along > new
        new[longer], began[longer] = along[longer], began[source[longer]]
        score, start = new, began
        top = int(score.argmax())
        if score[top] > best:
            best, end, origin = int(score[top]), top, int(start[top])
    return best, origin, end


def _passages(at: np.ndarray, seed: np.ndarray, size: int, total: int) -> Iterator[tuple[int, int]]:
    """Stretches of a document around seeds of one item that stand near each other, two different ones at least (one if the item has but one)."""
    reach = 2 * size + 4
    cuts = np.flatnonzero(np.diff(at) > reach) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
        if len(np.unique(seed[a:b])) >= 2 or size <= GRAM + 1:
            yield max(0, int(at[a]) - reach), min(total, int(at[b - 1]) + reach)


def _search(items: Items, n: int, share: float):  # noqa: ANN202
    grams = np.unique(items.gram)
    first = np.searchsorted(items.gram, grams, side="left")
    last = np.searchsorted(items.gram, grams, side="right")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, data, off in chunks(batch.column(1)):
                h, edge = tokens(data, off)
                doc, at, seed = _seed_hits(h, edge, grams, n)
                if not len(doc):
                    continue
                size = last[seed] - first[seed]
                which = np.repeat(np.arange(len(seed)), size)
                item = items.item[np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + first[seed][which]]
                doc, at, seed = doc[which], at[which], seed[which]
                order = np.lexsort((at, item, doc))
                doc, at, seed, item = doc[order], at[order], seed[order], item[order]
                new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (item[1:] != item[:-1])])).tolist()
                rows = []
                for a, b in zip(new, [*new[1:], len(doc)], strict=True):
                    d, i = int(doc[a]), int(item[a])
                    words = items.words[items.edge[i] : items.edge[i + 1]]
                    base, total = int(edge[d]), int(edge[d + 1] - edge[d])
                    best = (0.0, 0, 0)
                    for s, e in _passages(at[a:b] - base, seed[a:b], len(words), total):
                        score, began, ended = align(words, h[base + s : base + e])
                        best = max(best, (score / (MATCH * len(words)), s + began, s + ended), key=lambda x: (x[0], -x[1]))
                    if best[0] >= share:
                        rows.append((lo + d, i, *best))
                if rows:
                    row, i, score, s, e = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(items.ids[list(i)]), pa.array(score, pa.float64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())], names=["id", "item_id", "score", "start_word", "end_word"])

    return search


def spared(items: Items, n: int, share: float) -> np.ndarray:
    """For each item, how many of its n-grams can be left out so that a copy with `share` of the score still holds two of the others.

    A point of the score buys at most n - 1 lost n-grams (a word put in between),
    so those that a copy must hold are the distinct ones less n - 1 for each
    point that it may lose.
    """
    lost = np.floor((1 - share) * MATCH * np.diff(items.edge) + 1e-9).astype(np.int64) * max(n - 1, 1)
    return np.maximum(0, np.bincount(items.item, minlength=len(items.ids)) - lost - 2)


def _counted(docs: DataFrame, text_col: str, items: Items, n: int) -> np.ndarray:
    """For each n-gram of each item, the number of documents that hold it."""
    grams, back = np.unique(items.gram, return_inverse=True)
    counted = docs.select(F.col(text_col)).mapInArrow(_count(grams, n), "gram bigint, docs bigint").groupBy("gram").agg(F.sum("docs").alias("docs")).toArrow()
    held = np.zeros(len(grams), dtype=np.int64)
    held[counted["gram"].to_numpy()] = counted["docs"].to_numpy()
    return held[back]


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", n: int = GRAM, rare: int = RARE, share: float = SHARE) -> DataFrame:
    """One row for each document and test item that it holds a copy of: score (1 for a perfect copy), start_word, end_word.

    The item id must be an integer. Items or documents without words match
    nothing; an item shorter than `n` words has its whole text for its only
    seed and is only searched where a document has `n` words, so it matches
    nothing either. Rows of `docs` with equal ids are searched each. Of several
    passages with copies the best is reported, the first of equals.
    """
    some = benchmark.where(F.col(item_text_col).isNotNull() & F.col(item_col).isNotNull())
    total = some.agg(F.sum(F.octet_length(item_text_col))).first()[0] or 0
    blocks = int(total // BLOCK_BYTES) + 1
    id_type = docs.schema[id_col].dataType.simpleString()
    out = None
    for block in range(blocks):
        rows = some.where(F.pmod(F.xxhash64(item_col), F.lit(blocks)) == block).orderBy(item_col).select(F.col(item_col).cast("bigint").alias("i"), F.col(item_text_col).alias("t")).toArrow()
        items = Items.of(rows["i"].to_numpy(), rows["t"].combine_chunks(), n)
        spare = spared(items, n, share)
        if spare.any():
            often = _counted(docs, text_col, items, n)
            order = np.lexsort((often, items.item))
            number = np.bincount(items.item, minlength=len(items.ids))
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order)) - (np.cumsum(number) - number)[items.item[order]]
            items = items.keep((place < (number - spare)[items.item]) | (often <= rare))
        found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_search(items, n, share), f"id {id_type}, item_id bigint, score double, start_word int, end_word int")
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("id", id_col)
