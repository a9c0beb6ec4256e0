"""Fragments of text that share an anchor meet, whatever the size of their group.

A fragment is the text of a run of windows with one anchor (see `repeats`).
Fragments are dealt out by anchor and settled a few groups at a time. Equal
fragments are one piece with several places. A group of more than HOT_BYTES of
different pieces is not held: it is cut by longer anchors and dealt out again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.repeats import partitions

#: (key, document, first window) of the places of a piece.
Places = list[tuple[int, int, int]]
#: Spans (key, first window, end) that pieces with their places settle.
Settle = Callable[[dict[bytes, Places]], list[tuple[int, int, int]]]
#: The parts (longer anchor, first window, piece) of a fragment (anchor, first window, piece).
Longer = Callable[[int, int, bytes], list[tuple[int, int, bytes]]]

#: Bytes of pieces of one anchor beyond which they are dealt out by a longer one.
HOT_BYTES = 4 << 20
FRAGMENT_DDL = "anchor bigint, key bigint, doc bigint, s int, piece binary"
MERGED = [("route", pa.int64()), ("anchor", pa.int64()), ("key", pa.int64()), ("doc", pa.int64()), ("s", pa.int32()), ("e", pa.int32()), ("piece", pa.binary())]
MERGED_DDL = "route bigint, anchor bigint, key bigint, doc bigint, s int, e int, piece binary"


def _packed(**columns: tuple) -> pa.RecordBatch:
    n = len(columns["key"])
    return pa.RecordBatch.from_arrays([pa.array(columns[name], t) if name in columns else pa.nulls(n, t) for name, t in MERGED], names=[name for name, _ in MERGED])


def _gather(settle: Settle, longer: Longer, together: int, hot: int | None):  # noqa: ANN202
    """Settles fragments that come in order by anchor.

    About `together` bytes of whole groups are held, and `hot` bytes of one
    anchor. Rows without a piece are spans, and pass.
    """

    def settled(held: dict[bytes, Places]) -> pa.RecordBatch:
        spans = settle(held)
        key, s, e = zip(*spans, strict=True) if spans else ((), (), ())
        return _packed(route=key, key=key, s=s, e=e)

    def onward(anchor: int, rows: list[tuple[bytes, int, int, int]]) -> pa.RecordBatch:
        parts = [(wide, key, doc, at, part) for piece, key, doc, s in rows for wide, at, part in longer(anchor, s, piece)]
        wide, key, doc, s, piece = zip(*parts, strict=True)
        return _packed(route=wide, anchor=wide, key=key, doc=doc, s=s, piece=piece)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, Places] = {}
        own: dict[bytes, Places] = {}
        size = own_size = 0
        last, splitting, wait = None, False, []
        for batch in batches:
            if "e" in batch.schema.names:
                spans = batch.filter(batch.column("piece").is_null())
                if spans.num_rows:
                    yield spans.select([name for name, _ in MERGED])
                batch = batch.filter(batch.column("piece").is_valid())
            for anchor, key, doc, s, piece in zip(*(batch.column(c).to_pylist() for c in ("anchor", "key", "doc", "s", "piece")), strict=True):
                if anchor != last:
                    if wait:
                        yield onward(last, wait)
                        wait = []
                    held |= own
                    size += own_size
                    if size >= together:
                        yield settled(held)
                        held, size = {}, 0
                    own, own_size, last, splitting = {}, 0, anchor, False
                if splitting:
                    wait.append((piece, key, doc, s))
                    if len(wait) >= 4096:
                        yield onward(anchor, wait)
                        wait = []
                    continue
                if piece not in own:
                    own[piece] = []
                    own_size += len(piece)
                own[piece].append((key, doc, s))
                if hot is not None and own_size > hot:
                    wait, splitting = [(p, *row) for p, rows in own.items() for row in rows], True
                    own, own_size = {}, 0
        if wait:
            yield onward(last, wait)
        held |= own
        if held:
            yield settled(held)

    return gather


def meet(pieces: DataFrame, settle: Settle, longer: Longer, together: int) -> DataFrame:
    """key, s, e: what `settle` finds among the fragments (FRAGMENT_DDL) of each anchor."""
    n = partitions(pieces.sparkSession)
    first = pieces.repartition(n, "anchor").sortWithinPartitions("anchor").mapInArrow(_gather(settle, longer, together, HOT_BYTES), MERGED_DDL)
    again = first.repartition(n, "route").sortWithinPartitions("anchor").mapInArrow(_gather(settle, longer, together, None), MERGED_DDL)
    return again.select("key", "s", "e").where(F.col("key").isNotNull())
