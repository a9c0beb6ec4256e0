"""Burrows-Wheeler transforms of shards and their merge by interleave refinement.

The merge never sorts suffixes of different shards against each other. It keeps
the interleave of the shards' transforms: which shard each position of the
merged transform comes from. Refinement h+1 walks the merged transform of
refinement h and deals its positions out by their symbol, stably; after h steps
the suffixes are in order by their first h symbols. Along with the interleave
goes the number of the block of suffixes that agree on those h symbols, so that
after h steps the common prefixes of length h are known: blocks with more than
one member are the repeated intervals. Transforms hold pairs of symbols, so one
step refines by two.
"""

from __future__ import annotations

import numpy as np

#: Symbol that ends each string. Bytes b of UTF-8 text are symbols b + 1, at most 0xF5.
END = np.uint8(0)
#: Symbols of a shard.
SHARD = 1 << 16


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of `text` in order by at least their first `depth` symbols."""
    n = len(text)
    padded = np.zeros(n + 8, dtype=np.uint64)
    padded[:n] = text
    rank = np.zeros(n, dtype=np.uint64)
    for i in range(7):
        rank = (rank << np.uint64(8)) | padded[i : i + n]
    reach, rank = 7, rank.astype(np.int64)
    while True:
        order = np.argsort(rank, kind="stable")
        new = np.ones(n, dtype=np.int64)
        new[1:] = rank[order][1:] != rank[order][:-1]
        dense = np.empty(n, dtype=np.int64)
        dense[order] = np.cumsum(new)
        if reach >= depth or dense[order[-1]] == n:
            return order
        follow = np.zeros(n, dtype=np.int64)
        follow[: max(0, n - reach)] = dense[reach:]
        rank = dense * (n + 1) + follow
        reach *= 2


def transform(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(BWT in symbol pairs, suffix order) of a shard: the two symbols before each suffix, so a step refines by two."""
    order = suffix_order(text, depth)
    return text[order - 2].astype(np.uint16) << np.uint16(8) | text[order - 1], order


def merge(shards: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(merged positions listed shard by shard, block number by merged position), by `depth` symbols (even).

    Suffixes with equal block numbers agree on their first `depth` symbols.
    """
    joined = np.concatenate(shards)
    total = len(joined)
    kind = np.uint8 if len(shards) <= 256 else np.uint16 if len(shards) <= 65536 else np.int64
    source = np.repeat(np.arange(len(shards), dtype=kind), [len(x) for x in shards])
    block = np.zeros(total, dtype=np.int32 if total < 1 << 31 else np.int64)
    symbols = np.empty(total, dtype=np.uint16)
    for _ in range(depth // 2):
        if len(shards) > 1:
            symbols[np.argsort(source, kind="stable")] = joined
        else:
            symbols = joined
        step = np.argsort(symbols, kind="stable")
        source = source[step]
        moved, before = symbols[step], block[step]
        new = np.zeros(total, dtype=bool)
        new[1:] = (moved[1:] != moved[:-1]) | (before[1:] != before[:-1])
        block = np.cumsum(new, dtype=block.dtype)
    return np.argsort(source, kind="stable"), block


def repeated_intervals(strings: list[np.ndarray], depth: int, shard: int = SHARD) -> tuple[np.ndarray, np.ndarray]:
    """For the strings joined, each followed by END: (starts of suffixes in merged order, their blocks)."""
    shards, orders, bounds, held, size, base = [], [], [], [], 0, 0
    for x in strings:
        held.append(x)
        size += len(x) + 1
        if size >= shard:
            bounds.append(held)
            held, size = [], 0
    if held:
        bounds.append(held)
    for held in bounds:
        text = np.concatenate([y for x in held for y in (x, np.array([END]))])
        bwt, order = transform(text, depth)
        shards.append(bwt)
        orders.append(order + base)
        base += len(text)
    at, block = merge(shards, depth)
    # `at` lists merged positions shard by shard; its inverse gives, for each merged position, the suffix
    starts = np.empty(base, dtype=np.int64)
    starts[at] = np.concatenate(orders)
    return starts, block
