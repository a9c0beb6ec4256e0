"""Relative Lempel-Ziv factors of blocks against an index of all blocks.

The index is a suffix array of the blocks, by prefix doubling; its ranks at each
power of two tell how far two places agree. A place's longest match is beside it
in the order. A block is factored greedily: the longest match from its first
place, then from where that ends, and so on; a place without a match is a factor
of one item of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Factors:
    """Greedy factors in order by block and place: `length` items at `place` of `block` agree with those at `source_place` of `source`.

    A factor of no length is a literal: its item starts no match. inside and
    matches tell of each place whether a window starts there that lies in a factor
    as a whole, and how long its longest match is.
    """

    block: np.ndarray
    place: np.ndarray
    source: np.ndarray
    source_place: np.ndarray
    length: np.ndarray
    matches: list[np.ndarray]


def _levels(items: np.ndarray, depth: int) -> list[np.ndarray]:
    """Ranks of all places by their first 1, 2, 4, ... items, to `depth` at least. Places past the end have rank 0."""
    _, rank = np.unique(items, return_inverse=True)
    out, reach = [np.append(rank + 1, 0)], 1
    while reach < depth:
        now = out[-1]
        after = np.zeros(len(now), dtype=np.int64)
        after[: len(now) - reach] = now[reach:]
        _, rank = np.unique(now[:-1] * len(now) + after[:-1], return_inverse=True)
        out.append(np.append(rank + 1, 0))
        reach *= 2
    return out


def _agree(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many items the places a and b have in common."""
    length = np.zeros(len(a), dtype=np.int64)
    end = len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        # each level can hold twice, since the depth is only reached, not exceeded
        for _ in range(2 if k == len(levels) - 1 else 1):
            x, y = np.minimum(a + length, end), np.minimum(b + length, end)
            length += np.where((levels[k][x] == levels[k][y]) & (x < end) & (y < end), 1 << k, 0)
    return length


def factors(blocks: list[np.ndarray], window: int) -> Factors:
    """Factors of the blocks (arrays of non-negative integers) against all of them; a place is no match of itself.

    Only places where a window of `window` items starts are factored or matched.
    """
    sizes = np.array([len(b) for b in blocks], dtype=np.int64)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])
    items = np.empty(base[-1], dtype=np.int64)
    for i, b in enumerate(blocks):
        items[base[i] : base[i] + len(b)] = b
        items[base[i] + len(b)] = -1 - i  # an end of its own, so no match passes it
    levels = _levels(items, int(sizes.max(initial=1)))
    starts = np.maximum(sizes - window + 1, 0)
    which = np.repeat(np.arange(len(blocks)), starts)
    places = np.arange(len(which)) - np.repeat(np.cumsum(starts) - starts, starts)
    at = base[which] + places
    order = np.argsort(levels[-1][at], kind="stable")
    beside = _agree(levels, at[order][:-1], at[order][1:])
    before, after = np.concatenate([[0], beside]), np.concatenate([beside, [0]])
    longest, source = np.zeros(len(at), np.int64), np.full(len(at), -1)
    longest[order] = np.maximum(before, after)
    source[order] = np.where(before >= after, np.concatenate([[-1], order[:-1]]), np.concatenate([order[1:], [-1]]))
    # greedily, all blocks at a time
    first = np.cumsum(starts) - starts
    live = np.flatnonzero(starts > 0)
    now = np.zeros(len(blocks), dtype=np.int64)
    found: list[np.ndarray] = []
    while len(live):
        here = first[live] + now[live]
        found.append(np.stack([live, now[live], source[here], longest[here]]))
        now[live] += np.maximum(longest[here], 1)
        live = live[now[live] < starts[live]]
    block, place, src, length = np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)
    turn = np.lexsort((place, block))
    block, place, src, length = block[turn], place[turn], src[turn], length[turn]
    real = length > 0
    return Factors(block, place, np.where(real, which[src], -1) if len(which) else src, np.where(real, places[src], -1) if len(which) else src, length, np.split(longest, np.cumsum(starts)[:-1]) if len(blocks) else [])


def repeated_windows(blocks: list[np.ndarray], window: int) -> list[np.ndarray]:
    """For each block, whether each of its windows starts anywhere else in the blocks.

    A window inside a factor does. Any other window crosses the end of a factor
    and is looked up for itself.
    """
    f = factors(blocks, window)
    out = [np.zeros(len(m) + 1, dtype=np.int64) for m in f.matches]
    for b, p, n in zip(*(x[f.length >= window].tolist() for x in (f.block, f.place, f.length)), strict=True):
        out[b][p] += 1
        out[b][min(p + n - window + 1, len(out[b]) - 1)] -= 1
    return [(np.cumsum(x[:-1]) > 0) | (m >= window) for x, m in zip(out, f.matches, strict=True)]
