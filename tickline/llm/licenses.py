"""License scan by patience alignment.

Stretches of a document with words of license notices are aligned with each
template: words that occur once in both are anchors; the longest increasing
subsequence of their places is kept; the gaps between kept anchors are aligned
in the same way, where more words become unique. The share of aligned words in
the template, or in the stretch from the first to the last of them if that is
longer, is the coverage: a notice does not cover another one that it contains
with words in between. Where repeated words leave this alignment short of a
perfect one, a longest common subsequence from each first word decides.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickline.llm.decontaminate import tokens
from tickline.llm.text import buffers, chunks

#: Notices and license texts, by identifier.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "MIT": "Released under the MIT License",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
}
#: Words of templates that are looked for before others, as they are rare elsewhere.
KEY_WORDS = ("license", "licensed", "licence", "licenced", "copyright", "permission", "permitted", "redistribution")
COVERAGE = 0.9


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        if k == len(tails):
            tails.append(v)
            ends.append(i)
        else:
            tails[k], ends[k] = v, i
        before[i] = ends[k - 1] if k else -1
    out = []
    i = ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b) of equal words, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = (Counter(x) for x in (a[a0:a1], b[b0:b1]))
        place = {b[j]: j for j in range(b0, b1) if once_b[b[j]] == 1}
        pairs = [(i, place[a[i]]) for i in range(a0, a1) if once_a[a[i]] == 1 and a[i] in place]
        kept = [pairs[k] for k in longest_increasing([j for _, j in pairs])]
        out += kept
        if kept:
            for (i, j), (i2, j2) in zip([(a0 - 1, b0 - 1), *kept], [*kept, (a1, b1)], strict=True):
                todo.append((i + 1, i2, j + 1, j2))
    return sorted(out)


def cover(template: Sequence[int], text: Sequence[int], place: Sequence[int], least: float) -> tuple[float, int, int]:
    """(coverage, first place, last place) of the best copy in the words `text` at `place`; coverage 0 if `least` is not reached.

    Of equal coverages the shortest stretch counts, then the first.
    """
    size = len(template)
    pairs = patience(template, text)
    if len(pairs) == size and place[pairs[-1][1]] - place[pairs[0][1]] < size:
        return 1.0, place[pairs[0][1]], place[pairs[-1][1]]
    if (Counter(template) & Counter(text)).total() / size < least:
        return 0.0, 0, 0
    at: dict[int, int] = {}
    for i, w in enumerate(template):
        at[w] = at.get(w, 0) | 1 << i
    whole = (1 << size) - 1
    found = (0.0, 0, 0)
    for s, w in enumerate(text):
        if w not in at:
            continue
        # bit i is off where the common subsequence grows at the template's word i
        rest = whole
        for e in range(s, len(text)):
            stretch = place[e] - place[s] + 1
            if size / stretch < least:
                break
            same = rest & at.get(text[e], 0)
            rest = ((rest + same) | (rest - same)) & whole
            score = (size - rest.bit_count()) / max(size, stretch)
            if score >= least and (score, -stretch) > (found[0], found[1] - found[2] - 1):
                found = (score, place[s], place[e])
    return found


def _scan(names: list[str], templates: list[list[int]], keys: list[int], least: float):  # noqa: ANN202
    vocabulary = np.unique(np.array([w for t in templates for w in t] + keys, dtype=np.uint64))
    key_words = np.unique(np.array(keys, dtype=np.uint64))
    longest = max(len(t) + _room(len(t), least)[1] for t in templates)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, data, off in chunks(batch.column(1)):
                h, edge = tokens(data, off)
                known = vocabulary[np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)] == h
                key = key_words[np.minimum(np.searchsorted(key_words, h), len(key_words) - 1)] == h
                rows = []
                for d in np.unique(np.searchsorted(edge, np.flatnonzero(key), side="right") - 1).tolist():
                    a, b = int(edge[d]), int(edge[d + 1])
                    at = np.flatnonzero(key[a:b])
                    cuts = np.flatnonzero(np.diff(at) > longest) + 1
                    best: dict[int, tuple[float, int, int]] = {}
                    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True):
                        start, end = max(a, a + int(at[s]) - longest), min(b, a + int(at[e - 1]) + longest)
                        place = start + np.flatnonzero(known[start:end])
                        text = h[place].tolist()
                        counts = Counter(text)
                        for k, template in enumerate(templates):
                            for first, last in _tight(text, counts, place, template, least):
                                score, began, ended = cover(template, text[first:last], place[first:last].tolist(), least)
                                if score > best.get(k, (0.0,))[0]:
                                    best[k] = (score, began - a, ended + 1 - a)
                    rows += [(lo + d, names[k], *found) for k, found in best.items()]
                if rows:
                    row, name, score, s, e = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(name), pa.array(score, pa.float64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())], names=["id", "license", "coverage", "start_word", "end_word"])

    return scan


def gate_words(template: str, least: float, prefer: Sequence[str]) -> list[str]:
    """Words of the template of which every copy of that coverage has one: more of them than a copy may lack."""
    found = dict.fromkeys(re.findall(r"[^\W_]+", template.lower()))
    size = len(re.findall(r"[^\W_]+", template))
    lacking, _ = _room(size, least)
    return sorted(found, key=lambda w: (w not in prefer, -len(w), w))[: lacking + 1]


def _room(size: int, least: float) -> tuple[int, int]:
    """How many of a template's words a copy may lack, and how many others it may hold."""
    return size - ceil(least * size - 1e-9), floor(size / least + 1e-9) - size


def _tight(text: list[int], counts: Counter[int], place: np.ndarray, template: list[int], least: float) -> Iterator[tuple[int, int]]:
    """Stretches of the known words that hold all copies of the template.

    A copy lacks at most so many words of the template, so it holds one of the
    rarest of them, one more than that, in its place.
    """
    size = len(template)
    lacking, more = _room(size, least)
    if (counts & Counter(template)).total() < size - lacking:
        return
    seeds: dict[int, list[int]] = {}
    for p in sorted(range(size), key=lambda p: counts[template[p]])[: lacking + 1]:
        seeds.setdefault(template[p], []).append(p)
    seen = set()
    for i, w in enumerate(text):
        for p in seeds.get(w, ()):
            low, high = place[i] - p - more, place[i] + size - 1 - p + more
            window = int(np.searchsorted(place, low)), int(np.searchsorted(place, high, side="right"))
            if window not in seen:
                seen.add(window)
                yield window


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", templates: Mapping[str, str] = TEMPLATES, key_words: Sequence[str] = KEY_WORDS, coverage: float = COVERAGE) -> DataFrame:
    """One row for each document and license whose template it covers to `coverage` or more, in one place.

    Returns the id, license, coverage and the place in words (runs of letters,
    digits and other than ASCII, A-Z lower-cased); of several places the one
    with the highest coverage, the first of equals. Only stretches around words of
    which every copy has one are aligned (see `gate_words`; key_words are taken
    first). Null and empty texts have no license. Rows with equal ids are scanned
    each. Other columns are not read.
    """

    def hashed(text: str) -> list[int]:
        raw, off = buffers(pa.array([text]))
        return tokens(raw[: off[-1]], off)[0].tolist()

    id_type = docs.schema[id_col].dataType.simpleString()
    scan = _scan(list(templates), [hashed(t) for t in templates.values()], sorted({h for t in templates.values() for w in gate_words(t, coverage, key_words) for h in hashed(w)}), coverage)
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(scan, f"id {id_type}, license string, coverage double, start_word int, end_word int")
    return out.withColumnRenamed("id", id_col)
