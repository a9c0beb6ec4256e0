"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of each whole text are counted once. On a bounded sample of labelled
rows, small gradient-boosted trees are grown; each path from a root to a node is
a rule, a conjunction of thresholds. A lasso logistic regression weighs the
rules, most of them with zero, and the rest score the statistics of every row,
batch by batch. They are no Spark expression: planning and compiling one of some
200 rules took more of the driver's memory than all else.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickline.llm.shared import cut, small_batches
from tickline.llm.text import BYTE_VALUE, chunks, gram_hash, owner, prefix_sums, span_hash, word_hash, words

#: Labelled rows that the fit takes at most: those with the smallest hash of their id.
FIT_ROWS = 20_000
#: Folds by crc32 of the id; the first is held out.
FOLDS = 5
THRESHOLD = 0.3
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".", "comma": b",", "bang": b"!?", "pipe": b"|", "symbol": b"#$%&*@^~<>{}[]\\=+_", "line": b"\n", "space": b" \t\r\x0b\x0c", "high": bytes(range(128, 256))}
STATS = ("log_words", "word_bytes", *(f"{c}_share" for c in CLASSES), "distinct_words", "top_word", "same_next", "distinct_5grams", "distinct_lines", "words_per_line", "words_per_stop")
_TABLES = {name: np.isin(np.arange(256), list(chars)) for name, chars in CLASSES.items()}
STATS_DDL = ", ".join(f"{s} double" for s in STATS)


def _per_doc(off: np.ndarray, marks: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
    return sums[off[1:]] - sums[off[:-1]]


def _distinct(doc: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each document, and how often its most frequent one occurs."""
    order = np.lexsort((value, doc))
    d, v = doc[order], value[order]
    if not len(d):
        return np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    at = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (v[1:] != v[:-1])]))
    top = np.zeros(rows, np.int64)
    np.maximum.at(top, d[at], np.diff(np.append(at, len(d))))
    return np.bincount(d[at], minlength=rows), top


def statistics(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of STATS for each document."""
    rows = len(off) - 1
    size = np.maximum(np.diff(off), 1)
    first, last, word_off = words(data, off)
    n = np.diff(word_off)
    many = np.maximum(n, 1)
    h = word_hash(data, first, last)
    doc = owner(word_off)
    counts = {name: _per_doc(off, table[data]) for name, table in _TABLES.items()}
    kinds, top = _distinct(doc, h, rows)
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    grams = gram_hash(prefix_sums(h), 5)
    whole = doc[: len(grams)] == doc[4 : 4 + len(grams)]
    five, _ = _distinct(doc[: len(grams)][whole], grams[whole], rows)
    breaks = np.flatnonzero(data == 10)
    starts = np.union1d(off[:-1][np.diff(off) > 0], breaks + 1)
    starts = starts[starts < len(data)]
    line_doc = np.searchsorted(off, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(data)), off[line_doc + 1])
    value = span_hash(prefix_sums(BYTE_VALUE[data]), starts, ends)
    lines = np.bincount(line_doc, minlength=rows)
    distinct_lines, _ = _distinct(line_doc, value, rows)
    out = [np.log1p(n), _per_word(word_off, last - first) / many]
    out += [c / size for c in counts.values()]
    out += [kinds / many, top / many, _per_doc(word_off, same) / many, five / np.maximum(n - 4, 1), distinct_lines / np.maximum(lines, 1), n / np.maximum(lines, 1), n / (counts["stop"] + 1)]
    return np.stack(out, axis=1)


def _per_word(word_off: np.ndarray, length: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(length)])
    return sums[word_off[1:]] - sums[word_off[:-1]]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, off in chunks(batch.column(1)):
            x = statistics(data, off)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *(pa.array(np.ascontiguousarray(x[:, i])) for i in range(len(STATS))), *(c.slice(lo, hi - lo) for c in batch.columns[2:])], names=["id", *STATS, *batch.schema.names[2:]])


@dataclass
class Rules:
    """score = sigmoid(intercept + the weights of the rules that hold); a rule is a list of (statistic, above, threshold)."""

    intercept: float = 0.0
    rules: list[tuple[list[tuple[str, bool, float]], float]] = field(default_factory=list)

    def score(self, columns: dict[str, np.ndarray], rows: int) -> np.ndarray:
        """The score of each of `rows` rows, from the statistics by name."""
        total = np.full(rows, self.intercept)
        for tests, weight in self.rules:
            hold = np.ones(rows, dtype=bool)
            for name, above, at in tests:
                hold &= (columns[name] > at) if above else (columns[name] <= at)
            total += np.where(hold, weight, 0.0)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-total))


def _score(model: Rules, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, score and what follows the statistics."""
    for batch in batches:
        columns = {s: batch.column(1 + i).to_numpy(zero_copy_only=False) for i, s in enumerate(STATS)}
        rest = len(STATS) + 1
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(columns, batch.num_rows)), *batch.columns[rest:]], names=["id", "score", *batch.schema.names[rest:]])


def _grow(binned: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, depth: int, bins: int, least: int) -> list[tuple[list[tuple[int, bool, int]], np.ndarray, float]]:
    """Nodes of one tree: (tests, rows, value); leaves are those with value not nan."""
    nodes, out = [([], np.arange(len(binned)))], []
    for level in range(depth + 1):
        below = []
        for tests, rows in nodes:
            g, h = gradient[rows].sum(), hessian[rows].sum()
            best, split = 1e-3, None
            if level < depth and len(rows) >= 2 * least:
                for j in range(binned.shape[1]):
                    b = binned[rows, j]
                    gs, hs, c = (np.cumsum(np.bincount(b, w, bins)) for w in (gradient[rows], hessian[rows], None))
                    gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
                    gain[(c < least) | (len(rows) - c < least)] = 0
                    if gain.max() > best:
                        best, split = gain.max(), (j, int(gain.argmax()))
            out.append((tests, rows, -g / (h + 1) if split is None else float("nan")))
            if split is not None:
                high = binned[rows, split[0]] > split[1]
                below += [([*tests, (split[0], False, split[1])], rows[~high]), ([*tests, (split[0], True, split[1])], rows[high])]
        nodes = below
    return out


def fit(x: np.ndarray, y: np.ndarray, names: Sequence[str], *, trees: int = 40, depth: int = 3, bins: int = 48, rate: float = 0.3, penalty: float = 2e-4, steps: int = 400) -> Rules:
    """Rules from the rows x with labels y (0 or 1). With labels of one kind only, their share is the score."""
    if len(y) < 50 or y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return Rules(float(np.log(share / (1 - share))))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)
    found: dict[tuple, np.ndarray] = {}
    least, everyone = max(5, len(y) // 1000), np.arange(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        for tests, rows, value in _grow(binned, p - y, p * (1 - p), depth, bins, least):
            if tests:
                found.setdefault(tuple(sorted(tests)), np.packbits(np.isin(everyone, rows, assume_unique=True)))
            if value == value:
                margin[rows] += rate * value
    rules = list(found)
    # one matrix in single precision, standardised in place: the driver has little memory
    z = np.zeros((len(y), len(rules)), dtype=np.float32)
    for k, tests in enumerate(rules):
        z[:, k] = np.unpackbits(found.pop(tests), count=len(y))
    mean = z.mean(axis=0)
    scale = np.sqrt(mean * (1 - mean)) + np.float32(1e-6)
    z -= mean
    z /= scale
    y = y.astype(np.float32)
    w = np.zeros(len(rules), dtype=np.float32)
    bias = np.float32(base)
    v = np.random.default_rng(0).normal(size=len(rules)).astype(np.float32)
    for _ in range(20):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v)
    step = np.float32(4 * len(y) / np.linalg.norm(z.T @ (z @ v)))
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        wrong = 1 / (1 + np.exp(-(bias + z @ ahead))) - y
        bias -= np.float32(2 * wrong.mean())
        moved = ahead - step / np.float32(len(y)) * (z.T @ wrong)
        new = np.sign(moved) * np.maximum(np.abs(moved) - step * np.float32(penalty), 0)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = (new + np.float32((t - 1) / t_next) * (new - w)).astype(np.float32)
        w, t = new.astype(np.float32), t_next
    weights = w / scale
    intercept = float(bias - (weights * mean).sum())
    kept = np.flatnonzero(np.abs(w) > 1e-4)
    return Rules(intercept, [([(names[j], above, float(edges[j][b])) for j, above, b in rules[k]], float(weights[k])) for k in kept])


def fold(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", key_col: str | None = None, fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of `docs`: id, held_out, score (0 to 1, higher: label 1 likelier) and predicted.

    The fit takes at most `fit_rows` labelled rows outside fold 0, never the
    labels of fold 0. A null or empty text has the statistics of no words and is
    scored by them. Without labels every score is 0.5; with labels of one kind,
    their smoothed share. Null labels and labels of unknown documents count for
    nothing. A document with several labels is fitted with each. `key_col` of
    `docs`, an integer, is returned too, to tell rows with equal ids or none apart.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    key = [F.col(key_col).cast("bigint").alias("key")] if key_col else []
    key_ddl = ", key bigint" * len(key)
    with small_batches(docs.sparkSession):
        stats = cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *key).mapInArrow(_measure, f"id {id_type}, {STATS_DDL}{key_ddl}"))
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & (fold("id") != 0))
    # a share of the hash range that holds little more than the sample, so that no task sends the driver rows in vain
    share = min(1.0, 1.2 * fit_rows / max(1, marks.count()))
    turn = F.xxhash64("id", F.lit(7))
    early = marks.withColumn("turn", turn).where(F.col("turn") <= min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))
    sample = stats.join(early, "id").orderBy("turn", "y").limit(fit_rows).select(*STATS, "y")
    rows = sample.toArrow()
    model = fit(np.column_stack([rows[name].to_numpy() for name in STATS]), rows["y"].to_numpy().astype(float), STATS)
    scored = stats.mapInArrow(partial(_score, model), f"id {id_type}, score double{key_ddl}")
    out = scored.select(F.col("id").alias(id_col), *(F.col("key").alias(key_col) for _ in key), (fold("id") == 0).alias("held_out"), "score")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
