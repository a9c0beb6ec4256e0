"""Approximate nearest neighbours by learned partitions.

On a bounded sample, the graph of nearest neighbours is cut into balanced parts,
and a small neural classifier learns which parts a vector's neighbours lie in.
The classifier puts every row into its most probable part and sends each query
to its most probable parts, as many as reach a share of probability that the
sample shows to be enough. There the query's scores are computed exactly.

A part is dealt out in blocks of rows and blocks of queries, so that neither a
part that holds most of the rows nor one that most queries visit meets in one
task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickline.llm.shared import cut

#: Rows of the sample at most: those with the smallest hash of their id.
SAMPLE = 4096
PARTS = 32
GRAPH_DEGREE = 20
#: Recall that the sample's own queries must reach, which is above what is asked of the search.
AIM = 0.97
#: Rows of a part, and queries, that meet in one task.
BLOCK = 4096
#: Scores held at once.
SCORES = 1 << 21


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """For each row, the others with the largest inner products, nearest first."""
    out = np.empty((len(x), degree), dtype=np.int64)
    for i in range(0, len(x), 512):
        s = x[i : i + 512] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        near = np.argpartition(-s, degree - 1, axis=1)[:, :degree]
        out[i : i + 512] = np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, axis=1), axis=1), axis=1)
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12) -> np.ndarray:
    """A part for each node, none much above the mean size, with few graph edges between parts.

    Starts from halves along principal directions; then nodes move to the part
    that holds most of their neighbours, those with most to gain first, as long
    as it has room.
    """
    n = len(x)
    label = np.zeros(n, dtype=np.int64)
    todo = [(np.arange(n), parts, 0)]
    while todo:
        rows, k, base = todo.pop()
        if k == 1:
            label[rows] = base
            continue
        y = x[rows] - x[rows].mean(axis=0)
        axis = np.linalg.svd(y.T @ y)[0][:, 0]
        order = np.argsort(y @ axis, kind="stable")
        half = len(rows) * (k // 2) // k
        todo += [(rows[order[:half]], k // 2, base), (rows[order[half:]], k - k // 2, base + k // 2)]
    room = int(np.ceil(1.05 * n / parts))
    ends = np.concatenate([graph.ravel(), np.repeat(np.arange(n), graph.shape[1])])
    begins = np.concatenate([np.repeat(np.arange(n), graph.shape[1]), graph.ravel()])
    for _ in range(rounds):
        votes = np.bincount(begins * parts + label[ends], minlength=n * parts).reshape(n, parts)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), label]
        size = np.bincount(label, minlength=parts)
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[label[i]] -= 1
                size[best[i]] += 1
                label[i] = best[i]
                moved += 1
        if moved < n // 200:
            break
    return label


@dataclass
class Router:
    """A classifier with one hidden layer, and the share of probability that queries are sent to."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    share: float = 1.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def visits(self, x: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(query number, part) for every part that a query is sent to: up to the share, and on until they hold `least` rows."""
        p = self.probabilities(x)
        order = np.argsort(-p, axis=1, kind="stable")
        before = np.cumsum(np.take_along_axis(p, order, axis=1), axis=1) - np.take_along_axis(p, order, axis=1)
        held = np.cumsum(sizes[order], axis=1) - sizes[order]
        row, rank = np.nonzero((before < self.share) | (held < least))
        return row, order[row, rank]


def train_router(x: np.ndarray, goal: np.ndarray, hidden: int = 128, epochs: int = 40, batch: int = 128, rate: float = 3e-3) -> Router:
    rng = np.random.default_rng(1)
    shapes = [(x.shape[1], hidden), (hidden,), (hidden, goal.shape[1]), (goal.shape[1],)]
    w = [rng.normal(size=s) * (np.sqrt(2 / s[0]) if len(s) > 1 else 0) for s in shapes]
    m, v, t = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            rows = order[i : i + batch]
            a = x[rows] @ w[0] + w[1]
            h = np.maximum(a, 0)
            z = h @ w[2] + w[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            d = (p - goal[rows]) / len(rows)
            back = (d @ w[2].T) * (a > 0)
            t += 1
            for k, g in enumerate((x[rows].T @ back, back.sum(axis=0), h.T @ d, d.sum(axis=0))):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                w[k] -= rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Router(*w)


def learn(x: np.ndarray, parts: int = PARTS, aim: float = AIM, degree: int = GRAPH_DEGREE) -> Router:
    """A router fitted to the sample x; half of it calibrates the share of probability."""
    if len(x) < 8 * parts:
        zero = np.zeros
        return Router(zero((x.shape[1] if x.ndim == 2 else 1, 1)), zero(1), zero((1, 1)), zero(1))
    graph = neighbour_graph(x, degree)
    label = balanced_parts(x, graph, parts)
    goal = np.bincount(np.repeat(np.arange(len(x)), degree) * parts + label[graph].ravel(), minlength=len(x) * parts).reshape(len(x), parts) / degree
    fitted = np.arange(len(x)) % 2 == 0
    router = train_router(x[fitted], goal[fitted])
    p = router.probabilities(x)
    home = p.argmax(axis=1)
    held = np.flatnonzero(~fitted)
    order = np.argsort(-p[held], axis=1, kind="stable")
    sums = np.cumsum(np.take_along_axis(p[held], order, axis=1), axis=1)
    place = np.argsort(order, axis=1)
    rank = np.take_along_axis(place, home[graph[held]], axis=1)
    before = np.take_along_axis(sums, rank, axis=1) - np.take_along_axis(p[held], home[graph[held]], axis=1)
    router.share = float(np.quantile(before.ravel(), aim)) + 1e-9
    return router


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _assign(router: Router):  # noqa: ANN202
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 8192):
                b = batch.slice(i, 8192)
                home = router.probabilities(_vectors(b.column(1)).astype(float)).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(home.astype(np.int32))], names=["id", "vector", "part"])

    return assign


def _visit(router: Router, sizes: np.ndarray, least: int):  # noqa: ANN202
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                b = batch.slice(i, 1024)
                row, part = router.visits(_vectors(b.column(1)).astype(float), sizes, least)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(part.astype(np.int32))], names=["id", "vector", "part"])

    return visit


def _best(k: int):  # noqa: ANN202
    """The k nearest rows of a block for each query of a block."""

    def best(rows: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not len(rows) or not len(queries):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        ids, x = rows["id"].to_numpy(), _vectors(rows["vector"].combine_chunks()).astype(float)
        asked, q = queries["id"].to_numpy(), _vectors(queries["vector"].combine_chunks()).astype(float)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        out: list[list[np.ndarray]] = [[], [], []]
        step = max(1, SCORES // len(ids))
        for i in range(0, len(asked), step):
            s = q[i : i + step] @ x.T
            s[asked[i : i + step, None] == ids[None, :]] = -np.inf
            kth = -np.partition(-s, k - 1, axis=1)[:, k - 1] if len(ids) > k else np.full(len(s), -np.inf)
            a, b = np.nonzero((s >= kth[:, None] - 1e-9) & (s > -np.inf))
            score = (q[i + a] * x[b]).sum(axis=1)
            ranked = np.lexsort((ids[b], -score, a))
            a, b, score = a[ranked], b[ranked], score[ranked]
            first = np.searchsorted(a, a)
            keep = np.arange(len(a)) - first < k
            for part, value in zip(out, (asked[i + a[keep]], ids[b[keep]], score[keep]), strict=True):
                part.append(value)
        return pa.table([pa.array(np.concatenate(c)) for c in out], names=names)

    return best


def nearest(vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20, sample: int = SAMPLE, parts: int = PARTS, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k rows found nearest to each query, by inner product.

    Ties go to the smaller id. A row is no neighbour of a query with its id.
    Null, empty and zero vectors, vectors that hold nulls or values that are not
    finite, rows without an id, and vectors of another length than the rows
    mostly have take no part. A query goes on to further parts until they hold k
    other rows, so it gets fewer only where the table has fewer. Where the sample is too small for parts, every
    query meets every row.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        v = F.col(vector_col)
        whole = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(v, lambda c: c != 0)
        return df.where(F.col(id_col).isNotNull() & v.isNotNull() & whole).select(F.col(id_col).cast("bigint").alias("id"), v.alias("vector"))

    rows, asked = usable(vectors), usable(queries)
    usual = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    size = usual["n"] if usual else 1
    rows, asked = rows.where(F.size("vector") == size), asked.where(F.size("vector") == size)
    # a share of the hash range that holds little more than the sample, so that no task sends the driver rows in vain
    share = min(1.0, 1.2 * sample / max(1, usual["count"] if usual else 1))
    early = rows.where(F.xxhash64("id") <= min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))
    taken = early.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toPandas()["vector"]
    router = learn(np.array(taken.tolist(), dtype=float).reshape(len(taken), size), parts)
    kind = vectors.schema[vector_col].dataType.simpleString()
    ddl = f"id bigint, vector {kind}, part int"
    homes = cut(rows.mapInArrow(_assign(router), ddl))
    sizes = np.zeros(len(router.b2), dtype=np.int64)
    for r in homes.groupBy("part").count().collect():
        sizes[r["part"]] = r["count"]
    # all rows with the query's id are left out, so as many as one id has come on top
    own = homes.groupBy("id").count().agg(F.max("count")).first()[0] or 0
    visits = cut(asked.mapInArrow(_visit(router, sizes, k + own), ddl))
    # one row for each part: into how many blocks its rows and its queries are dealt
    blocks = lambda df, name: df.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias(name))
    dealt = F.broadcast(blocks(homes, "row_blocks").join(blocks(visits, "query_blocks"), "part"))
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = homes.join(dealt, "part").select("id", "vector", "part", mine("row_blocks").alias("i"), all_of("query_blocks").alias("j"))
    right = visits.join(dealt, "part").select("id", "vector", "part", all_of("row_blocks").alias("i"), mine("query_blocks").alias("j"))
    cell = ["part", "i", "j"]
    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(_best(k), "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
