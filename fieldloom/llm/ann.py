"""Approximate nearest neighbours by largest inner product, over learned partitions.

1. On a sample of at most ``SAMPLE`` vectors (picked by a hash of the id) the neighbour graph is made by brute
   force and cut into balanced parts: halves along main directions, then moves of vertices to the part that most of
   their neighbours are in, as far as the parts' capacity lets them.
2. A small two-layer classifier learns the parts of a vector's neighbours from the vector.
3. Every vector is filed under its most probable part. A query is sent to its most probable parts, as many as
   give ``GOAL`` recall for held-out sample queries; what it finds there is ranked by exact inner products.

Every row is indexed. A part with many vectors (a very common vector, say) is dealt into blocks of about ``BLOCK``,
and its queries into blocks of ``QUERIES``, so no task holds a whole part. In a block, of equal vectors only the
smallest ids can be among the nearest, which ends ties early; scores that count are recomputed row by row in
double precision, so equal vectors have equal scores.

Bounds: the driver holds the sample; what is broadcast is the classifier.

Defined results: vectors that are null, empty, zero, hold null or non-finite components, or don't have the most
frequent length take no part, neither as query nor as candidate, and so do null ids. Ties go to the smaller id.
Fewer candidates than ``k`` in the parts asked: the query is asked of all parts. A query never finds its own id.
Repeated rows are candidates each, and ask once; of an id with several vectors, each vector has its own ranks. Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldloom.llm.common import cut, unit_hash

SAMPLE = 8192
GOAL = 0.94
BLOCK, QUERIES = 4096, 2048
DEGREE = 10


def neighbours(x: np.ndarray, queries: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` vectors of ``x`` with the largest inner products for each of ``queries`` (places in ``x``)."""
    out = np.empty((len(queries), k), np.int64)
    for at in range(0, len(queries), 512):
        own = queries[at : at + 512]
        s = x[own] @ x.T
        s[np.arange(len(own)), own] = -np.inf
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        out[at : at + 512] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1)
    return out


def balanced(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.1, sweeps: int = 12) -> np.ndarray:
    """A part for each vertex of the neighbour ``graph`` (rows of places), each of at most (1 + slack) * n / parts."""
    n = len(x)
    label = np.zeros(n, np.int64)
    width = 1
    while width < parts:  # halves along the direction of most spread
        for p in range(width):
            own = np.flatnonzero(label == p)
            y = x[own] - x[own].mean(0) if len(own) else x[own]
            if len(own) > 1:
                axis = np.linalg.eigh(y.T @ y)[1][:, -1]
                upper = own[np.argsort(y @ axis, kind="stable")[len(own) // 2 :]]
                label[upper] = p + width
        width *= 2
    sources = np.repeat(np.arange(n), graph.shape[1])
    a, b = np.concatenate([sources, graph.ravel()]), np.concatenate([graph.ravel(), sources])
    most = int(np.ceil((1 + slack) * n / width))
    for _ in range(sweeps):
        near = np.bincount(a * width + label[b], minlength=n * width).reshape(n, width)
        to = near.argmax(1)
        gain = near[np.arange(n), to] - near[np.arange(n), label]
        sizes, moved = np.bincount(label, minlength=width), 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            if sizes[to[i]] < most:
                sizes[label[i]] -= 1
                sizes[to[i]] += 1
                label[i] = to[i]
                moved += 1
        if moved < n // 200:
            break
    return label


class Router:
    """A two-layer classifier from vectors to parts."""

    def __init__(self, mean, scale, w1, b1, w2, b2) -> None:
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum((x - self.mean) * self.scale @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    @classmethod
    def fit(cls, x: np.ndarray, target: np.ndarray, hidden: int = 96, epochs: int = 40, seed: int = 0) -> Router:
        """Adam on the cross-entropy to ``target``, rows of part shares."""
        rng = np.random.default_rng(seed)
        mean, scale = x.mean(0), np.full(x.shape[1], 1 / max(float(x.std()), 1e-12))
        z = (x - mean) * scale
        values = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, (hidden, target.shape[1])), np.zeros(target.shape[1])]
        first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
        for _ in range(epochs):
            mixed = rng.permutation(len(z))
            for at in range(0, len(z), 256):
                rows = mixed[at : at + 256]
                h = np.maximum(z[rows] @ values[0] + values[1], 0)
                o = h @ values[2] + values[3]
                p = np.exp(o - o.max(1, keepdims=True))
                e = (p / p.sum(1, keepdims=True) - target[rows]) / len(rows)
                back = e @ values[2].T * (h > 0)
                step += 1
                for i, g in enumerate((z[rows].T @ back, back.sum(0), h.T @ e, e.sum(0))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    values[i] -= 2e-3 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        return cls(mean, scale, *values)


def learn(x: np.ndarray, parts: int, k: int, seed: int = 0) -> tuple[Router, int]:
    """A router for ``parts`` parts and the number of parts to ask."""
    degree = min(DEGREE, len(x) - 1)
    if parts < 2 or degree < 1:
        return Router(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1
    graph = neighbours(x, np.arange(len(x)), degree)
    label = balanced(x, graph, parts)
    width = int(label.max()) + 1
    near = np.zeros((len(x), width))
    for j in range(degree):
        near[np.arange(len(x)), label[graph[:, j]]] += 0.5 / degree
    near[np.arange(len(x)), label] += 0.5
    held = np.random.default_rng(seed).permutation(len(x))[: min(512, max(1, len(x) // 8))]
    own = np.setdiff1d(np.arange(len(x)), held)
    router = Router.fit(x[own], near[own])
    logits = router.logits(x)
    filed, order = logits.argmax(1), np.argsort(-logits[held], axis=1, kind="stable")
    place = np.argsort(order, axis=1)  # rank of each part for each held-out query
    true = neighbours(x, held, min(k, len(x) - 1))
    needed = np.take_along_axis(place, filed[true], 1)
    for asked in range(1, width + 1):
        if (needed < asked).mean() >= GOAL:
            break
    return router, asked


def nearest(q: np.ndarray, q_ids: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the query, candidate id, inner product) of the ``k`` nearest of each query."""
    order = np.argsort(c_ids, kind="stable")
    c, c_ids = c[order], c_ids[order]
    _, same = np.unique(c, axis=0, return_inverse=True)  # equal vectors: only the k smallest ids without a query's own can count
    by = np.argsort(same, kind="stable")
    group, own = same[by], c_ids[by]
    new = np.ones(len(by), bool)
    new[1:] = (group[1:] != group[:-1]) | (own[1:] != own[:-1])
    copy = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    by, group, copy = by[copy < k], group[copy < k], copy[copy < k]
    rank = np.arange(len(by)) - np.searchsorted(group, group)
    most = np.maximum.accumulate(group * (k + 2) + copy + 1) - group * (k + 2)  # rows of one id so far
    before = np.where(rank > 0, np.concatenate([[0], most[:-1]]), 0)
    keep = np.sort(by[rank - before < k])
    c, c_ids = c[keep], c_ids[keep]
    found = []
    for at in range(0, len(q), 256):
        x, ids = q[at : at + 256], q_ids[at : at + 256]
        s = x @ c.T
        s[ids[:, None] == c_ids[None, :]] = -np.inf
        if len(c) > k:
            kth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
            low = np.where(np.isfinite(kth), kth - 1e-9 * (1 + np.abs(kth)), np.finfo(float).min)
        else:
            low = np.full(len(x), np.finfo(float).min)
        i, j = np.nonzero(s >= low[:, None])
        score = (x[i] * c[j]).sum(1)
        order = np.lexsort((c_ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        top = np.arange(len(i)) - np.searchsorted(i, i) < k
        found.append((at + i[top], c_ids[j[top]], score[top]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def search(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest of each row of ``vectors`` that ``queries`` (over ``id_col``) holds for."""
    spark = vectors.sparkSession
    finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("asks"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(finite)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = sizes[0]
    rows = rows.where(F.size("v") == d)
    picked = rows.where(unit_hash(F.col("id"), 7) < SAMPLE / n).select("id", "v").limit(2 * SAMPLE).toArrow().sort_by("id").slice(0, SAMPLE)
    parts = 1 << min(6, max(0, int(n / 250).bit_length() - 1))
    router, asked = learn(_matrix(picked.column("v")), parts, k) if picked.num_rows else learn(np.zeros((1, d)), 1, k)
    shared = spark.sparkContext.broadcast(router)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logits = shared.value.logits(_matrix(batch.column(2)))
            order = np.argsort(-logits, axis=1, kind="stable")
            asks = batch.column(1).to_numpy(zero_copy_only=False)
            to = [o.tolist() if ask else [] for o, ask in zip(order.astype(np.int32), asks, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(order[:, 0], pa.int32()), pa.array(to, pa.list_(pa.int32()))], names=["id", "v", "part", "ask"])

    filed = cut(rows.mapInArrow(route, "id long, v array<double>, part int, ask array<int>"))
    held = {r.part: r.n for r in filed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each part
    # as many parts as were learned to be enough, and more until they hold k candidates besides the query's own rows
    size_of = F.create_map(*[F.lit(x) for p, m in held.items() for x in (p, m)])
    before = F.transform(F.sequence(F.lit(1), F.size("ask")), lambda i: F.aggregate(F.slice("ask", F.lit(1), i - 1), F.lit(0).cast("long"), lambda s, p: s + F.coalesce(size_of[p], F.lit(0).cast("long"))))
    asking = filed.where(F.size("ask") > 0).groupBy("id", "v").agg(F.first("ask").alias("ask"), F.count(F.lit(1)).alias("own"))  # repeated rows ask once
    asking = asking.withColumn("own", F.sum("own").over(Window.partitionBy("id"))).withColumn("before", before)
    asking = asking.select("id", "v", F.xxhash64("v").alias("mark"), F.explode(F.filter(F.arrays_zip("ask", "before"), lambda z: F.array_contains(F.slice("ask", 1, asked), z["ask"]) | (z["before"] < k + F.col("own")))["ask"]).alias("part"))
    asking = cut(asking)
    wanted = {r.part: r.n for r in asking.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks = {p: -(-m // BLOCK) for p, m in held.items()}
    rounds = {p: -(-m // QUERIES) for p, m in wanted.items()}
    both = sorted(set(blocks) & set(rounds))
    if not both:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    block = F.create_map(*[F.lit(x) for p in both for x in (p, blocks[p])])[F.col("part")]
    turn = F.create_map(*[F.lit(x) for p in both for x in (p, rounds[p])])[F.col("part")]
    spread = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "id"), count).cast("int")
    to_all = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    candidates = filed.where(F.col("part").isin(both)).select("id", "v", "part", spread(1, block).alias("b"), turn.alias("t_n")).select("id", "v", "part", "b", to_all(F.col("t_n")).alias("t"))
    questions = asking.where(F.col("part").isin(both)).select("id", "v", "mark", "part", spread(2, turn).alias("t"), block.alias("b_n")).select("id", "v", "mark", "part", "t", to_all(F.col("b_n")).alias("b"))

    def rank(asks: pa.Table, has: pa.Table) -> pa.Table:
        q, i, s = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        if asks.num_rows and has.num_rows:
            q, i, s = nearest(_matrix(asks.column("v")), asks.column("id").to_numpy(), _matrix(has.column("v")), has.column("id").to_numpy(), k)
        q = pa.array(q, pa.int64())
        return pa.table({"query_id": asks.column("id").take(q), "mark": asks.column("mark").take(q), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.float64())})

    keys = ["part", "b", "t"]
    found = questions.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(rank, "query_id long, mark long, vec_id long, score double")
    first = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
