"""Approximate nearest neighbours by learned partitions (Dong, Indyk, Razenshteyn, Wagner).

The neighbour graph of a bounded sample is cut into balanced parts, and a small classifier learns which
part a vector belongs to. Every vector is indexed in its most probable part; a query goes to several most
probable parts, whose vectors are ranked by exact inner products. Parts are searched in cells of bounded
size, so a part that holds a third of all vectors is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from claimtree.llm.common import small_batches, stored

# Rows that the index is fitted on, at most: those with the smallest hash of their id.
SAMPLE_ROWS = 8192
PARTS = 16
# Queries go to their most probable parts until these hold a probability, and to at least so many. The
# probability is the one at which held-out vectors of the sample find this share of their neighbours.
RECALL, LEAST_PARTS = 0.95, 3
HELD_OUT = 8
GRAPH_NEIGHBOURS = 10
LEAST_PART_ROWS = 64
HIDDEN, EPOCHS, BATCH = 128, 40, 256
# Vectors and queries that one task compares at once, at most.
CELL_VECTORS, CELL_QUERIES = 16_384, 2_048
# Rounding of a matrix product, well above what any order of summation changes.
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Neither NULL, nor zero, nor with NULL or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbour_graph(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Undirected edges from every vector to those with the largest inner products."""
    n = len(vectors)
    k = min(k, n - 1)
    near = np.empty((n, k), np.int64)
    for a in range(0, n, 1024):
        block = vectors[a : a + 1024] @ vectors.T
        block[np.arange(len(block)), np.arange(a, a + len(block))] = -np.inf
        near[a : a + 1024] = np.argpartition(-block, k - 1, axis=1)[:, :k]
    left, right = np.repeat(np.arange(n), k), near.ravel()
    edges = np.unique(np.sort(np.stack([left, right], axis=1), axis=1), axis=0)
    return np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])


def halves(members: np.ndarray, left: np.ndarray, right: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """A balanced cut of the graph below ``members``: the slowest non-constant mode of a random walk, split
    at its median, then swaps of the nodes that gain most."""
    n = len(members)
    position = np.full(max(left.max(initial=0), right.max(initial=0), members.max()) + 1, -1)
    position[members] = np.arange(n)
    inside = (position[left] >= 0) & (position[right] >= 0)
    a, b = position[left[inside]], position[right[inside]]
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    mode = rng.standard_normal(n)
    for _ in range(100):
        mode -= (mode * degree).sum() / degree.sum()
        mode = 0.5 * mode + 0.5 * np.bincount(a, mode[b], n) / degree
        mode /= np.abs(mode).max() + 1e-300
    side = np.zeros(n, bool)
    side[np.argsort(mode, kind="stable")[n // 2 :]] = True
    for _ in range(10):
        across = side[a] != side[b]
        gain = np.bincount(a, across * 2.0 - 1, n)
        up = np.flatnonzero(~side)[np.argsort(-gain[~side], kind="stable")]
        down = np.flatnonzero(side)[np.argsort(-gain[side], kind="stable")]
        pairs = min(len(up), len(down))
        swap = int((gain[up[:pairs]] + gain[down[:pairs]] > 0).sum()) // 2
        if not swap:
            break
        side[up[:swap]], side[down[:swap]] = True, False
    return side


def balanced_parts(vectors: np.ndarray, parts: int, seed: int = 1) -> np.ndarray:
    """A part for every vector by repeated halving of the neighbour graph; ``parts`` is a power of two."""
    left, right = neighbour_graph(vectors, GRAPH_NEIGHBOURS)
    rng = np.random.default_rng(seed)
    groups = [np.arange(len(vectors))]
    while len(groups) < parts:
        cut = [(g, halves(g, left, right, rng)) for g in groups]
        groups = [g[side == half] for g, side in cut for half in (False, True)]
    label = np.empty(len(vectors), np.int64)
    for k, g in enumerate(groups):
        label[g] = k
    return label


class Router:
    """A network with one hidden layer that gives the probability of every part."""

    def __init__(self, vectors: np.ndarray, label: np.ndarray, parts: int, seed: int = 2):
        rng = np.random.default_rng(seed)
        size = vectors.shape[1]
        self.scale = 1 / max(1e-300, float(np.sqrt((vectors**2).sum(axis=1).mean() / size)))
        self.weights = [
            rng.standard_normal((size, HIDDEN)) / np.sqrt(size), np.zeros(HIDDEN),
            rng.standard_normal((HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts),
        ]
        if parts == 1:
            return
        x, means, squares, step = vectors * self.scale, [0.0] * 4, [0.0] * 4, 0
        for epoch in range(EPOCHS):
            rate = 0.003 * (1 - epoch / EPOCHS)
            order = rng.permutation(len(x))
            for at in range(0, len(x), BATCH):
                chosen, step = order[at : at + BATCH], step + 1
                w1, b1, w2, b2 = self.weights
                hidden = np.maximum(x[chosen] @ w1 + b1, 0)
                error = _softmax(hidden @ w2 + b2)
                error[np.arange(len(chosen)), label[chosen]] -= 1
                error /= len(chosen)
                back = (error @ w2.T) * (hidden > 0)
                slopes = [x[chosen].T @ back, back.sum(0), hidden.T @ error, error.sum(0)]
                for k, slope in enumerate(slopes):
                    means[k] = 0.9 * means[k] + 0.1 * slope
                    squares[k] = 0.999 * squares[k] + 0.001 * slope**2
                    move = means[k] / (1 - 0.9**step) / (np.sqrt(squares[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = self.weights[k] - rate * (move + (1e-2 * self.weights[k] if k in (0, 2) else 0))

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return _softmax(np.maximum(vectors * self.scale @ w1 + b1, 0) @ w2 + b2)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def needed_probability(router: Router, queries: np.ndarray, vectors: np.ndarray, k: int, recall: float) -> float:
    """The probability that the parts asked must hold to reach a recall, measured on exact neighbours."""
    if not len(queries) or len(vectors) <= k:
        return 1.0
    near = np.argpartition(-(queries @ vectors.T), k - 1, axis=1)[:, :k]
    part = router.probabilities(vectors).argmax(axis=1)
    odds = router.probabilities(queries)
    order = np.argsort(-odds, axis=1, kind="stable")
    asked = np.take_along_axis(odds, order, axis=1)
    before = np.empty_like(odds)
    np.put_along_axis(before, order, np.cumsum(asked, axis=1) - asked, axis=1)
    return float(np.nextafter(np.quantile(np.take_along_axis(before, part[near], axis=1), recall), 2))


def matrix(vectors: pd.Series, size: int) -> np.ndarray:
    return np.array([np.asarray(v, float) for v in vectors]).reshape(len(vectors), size)


def fit(vectors: DataFrame, parts: int, sample_rows: int, k: int, recall: float) -> tuple[Router, int, float] | None:
    """A router, the size of vectors and the probability to ask for, from (id, vector); None without a vector.

    Few vectors give fewer parts, at least ``LEAST_PART_ROWS`` of the sample in each.
    """
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("vector").collect()
    if not rows:
        return None
    sizes = [len(r.vector) for r in rows]
    size = max(set(sizes), key=lambda s: (sizes.count(s), -s))
    # Equal vectors belong to one part whatever their number, so the graph has each once.
    sample = np.unique(np.array([r.vector for r in rows if len(r.vector) == size], float), axis=0)
    sample = np.random.default_rng(0).permutation(sample)
    held, sample = np.split(sample, [len(sample) // HELD_OUT])
    count = 1
    while 2 * count <= parts and len(sample) // (2 * count) >= LEAST_PART_ROWS:
        count *= 2
    router = Router(sample, balanced_parts(sample, count), count)
    return router, size, needed_probability(router, held, sample, k, recall)


def exact_top(queries: pd.DataFrame, vectors: pd.DataFrame, size: int, k: int) -> pd.DataFrame:
    """The k nearest of ``vectors`` for each query: largest inner product, then smallest id."""
    ids, q_ids = vectors["id"].to_numpy(), queries["query_id"].to_numpy()
    data, asked = matrix(vectors["vector"], size), matrix(queries["query"], size)
    length = np.sqrt((data**2).sum(axis=1).max(initial=0))
    out = []
    for at in range(0, len(asked), 256):
        block = asked[at : at + 256]
        scores = block @ data.T
        scores[q_ids[at : at + 256, None] == ids[None]] = -np.inf
        most = min(k, len(ids))
        least = -np.partition(-scores, most - 1, axis=1)[:, most - 1]
        for row, (query, floor) in enumerate(zip(block, least, strict=True)):
            # Rounding may not decide: all that could be among the nearest are summed in one fixed order.
            slack = SLACK * length * np.sqrt((query**2).sum())
            near = np.flatnonzero((scores[row] >= floor - slack) & np.isfinite(scores[row]))
            exact = (data[near] * query).sum(axis=1)
            order = np.lexsort((ids[near], -exact))[:k]
            out.append(pd.DataFrame({"query_id": q_ids[at + row], "vec_id": ids[near][order], "score": exact[order]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
    parts: int = PARTS, recall: float = RECALL, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for each row of ``queries``.

    Both tables have ``vec_id`` (an integer) and ``vector``. Nearness is the inner product in double
    precision, ties go to the smaller id; a row with the query's id is not its neighbour. Vectors that are
    NULL, zero, hold NULL or non-finite components, or are not as long as most are, and rows with a NULL
    id, take no part. Repeated rows of an id are one candidate and one query. A query with fewer
    candidates gets them all. Other columns are not used; empty tables give no row.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    own = [F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")]
    pick = lambda df: df.select(*own).where(F.col("id").isNotNull() & usable(F.col("vector")))
    schema = "query_id long, vec_id long, score double"
    fitted = fit(pick(vectors), parts, sample_rows, k, recall)
    if fitted is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    router, size, probability = fitted
    indexed = pick(vectors).where(F.size("vector") == size).dropDuplicates(["id"])
    indexed = stored(indexed.withColumn("part", _first_part(F.col("vector"), router, size)), "indexed")
    # One row per part.
    rows_of = {r.part: r["count"] for r in indexed.groupBy("part").count().collect()}
    asked = pick(queries).where(F.size("vector") == size).dropDuplicates(["id"])
    chosen = _parts(F.col("vector"), router, size, rows_of, k, probability)
    asked = asked.select(F.col("id").alias("query_id"), F.col("vector").alias("query"), chosen.alias("parts"))
    asked = stored(asked.withColumn("part", F.explode("parts")).drop("parts"), "asked")
    asks_of = {r.part: r["count"] for r in asked.groupBy("part").count().collect()}
    # Cells of a part: its vectors in blocks times its queries in blocks.
    def blocks(counts: dict[int, int], most: int) -> Column:
        pairs = [F.lit(int(x)) for p in rows_of for x in (p, max(1, -(-counts.get(p, 0) // most)))]
        return F.create_map(*pairs)[F.col("part")]

    v_blocks, q_blocks = blocks(rows_of, CELL_VECTORS), blocks(asks_of, CELL_QUERIES)
    spread = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    of_vectors = indexed.withColumn("v", F.pmod(F.xxhash64("id"), v_blocks).cast("int")).withColumn("q", spread(q_blocks))
    of_queries = asked.withColumn("q", F.pmod(F.xxhash64("query_id"), q_blocks).cast("int")).withColumn("v", spread(v_blocks))
    cell = ["part", "v", "q"]
    met = of_queries.groupBy(*cell).cogroup(of_vectors.groupBy(*cell)).applyInPandas(
        lambda q, v: exact_top(q, v, size, k)[["query_id", "vec_id", "score"]], schema
    )
    # At most k rows from each cell of a query.
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _first_part(vector: Column, router: Router, size: int) -> Column:
    @F.pandas_udf("int")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(router.probabilities(matrix(batch, size)).argmax(axis=1).astype("int32"))

    return run(vector)


def _parts(vector: Column, router: Router, size: int, rows_of: dict[int, int], k: int, probability: float) -> Column:
    """Parts by falling probability until they hold ``probability`` and at least k vectors beside the query."""
    counts = np.array([rows_of.get(p, 0) for p in range(router.weights[3].size)])

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            odds = router.probabilities(matrix(batch, size))
            order = np.argsort(-odds, axis=1, kind="stable")
            before = np.cumsum(np.take_along_axis(odds, order, axis=1), axis=1)
            before = np.concatenate([np.zeros((len(order), 1)), before[:, :-1]], axis=1)
            rows = np.cumsum(counts[order], axis=1) - counts[order]
            asked = (before < probability) | (np.arange(order.shape[1]) < LEAST_PARTS) | (rows <= k)
            yield pd.Series([o[a & (counts[o] > 0)].astype("int32") for o, a in zip(order, asked, strict=True)])

    return run(vector)
