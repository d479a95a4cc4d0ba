"""Exact top-k by integer inner product, with no-random-access aggregation.

Every block of candidates keeps one list per component, sorted by value. A
query reads all lists step by step from the end that helps its score. What has
been read of a candidate, plus the worst or best that its unread lists still
allow, bounds its score from below and above. Reading stops as soon as nobody
outside a small set of survivors can reach the k-th best lower bound; the
survivors' scores are then resolved.

Many queries read together, in few large steps: for 64 components of either sign
the bounds are too wide to stop much earlier even if each query reads by itself,
in small steps, the list that leaves most open (see the README)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import best_first, searched, usable

LONGEST = 2**63 - 1


def quantised(vectors: DataFrame, scale: float = 64.0) -> DataFrame:
    """Each component as floor(scale * x), held within the range of a long."""
    return vectors.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale).cast("double")))


def exact_topk(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = 4096,
    query_rows: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score long``: for each row where ``is_query``
    (a condition on ``vec_id``) holds, the ``k`` other rows with the largest
    inner product of quantised vectors, ties to the smaller id.

    Rows whose id or vector is null, empty, or holds a null or non-finite
    component take no part; of rows with one id the smallest vector counts;
    vectors of other lengths than the query's are no candidates. Scores are
    summed as whole numbers of any size; one beyond the range of a long is
    returned and ranked as the end of that range. An empty table gives no rows.
    Other columns are ignored."""
    vectors = quantised(usable(embeddings, id_col, vector_col), scale)
    return searched(vectors, is_query, k, nra, "long", block_rows, query_rows)


def nra(
    queries: np.ndarray,
    candidates: np.ndarray,
    ids: np.ndarray,
    k: int,
    steps: int = 4,
    batch: int = 256,
    depths: list[float] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of queries, ids and scores of the ``k`` best candidates of one
    block for each query. ``ids`` ascend.

    ``batch`` queries at a time read the block's lists together: for a positive
    component from the largest value down, for a negative one from the smallest
    value up. ``depths`` receives the share of the lists that each query read."""
    count, width = candidates.shape
    largest = float(np.abs(candidates).max()) * float(np.abs(queries).max()) * width
    # Floating sums of whole numbers are exact below these bounds; beyond, Python's own numbers are.
    exact = np.float32 if largest < 2**23 else np.float64 if largest < 2**52 else object
    if exact is object:
        candidates, queries = (np.frompyfunc(int, 1, 1)(part) for part in (candidates, queries))
    candidates, queries = candidates.astype(exact), queries.astype(exact)
    order = np.argsort(candidates, axis=0, kind="stable")
    values = np.take_along_axis(candidates, order, axis=0)
    columns = np.arange(width)
    weights = np.stack([np.maximum(queries, 0), np.minimum(queries, 0)])
    worst = np.stack([values[0], values[-1]])
    step = -(-count // steps)
    at, found, scores = [], [], []

    def resolve(number: int, alive: np.ndarray) -> None:
        score = candidates[alive] @ queries[number]
        if exact is object:
            score = np.clip(score, -LONGEST - 1, LONGEST)
        score = score.astype(np.int64)
        if depths is not None:
            depths.append(depth / count)
        best = best_first(score, ids[alive], k)
        at.append(np.full(len(best), number))
        found.append(ids[alive][best])
        scores.append(score[best])

    for first in range(0, len(queries), batch):
        active, depth = np.arange(first, min(first + batch, len(queries))), 0
        # Values and marks of the entries read so far, of lists read downwards and upwards.
        read, seen = np.zeros((2, count, width), exact), np.zeros((2, count, width), exact)
        while len(active):
            upto = min(count, depth + step)
            for side, rows in enumerate((slice(count - upto, count - depth), slice(depth, upto))):
                read[side, order[rows], columns] = values[rows]
                seen[side, order[rows], columns] = 1
            depth = upto
            # An unread entry is worth at least its list's far end and at most the last one read.
            last = np.stack([values[count - depth], values[depth - 1]])
            known, low, high = 0, 0, 0
            for side in (0, 1):
                weight = weights[side, active].T
                known += read[side] @ weight
                for_worst, for_last = weight * worst[side][:, None], weight * last[side][:, None]
                low += for_worst.sum(0) - seen[side] @ for_worst
                high += for_last.sum(0) - seen[side] @ for_last
            low, high = known + low, known + high
            place = max(0, count - k)
            alive = high >= np.partition(low, place, axis=0)[place]
            survivors = alive.sum(0)
            done = (survivors <= max(4 * k, min(step, count - depth))) | (depth == count)
            for column in np.flatnonzero(done):
                resolve(active[column], np.flatnonzero(alive[:, column]))
            active = active[~done]
    return np.concatenate(at), np.concatenate(found), np.concatenate(scores)
