"""Approximate nearest neighbours by cosine, with a forest of hash prefixes.

A tree is a sorted array of long bit strings, one per row, whose bits are the
sides of random hyperplanes. A query descends in each tree to its longest
matching prefix, then ascends in all trees at once, one bit at a time, until the
ranges that share its prefix hold enough entries. Rows that share longer
prefixes in more trees come first; the exact cosines of the first ones decide."""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame

from .vectors import best_first, searched, usable

BITS = 32


def nearest(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 5,
    trees: int = 96,
    gather: float = 5.0,
    scored: float = 0.18,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    block_rows: int = 4096,
    query_rows: int = 4096,
) -> DataFrame:
    """``query_id, rank, vec_id, score double``: for each row where ``is_query``
    (a condition on ``vec_id``) holds, the ``k`` nearest other rows found, by
    cosine, ties to the smaller id.

    The index holds every row: each block of about ``block_rows`` rows has a
    forest of its own. From each a query gathers the longest common prefixes
    whose ranges hold ``gather`` entries for each row of the block, all trees
    together, and scores the share ``scored`` of the rows that come first (at
    least ``k``), and all rows that come equally. A prefix level is gathered whole,
    however many rows share it. Rows whose id or vector is null, empty, all zero, or
    holds a null or non-finite component take no part; of rows with one id the
    smallest vector counts; vectors of other lengths than the query's are no
    candidates. An empty table gives no rows. Other columns are ignored."""
    search = partial(forest_search, trees=trees, gather=gather, scored=scored)
    vectors = usable(embeddings, id_col, vector_col, nonzero=True)
    return searched(vectors, is_query, k, search, "double", block_rows, query_rows)


def bit_strings(vectors: np.ndarray, trees: int) -> np.ndarray:
    """One 32-bit string per tree (rows) and vector (columns)."""
    planes = np.random.default_rng(977).standard_normal((vectors.shape[1], trees * BITS))
    signs = (vectors @ planes > 0).reshape(len(vectors), trees, BITS)
    return np.packbits(signs, axis=2).view(">u4")[:, :, 0].astype(np.uint32).T.copy()


def forest_search(
    queries: np.ndarray,
    candidates: np.ndarray,
    ids: np.ndarray,
    k: int,
    trees: int = 96,
    gather: float = 5.0,
    scored: float = 0.18,
    shares: list[float] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of queries, ids and cosines of the ``k`` best scored rows of one
    block for each query; ``shares`` receives the share of rows scored."""
    strings = bit_strings(candidates, trees)
    order = np.argsort(strings, axis=1, kind="stable")
    arrays = np.take_along_axis(strings, order, axis=1)
    asked = bit_strings(queries, trees)
    count = len(candidates)
    lengths = _prefix_lengths(arrays, asked, min(gather, trees) * count)
    levels = [_ranges(arrays, asked, np.minimum(lengths + more, BITS)) for more in range(3)]
    most = min(count, max(k, int(scored * count)))
    norms = np.sqrt((candidates * candidates).sum(1))
    at, found, scores = [], [], []
    for number, query in enumerate(queries):
        # A row counts once for each tree and each of three prefix lengths.
        entries = [order[t, low[t, number] : high[t, number]] for low, high in levels for t in range(trees)]
        times = np.bincount(np.concatenate(entries), minlength=count)
        least = np.partition(times, count - most)[count - most]
        near = np.flatnonzero(times >= max(1, least))
        if len(near) < k:
            near = np.arange(count)
        rows = candidates[near]
        score = (rows * query).sum(1) / (norms[near] * np.sqrt((query * query).sum()))
        best = best_first(score, ids[near], k)
        at.append(np.full(len(best), number))
        found.append(ids[near][best])
        scores.append(score[best])
        if shares is not None:
            shares.append(len(near) / count)
    return np.concatenate(at), np.concatenate(found), np.concatenate(scores)


def _ranges(arrays: np.ndarray, asked: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each tree and query the range of the sorted array that shares the
    query's prefix of its length."""
    rest = _low_bits(BITS - lengths)
    first = asked & ~rest
    last = asked | rest
    low = np.stack([np.searchsorted(array, part, "left") for array, part in zip(arrays, first)])
    high = np.stack([np.searchsorted(array, part, "right") for array, part in zip(arrays, last)])
    return low, high


def _low_bits(count: np.ndarray) -> np.ndarray:
    return ((np.uint64(1) << count.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)


def _prefix_lengths(arrays: np.ndarray, asked: np.ndarray, wanted: float) -> np.ndarray:
    """For each query the longest length at which the ranges of all trees
    together hold at least ``wanted`` entries; 0 holds all."""
    lengths = np.zeros(asked.shape[1], np.int64)
    climbing = np.arange(asked.shape[1])
    for length in range(BITS, 0, -1):
        low, high = _ranges(arrays, asked[:, climbing], np.full(len(climbing), length))
        enough = (high - low).sum(0) >= wanted
        lengths[climbing[enough]] = length
        climbing = climbing[~enough]
        if not len(climbing):
            break
    return lengths
