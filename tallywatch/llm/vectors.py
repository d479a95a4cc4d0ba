"""Vector tables for the two searches: usable rows, equal vectors folded
together, and blocks of queries against blocks of candidates."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import stored


def usable(rows: DataFrame, id_col: str, vector_col: str, nonzero: bool = False) -> DataFrame:
    """``vec_id long, vector array<double>`` of the rows that have an id and a
    vector with finite components only (and, if asked, not all zero). Of
    several rows with one id the smallest vector counts."""
    vector = F.col(vector_col).cast("array<double>")
    limit = F.lit(float("inf"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    kept = rows.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(
        F.col("vec_id").isNotNull() & (F.size("vector") > 0) & fine
    )
    if nonzero:
        kept = kept.where(F.exists("vector", lambda x: x != 0))
    return kept.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def searched(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    search: Callable[[np.ndarray, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]],
    score_type: str,
    block_rows: int,
    query_rows: int,
) -> DataFrame:
    """The ``k`` best rows for each query row, its own excepted:
    ``query_id, rank, vec_id, score``.

    ``search(queries, candidates, ids, k)`` returns positions of queries, ids
    and scores. Only vectors of equal length meet. A vector held by many rows
    is searched once and stands for its ``k + 1`` smallest ids, since later
    ones lose every tie; the searches run on pairs of bounded blocks, and the
    best of each block are ranked once more."""
    rows = stored(vectors, "vectors")
    same = Window.partitionBy("vector").orderBy("vec_id")
    members = rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1)
    candidates = stored(members.select("vec_id", "vector"), "candidates")
    asked = rows.where(is_query).groupBy("vector").agg(F.min("vec_id").alias("query"))
    asked = stored(asked, "queries")
    blocks = max(1, -(-candidates.count() // block_rows))
    query_blocks = max(1, -(-asked.count() // query_rows))

    def block(column: str, count: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    size = F.size("vector").alias("size")
    left = asked.select(
        every(blocks).alias("block"), block("query", query_blocks).alias("query_block"), size, "query", "vector"
    )
    right = candidates.select(
        block("vec_id", blocks).alias("block"), every(query_blocks).alias("query_block"), size, "vec_id", "vector"
    )

    types = pa.schema(
        [("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64() if score_type == "long" else pa.float64())]
    )

    def pair(queries: pa.Table, found: pa.Table) -> pa.Table:
        if not len(queries) or not len(found):
            return types.empty_table()
        ids = found["vec_id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        at, ids, scores = search(_matrix(queries["vector"]), _matrix(found["vector"])[order], ids[order], k + 1)
        return pa.table({"query": queries["query"].to_numpy()[at], "vec_id": ids, "score": scores}).cast(types)

    keys = ["block", "query_block", "size"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        pair, f"query long, vec_id long, score {score_type}"
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    hits = hits.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place")

    askers = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector")
    askers = askers.join(asked, "vector").select("query_id", "query")
    answer = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        askers.join(hits, "query")
        .where(F.col("query_id") != F.col("vec_id"))
        .withColumn("rank", F.row_number().over(answer).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def best_first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties by smaller id."""
    return np.lexsort((ids, -scores))[:k]
