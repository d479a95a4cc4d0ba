"""Both vector searches against brute force, and their edge cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tallywatch.llm.exact_topk import exact_topk, nra
from tallywatch.llm.lsh_forest import forest_search, nearest

from .conftest import SF

EVERY = "vec_id >= 0"


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, 2.0, "b") for i, v in rows], "vec_id long, embedding array<float>, rank int, score double, block string"
    )


def brute(rows, queries, k, score):
    out = {}
    for q, a in rows:
        if q in queries:
            found = sorted((-score(a, b), i) for i, b in rows if i != q and len(a) == len(b))
            out[q] = [(i, -s) for s, i in found[:k]]
    return out


def inner(a, b):
    return sum(math.floor(64 * x) * math.floor(64 * y) for x, y in zip(a, b))


def answers(frame):
    out = {}
    for row in frame.orderBy("query_id", "rank").collect():
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
        assert row["rank"] == len(out[row.query_id])
    return out


@pytest.mark.parametrize("block_rows,query_rows", [(4096, 4096), (40, 7)])
def test_topk_equals_brute_force(spark, block_rows, query_rows):
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(0, 0.2, 8).astype(np.float32).astype(float).tolist()) for i in range(150)]
    rows += [(200 + i, rows[5][1]) for i in range(40)]  # more ties than places
    found = answers(
        exact_topk(vectors(spark, rows), F.col("vec_id") % 5 == 0, 6, block_rows=block_rows, query_rows=query_rows)
    )
    assert found == brute(rows, {i for i, _ in rows if i % 5 == 0}, 6, inner)


def test_topk_leaves_out_unusable_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0])]
    rows += [(7, []), (None, [1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (2, [2.0, 1.0]), (9, [0.0, 0.0])]
    found = answers(exact_topk(vectors(spark, rows), F.expr(EVERY), 5))
    assert found == {
        1: [(2, 64 * 64 * 4), (9, 0)],
        2: [(1, 64 * 64 * 4), (9, 0)],
        9: [(1, 0), (2, 0)],
    }


def test_empty_tables(spark):
    nothing = vectors(spark, [(1, [1.0])]).where("false")
    assert exact_topk(nothing, F.expr(EVERY)).count() == 0
    assert nearest(nothing, F.expr(EVERY)).count() == 0


def best_of(query, candidates, k):
    every = candidates @ query
    best = np.lexsort((np.arange(len(candidates)), -every))[:k]
    return best.tolist(), every[best].tolist()


def test_nra_equals_all_products():
    draw = np.random.default_rng(1)
    for case in range(40):
        count, width, k = int(draw.integers(1, 400)), int(draw.integers(1, 12)), int(draw.integers(1, 9))
        candidates = np.floor(draw.normal(0, 8 if case % 2 else 1, (count, width)))
        queries = np.floor(draw.normal(0, 5, (3, width)) * draw.integers(0, 2, (3, width)))
        at, ids, scores = nra(queries, candidates, np.arange(count), k)
        for number, query in enumerate(queries):
            assert (ids[at == number].tolist(), scores[at == number].tolist()) == best_of(query, candidates, k)


def test_nra_stops_when_outsiders_cannot_qualify():
    """Best rows far ahead: a quarter of the lists is enough. Without a lead the
    lists are read further."""
    draw = np.random.default_rng(1)
    candidates = np.floor(draw.normal(0, 64, (2000, 16)))
    signs = draw.choice([-1.0, 1.0], 16)
    ahead = candidates.copy()
    ahead[100:105] = 400 * signs
    for rows, read in ((ahead, 0.25), (candidates, None)):
        depths = []
        _, ids, _ = nra(9 * signs[None, :], rows, np.arange(2000), 5, depths=depths)
        assert ids.tolist() == best_of(9 * signs, rows, 5)[0]
        assert depths == [read] if read else depths[0] > 0.25


def test_large_components_are_summed_exactly(spark):
    big = [2**22 + 0.25, -(2.0**22), 2.0**22 - 0.5]
    rows = [(1, big), (2, [*big[:2], big[2] + 0.25]), (3, [1.0, 2.0, 3.0]), (4, [-x for x in big]), (5, [x / 3 for x in big])]
    rows = [(i, np.array(v, np.float32).astype(float).tolist()) for i, v in rows]
    assert answers(exact_topk(vectors(spark, rows), F.expr(EVERY), 5)) == brute(rows, {1, 2, 3, 4, 5}, 5, inner)
    huge = [(1, [1e30, 1.0]), (2, [1e30, 2.0]), (3, [-1e30, 5.0]), (4, [1.0, 1.0]), (5, [1e8, 0.0])]
    found = answers(exact_topk(vectors(spark, huge), F.expr(EVERY), 5))
    assert found[1][0] == (2, 2**63 - 1) and found[1][-1] == (3, -(2**63))
    assert found[4][-1][0] == 3 and found[5][0] == (1, 2**63 - 1)


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b)) / (math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(y * y for y in b)))


def test_forest_returns_all_of_few_and_breaks_ties(spark):
    rows = [(i, [1.0, 0.5]) for i in range(9, 2, -1)] + [(1, [0.5, 1.0]), (2, [-1.0, 0.0]), (20, [0.0, 0.0]), (21, None)]
    found = answers(nearest(vectors(spark, rows), F.col("vec_id").isin(1, 5, 20, 21)))
    assert set(found) == {1, 5}
    assert [i for i, _ in found[5]] == [3, 4, 6, 7, 8] and [i for i, _ in found[1]] == [3, 4, 5, 6, 7]
    few = answers(nearest(vectors(spark, rows[-4:-1]), F.expr(EVERY)))
    assert [i for i, _ in few[1]] == [2] and few[1][0][1] == pytest.approx(cosine([0.5, 1.0], [-1.0, 0.0]))


def test_forest_takes_longest_prefixes_first():
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(20, 16))
    rows = np.repeat(centres, 30, 0) + draw.normal(size=(600, 16)) * 0.05
    at, ids, _ = forest_search(rows[::30], rows, np.arange(600), 5, trees=8, gather=0.1, scored=0.05)
    for number in range(20):
        assert (ids[at == number] // 30 == number).all()


@pytest.mark.parametrize("noise", [None, 0.3])
def test_forest_finds_nine_of_ten_by_scoring_a_fifth(noise):
    """Of vectors without any order, and of noisy copies."""
    draw = np.random.default_rng(5)
    rows = draw.normal(size=(2000, 64))
    if noise:
        rows = np.repeat(rows[:100], 20, 0) + noise * draw.normal(size=rows.shape)
    shares = []
    at, ids, _ = forest_search(rows[::40], rows, np.arange(2000), 6, shares=shares)
    unit = rows / np.sqrt((rows * rows).sum(1))[:, None]
    hits = 0
    for number in range(50):
        best = np.argsort(-(unit @ unit[40 * number]))[:6]
        hits += len(set(best.tolist()) & set(ids[at == number].tolist())) - 1
    assert hits >= 0.9 * 250 and np.mean(shares) <= 0.2


def test_forest_recall_on_the_table(spark):
    found = spark_entry.queries()["op2_hash_prefix_forest"](spark, SF).collect()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([row.vec_id for row in rows])
    unit = np.array([row.embedding for row in rows], float)
    unit /= np.sqrt((unit * unit).sum(1))[:, None]
    hits = total = 0
    for place in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[place]
        best = [i for i in np.lexsort((ids, -score)) if i != place][:5]
        mine = {row.vec_id: row.score for row in found if row.query_id == ids[place]}
        hits += len(set(ids[best].tolist()) & set(mine))
        total += 5
        for i in np.flatnonzero(np.isin(ids, list(mine))):
            assert mine[ids[i]] == pytest.approx(score[i], abs=1e-12)
    assert hits >= 0.9 * total
