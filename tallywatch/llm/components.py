"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import joined_evenly, stored


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a long, b long``): ``root``
    is the smallest node that can be reached. Nodes without a link to another
    are left out.

    Turns of large and small stars: each node hands its larger, then its smaller
    neighbours to the smallest one it knows, until the graph is a star for each
    component. Each turn aggregates before the shuffle and is written to the
    shared folder; the number of turns grows with the logarithm of the size."""
    known = stored(_canonical(links), "links")
    before, count = None, known.count()
    for _ in range(rounds):
        both = known.unionByName(known.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"), F.count(F.lit(1)).alias("members"))
        least = stored(least.withColumn("least", F.least("a", "least")), "least")
        large = joined_evenly(both, least, "a", 2 * count, "inner").where(F.col("b") > F.col("a")).select("b", F.col("least").alias("a"))
        small = _canonical(large)
        least = small.groupBy("b").agg(F.min("a").alias("least"))
        moved = small.join(least, "b")
        known = stored(
            _canonical(
                moved.select(F.col("a"), F.col("least").alias("b")).unionByName(
                    moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
                )
            ),
            "links",
        )
        # Stars are what no turn changes any more: as many links, and the same sum of roots.
        state = known.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before, count = state, state[0]
    else:
        raise RuntimeError("components did not settle")
    root = known.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    return root.unionByName(root.select(F.col("root").alias("node"), "root").distinct())


def _canonical(links: DataFrame) -> DataFrame:
    """Each link once, smaller node first, none to itself."""
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
