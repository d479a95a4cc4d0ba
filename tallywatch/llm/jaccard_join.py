"""Similarity join of documents by the Jaccard similarity of their word
shingles, size-aware, with separate ways for small (light) and large (heavy)
sets.

Tokens (shingle hashes) are ordered by how many documents hold them, rarest
first. Two similar sets share a token within their first quarters, and two
tokens within slightly longer prefixes. Small sets list all two-token subsets of
that longer prefix and meet in equal subsets; a pair with a large set meets in
the inverted list of one prefix token. Where small ends is chosen by cost.

Lists are not expanded into all pairs. Each member is first compared with a few
members of its list, which joins groups of near copies in linear time; only what
then lies in different components is compared pair by pair."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import LOWER, bytes_of, combine, mix, rows_of_words, word_bounds, word_hashes
from .components import components
from .tables import free_name, joined_evenly, new_folder, parquet_tables, stored, texts
from .tokens import slices

WORDS = 5
PARTS = 64
LARGEST_COUNT = 65535
BITS = 512
SMALL_LIMIT = 64
HEADS = 8
BROADCAST_ROWS = 2_000_000
SKETCH = [f"s{part}" for part in range(BITS // 64)]


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes, ascending."""
    data, offsets = bytes_of(column)
    lower = LOWER[data]
    starts, ends = word_bounds(lower, offsets)
    words = word_hashes(lower, starts, ends)
    first = rows_of_words(starts, offsets).tolist()
    count = max(0, len(words) - WORDS + 1)
    shingles = combine(*(words[place : place + count] for place in range(WORDS))) if count else np.zeros(0, np.uint64)
    for begin, end in zip(first, first[1:]):
        if end - begin >= WORDS:
            yield np.unique(shingles[begin : end - WORDS + 1])
        elif end > begin:
            # The whole text as one shingle, told apart from five words by its length.
            yield combine(*(words[place : place + 1] for place in range(begin, end)), np.array([end - begin], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def fingerprint(tokens: np.ndarray) -> int:
    """One signed 64-bit number per set."""
    total = mix(tokens ^ np.uint64(0xA5A5A5A5)).sum(keepdims=True, dtype=np.uint64)
    return int(combine(total, np.array([len(tokens)], np.uint64)).view(np.int64)[0])


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of tokens per bit: two sets differ in at least as many tokens
    as their sketches in bits."""
    odd = np.bincount((tokens % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _counters(rows: DataFrame) -> int:
    """How many counters there are: about one for eight tokens of a scan's
    usual partitions, four million (16 MB for a task) at most, so that what the
    tasks write grows with their number alone. Fewer make the order of tokens less
    good, and nothing wrong."""
    return min(1 << 22, max(1 << 16, 1 << (rows.rdd.getNumPartitions() * (1 << 19) - 1).bit_length()))


def _place(tokens: np.ndarray, counters: int) -> np.ndarray:
    return (tokens >> np.uint64(32)).astype(np.int64) & (counters - 1)


def _describe(docs: DataFrame, counters: int) -> tuple[DataFrame, DataFrame]:
    """One row per document with its set's size, fingerprint and sketch; and
    counters, in parts, of how many documents hold a token that falls to them."""
    schema = "doc_id long, cls long, n long, " + ", ".join(f"{name} long" for name in SKETCH) + ", part int, counts binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted = np.zeros(counters, np.uint32)
        for batch in slices(batches):
            rows = []
            for tokens in shingle_sets(batch["text"]):
                np.add.at(counted, _place(tokens, counters), 1)
                rows.append((fingerprint(tokens), len(tokens), *parity_sketch(tokens).tolist()))
            columns = [pa.array(values, pa.int64()) for values in zip(*rows)]
            none = len(rows)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *columns, pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())], names=names
            )
        if counted.any():
            empty = [pa.nulls(1, pa.int64()) for _ in range(3 + len(SKETCH))]
            for part, values in enumerate(counted.reshape(PARTS, -1)):
                blob = np.minimum(values, LARGEST_COUNT).astype("<u2").tobytes()
                columns = [*empty, pa.array([part], pa.int32()), pa.array([blob], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "cls", "n", *SKETCH, "part", "counts"]
    both = stored(texts(docs).mapInArrow(run, schema), "sets")
    return both.where(F.col("part").isNull()).drop("part", "counts"), _summed(both.where(F.col("part").isNotNull()))


def _summed(blobs: DataFrame) -> DataFrame:
    """``part, counts, total, squares``: the tasks' counters added up, in two
    steps so that no group is large."""

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(len(group["counts"][0].as_buffer()) // 2, np.uint32)
        for blob in group["counts"]:
            total += np.frombuffer(blob.as_buffer(), "<u2")
        values = np.minimum(total, LARGEST_COUNT).astype("<u2")
        sums = {"total": [float(values.sum(dtype=np.float64))], "squares": [float(np.square(values, dtype=np.float64).sum())]}
        return pa.table({"part": group["part"].slice(0, 1), "counts": pa.array([values.tobytes()], pa.binary()), **sums})

    schema = "part int, counts binary, total double, squares double"
    spread = F.pmod(F.monotonically_increasing_id() % 1_000_003, F.lit(32))
    some = blobs.select("part", "counts").withColumn("share", spread).groupBy("part", "share").applyInArrow(add, schema)
    return some.select("part", "counts").groupBy("part").applyInArrow(add, schema)


@lru_cache(maxsize=1)
def _read_counts(folder: str, counters: int) -> np.ndarray:
    """All counters, read by a task from the shared folder; they never pass
    through the driver."""
    counts = np.zeros((PARTS, counters // PARTS), np.uint16)
    for table in parquet_tables(folder):
        for part, blob in zip(table["part"].to_pylist(), table["counts"]):
            counts[part] = np.frombuffer(blob.as_buffer(), "<u2")
    return counts.ravel()


def small_limit(sizes: dict[int, int], scan: float) -> int:
    """The size up to which sets are small, where the rows to enumerate for
    small sets and the list entries to scan for large ones cost least; an entry
    of a list costs ``scan`` rows, its usual length."""

    def cost(limit: int) -> float:
        spent = 0.0
        for size, count in sizes.items():
            prefix = size // 4 + 1
            if size <= limit:
                spent += count * prefix * (prefix + 1) / 2
            if 4 * size >= 3 * (limit + 1):
                spent += count * prefix * scan
        return spent

    return min(range(SMALL_LIMIT + 1), key=lambda limit: (cost(limit), limit))


def _entries(docs: DataFrame, folder: str, counters: int, limit: int) -> DataFrame:
    """``key, cls, n, reach``: the list entries and subsets of every set of two
    tokens or more (smaller ones are similar to equal ones only). ``reach`` bounds
    the overlap with a set whose first common tokens these are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = _read_counts(folder, counters), set()
        for batch in slices(batches):
            keys, classes, sizes, reach = [], [], [], []
            for tokens in shingle_sets(batch["text"]):
                size = len(tokens)
                cls = fingerprint(tokens)
                if size < 2 or cls in seen:
                    continue
                seen.add(cls)
                held = rank[_place(tokens, counters)]
                longest = tokens[np.lexsort((tokens, held))[: size // 4 + 2]]
                if size <= limit:
                    i, j = np.triu_indices(len(longest), 1)
                    found, far = combine(longest[i], longest[j]), size + 1 - j
                else:
                    found, far = np.zeros(0, np.uint64), np.zeros(0, np.int64)
                if 4 * size >= 3 * (limit + 1):
                    prefix = longest[: size // 4 + 1]
                    found = np.concatenate([found, prefix])
                    far = np.concatenate([far, size - np.arange(len(prefix))])
                keys.append(found.view(np.int64))
                reach.append(far)
                classes.append(np.full(len(found), cls))
                sizes.append(np.full(len(found), size))
            if keys:
                columns = (np.concatenate(part) for part in (keys, classes, sizes, reach))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, pa.int64()).cast(kind) for column, kind in zip(columns, kinds)], names=names
                )

    kinds, names = (pa.int64(), pa.int64(), pa.int32(), pa.int32()), ["key", "cls", "n", "reach"]
    return texts(docs).mapInArrow(run, "key long, cls long, n int, reach int")


def _possible(n: str, m: str, reach: str, other: str) -> Column:
    """Whether sizes and bounds allow for similarity of 3/4."""
    n, m = F.col(n), F.col(m)
    return (4 * F.least(n, m) >= 3 * F.greatest(n, m)) & (7 * F.least(reach, other) >= 3 * (n + m))


def _sketches(sets: DataFrame, name: str) -> DataFrame:
    """``sets`` with their columns named after the side of a pair."""
    return sets.select(F.col("cls").alias(name), F.col("n").alias(f"n_{name}"), *(F.col(s).alias(f"{s}_{name}") for s in SKETCH))


def _near() -> Column:
    """Whether the sketches of both sides allow for similarity."""
    differ = sum((F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in SKETCH), F.lit(0))
    return 7 * differ <= F.col("n_a") + F.col("n_b")


def _close(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``a, b`` whose sketches allow for similarity."""
    return pairs.join(_sketches(sets, "a"), "a").join(_sketches(sets, "b"), "b").where(_near()).select(*pairs.columns)


def _tokens_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``cls, tokens binary`` of the wanted classes, from the document that
    stands for each (``cls, doc_id``). They are broadcast if few; else both
    sides are shuffled."""
    few = wanted.count() <= BROADCAST_ROWS
    named = wanted.select("doc_id", "cls")
    rows = texts(docs).join(F.broadcast(named) if few else named, "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [
                (cls, tokens.tobytes())
                for cls, tokens in zip(batch["cls"].to_pylist(), shingle_sets(batch["text"]))
                if fingerprint(tokens) == cls
            ]
            yield pa.RecordBatch.from_pydict(
                {"cls": pa.array([c for c, _ in found], pa.int64()), "tokens": pa.array([t for _, t in found], pa.binary())}
            )

    found = rows.select("cls", "text").mapInArrow(run, "cls long, tokens binary")
    # Rows with one id and equal texts come more than once.
    return stored(found.dropDuplicates(["cls"]), "tokens")


def _verified(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Those of ``a, b`` that are similar, by their whole sets."""
    a = tokens.select(F.col("cls").alias("a"), F.col("tokens").alias("left"))
    b = tokens.select(F.col("cls").alias("b"), F.col("tokens").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for left, right in zip(batch["left"], batch["right"]):
                left, right = (np.frombuffer(side.as_buffer(), np.uint64) for side in (left, right))
                common = len(left) + len(right) - len(np.unique(np.concatenate([left, right])))
                kept.append(100 * common >= 75 * (len(left) + len(right) - common))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    joined = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "left", "right")
    return joined.mapInArrow(run, "a long, b long")


def similar_groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row: the number of
    distinct 5-word shingles, and the smallest id that can be reached over links
    between documents of similarity 0.75 or more (its own included).

    Words are what ASCII white space leaves, with A-Z lower-cased. A text of
    fewer words is one shingle; a null or empty one has none and links with
    nothing. Equal sets are one class from the start. A row without an id belongs
    to the documents with an equal set, else to none; rows with equal ids are
    separate documents that name the same one. An empty table gives no rows; other columns are
    ignored."""
    counters = _counters(docs)
    rows, counts = _describe(docs, counters)
    folder = new_folder(docs.sparkSession, "counters")
    counts.write.option("compression", "zstd").parquet(folder)
    sums = docs.sparkSession.read.parquet(folder).agg(F.sum("total").alias("total"), F.sum("squares").alias("squares")).first()
    # Length of the list of a usual token, less what other tokens add to its counter.
    scan = max(1.0, sums["squares"] / sums["total"] - sums["total"] / counters) if sums["total"] else 1.0
    # Each class once, with the document that stands for it (one without an id can't) and its number of rows.
    sets = stored(
        rows.where(F.col("n") > 0)
        .groupBy("cls")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.count(F.lit(1)).alias("members"),
            *(F.first(name).alias(name) for name in ("n", *SKETCH)),
        )
        .where(F.col("doc_id").isNotNull()),
        "classes",
    )
    bucket = F.least("n", F.lit(4 * SMALL_LIMIT))
    sizes = {row["size"]: row["count"] for row in sets.groupBy(bucket.alias("size")).count().collect()}
    entries = _entries(docs, folder, counters, small_limit(sizes, scan))

    # Members in a random order that is the same in all lists, so that the first ones of a group's
    # lists are mostly the same few.
    along = Window.partitionBy("key").orderBy("order", "cls")
    lists = entries.withColumn("order", F.xxhash64("cls")).withColumns(
        {"after": F.lead("cls").over(along), "head": F.first("cls").over(along)}
    )
    lists = lists.where(
        # Once per class, which may come from several tasks, and not if it is alone.
        F.when(F.col("after").isNull(), F.col("head") != F.col("cls")).otherwise(F.col("after") != F.col("cls"))
    )
    member = F.struct(F.col("cls"), F.col("n"), F.col("reach"))
    heads = F.array(*(F.nth_value(member, number + 1).over(along) for number in range(HEADS)))
    lists = lists.withColumns({"heads": heads, "number": F.row_number().over(along)})
    lists = stored(lists.select("key", "cls", "n", "reach", "heads", "number"), "lists")

    # A few comparisons per list and member, with the list's first members.
    heads = lists.select("cls", "n", "reach", F.explode("heads").alias("of")).select(
        "cls", "n", "reach", *(F.col(f"of.{name}").alias(f"head_{name}") for name in ("cls", "n", "reach"))
    )
    heads = heads.where((F.col("head_cls") != F.col("cls")) & _possible("n", "head_n", "reach", "head_reach"))
    ordered = heads.select(F.least("cls", "head_cls").alias("a"), F.greatest("cls", "head_cls").alias("b"))
    star = stored(_close(ordered.distinct(), sets), "star")
    links = stored(_verified(star, _tokens_of(docs, _named(star, sets))), "links")
    roots = stored(components(links), "roots")

    # Then every other pair of a list that may be similar and isn't in one component yet. The first
    # members have been compared with all.
    others = lists.where(F.col("number") > HEADS).select("key", "cls", "n", "reach")
    rooted = others.join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "cls"))
    open_keys = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    open_keys = open_keys.where(F.col("low") != F.col("high")).select("key")
    open_lists = stored(
        rooted.join(open_keys, "key", "left_semi").join(sets.drop("doc_id", "n", "members"), "cls"), "open-lists"
    )
    a, b = (
        open_lists.select("key", *(F.col(name).alias(f"{name}_{side}") for name in open_lists.columns if name != "key"))
        for side in "ab"
    )
    # Sketches are compared within the join, so that only pairs worth verifying come out of it.
    crossing = a.join(
        b,
        (a["key"] == b["key"])
        & (F.col("cls_a") < F.col("cls_b"))
        & (F.col("root_a") != F.col("root_b"))
        & _possible("n_a", "n_b", "reach_a", "reach_b")
        & _near(),
    )
    crossing = crossing.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()
    rest = stored(crossing.join(star, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        found = _verified(rest, _tokens_of(docs, _named(rest, sets)))
        roots = components(found.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    # Components are named class by class, then each class's rows after it.
    rooted = sets.select("cls", "doc_id", "members").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "cls")), "rooted")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("members"))
    classes = rooted.agg(F.count(F.lit(1)).alias("classes"), F.coalesce(F.sum("members"), F.lit(0)).alias("rows")).first()
    named = joined_evenly(rooted, stored(least, "least"), "root", classes["classes"])
    named = stored(named.select("cls", "component_id", "members"), "named")
    labelled = rows.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("cls")).alias("cls"))
    labelled = joined_evenly(labelled, named, "cls", classes["rows"])
    return labelled.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, but only the first of each
    group of near duplicates (as ``similar_groups`` has them). Rows are told
    apart by their position, so equal and null ids do no harm; ``docs`` has to
    come straight from a table, whose rows have fixed positions. The rows to
    drop are broadcast if few; else both sides are shuffled."""
    row = free_name(docs, "_row")
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    groups = similar_groups(rows.select(F.col(row).alias("doc_id"), "text"))
    surplus = groups.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias(row))
    surplus = stored(surplus, "surplus")
    few = surplus.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(surplus) if few else surplus, row, "left_anti").select(*docs.columns)


def _named(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``cls, doc_id`` of the classes in ``a, b``."""
    classes = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    return classes.join(sets.select("cls", "doc_id"), "cls")
