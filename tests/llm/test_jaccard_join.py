"""Near-duplicate groups against all pairs, components, and the pipeline's use."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallywatch.llm import jaccard_join
from tallywatch.llm.components import components
from tallywatch.llm.jaccard_join import fingerprint, one_of_each, parity_sketch, shingle_sets, similar_groups, small_limit
from tallywatch.llm.tables import joined_evenly

from .conftest import WORDS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = (text or "").translate(LOWER).replace("\n", " ").replace("\t", " ").split(" ")
    words = [w for w in words if w]
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def plain(texts):
    sets = {i: shingles(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def found(frame):
    return sorted(tuple(row) for row in frame.select("doc_id", "n_shingles", "component_id").collect())


def corpus(seed, groups=12, size=9):
    """Groups of texts that differ by a few words, about as far as links reach."""
    draw = random.Random(seed)
    texts = []
    for _ in range(groups):
        words = [draw.choice(WORDS) + str(draw.randint(0, 30)) for _ in range(draw.choice([6, 8, 12, 20, 40, 90, 300]))]
        for _ in range(draw.randint(1, size)):
            other = list(words)
            for _ in range(draw.randint(0, 1 + len(words) // 25)):
                at = draw.randrange(len(other))
                other[at : at + draw.randint(0, 2)] = [draw.choice(WORDS)] * draw.randint(0, 2)
            texts.append(" ".join(other))
    draw.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,limit", [(1, None), (2, 0), (3, 64), (4, 15)])
def test_groups_equal_all_pairs(docs, monkeypatch, seed, limit):
    if limit is not None:
        monkeypatch.setattr(jaccard_join, "small_limit", lambda sizes, scan: limit)
    texts = corpus(seed)
    expected = plain(texts)
    assert 3 < len({c for *_, c in expected}) < len(texts)
    assert found(similar_groups(docs(texts))) == expected


def test_odd_texts(docs):
    long = " ".join(f"w{i}" for i in range(30_000))
    texts = list(
        enumerate([None, "", " ", "a", "A", "a b", "a  B", "a b c d e", "a b c d e f", "a b c d", "a\nb\tc d", long, long + " x", "a"])
    )
    assert found(similar_groups(docs(texts))) == plain(texts)
    assert similar_groups(docs(["a"]).where("false")).count() == 0
    rows = found(similar_groups(docs([(7, "a b"), (7, "c d"), (9, "c d"), (8, "x")])))
    assert rows == [(7, 1, 7), (7, 1, 7), (8, 1, 8), (9, 1, 7)]
    rows = similar_groups(docs([(None, "a b"), (4, "a b"), (None, "z")])).collect()
    assert sorted(str((r.doc_id, r.component_id)) for r in rows) == ["(4, 4)", "(None, 4)", "(None, None)"]


def test_a_chain_is_one_component(docs):
    """Neighbours are similar, ends are not."""
    words = [f"w{i}" for i in range(400)]
    texts = [(i, " ".join(words[6 * i : 6 * i + 60])) for i in range(40)]
    rows = found(similar_groups(docs(texts)))
    assert rows == plain(texts) and {c for *_, c in rows} == {0}


def test_a_large_group_of_near_copies(docs):
    draw = random.Random(9)
    words = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(400):
        other = list(words)
        other[draw.randrange(120)] = f"x{i}"
        texts.append((i, " ".join(other)))
    texts += [(1000 + i, " ".join(f"{w}{i}" for w in words)) for i in range(30)]
    assert found(similar_groups(docs(texts))) == plain(texts)


def test_one_of_each_group(docs, table):
    rows = docs([(5, "a b c d e f"), (5, "a b c d e f"), (None, "z"), (None, "z"), (None, None), (1, ""), (2, ""), (9, "q r s")])
    kept = one_of_each(table(rows, 1))
    assert kept.columns == rows.columns
    assert sorted(str(row.text) for row in kept.collect()) == ["", "", "None", "a b c d e f", "q r s", "z"]
    assert one_of_each(table(rows.where("false"))).count() == 0


def test_components_of_random_graphs(spark):
    draw = random.Random(11)
    for size, links in ((30, 20), (60, 70), (2, 1)):
        pairs = [(draw.randrange(size), draw.randrange(size)) for _ in range(links)] + [(5, 5)]
        frame = spark.createDataFrame(pairs, "a long, b long")
        root = {n: n for p in pairs for n in p}
        for _ in root:
            for a, b in pairs:
                root[a] = root[b] = min(root[a], root[b])
        expected = {n: r for n, r in root.items() if sum(r == other for other in root.values()) > 1}
        assert {row.node: row.root for row in components(frame).collect()} == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketches_bound_the_difference():
    draw = np.random.default_rng(3)
    for _ in range(50):
        a = np.unique(draw.integers(0, 2**63, 300).astype(np.uint64))
        b = np.unique(np.concatenate([a[draw.integers(0, 40) :], draw.integers(0, 2**63, 20).astype(np.uint64)]))
        bits = sum(int(x ^ y).bit_count() for x, y in zip(parity_sketch(a).view(np.uint64), parity_sketch(b).view(np.uint64)))
        assert bits <= len(np.setxor1d(a, b))
    assert fingerprint(a) != fingerprint(b) and fingerprint(a) == fingerprint(a.copy())


def test_shingles_tell_short_texts_from_long_ones():
    sets = list(shingle_sets(pa.array(["a b c d", "a b c d e", "e a b c d", "", None, "A b C d", "a b c d e f"])))
    assert [len(s) for s in sets] == [1, 1, 1, 0, 0, 1, 2]
    assert sets[0] == sets[5] and sets[1] != sets[2] and sets[1][0] in sets[6]


def test_the_boundary_follows_the_cost():
    assert small_limit({}, 1.0) == 0
    limits = [small_limit({10: 5, 40: 5}, scan) for scan in (1.0, 4.0, 50.0)]
    assert limits == sorted(limits) and limits[0] < 10 < limits[-1]


def test_no_list_is_expanded_into_all_pairs(spark, docs, monkeypatch):
    """Near copies are compared once per member and list, not with each other."""
    words = [f"w{i}" for i in range(200)]
    texts = [(i, " ".join([*words[:i], f"x{i}", *words[i + 1 :]])) for i in range(150)]
    compared = []
    real = jaccard_join._close
    monkeypatch.setattr(jaccard_join, "_close", lambda pairs, sets: compared.append(pairs.count()) or real(pairs, sets))
    assert {row.component_id for row in similar_groups(docs(texts)).collect()} == {0}
    assert 0 < sum(compared) < 150 * 40


def test_even_join_equals_a_plain_one(spark, table):
    """Hot keys, cold keys, keys that aren't found, rows without a key."""
    keys = [7] * 900 + [8] * 250 + list(range(100, 300)) + [None] * 300
    rows = table(spark.createDataFrame(list(enumerate(keys)), "row long, key long"))
    found = spark.createDataFrame(
        [(7, "hot", 900), (8, "warm", 250), *((key, f"v{key}", 1) for key in range(100, 250))], "key long, value string, members long"
    )
    plain = rows.join(found.drop("members"), "key", "left").select("row", "key", "value").collect()
    even = joined_evenly(rows, found, "key", len(keys)).select("row", "key", "value").collect()
    assert sorted(plain) == sorted(even)
    inner = joined_evenly(rows, found, "key", len(keys), "inner").select("row", "key", "value").collect()
    assert sorted(inner) == sorted(row for row in plain if row.value)
