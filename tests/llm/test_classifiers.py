"""Quality and toxicity: held-out accuracy, model parts, and edge cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
from tallywatch.llm import toxicity
from tallywatch.llm.quality import FEATURES, features, fit, good_texts, quality_scores
from tallywatch.llm.tables import sampled_texts
from tallywatch.llm.toxicity import boost, civil_texts, isotonic, toxicity_scores

from ..conftest import TESTDATA

SF = f"{TESTDATA}/sf0.1"
ODD = [None, "", " ", "a", "\n\n", "x" * 200_000, "word " * 20_000, "日本語 " * 50, "\x00", "!!!", "é" * 7]


@pytest.mark.parametrize("name,label,part,parts", [("op4_quality_gam", "quality", 0, 5), ("op7_toxicity", "toxic", 1, 3)])
def test_held_out_accuracy(spark, name, label, part, parts):
    labels = spark.read.parquet(f"{SF}/labels.parquet").where(F.col(label).isNotNull())
    rows = spark_entry.queries()[name](spark, SF)
    assert rows.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    known = rows.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", label).collect()
    for row in known:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % parts == part) and 0 <= row.score <= 1
    held = [row for row in known if row.held_out]
    for wanted in (0, 1):
        mine = [row.predicted for row in held if row[label] == wanted]
        assert np.mean(np.array(mine) == wanted) > (0.97 if wanted == (label == "quality") else 0.9)


@pytest.mark.parametrize("score_of", [quality_scores, toxicity_scores])
def test_odd_texts_and_labels(spark, docs, score_of):
    name = "quality" if score_of is quality_scores else "toxic"
    rows = docs(list(enumerate(ODD)) + [(3, "a"), (None, "b"), (None, "b")])
    labels = spark.createDataFrame(
        [(i % 7, i % 2, i % 2) for i in range(14)] + [(None, 1, 1), (5, None, None), (6, 9, 9)],
        "doc_id long, quality int, toxic int",
    )
    found = score_of(rows, labels).collect()
    assert len(found) == len(ODD) + 3 and all(0 <= row.score <= 1 for row in found)
    no_labels = score_of(rows, labels.where("false")).collect()
    assert {row.score for row in no_labels} == {0.5}
    assert {row.predicted for row in no_labels} == {1 if name == "quality" else 0}
    assert score_of(rows.where("false"), labels).count() == 0


@pytest.mark.parametrize("keep", [good_texts, civil_texts])
def test_filters_keep_columns(spark, docs, keep):
    rows = docs(ODD)
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int").where("false")
    kept = keep(rows, labels)
    assert kept.schema == rows.schema and kept.count() == len(ODD)
    assert keep(rows.where("false"), labels).count() == 0


def test_held_out_labels_are_never_read(spark, docs):
    """Turning the labels of held-out ids leaves every score as it is."""
    texts = [("good plain text here " * (3 + i % 5)) if i % 2 else ("$$$ ### " * (4 + i % 7)) for i in range(120)]
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(120)], "doc_id long, quality int, toxic int")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    rows = docs(texts)
    one, two = (
        [tuple(r) for r in quality_scores(rows, some).orderBy("doc_id").collect()] for some in (labels, turned)
    )
    assert one == two
    assert all(row[3] == row[0] % 2 for row in one)


def test_scores_are_sums_of_table_entries():
    draw = np.random.default_rng(5)
    values = draw.random((2000, 3))
    labels = ((values[:, 0] > 0.5) ^ (values[:, 1] > 0.5)).astype(float)
    model = fit(values, labels, rounds=20, pair_rounds=40, pairs=2)
    assert (0, 1) in model.pairs  # the interaction alone explains the label
    assert ((model.score(values) > 0.5) == labels).mean() > 0.95
    total = np.full(2000, model.intercept)
    for f in range(3):
        total += model.tables[f][[int((model.edges[f] <= v).sum()) for v in values[:, f]]]
    for (a, b), table in model.pairs.items():
        rows = [int((model.coarse[a] <= v).sum()) for v in values[:, a]]
        total += table[rows, [int((model.coarse[b] <= v).sum()) for v in values[:, b]]]
    assert np.allclose(model.score(values), 1 / (1 + np.exp(-total)))


def test_features_do_not_depend_on_neighbours():
    texts = [t for t in ODD if t is not None] + ["One two, two! THREE 4", "a b a b"]
    together = features(pa.array(texts))
    assert together.shape == (len(texts), len(FEATURES)) and np.isfinite(together).all()
    for text, row in zip(texts, together):
        assert np.allclose(features(pa.array([text]))[0], row)
    named = dict(zip(FEATURES, features(pa.array(["aa aa bb! CCC"]))[0]))
    assert named["distinct"] == 0.75 and named["repeats"] == 0.25 and named["marked_words"] == 0.25
    assert named["capital_words"] == 0.25 and named["word_length"] == 13 / 4


def test_trees_learn_and_calibration_rises():
    draw = np.random.default_rng(6)
    values = draw.random((3000, 4))
    labels = ((values[:, 0] > 0.3) & (values[:, 2] < 0.6)).astype(float)
    model = boost(values[:2000], labels[:2000])
    raw = model.raw(values[2000:])
    assert ((raw > 0) == labels[2000:]).mean() > 0.97
    x, y = isotonic(raw, labels[2000:])
    assert (np.diff(x) >= 0).all() and (np.diff(y) >= 0).all() and 0 < y.min() and y.max() < 1
    assert len(isotonic(np.zeros(0), np.zeros(0))[0]) == 0


def test_lexicon_is_learned_from_labels(spark):
    texts = [("you are a grumbleflop today", 1, 0)] * 20 + [("you are a fine person today", 0, n % 2) for n in range(40)]
    texts += [("a snarkle it is", 1, n % 2) for n in range(20)]
    first, second, lexicon = toxicity.learn_lexicons(spark.createDataFrame(texts, "text string, label int, fold int"), 2)
    column = pa.array(["grumbleflop", "snarkle"])
    seen = [(one := toxicity.features(column, some))[0].sum() > 2 and one[1].sum() > 2 for some in (first, lexicon)]
    assert seen == [False, True] and len(first.keys) < len(second.keys) == len(lexicon.keys)
    column = pa.array(["such a grumbleflop", "such a person", None, ""])
    hits = toxicity.features(column, lexicon)
    assert hits[0].sum() > hits[1].sum() and np.isfinite(hits).all()


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_a_smaller_sample_keeps_the_decisions(spark, docs, name):
    """Four in ten borderline texts are of the rare class, and no other text but
    a few plain cases is: thinning the common class must not turn them."""
    rows, labels = [], []
    for i in range(2400):
        kind = 0 if i % 40 == 0 else 1 if i % 4 == 0 else 2
        text = ["you idiot moron scum $$$ ### ", "WHAT IS THIS!!! ", "a calm and plain remark about rivers "][kind]
        rare = [1, int(i // 4 % 10 < 4), 0][kind]
        rows.append((i, text * (2 + i % 3)))
        labels.append((i, 1 - rare, rare))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    score_of = quality_scores if name == "quality" else toxicity_scores
    found = []
    for per_class in (8000, 150):
        scored = score_of(docs(rows), labels, per_class=per_class).select("doc_id", "predicted", "score").collect()
        found.append({row.doc_id: row for row in scored})
    every, few = found
    assert np.mean([every[i].predicted == few[i].predicted for i in every]) > 0.98
    border = [i for i in every if i % 40 and i % 4 == 0]
    means = [np.mean([one[i].score for i in border]) for one in found]
    assert abs(means[0] - means[1]) < 0.12 and abs(means[0] - (0.4 if name == "toxic" else 0.6)) < 0.1


@pytest.mark.parametrize("score_of", [quality_scores, toxicity_scores])
def test_of_repeated_ids_one_row_is_learned_from(spark, docs, score_of):
    """Whatever the order the rows are read in, and however many there are."""
    texts = [(n % 40, f"{'good plain words' if n % 40 % 2 else 'you IDIOT !!! $$$'} {n} and more of it") for n in range(400)]
    labels = spark.createDataFrame([(n, n % 2, 1 - n % 2) for n in range(40)], "doc_id long, quality int, toxic int")
    first = sampled_texts(docs(texts), labels.selectExpr("doc_id", "quality label", "1.0D weight"))
    assert first.count() == 40 == first.select("doc_id").distinct().count()
    asked = docs([(900, "good plain words"), (901, "you IDIOT")])

    def scores(rows):
        frame = docs(rows).repartition(5).unionByName(asked)
        return sorted((row.doc_id, row.score) for row in score_of(frame, labels).collect() if row.doc_id >= 900)

    assert scores(texts) == scores(texts[::-1]) == scores(texts + texts)


def test_isotonic_blocks_equal_the_best_monotone_fit():
    """Pooling gives the rising steps with the least squared error (min-max formula)."""
    draw = np.random.default_rng(6)
    for _ in range(30):
        raw = np.sort(draw.normal(size=draw.integers(1, 25)))
        label, weight = draw.integers(0, 2, len(raw)).astype(float), draw.uniform(0.5, 3, len(raw))
        weight /= weight.mean()
        x, y = isotonic(raw, label, weight)
        expected = [
            max(
                min((label[i : j + 1] * weight[i : j + 1]).sum() / weight[i : j + 1].sum() for j in range(at, len(raw)))
                for i in range(at + 1)
            )
            for at in range(len(raw))
        ]
        blocks = np.concatenate([[0], np.cumsum(np.abs(np.diff(expected)) > 1e-12)])
        ones, all_ = np.bincount(blocks, weight * label), np.bincount(blocks, weight)
        smoothed = np.maximum.accumulate((ones + 0.5) / (all_ + 1))
        assert np.interp(raw, x, y) == pytest.approx(smoothed[blocks])
